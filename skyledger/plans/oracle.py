"""DuckDB SQL for the registered queries: named parts, joined to one WITH query each by the names they mention."""

from __future__ import annotations

import re

from skyledger.functions.values import POINTS, QUALITY_FLAGS
from skyledger.operators import textcheck
from skyledger.plans.data_tests import IDENTITY, TESTS, name_of
from skyledger.plans.tables import DAYS, MODEL, VERSION
from skyledger.sources import feed
from skyledger.sources.files import STATION_LAYOUT


def lit(v: object) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).upper() if isinstance(v, bool) else repr(v) + ("::DOUBLE" if isinstance(v, float) else "")


def values(rows: list[tuple], names: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") v({names})"


KEY, ORDER = "station_id, obs_date, element", "value, mflag, qflag, sflag, obs_time"
FLAGS = "concat_ws('|', coalesce({0}mflag, ''), coalesce({0}qflag, ''), coalesce({0}sflag, ''), coalesce({0}obs_time, ''))"
DAY = "CASE WHEN regexp_full_match({0}, '[0-9]{{8}}') THEN try_strptime({0}, '%Y%m%d')::DATE END"
LINE = "concat_ws(',', coalesce(station_id, ''), coalesce(obs_date, ''), coalesce(element, ''), coalesce(value, ''), coalesce(mflag, ''), coalesce(qflag, ''), coalesce(sflag, ''), coalesce(obs_time, ''))"
USABLE = "('valid', 'trace')"
QUARANTINED = "('qc_failed', 'out_of_bounds', 'inconsistent', 'unparseable')"
ELEMENTS = [e for e, *_ in feed.CATALOG if "*" not in e]
SHORT = "regexp_replace({0}::VARCHAR, '\\.0$', '')"
KM = ("round(6371 * 2 * asin(sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))), 1)")
USER = "substr({0}, 4, 8)::INT"

_ASSESS = """SELECT o.*, CASE WHEN o.obs_date IS NOT NULL AND o.element IN ('TMAX', 'TMIN') AND i.station_id IS NOT NULL THEN 'inconsistent' ELSE o.s END AS quality_status
FROM {0} o LEFT JOIN {1} i ON i.station_id = o.station_id AND i.obs_date = o.obs_date"""
_CHECKED = f"""SELECT m.station_id, m.obs_date AS obs_date_text, m.element, {DAY.format('m.obs_date')} AS obs_date, TRY_CAST(m.value AS INT) AS raw_value,
 (TRY_CAST(m.value AS INT) * e.scale)::DECIMAL(12,1) AS value, e.unit, m.mflag, m.qflag, m.mflag = 'T' AS is_trace,
 CASE WHEN {DAY.format('m.obs_date')} IS NULL OR TRY_CAST(m.value AS INT) IS NULL THEN 'unparseable' WHEN m.qflag IS NOT NULL THEN 'qc_failed'
  WHEN TRY_CAST(m.value AS INT) * e.scale < e.lower_bound OR TRY_CAST(m.value AS INT) * e.scale > e.upper_bound THEN 'out_of_bounds'
  WHEN m.mflag = 'T' THEN 'trace' ELSE 'valid' END AS s, e.policy_hash, m.run_id AS raw_run_id, m.last_changed_at
FROM @rows m JOIN elements_in_scope e USING (element) WHERE m.station_id IN (SELECT station_id FROM selected)"""
_INVERTED = """SELECT station_id, obs_date, min(value) FILTER (element = 'TMAX') AS tmax, max(value) FILTER (element = 'TMIN') AS tmin
FROM {0} WHERE s = 'valid' AND element IN ('TMAX', 'TMIN') AND obs_date IS NOT NULL GROUP BY ALL HAVING min(value) FILTER (element = 'TMAX') < max(value) FILTER (element = 'TMIN')"""
_FCT = """SELECT station_id, obs_date_text, element, obs_date, raw_value, value, quality_status, is_trace, quality_status IN ('valid', 'trace') AS is_usable, false AS is_deleted, raw_run_id, qflag, policy_hash FROM {0}"""

IN_SQL = {"log": "change_log", "elements": "elements_in_scope", "reported": "station_elements"}


def failing_rows(test: tuple) -> str:
    """The failures of one data test, to be put after other SELECTs."""
    kind, table, columns, given, severity = test
    text, of, c = lambda names: ", ".join(f"{n}::VARCHAR AS {n}" for n in names), IN_SQL.get(table, table), columns[0]
    if kind == "unique":
        rows = f"SELECT {text(columns)}, count(*) AS n_rows FROM {of} WHERE {f'{c} IS NOT NULL' if len(columns) == 1 else 'true'} GROUP BY {', '.join(columns)} HAVING count(*) > 1"
    else:
        wrong = {
            "not_null": lambda: f"{c} IS NULL", "accepted_values": lambda: f"{c} NOT IN ({', '.join(map(lit, given))})", "within_bounds": lambda: f"({c} < {given[0]} OR {c} > {given[1]})",
            "relationships": lambda: f"{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {IN_SQL.get(given[0], given[0])} p WHERE p.{given[1]} = x.{c})",
        }[kind]()
        rows = f"SELECT {text(IDENTITY[table])} FROM {of} x WHERE {wrong}"
    return f"\nUNION ALL SELECT '{name_of(kind, table, columns)}', '{table}', '{severity}', to_json(t)::VARCHAR FROM ({rows}) t"


def wide(grid: str, elements: list[str]) -> str:
    return "SELECT g.station_id, obs_date, " + ", ".join(
        f"max(value) FILTER (element = '{e}') AS {e.lower()}, max(status) FILTER (element = '{e}') AS {e.lower()}_status" for e in elements) + f""",
 count(*) FILTER (is_core AND is_expected) AS core_expected, count(*) FILTER (is_core AND is_expected AND status IN ('valid', 'trace', 'not_reported')) AS core_present,
 string_agg(element, ', ' ORDER BY element) FILTER (status = 'missing') AS missing_elements, string_agg(element, ', ' ORDER BY element) FILTER (status IN {QUARANTINED}) AS quarantined_elements,
 s.city, s.station_name FROM {grid} g JOIN selected s USING (station_id) GROUP BY g.station_id, obs_date, s.city, s.station_name"""


PARTS = {
    "feed": """SELECT event_id, user_id, 'CAN' || lpad(user_id::VARCHAR, 8, '0') AS station_id,
 CASE WHEN event_id % 73 = 0 THEN left(strftime(ts, '%Y%m%d'), 7) ELSE strftime(ts, '%Y%m%d') END AS obs_date, element,
 CASE WHEN event_id % 71 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN '0' ELSE (CASE WHEN element IN ('TMAX', 'TMIN', 'TAVG') THEN tenths % 900 - 200
  WHEN element = 'WDFG' THEN tenths % 36 * 10 WHEN element IN ('SNOW', 'SNWD') THEN tenths % 1200 ELSE tenths END)::VARCHAR END AS value,
 CASE WHEN event_id % 11 = 0 THEN 'T' END AS mflag, CASE WHEN event_id % 17 = 0 THEN 'I' END AS qflag, 'C' AS sflag, NULL::VARCHAR AS obs_time
FROM (SELECT *, floor(value * 10)::BIGINT AS tenths, CASE event_type WHEN 'view' THEN CASE WHEN event_id % 5 = 0 THEN 'TAVG' ELSE 'TMAX' END WHEN 'click' THEN 'TMIN'
 WHEN 'purchase' THEN 'PRCP' WHEN 'signup' THEN CASE WHEN event_id % 4 = 0 THEN 'WDFG' ELSE 'SNOW' END ELSE CASE WHEN event_id % 3 = 0 THEN 'WSFG' ELSE 'SNWD' END END AS element FROM events)""",
    "v1": f"SELECT event_id, station_id AS file_station, {KEY}, {ORDER} FROM feed WHERE event_id % 89 <> 0",
    "v2": """SELECT event_id, station_id AS file_station, CASE WHEN event_id % 103 = 0 THEN 'XXX00000000' ELSE station_id END AS station_id, obs_date, element,
 CASE WHEN event_id % 53 = 0 THEN coalesce((TRY_CAST(value AS BIGINT) + 1)::VARCHAR, value) ELSE value END AS value, mflag,
 CASE WHEN event_id % 59 = 0 THEN 'G' ELSE qflag END AS qflag, sflag, obs_time FROM feed WHERE event_id % 97 <> 0""",
    "metadata": """SELECT user_id, 'CAN' || lpad(user_id::VARCHAR, 8, '0') AS id, 'R' || n_regionkey AS state,
 'N' || c_nationkey || ' ' || ['INTL A', 'A', 'AP', 'CENTRE', 'INT', 'HARBOUR'][user_id % 6 + 1] AS name, CASE WHEN user_id % 3 = 0 THEN lpad(user_id::VARCHAR, 5, '0') ELSE '' END AS wmo_id,
 printf('%.4f', 45.0 + c_nationkey % 5 + ((user_id * 37) % 100) * 0.0005) AS latitude, printf('%.4f', -75.0 - c_nationkey % 7 - ((user_id * 53) % 100) * 0.0005) AS longitude,
 CASE WHEN user_id % 10 = 0 THEN '-999.9' ELSE (user_id % 500)::VARCHAR || '.5' END AS elevation, CASE WHEN user_id % 4 = 0 THEN 'GSN' ELSE '' END AS gsn_flag, '' AS hcn_crn_flag, c_nationkey
FROM (SELECT DISTINCT user_id FROM events) JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey""",
    "stations": """SELECT id AS station_id, left(id, 2) AS country_code, substr(id, 3, 1) AS network_code, substr(id, 4) AS network_station_id, latitude::DOUBLE AS latitude, longitude::DOUBLE AS longitude,
 nullif(elevation, '-999.9')::DOUBLE AS elevation_m, state AS state_code, name AS station_name, gsn_flag = 'GSN' AS is_gsn, hcn_crn_flag, wmo_id FROM metadata""",
    "selected": "SELECT 'Town ' || user_id AS city, m.state AS province, s.* FROM metadata m JOIN stations s ON s.station_id = m.id WHERE user_id % 5 <> 4",
    "inventory": "SELECT DISTINCT station_id, element, (2010 + user_id % 15)::INT AS first_year, CASE WHEN user_id % 7 = 0 AND element IN ('SNWD', 'PRCP') THEN 2023 ELSE 2024 END AS last_year FROM feed",
    "catalog": values(feed.CATALOG, "element, description, unit, scale, is_core"),
    "policy": values(feed.POLICY, "element, excluded, absent_means_zero, persistent, fed_by, lower_bound, upper_bound, display_unit, display_factor"),
    "scope": values([feed.SCOPE], "a, b, freshness_warn_days, freshness_error_days, volume_change_warn_pct").replace("SELECT *", "SELECT a::DATE AS start_date, b::DATE AS end_date, freshness_warn_days, freshness_error_days"),
    "scoped_elements": "SELECT DISTINCT element FROM inventory CROSS JOIN scope WHERE station_id IN (SELECT station_id FROM selected) AND first_year <= year(end_date) AND last_year >= year(start_date)",
    "elements_in_scope": """SELECT element, regexp_replace(description, '\\s*[(\\[].*$', '') AS label, unit, scale, is_core, coalesce(absent_means_zero, false) AS absent_means_zero, coalesce(persistent, false) AS persistent,
 fed_by, lower_bound, upper_bound, coalesce(display_unit, unit) AS display_unit, coalesce(display_factor, 1.0)::DOUBLE AS display_factor,
 md5(concat_ws('|', scale::VARCHAR, coalesce(absent_means_zero, false)::VARCHAR, coalesce(lower_bound::VARCHAR, '∅'), coalesce(upper_bound::VARCHAR, '∅'))) AS policy_hash
FROM catalog LEFT JOIN policy USING (element) WHERE element IN (FROM scoped_elements) AND NOT regexp_matches(element, '[*#]') AND NOT coalesce(excluded, false)""",
    "station_elements": "SELECT station_id, element, first_year, last_year FROM inventory WHERE station_id IN (SELECT station_id FROM selected) AND element IN (SELECT element FROM elements_in_scope)",
    "stored0": f"SELECT {KEY}, {ORDER} FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY value NULLS LAST, mflag NULLS LAST, qflag NULLS LAST, sflag NULLS LAST, obs_time NULLS LAST) AS n FROM v1) WHERE n = 1",
    "stored": f"SELECT *, md5(concat_ws('|', coalesce(value, ''), {FLAGS.format('')})) AS row_hash, TIMESTAMP '{feed.LOADED_AT}' AS first_loaded_at, TIMESTAMP '{feed.LOADED_AT}' AS last_changed_at, '{feed.FIRST_RUN}' AS run_id FROM stored0",
    "ranked2": f"SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY value NULLS LAST, mflag NULLS LAST, qflag NULLS LAST, sflag NULLS LAST, obs_time NULLS LAST) AS n FROM v2 WHERE station_id = file_station",
    "incoming": f"SELECT {KEY}, {ORDER}, md5(concat_ws('|', coalesce(value, ''), {FLAGS.format('')})) AS row_hash FROM ranked2 WHERE n = 1",
    "found_changes": f"""SELECT coalesce(o.station_id, i.station_id) AS station_id, coalesce(o.obs_date, i.obs_date) AS obs_date, coalesce(o.element, i.element) AS element,
 CASE WHEN o.row_hash IS NULL THEN 'insert' WHEN i.row_hash IS NULL THEN 'delete' ELSE 'update' END AS change, o.value AS old_value, i.value AS new_value,
 CASE WHEN o.row_hash IS NOT NULL THEN {FLAGS.format('o.')} END AS old_flags, CASE WHEN i.row_hash IS NOT NULL THEN {FLAGS.format('i.')} END AS new_flags
FROM stored o FULL JOIN incoming i ON o.station_id = i.station_id AND o.obs_date = i.obs_date AND o.element = i.element WHERE o.row_hash IS DISTINCT FROM i.row_hash""",
    "deletes_guard": f"""SELECT station_id, coalesce(deleted, 0) AS deleted, existing, 100.0 * coalesce(deleted, 0) / existing > {feed.MAX_DELETED_PCT} AS refused
FROM (SELECT station_id, count(*) AS existing FROM stored GROUP BY 1) LEFT JOIN (SELECT station_id, count(*) AS deleted FROM found_changes WHERE change = 'delete' GROUP BY 1) USING (station_id)""",
    "changes": "SELECT * FROM found_changes WHERE station_id NOT IN (SELECT station_id FROM deletes_guard WHERE refused)",
    "change_log": f"""SELECT '{feed.FIRST_RUN}' AS run_id, {KEY}, 'insert' AS change, NULL AS old_value, value AS new_value, NULL AS old_flags, {FLAGS.format('')} AS new_flags, TIMESTAMP '{feed.LOADED_AT}' AS changed_at FROM stored
UNION ALL SELECT '{feed.SECOND_RUN}', {KEY}, change, old_value, new_value, old_flags, new_flags, TIMESTAMP '{feed.CHANGED_AT}' FROM changes""",
    "merged": f"""SELECT s.* FROM stored s ANTI JOIN (SELECT * FROM changes WHERE change <> 'insert') c USING ({KEY})
UNION ALL SELECT i.station_id, i.obs_date, i.element, i.value, i.mflag, i.qflag, i.sflag, i.obs_time, i.row_hash, f.first, TIMESTAMP '{feed.CHANGED_AT}', '{feed.SECOND_RUN}'
FROM incoming i SEMI JOIN (SELECT * FROM changes WHERE change <> 'delete') c USING ({KEY}) LEFT JOIN (SELECT {KEY}, min(changed_at) AS first FROM change_log WHERE change = 'insert' GROUP BY ALL) f USING ({KEY})""",
    "rejects": f"""SELECT file_station, {LINE} AS line, 'filed under another station''s name: ' || station_id AS reason FROM v2 WHERE station_id <> file_station
UNION ALL SELECT file_station, {LINE}, 'second row of ' || obs_date || ', ' || element || '; the first in order stays' FROM ranked2 WHERE n > 1""",
    "checked": _CHECKED.replace("@rows", "merged"), "checked0": _CHECKED.replace("@rows", "stored"), "inverted": _INVERTED.format("checked"), "inverted0": _INVERTED.format("checked0"),
    "assessed": _ASSESS.format("checked", "inverted"), "assessed0": _ASSESS.format("checked0", "inverted0"),
    "removed": "SELECT station_id, obs_date AS obs_date_text, element, max(changed_at) AS changed_at, max(run_id) AS run_id FROM change_log WHERE change = 'delete' GROUP BY ALL",
    "tombstones": f"""SELECT station_id, obs_date_text, element, {DAY.format('obs_date_text')} AS obs_date, NULL::INT AS raw_value, NULL::DECIMAL(12,1) AS value, 'removed_at_source' AS quality_status, false AS is_trace,
 false AS is_usable, true AS is_deleted, run_id AS raw_run_id, NULL AS qflag, NULL AS policy_hash
FROM removed ANTI JOIN assessed USING (station_id, obs_date_text, element) WHERE station_id IN (SELECT station_id FROM selected) AND element IN (SELECT element FROM elements_in_scope)""",
    "fct": _FCT.format("assessed") + " UNION ALL SELECT * FROM tombstones", "fct0": _FCT.format("assessed0"),
    "spine": "SELECT unnest(generate_series(start_date, least(end_date, latest), INTERVAL 1 DAY))::DATE AS obs_date FROM scope, (SELECT max(obs_date) AS latest FROM fct WHERE NOT is_deleted)",
    "cells": """SELECT s.station_id, p.obs_date, e.element, e.unit, e.is_core, e.absent_means_zero, e.persistent, e.fed_by, r.station_id IS NOT NULL AS is_expected,
 f.station_id IS NOT NULL AS has_row, f.quality_status, f.is_usable, f.value AS observed, f.is_trace, f.qflag, f.raw_value
FROM selected s CROSS JOIN spine p CROSS JOIN elements_in_scope e LEFT JOIN station_elements r ON r.station_id = s.station_id AND r.element = e.element AND year(p.obs_date) BETWEEN r.first_year AND r.last_year
LEFT JOIN fct f ON f.station_id = s.station_id AND f.obs_date = p.obs_date AND f.element = e.element AND NOT f.is_deleted""",
    "neighbours": """SELECT *, last_value(CASE WHEN is_usable THEN observed END IGNORE NULLS) OVER (PARTITION BY station_id, element ORDER BY obs_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
 first_value(CASE WHEN is_usable THEN observed END IGNORE NULLS) OVER (PARTITION BY station_id, element ORDER BY obs_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM cells""",
    "present": """SELECT n.*, n.absent_means_zero AND NOT coalesce(n.persistent AND ((n.before > 0 AND n.after > 0) OR coalesce(d.observed, 0) > 0), false) AS nothing
FROM neighbours n LEFT JOIN neighbours d ON d.station_id = n.station_id AND d.obs_date = n.obs_date AND d.element = n.fed_by AND d.is_usable""",
    "grid": """SELECT station_id, obs_date, element, unit, is_core, is_expected,
 CASE WHEN has_row THEN quality_status WHEN NOT is_expected THEN 'not_expected' WHEN nothing THEN 'not_reported' ELSE 'missing' END AS status,
 CASE WHEN is_usable THEN observed::DOUBLE WHEN NOT has_row AND is_expected AND nothing THEN 0.0 END AS value, coalesce(is_trace, false) AS is_trace, qflag, raw_value FROM present""",
    "daily": wide("grid", ELEMENTS),
    "by_status": "SELECT station_id, element, count(*) FILTER (is_expected) AS expected_days, " + ", ".join(
        f"count(*) FILTER (status = '{s}') AS {s}_days" for s in ("valid", "trace", "missing", "not_reported", "qc_failed", "out_of_bounds", "inconsistent", "unparseable")
    ) + f", min(obs_date) FILTER (status IN {USABLE}) AS first_usable_date, max(obs_date) FILTER (status IN {USABLE}) AS last_usable_date FROM grid GROUP BY ALL",
    "quality": """SELECT s.city, b.*, CASE WHEN expected_days > 0 THEN round((valid_days + trace_days + not_reported_days) / expected_days, 4) END AS completeness, (end_date - last_usable_date)::INT AS days_since_last,
 CASE WHEN expected_days = 0 THEN 'not_expected' WHEN e.absent_means_zero THEN 'not_applicable' WHEN last_usable_date IS NULL OR end_date - last_usable_date > freshness_error_days THEN 'stale'
  WHEN end_date - last_usable_date > freshness_warn_days THEN 'lagging' ELSE 'fresh' END AS freshness
FROM by_status b JOIN selected s USING (station_id) JOIN elements_in_scope e USING (element) CROSS JOIN scope""",
    "facts": f"""SELECT g.station_id, g.obs_date, list({{'element': g.element, 'label': e.label, 'value': CASE WHEN status IN {USABLE} THEN round(g.value * e.display_factor, 1) END, 'unit': e.display_unit, 'status': g.status,
 'compass': CASE WHEN e.unit = 'degrees' AND status IN {USABLE} THEN {POINTS!r}[(round(g.value / 45)::INT % 8) + 1] END}} ORDER BY e.is_core DESC, g.element) AS fact_list
FROM grid g JOIN elements_in_scope e USING (element) WHERE status <> 'not_expected' GROUP BY ALL""",
    "sheets": "SELECT station_id, city, province, station_name, obs_date, fact_list, to_json(fact_list)::VARCHAR AS facts, md5(to_json(fact_list)::VARCHAR) AS input_hash FROM facts JOIN selected USING (station_id)",
    "named": "SELECT *, " + ", ".join(f"list_filter(fact_list, lambda f: f.element = '{e}')[1] AS {e.lower()}" for e in ("TMAX", "TMIN", "PRCP", "SNOW", "SNWD", "WSFG")) + " FROM sheets",
    "usables": "SELECT *, " + ", ".join(f"coalesce({e}.status IN {USABLE} AND {e}.value IS NOT NULL, false) AS u_{e}" for e in ("tmax", "tmin", "prcp", "snow", "snwd", "wsfg")) + " FROM named",
    "sentences": f"""SELECT *, CASE WHEN u_tmax AND u_tmin THEN city || ' reached a high of ' || {SHORT.format('tmax.value')} || ' °C and a low of ' || {SHORT.format('tmin.value')} || ' °C.'
  ELSE 'Temperature readings for ' || city || ' were not available.' END AS s1,
 CASE WHEN coalesce(prcp.status, '') = 'trace' THEN 'There was a trace of precipitation.' WHEN u_prcp AND prcp.value > 0 THEN {SHORT.format('prcp.value')} || ' mm of precipitation fell.'
  WHEN coalesce(prcp.status, '') = 'valid' THEN 'It stayed dry.' ELSE 'The precipitation reading was not available.' END AS s2,
 u_snow AND coalesce(snow.value > 0, false) AS snowed, CASE WHEN u_wsfg THEN 'Gusts peaked at ' || round(wsfg.value)::BIGINT || ' km/h.' END AS s3,
 u_prcp AND coalesce(prcp.value > 0, false) AND prcp.status <> 'trace' AS rained FROM usables""",
    "drafts": f"""SELECT *, concat_ws(' ', s1, CASE WHEN snowed THEN rtrim(s2, '.') || ', with ' || {SHORT.format('snow.value')} || ' cm of snow.' ELSE s2 END, s3) AS draft,
 list_concat(list_concat(CASE WHEN u_tmax AND u_tmin THEN [{{'element': 'TMAX', 'value': tmax.value}}, {{'element': 'TMIN', 'value': tmin.value}}] ELSE [] END,
 CASE WHEN coalesce(rained, false) THEN [{{'element': 'PRCP', 'value': prcp.value}}] ELSE [] END),
 list_concat(CASE WHEN snowed THEN [{{'element': 'SNOW', 'value': snow.value}}] ELSE [] END, CASE WHEN u_wsfg THEN [{{'element': 'WSFG', 'value': wsfg.value}}] ELSE [] END)) AS cited,
 ({USER.format('station_id')} + day(obs_date)) % 9 AS kind FROM sentences""",
    "texts": """SELECT *, CASE kind WHEN 1 THEN draft || ' Expect sunny skies tomorrow.' WHEN 2 THEN 'A high of 99 °C. ' || draft WHEN 3 THEN draft || ' It stayed dry.' WHEN 4 THEN draft || ' Wind came from the NW.'
 WHEN 5 THEN draft || ' Town 3 was dry.' WHEN 6 THEN 'Heavy rain fell. ' || draft WHEN 7 THEN draft || ' No snow on the ground; the temperature was missing.'
 WHEN 8 THEN draft || ' Northerly wind, 12.0 degrees C.' ELSE draft END AS narrative FROM drafts""",
    "coverage": f"""SELECT station_id, count(DISTINCT element) AS elements, count(DISTINCT element) FILTER (element IN {tuple(feed.REQUIRED)} AND first_year <= 2024 AND last_year >= 2024) AS required_covered,
 min(first_year) AS first_year, max(last_year) AS last_year FROM inventory GROUP BY 1""",
    "cities": "SELECT 'City ' || c_nationkey AS city, state AS province, 'N' || c_nationkey || ' ' AS prefix, CASE WHEN c_nationkey % 9 = 0 THEN max(id) END AS pinned_id FROM metadata GROUP BY c_nationkey, state",
    "known": "SELECT s.*, coalesce(elements, 0) AS elements, coalesce(required_covered, 0) AS required_covered, last_year FROM stations s LEFT JOIN coverage USING (station_id)",
    "named_like": "SELECT c.city, c.province, k.* FROM cities c JOIN known k ON c.pinned_id IS NULL AND k.country_code = 'CA' AND k.state_code = c.province AND starts_with(k.station_name, c.prefix)",
    "anchors": r"""SELECT * FROM named_like WHERE regexp_matches(station_name, ' (A|AP|INT)$') QUALIFY row_number() OVER (PARTITION BY city, province ORDER BY NOT regexp_matches(station_name, '\bINT(L|''L|ERCONTINENTAL)?\b'),
 required_covered DESC, coalesce(last_year, 0) DESC, coalesce(trim(wmo_id), '') = '', elements DESC, station_id) = 1""",
    "near": f"""SELECT a.city, a.province, a.station_id AS anchor_id, a.station_name AS anchor_name, a.required_covered AS anchor_covered, k.*, {KM.format(a='a.latitude', b='a.longitude', c='k.latitude', d='k.longitude')} AS distance_km
FROM anchors a JOIN known k ON k.country_code = a.country_code AND {KM.format(a='a.latitude', b='a.longitude', c='k.latitude', d='k.longitude')} <= {feed.MAX_KM}""",
    "ranked_near": "SELECT *, CASE WHEN required_covered = 3 THEN row_number() OVER (PARTITION BY city, province, required_covered = 3 ORDER BY distance_km, elements DESC, station_id) END AS rank FROM near",
    "resolved": """SELECT city, province, station_id, station_name, required_covered = 3 AS selected, CASE WHEN required_covered = 3 THEN 1 END AS rank,
 CASE WHEN required_covered = 3 THEN 'selected: pinned in config' ELSE 'reports ' || required_covered || ' of 3 required elements' END AS reason FROM cities JOIN known ON station_id = pinned_id
UNION ALL SELECT city, province, station_id, station_name, coalesce(rank = 1, false), rank, CASE WHEN required_covered <> 3 THEN 'reports ' || required_covered || ' of 3 required elements'
 WHEN rank > 1 THEN 'ranked lower: ' || printf('%.1f', distance_km) || ' km from ' || anchor_name WHEN station_id = anchor_id THEN 'selected: the airport''s own station'
 ELSE 'selected: ' || printf('%.1f', distance_km) || ' km from ' || anchor_name || ', which reports ' || anchor_covered || ' of 3' END FROM ranked_near
UNION ALL SELECT n.city, n.province, n.station_id, n.station_name, false, NULL, CASE WHEN NOT regexp_matches(n.station_name, ' (A|AP|INT)$') THEN 'name isn''t an airport''s'
 ELSE 'ranked lower than the city''s airport, ' || a.station_name END FROM named_like n LEFT JOIN anchors a ON a.city = n.city AND a.province = n.province
 WHERE NOT EXISTS (SELECT 1 FROM near x WHERE x.city = n.city AND x.province = n.province AND x.station_id = n.station_id)""",
    "failures": """SELECT 'not_null_obs_date' AS test_name, 'fct_observations' AS tested, 'warn' AS severity, to_json(t)::VARCHAR AS failing_row FROM (SELECT station_id, obs_date_text, element FROM fct WHERE obs_date IS NULL) t
UNION ALL SELECT 'value_within_300', 'fct_observations', 'warn', to_json(t)::VARCHAR FROM (SELECT station_id, obs_date::VARCHAR AS obs_date, element FROM fct WHERE is_usable AND (value < -300 OR value > 300)) t
UNION ALL SELECT 'stations_fresh', 'data_quality', 'error', to_json(t)::VARCHAR FROM (SELECT station_id, element FROM quality WHERE freshness = 'stale') t
UNION ALL SELECT 'every_city_has_a_station', 'cities', 'error', to_json(t)::VARCHAR FROM (SELECT city FROM cities WHERE city NOT IN (SELECT city FROM resolved WHERE selected)) t
UNION ALL SELECT 'tavg_within_tmin_tmax', 'fct_observations', 'warn', to_json(t)::VARCHAR FROM (SELECT a.station_id, a.obs_date::VARCHAR AS obs_date FROM fct a JOIN fct i ON i.station_id = a.station_id AND i.obs_date = a.obs_date AND i.element = 'TMIN'
 JOIN fct x ON x.station_id = a.station_id AND x.obs_date = a.obs_date AND x.element = 'TMAX' WHERE a.element = 'TAVG' AND a.is_usable AND i.is_usable AND x.is_usable AND (a.value < i.value - 0.5 OR a.value > x.value + 0.5)) t
UNION ALL SELECT 'tmax_not_below_tmin', 'fct_observations', 'error', to_json(t)::VARCHAR FROM (SELECT x.station_id, x.obs_date::VARCHAR AS obs_date FROM fct x JOIN fct i ON i.station_id = x.station_id AND i.obs_date = x.obs_date
 WHERE x.element = 'TMAX' AND i.element = 'TMIN' AND x.is_usable AND i.is_usable AND x.value < i.value) t
UNION ALL SELECT 'single_row_scope', 'scope', 'error', to_json(t)::VARCHAR FROM (SELECT count(*) AS n_rows FROM scope HAVING count(*) <> 1) t
UNION ALL SELECT 'single_row_selected', 'selected', 'warn', to_json(t)::VARCHAR FROM (SELECT count(*) AS n_rows FROM selected HAVING count(*) <> 1) t""" + "".join(map(failing_rows, TESTS)),
    "source_changes": f"""SELECT l.run_id, l.station_id, s.city, min(changed_at) AS changed_at, count(*) FILTER (change = 'insert') AS inserted, count(*) FILTER (change = 'update') AS updated, count(*) FILTER (change = 'delete') AS deleted,
 count(*) FILTER (change = 'update' AND old_value IS DISTINCT FROM new_value) AS value_revisions, count(*) FILTER (change = 'update' AND old_value IS NOT DISTINCT FROM new_value) AS flag_revisions,
 count(*) FILTER (change IN ('update', 'delete') AND {DAY.format('obs_date')} < changed_at::DATE - 7) AS historical_changes, min({DAY.format('obs_date')}) AS earliest_date_touched, max({DAY.format('obs_date')}) AS latest_date_touched
FROM change_log l LEFT JOIN selected s USING (station_id) GROUP BY l.run_id, l.station_id, s.city""",
    "loads": f"""SELECT file_station AS file, count(*) AS rows_read, TIMESTAMP '{feed.LOADED_AT}' AS loaded_at FROM v1 GROUP BY 1
UNION ALL SELECT file_station, count(*), TIMESTAMP '{feed.CHANGED_AT}' FROM v2 GROUP BY 1""",
    "swings": "SELECT *, round(100 * (rows_read - rows_before) / rows_before, 2) AS swing_pct FROM (SELECT *, lag(rows_read) OVER (PARTITION BY file ORDER BY loaded_at) AS rows_before FROM loads) WHERE rows_before IS NOT NULL",
    "file_checks": f"""SELECT file_station AS station_id, count(*) FILTER (read AND station_id <> file_station) AS f,
 count(*) FILTER (read AND station_id = file_station) - count(DISTINCT (obs_date, element)) FILTER (read AND station_id = file_station) AS d, count(*) FILTER (NOT read) AS u
FROM (SELECT *, event_id % 101 <> 0 AND event_id % 107 <> 0 AS read FROM v2) GROUP BY 1""",
    "load_checks": f"""SELECT station_id, 'rows_belong_to_station' AS check_name, 'error' AS severity, f = 0 AS passed, f::DOUBLE AS observed, 0.0::DOUBLE AS expected FROM file_checks
UNION ALL SELECT station_id, 'unique_station_date_element', 'error', d = 0, d, 0 FROM file_checks UNION ALL SELECT station_id, 'parseable_rows', 'warn', u = 0, u, 0 FROM file_checks
UNION ALL SELECT station_id, 'deletes_within_limit', 'error', NOT refused, round(100 * deleted / existing, 4), {feed.MAX_DELETED_PCT} FROM deletes_guard""",
    "keyed": f"SELECT {KEY}, {ORDER}, row_hash FROM incoming SEMI JOIN (SELECT * FROM changes WHERE change = 'update') c USING ({KEY})",
    "lines": f"""SELECT *, row_number() OVER (PARTITION BY file_station ORDER BY event_id) AS line_number, CASE WHEN event_id % 101 = 0 THEN concat_ws(',', station_id, obs_date, element, value, coalesce(mflag, ''))
 WHEN event_id % 107 = 0 THEN {LINE} || ',extra' ELSE {LINE} END AS line FROM v1""",
    "lines2": f"""SELECT *, row_number() OVER (PARTITION BY file_station ORDER BY event_id) AS line_number, CASE WHEN event_id % 101 = 0 THEN concat_ws(',', station_id, obs_date, element, value, coalesce(mflag, ''))
 WHEN event_id % 107 = 0 THEN {LINE} || ',extra' ELSE {LINE} END AS line FROM v2""",
    "waiting": "SELECT 1 AS load, * FROM lines UNION ALL SELECT 2, * FROM lines2",
    "waiting_ranked": f"""SELECT *, row_number() OVER (PARTITION BY load, {KEY} ORDER BY value NULLS LAST, mflag NULLS LAST, qflag NULLS LAST, sflag NULLS LAST, obs_time NULLS LAST, line_number) AS n
FROM waiting WHERE event_id % 101 <> 0 AND event_id % 107 <> 0 AND station_id = file_station""",
    "quoted": f"""SELECT event_id, file_station, {KEY}, CASE WHEN event_id % 13 = 0 THEN value || ',5' ELSE value END AS value, mflag, CASE WHEN event_id % 37 = 0 THEN 'say "I", twice' ELSE qflag END AS qflag, sflag, obs_time FROM v1""",
    "quoted_fields": """SELECT *, CASE WHEN event_id % 13 = 0 THEN '"' || value || '"' ELSE value END AS value_written, CASE WHEN event_id % 37 = 0 THEN '"say ""I"", twice"' ELSE coalesce(qflag, '') END AS qflag_written FROM quoted""",
    "quoted_lines": """SELECT *, row_number() OVER (PARTITION BY file_station ORDER BY event_id) AS line_number,
 CASE WHEN event_id % 101 = 0 THEN concat_ws(',', station_id, obs_date, element, value_written, coalesce(mflag, ''))
  ELSE concat_ws(',', station_id, obs_date, element, value_written, coalesce(mflag, ''), qflag_written, sflag, coalesce(obs_time, '')) || CASE WHEN event_id % 107 = 0 THEN ',extra' ELSE '' END END AS line,
 CASE WHEN event_id % 101 = 0 THEN 'MISSING COLUMNS' WHEN event_id % 107 = 0 THEN 'TOO MANY COLUMNS' END AS reason FROM quoted_fields""",
    "new_pairs": f"""SELECT DISTINCT station_id, element FROM assessed EXCEPT SELECT station_id, element FROM fct0 WHERE {USER.format('station_id')} % 5 <> 0""",
    "noaa": f"SELECT station_id, obs_date AS obs_date_text, element FROM change_log WHERE changed_at > (SELECT max(last_changed_at) FROM assessed0)",
}

# Text checks. Clauses, numbers and compass points as lists; a pattern with lookaround is rephrased.
_NUM = r"(^|[^\w.])(-?[0-9]+(?:\.[0-9]+)?)"
_T = textcheck


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def status(e: str, *s: str) -> str:
    return f"coalesce({e}.status IN ({', '.join(map(lit, s))}), false)"


def zero(e: str) -> str:
    return f"({status(e, 'valid')} AND coalesce({e}.value = 0, false))"


def close(a: str, b: str) -> str:
    return f"coalesce(abs(({a}) - ({b})) <= {_T.TOLERANCE}, false)"


_SNOW = r"(?i)\bno\s+(new\s+)?snow(fall)?\b"
_SNOW_GROUND = r"(?i)\bno\s+(new\s+)?snow(fall)?\s+on\s+the\s+ground"
_CLAUSE_OK = f"""(CASE WHEN regexp_matches(c, {q(_T.NO_MEASURABLE)}) THEN {status('prcp', 'trace')} OR {zero('prcp')} WHEN regexp_matches(c, {q(_T.DRY)}) THEN {zero('prcp')} ELSE true END)
 AND (NOT regexp_matches(regexp_replace(c, {q(_SNOW_GROUND)}, '', 'g'), {q(_SNOW)}) OR {zero('snow')}) AND (NOT regexp_matches(c, {q(_T.NO_SNOW_ON_GROUND)}) OR {status('snwd', 'not_reported')} OR {zero('snwd')})"""
_GAP = " OR ".join(f"(regexp_matches(c, {q('(?i)' + chr(92) + 'b' + w)}) AND {' AND '.join(status(e.lower(), 'valid', 'trace') for e in es)})" for w, es in _T.TOPICS.items())


def claims(word: str, e: str) -> str:
    found = f"regexp_extract_all(narrative, {q(f'(?i){chr(92)}b{word}s?{chr(92)}b[^.;0-9-]{{0,20}}?(-?[0-9]+(?:{chr(92)}.[0-9]+)?){chr(92)}s*(?:°|degrees?{chr(92)}b)')}, 1)"
    return f"len(list_filter({found}, lambda n: NOT ({status(e, 'valid', 'trace')} AND {close('n::DOUBLE', e + '.value')}))) = 0"


def intensity(pattern: str, element: str, least: float | None, most: float | None) -> str:
    e = element.lower()
    value = f"CASE WHEN {status(e, 'valid', 'trace')} THEN {e}.value WHEN {e} IS NULL OR {status(e, 'not_reported')} THEN 0.0 END"
    tests = [f"({value}) IS NOT NULL"] + ([f"({value}) >= {least}"] if least is not None else []) + ([f"({value}) <= {most}"] if most is not None else [])
    return f"(NOT regexp_matches(narrative, {q('(?i)' + pattern)}) OR coalesce({' AND '.join(tests)}, false))"


_DATE_FREE = ("regexp_replace(regexp_replace(narrative, '(?i)\\b(?:' || strftime(obs_date, '%B') || '|' || strftime(obs_date, '%b') || '\\.?)\\s+0?' || day(obs_date) || '(?:st|nd|rd|th)?\\b', ' ', 'g'),"
              " '\\b' || year(obs_date) || '\\b', ' ', 'g')")
PARTS["text_results"] = f"""SELECT *,
 len(list_filter(cited, lambda c: NOT {close('c.value', 'list_filter(fact_list, lambda f: f.element = c.element)[1].value')})) = 0 AS cited_values_match,
 len(list_filter(cited, lambda c: NOT coalesce(list_filter(fact_list, lambda f: f.element = c.element)[1].status IN {USABLE}, false))) = 0 AS cited_only_usable,
 len(list_filter(regexp_extract_all(replace({_DATE_FREE}, ',', ''), {q(_NUM)}, 2), lambda n: len(list_filter(fact_list, lambda f: f.status IN {USABLE} AND f.value IS NOT NULL
  AND (abs(n::DOUBLE - f.value) <= {_T.TOLERANCE} OR abs(abs(n::DOUBLE) - abs(f.value)) <= {_T.TOLERANCE}))) = 0)) = 0 AS numbers_grounded,
 {claims('high', 'tmax')} AND {claims('low', 'tmin')} AS high_low_attribution,
 len(list_filter(list_concat(list_filter(regexp_split_to_array(narrative, '[^\\w-]+'), lambda w: w IN ({', '.join(map(lit, _T.COMPASS_TOKENS))})),
  list_transform(regexp_extract_all(narrative, {q(_T.COMPASS_WORD)}), lambda w: upper(left(regexp_extract(lower(w), '(north|south)', 1), 1) || left(regexp_extract(lower(w), '(east|west)', 1), 1)))),
  lambda p: NOT list_contains(list_transform(list_filter(fact_list, lambda f: f.compass IS NOT NULL), lambda f: f.compass), p))) = 0 AS compass_matches,
 len(list_filter(regexp_split_to_array(narrative, {q(_T.CLAUSES)}), lambda c: NOT ({_CLAUSE_OK}))) = 0 AS no_false_zero,
 len(list_filter(regexp_split_to_array(narrative, {q(_T.CLAUSES)}), lambda c: regexp_matches(c, {q(_T.GAP_WORDS)}) AND ({_GAP}))) = 0 AS no_false_gaps,
 NOT regexp_matches(narrative, {q('(?i)' + _T.INVENTED)}) AS no_invented_topics,
 len(list_filter(['Town 1', 'Town 2', 'Town 3'], lambda t: t <> city AND regexp_matches(narrative, '(?i)\\b' || t || '\\b'))) = 0 AS names_own_city,
 regexp_matches(narrative, '(?i)\\b' || city || '\\b') AS named_own,
 {' AND '.join(intensity(*r) for r in _T.INTENSITY)} AS intensity_supported,
 NOT ({status('tmax', 'valid', 'trace')} AND {status('tmin', 'valid', 'trace')}) OR (len(list_filter(cited, lambda c: c.element = 'TMAX')) > 0 AND len(list_filter(cited, lambda c: c.element = 'TMIN')) > 0) AS mentions_temperatures,
 NOT ({' OR '.join(status(e, 'missing', 'qc_failed', 'out_of_bounds', 'inconsistent', 'unparseable') for e in ('tmax', 'tmin', 'prcp'))}) OR regexp_matches(narrative, {q(_T.GAP_WORDS)}) AS acknowledges_gaps,
 len(regexp_split_to_array(regexp_replace(trim(narrative), '([.!?])\\s+', '\\1\n', 'g'), '\n')) BETWEEN 1 AND 3 AND length(narrative) <= 450 AS length_ok
FROM texts"""
_ERRORS = [n for n, s in _T.CHECKS if s == "error"]
_WARNS = ["own_city_named", "intensity_supported", "mentions_temperatures", "acknowledges_gaps", '"length"']
PARTS["text_checked"] = f"""SELECT * EXCLUDE (length_ok), length_ok AS "length", NOT names_own_city OR named_own AS own_city_named, {' AND '.join(_ERRORS)} AS passed,
 concat_ws(', ', {', '.join(f"CASE WHEN NOT {n} THEN '{n}' END" for n in _ERRORS)}) AS failed_checks FROM text_results"""
PARTS["run_events"] = """SELECT printf('run-%08d', event_id // 4) AS run_id, ['ingest', 'transform', 'narrate', 'report', 'evaluate'][(event_id // 4) % 5 + 1] AS stage,
 CASE WHEN event_id % 4 = 0 THEN 'started' WHEN event_id % 4 = 3 AND (event_id // 4) % 7 = 0 THEN 'failed' WHEN event_id % 4 = 3 AND (event_id // 4) % 11 <> 0 THEN 'finished' END AS event, date_trunc('second', ts) AS "at", event_id FROM events"""
PARTS["run_ledger"] = """SELECT run_id, stage, min("at") FILTER (event = 'started') AS started_at, max("at") FILTER (event <> 'started') AS ended_at,
 epoch(max("at") FILTER (event <> 'started'))::BIGINT - epoch(min("at") FILTER (event = 'started'))::BIGINT AS seconds,
 CASE WHEN count(*) FILTER (event = 'started') = 0 THEN 'unknown' WHEN count(*) FILTER (event = 'failed') > 0 THEN 'failed' WHEN count(*) FILTER (event = 'finished') > 0 THEN 'success' ELSE 'unfinished' END AS status,
 max('no answer to event ' || event_id) FILTER (event = 'failed') AS error FROM run_events WHERE event IS NOT NULL GROUP BY 1, 2"""
PARTS["downloads"] = """SELECT 'run-' || (page_id % 4 + 1) AS run_id, url, strlen(html)::BIGINT AS bytes, page_id % 3 = 0 AS changed, CASE WHEN page_id % 11 = 0 THEN 'timed out' END AS error FROM pages"""
PARTS["cases"] = f"""SELECT city || '-' || lower(element) AS case_id, city, obs_date FROM (
 SELECT station_id, element, arg_min(obs_date, (CASE WHEN element = 'TMIN' THEN value ELSE -value END, obs_date)) AS obs_date FROM grid WHERE status IN {USABLE} AND element IN ('TMIN', 'TMAX', 'PRCP') GROUP BY 1, 2
 UNION ALL SELECT station_id, 'outside', DATE '2023-12-31' FROM selected) JOIN selected USING (station_id)"""
_TEXT = "CASE WHEN kind = 2 THEN '' ELSE narrative END"
PARTS["drafted"] = f"""SELECT unnest(CASE WHEN kind = 7 THEN ['v1'] ELSE ['v1', 'v2'] END) AS version, * EXCLUDE (narrative), {_TEXT} AS narrative FROM text_checked WHERE kind <> 4"""
PARTS["evaluated"] = f"""SELECT *, CASE WHEN outcome0 IS NULL AND n_failed = 0 THEN 'passed' ELSE coalesce(outcome0, 'failed') END AS outcome, outcome0 IS NULL AND n_failed = 0 AS passed FROM (
 SELECT v.version, c.case_id, c.city, c.obs_date, CASE WHEN s.station_id IS NULL THEN 'no sheet' WHEN coalesce(d.narrative, '') = '' THEN 'no text' END AS outcome0, length(coalesce(d.narrative, '')) AS chars,
 {', '.join(f"concat_ws(', ', " + ', '.join(f"CASE WHEN d.narrative <> '' AND NOT d.{n} THEN '{n.strip(chr(34))}' END" for n in names) + f") AS {label}, (" + ' + '.join(f"coalesce((d.narrative <> '' AND NOT d.{n})::INT, 0)" for n in names) + f") AS n_{label}" for label, names in (('failed', _ERRORS), ('warnings', _WARNS)))},
 concat_ws(', ', {', '.join(f"CASE WHEN regexp_matches(coalesce(d.narrative, ''), {q(p)}) THEN '{n}' END" for n, p in _T.STYLE.items())}) AS style, ({' + '.join(f"regexp_matches(coalesce(d.narrative, ''), {q(p)})::INT" for p in _T.STYLE.values())}) AS n_style
 FROM cases c CROSS JOIN (SELECT unnest(['v1', 'v2']) AS version) v LEFT JOIN sheets s ON s.city = c.city AND s.obs_date = c.obs_date LEFT JOIN drafted d ON d.version = v.version AND d.station_id = s.station_id AND d.obs_date = s.obs_date)"""
PARTS["attempts"] = f"""SELECT station_id, obs_date, input_hash, narrative, passed, failed_checks, kind, a.attempt FROM text_checked JOIN (SELECT unnest([1, 2]) AS attempt) a ON a.attempt = 1 OR kind IN (3, 4) WHERE kind <> 0"""
PARTS["latest"] = """SELECT station_id, obs_date, input_hash, attempt, narrative, CASE WHEN kind <> 5 THEN passed END AS passed, CASE WHEN kind <> 5 THEN failed_checks END AS failed_checks
FROM attempts QUALIFY row_number() OVER (PARTITION BY station_id, obs_date ORDER BY attempt DESC) = 1"""
PARTS["recent"] = f"SELECT * FROM (SELECT *, max(obs_date) OVER (PARTITION BY station_id) AS last_day FROM sheets)"


def whole(final: str) -> str:
    """``final`` with all the parts it needs in front, in order."""
    need: list[str] = []

    def add(sql: str, within: tuple[str, ...] = ()) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s*\(?([a-z_0-9]+)\b", sql):
            if name in PARTS and name not in need and name not in within:
                add(PARTS[name], (*within, name))
                need.append(name)

    add(final)
    return ("WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n]})" for n in need) + "\n" if need else "") + final


_FACT = "station_id, obs_date_text, element, obs_date, raw_value, value::DOUBLE AS value, quality_status, is_trace, is_usable, is_deleted, raw_run_id"
FINAL = {
    "scan_observations": f"SELECT file_station, {', '.join(f'nullif({c}, {lit(chr(0)[:0])}) AS {c}' for c in feed.COLUMNS)} FROM v1 WHERE event_id % 101 <> 0 AND event_id % 107 <> 0",
    "rejected_lines": "SELECT file_station, line_number, line, CASE WHEN event_id % 101 = 0 THEN 'MISSING COLUMNS' ELSE 'TOO MANY COLUMNS' END AS reason FROM lines WHERE event_id % 101 = 0 OR event_id % 107 = 0",
    "fixed_width_scan": "SELECT " + ", ".join(f"nullif(trim(left({n}, {b - a + 1})), '') AS {n}" for n, a, b in STATION_LAYOUT) + " FROM metadata",
    "layout_drift": f"SELECT id AS doc, 'latitude' AS variable, 13 AS first, 20 AS last, 13 AS doc_first, 21 AS doc_last FROM metadata WHERE {USER.format('id')} % 13 = 0",
    "load_documents": "SELECT id AS doc, content || chr(10) AS content, sha256(content || chr(10)) AS sha256 FROM (SELECT id, concat_ws(chr(10), 'I. INTRODUCTION', 'text', 'IV. FORMAT', " + ", ".join(
        f"CASE WHEN {USER.format('id')} % 13 = 0 THEN 'LATITUDE 13-21 Real' ELSE 'LATITUDE 13-20 Real' END" if n == "latitude" else f"'{n.upper()} {a}-{b} Character'" for n, a, b in STATION_LAYOUT) + ") AS content FROM metadata)",
    "city_candidates": "SELECT city, province, row_number() OVER (PARTITION BY city, province ORDER BY selected DESC, rank NULLS LAST, station_id) AS place, station_id, selected, rank, reason FROM resolved",
    "top_failures": "SELECT city, obs_date, failed_checks, left(narrative, 120) AS preview FROM latest JOIN (SELECT station_id, city FROM selected) USING (station_id) WHERE NOT passed ORDER BY obs_date DESC, station_id LIMIT 10",
    "check_status_counts": "SELECT check_name, passed, count(*) AS n FROM load_checks GROUP BY ALL",
    "catalog_from_text": "SELECT p_brand AS doc, 'P' || lpad(p_partkey::VARCHAR, 8, '0') AS code, p_name || ' (' || u || ')' AS description, CASE p_partkey % 4 WHEN 2 THEN 'cm' WHEN 3 THEN 'hPa' ELSE 'mm' END AS unit,"
                         " CASE WHEN p_partkey % 4 IN (0, 2) THEN 0.1::DOUBLE ELSE 1.0::DOUBLE END AS scale FROM (SELECT *, ['tenths of mm', 'mm', 'cm * 10', 'hPa; hourly'][p_partkey % 4 + 1] AS u FROM part)",
    "changed_files": f"""SELECT a.file_station, a.h AS sha256, b.h AS last_sha256 FROM (SELECT file_station, sha256(string_agg({LINE} || chr(10), '' ORDER BY event_id)) AS h FROM v2 GROUP BY 1) a
LEFT JOIN (SELECT file_station, sha256(string_agg({LINE} || chr(10), '' ORDER BY event_id)) AS h FROM v1 GROUP BY 1) b USING (file_station) WHERE a.h IS DISTINCT FROM b.h""",
    "element_policy": "SELECT element, readings, absent_means_zero, persistent, fed_by, lower_bound, upper_bound, start_date, end_date, (end_date - start_date)::INT AS window_days FROM (SELECT element, count(*) AS readings FROM feed GROUP BY 1) LEFT JOIN policy USING (element) CROSS JOIN scope",
    "typed_observations": f"SELECT station_id, {DAY.format('obs_date')} AS obs_date, element, TRY_CAST(value AS INT) AS raw_value, mflag, qflag, sflag, obs_time, obs_date AS obs_date_text, value AS value_text FROM feed",
    "typed_stations": "SELECT * FROM stations",
    "stations_selected": "SELECT station_id, city, province, station_name, country_code, country_name, state_code, r_name AS state_name, latitude, longitude, elevation_m FROM selected LEFT JOIN (SELECT 'C' || chr((65 + n_nationkey)::INT) AS country_code, n_name AS country_name FROM nation) USING (country_code) LEFT JOIN region ON state_code = 'R' || r_regionkey AND r_name <> 'ASIA'",
    "scoped_elements": "SELECT * FROM scoped_elements",
    "elements_in_scope": "SELECT * FROM elements_in_scope",
    "dim_element": "SELECT * EXCLUDE (policy_hash) FROM elements_in_scope",
    "station_elements": "SELECT * FROM station_elements",
    "dim_station": "SELECT station_id, city, province, station_name, elevation_m, elements_reported FROM selected LEFT JOIN (SELECT station_id, string_agg(element, ', ' ORDER BY element) AS elements_reported FROM station_elements GROUP BY 1) USING (station_id)",
    "element_coverage": "SELECT * FROM coverage",
    "dedup_observations": "SELECT * FROM incoming",
    "row_rejects": "SELECT * FROM rejects",
    "detect_changes": "SELECT * FROM found_changes",
    "deletes_guard": "SELECT * FROM deletes_guard",
    "merge": "SELECT * FROM merged",
    "load_checks": "SELECT * FROM load_checks",
    "source_changes": "SELECT * FROM source_changes",
    "latest_run_changes": "SELECT run_id, city, station_id, inserted, updated, deleted, historical_changes FROM source_changes QUALIFY run_id = max(run_id) OVER ()",
    "assess": "SELECT station_id, obs_date_text, element, obs_date, raw_value, value::DOUBLE AS value, unit, is_trace, quality_status, policy_hash FROM assessed",
    "inverted_days": "SELECT station_id, obs_date, tmax::DOUBLE AS tmax, tmin::DOUBLE AS tmin FROM inverted",
    "tavg_within": """SELECT a.station_id, a.obs_date, a.value::DOUBLE AS tavg, i.value::DOUBLE AS tmin, x.value::DOUBLE AS tmax FROM fct a JOIN fct i ON i.station_id = a.station_id AND i.obs_date = a.obs_date AND i.element = 'TMIN'
JOIN fct x ON x.station_id = a.station_id AND x.obs_date = a.obs_date AND x.element = 'TMAX' WHERE a.element = 'TAVG' AND a.is_usable AND i.is_usable AND x.is_usable AND (a.value < i.value - 0.5 OR a.value > x.value + 0.5)""",
    "removed_rows": "SELECT * FROM removed",
    "tombstones": f"SELECT {_FACT} FROM tombstones",
    "fct_full": f"SELECT {_FACT} FROM fct",
    "new_pairs": "SELECT * FROM new_pairs",
    "changed_keys": """SELECT station_id, obs_date_text, element FROM noaa UNION SELECT station_id, obs_date_text, CASE element WHEN 'TMAX' THEN 'TMIN' ELSE 'TMAX' END FROM noaa WHERE element IN ('TMAX', 'TMIN')
UNION SELECT station_id, obs_date_text, element FROM assessed WHERE (station_id, element) NOT IN (SELECT (station_id, element) FROM fct0)""",
    "fct_incremental": f"SELECT {_FACT} FROM fct",
    "scan_with_rejects": f"SELECT file_station, line_number, line, {', '.join(f'CASE WHEN reason IS NULL THEN {c} END AS {c}' for c in feed.COLUMNS)}, reason FROM quoted_lines",
    "stream_backlog": f"SELECT {KEY}, {ORDER}, row_hash, first_loaded_at, last_changed_at, run_id FROM merged",
    "stream_backlog_log": "SELECT * FROM change_log",
    "stream_rejects": """SELECT load, file_station, line_number, line, CASE WHEN event_id % 101 = 0 THEN 'MISSING COLUMNS' ELSE 'TOO MANY COLUMNS' END AS reason FROM waiting WHERE event_id % 101 = 0 OR event_id % 107 = 0
UNION ALL SELECT load, file_station, line_number, line, 'filed under another station''s name: ' || station_id FROM waiting WHERE station_id <> file_station AND event_id % 101 <> 0 AND event_id % 107 <> 0
UNION ALL SELECT load, file_station, line_number, line, 'second row of ' || obs_date || ', ' || element || '; the first in order stays' FROM waiting_ranked WHERE n > 1""",
    "stream_merge": f"SELECT {KEY}, {ORDER}, row_hash, first_loaded_at, last_changed_at FROM merged",
    "keyed_replace": f"SELECT {KEY}, {ORDER}, row_hash FROM stored ANTI JOIN keyed USING ({KEY}) UNION ALL SELECT * FROM keyed",
    "fct_refresh": f"SELECT {_FACT} FROM fct",
    "station_day_grid": "SELECT * FROM grid",
    "station_daily": "SELECT * FROM daily",
    "station_daily_scoped": wide("(SELECT * FROM grid WHERE element <> 'WDFG')", [e for e in ELEMENTS if e != "WDFG"]),
    "station_daily_retired": "SELECT * FROM (" + wide("(SELECT * FROM grid WHERE element <> 'WDFG')", [e for e in ELEMENTS if e != "WDFG"]) + f""") WHERE {USER.format('station_id')} % 2 = 0
UNION ALL BY NAME SELECT *, NULL::DOUBLE AS snow, NULL AS snow_status, NULL::DOUBLE AS snwd, NULL AS snwd_status FROM ("""
    + wide("(SELECT * FROM grid WHERE element NOT IN ('SNOW', 'SNWD'))", [e for e in ELEMENTS if e not in ("WDFG", "SNOW", "SNWD")]) + f""") WHERE {USER.format('station_id')} % 2 <> 0""",
    "status_counts": "SELECT element, status, count(*) AS n FROM grid GROUP BY ALL",
    "data_quality": "SELECT * FROM quality",
    "city_quality": """SELECT city, sum(expected_days)::BIGINT AS expected_days, sum(qc_failed_days + out_of_bounds_days + inconsistent_days + unparseable_days)::BIGINT AS quarantined_days, round(sum(round(completeness * 10000)::BIGINT)::DOUBLE / nullif(count(completeness), 0)) / 10000 AS mean_completeness,
 min(completeness) AS worst_completeness, bool_or(freshness = 'stale') AS any_stale, max(last_usable_date) AS latest_date FROM quality GROUP BY 1""",
    "worst_element": "SELECT city, min(completeness) AS worst_completeness, arg_min(element, (completeness, element)) FILTER (completeness IS NOT NULL) AS worst_element FROM quality GROUP BY 1",
    "daily_display": "SELECT station_id, city, obs_date, round(tmax, 1) AS tmax_shown, round(tmin, 1) AS tmin_shown, round(prcp, 1) AS prcp_shown, round(snow * 0.1, 1) AS snow_shown, round(wsfg * 3.6, 1) AS wsfg_shown FROM daily",
    "compass": f"SELECT station_id, obs_date, value, {POINTS!r}[(round(value / 45)::INT % 8) + 1] AS point FROM grid WHERE element = 'WDFG' AND status IN {USABLE}",
    "fact_sheets": "SELECT station_id, city, province, station_name, obs_date, facts, input_hash FROM sheets",
    "unique_combination": f"SELECT {KEY}, count(*) AS n_rows FROM feed GROUP BY ALL HAVING count(*) > 1",
    "all_failures": "SELECT * FROM failures",
    "data_tests": f"""SELECT test_name, tested, severity, failing, CASE WHEN failing = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' ELSE 'warn' END AS status FROM (
 SELECT n.*, (SELECT count(*) FROM failures f WHERE f.test_name = n.test_name) AS failing FROM ({values([
    ("not_null_obs_date", "fct_observations", "warn"), ("value_within_300", "fct_observations", "warn"), ("stations_fresh", "data_quality", "error"),
    ("every_city_has_a_station", "cities", "error"), ("tavg_within_tmin_tmax", "fct_observations", "warn"), ("tmax_not_below_tmin", "fct_observations", "error"),
    ("single_row_scope", "scope", "error"), ("single_row_selected", "selected", "warn"),
    *[(name_of(kind, table, cols), table, severity) for kind, table, cols, _, severity in TESTS]], "test_name, tested, severity")}) n)""",
    "data_issues": f"""SELECT 'quarantined' AS issue_type, 'info' AS severity, station_id, obs_date, element, raw_value::VARCHAR AS value, CASE quality_status
 WHEN 'qc_failed' THEN 'failed quality check ' || qflag || ': ' || CASE qflag {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in QUALITY_FLAGS.items())} ELSE 'unknown flag' END
 WHEN 'out_of_bounds' THEN 'outside the physical bounds' WHEN 'inconsistent' THEN 'maximum temperature below minimum that day: both set aside' ELSE 'value or date did not parse' END AS reason, 'facts' AS found_in, last_changed_at AS detected_at, city
FROM (SELECT f.*, coalesce(a.last_changed_at, r.changed_at) AS last_changed_at FROM fct f LEFT JOIN assessed a USING (station_id, obs_date_text, element) LEFT JOIN removed r USING (station_id, obs_date_text, element)) LEFT JOIN (SELECT station_id, city FROM selected) USING (station_id) WHERE quality_status IN {QUARANTINED}
UNION ALL SELECT 'rejected_row', 'warn', file_station, NULL, NULL, line, reason, 'rejects', TIMESTAMP '{feed.CHANGED_AT}', city FROM rejects LEFT JOIN selected ON station_id = file_station
UNION ALL SELECT 'revised_at_source', 'info', l.station_id, {DAY.format('obs_date')}, element, coalesce(new_value, old_value), CASE WHEN change = 'delete' THEN 'removed at source (was ' || old_value || ')'
 WHEN old_value IS DISTINCT FROM new_value THEN 'value revised: ' || old_value || ' -> ' || new_value ELSE 'flags revised: ' || old_flags || ' -> ' || new_flags END, 'change_log', changed_at, city
FROM change_log l LEFT JOIN (SELECT station_id, city FROM selected) s USING (station_id) WHERE change IN ('update', 'delete')
UNION ALL SELECT 'test_failure', severity, f.failing_row->>'$.station_id', TRY_CAST(f.failing_row->>'$.obs_date' AS DATE), f.failing_row->>'$.element', failing_row, 'failed test ' || test_name || ' on ' || tested, tested, NULL, city
FROM failures f LEFT JOIN selected s ON s.station_id = f.failing_row->>'$.station_id'""",
    "station_documents": """SELECT station_id, city, n_daily, n_quality, coalesce(n_changes, 0) AS n_changes, coalesce(n_texts, 0) AS n_texts, coalesce(n_evaluations, 0) AS n_evaluations, coalesce(n_tests, 0) AS n_tests, last_day, last_missing,
 coalesce(inserted, 0)::BIGINT AS inserted, coalesce(n_facts, 0)::BIGINT AS n_facts, coalesce(n_missing_facts, 0)::BIGINT AS n_missing_facts, coalesce(n_failed_checks, 0)::BIGINT AS n_failed_checks, coalesce(outcomes, '') AS outcomes, coalesce(failing, '') AS failing, first_text
FROM selected LEFT JOIN (SELECT station_id, count(*) AS n_daily, max(obs_date) AS last_day, arg_max(missing_elements, obs_date) FILTER (true) AS last_any FROM daily GROUP BY 1) USING (station_id)
LEFT JOIN (SELECT station_id, missing_elements AS last_missing FROM daily QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY obs_date DESC) = 1) USING (station_id)
LEFT JOIN (SELECT station_id, count(*) AS n_quality FROM quality GROUP BY 1) USING (station_id)
LEFT JOIN (SELECT station_id, count(*) AS n_changes, sum(inserted) AS inserted FROM source_changes GROUP BY 1) USING (station_id)
LEFT JOIN (SELECT l.station_id, count(*) AS n_texts, sum(len(fact_list)) AS n_facts, sum(len(list_filter(fact_list, lambda f: f.status = 'missing'))) AS n_missing_facts,
 sum(CASE WHEN coalesce(failed_checks, '') = '' THEN 0 ELSE len(string_split(failed_checks, ', ')) END) AS n_failed_checks, arg_min(narrative, l.obs_date) AS first_text
 FROM latest l LEFT JOIN sheets s ON s.station_id = l.station_id AND s.obs_date = l.obs_date GROUP BY 1) USING (station_id)
LEFT JOIN (SELECT city, count(*) AS n_evaluations, string_agg(DISTINCT outcome, ', ' ORDER BY outcome) AS outcomes FROM evaluated GROUP BY 1) USING (city)
LEFT JOIN (SELECT failing_row->>'$.station_id' AS station_id, count(*) AS n_tests, string_agg(DISTINCT test_name, ', ' ORDER BY test_name) AS failing FROM failures GROUP BY 1) USING (station_id)""",
    "normalised_names": "SELECT id, trim(upper(strip_accents(translate(name, 'AEOINn', 'ÀéÖïÑñ')))) AS plain_name FROM metadata",
    "window_bounds": """SELECT id, start_date, end_date, last_days, error, CASE WHEN error IS NULL THEN coalesce(start_date, last - last_days) END AS first_day, CASE WHEN error IS NULL THEN last END AS last_day FROM (
 SELECT *, CASE WHEN (start_date IS NULL) = (last_days IS NULL) THEN 'give either a start or a number of days' WHEN start_date > last THEN 'starts after its end' WHEN last_days < 0 THEN 'negative number of days' END AS error FROM (
 SELECT *, coalesce(end_date, DATE '2024-01-30') AS last FROM (SELECT id, CASE WHEN user_id % 3 <> 0 THEN DATE '2024-01-01' + (user_id % 37)::INT END AS start_date,
 CASE WHEN user_id % 2 = 0 THEN DATE '2024-01-01' + (user_id % 31)::INT END AS end_date, CASE WHEN user_id % 3 = 0 AND user_id % 4 <> 3 OR user_id % 7 = 0 THEN (user_id % 45 - 2)::INT END AS last_days FROM metadata)))""",
    "resolution_errors": """SELECT city, province, NULL::VARCHAR AS station_id, CASE WHEN pinned_id IS NOT NULL AND n = 0 THEN 'pinned station is unknown' WHEN pinned_id IS NOT NULL THEN 'pinned station reports too little'
 WHEN n = 0 THEN 'no station has the city''s name' WHEN n = other THEN 'no station of that name is an airport''s' ELSE 'no station near enough reports all required elements' END AS error FROM (
 SELECT c.city, c.province, c.pinned_id, count(r.reason) AS n, count(*) FILTER (r.reason = 'name isn''t an airport''s') AS other, count(*) FILTER (r.selected) AS chosen
 FROM (SELECT city, CASE WHEN substr(city, 6, 3)::INT % 3 = 0 THEN 'ZZ' ELSE province END AS province, pinned_id FROM cities) c LEFT JOIN resolved r USING (city, province) GROUP BY ALL) WHERE chosen = 0
UNION ALL SELECT city, province, station_id, 'station was given to several cities' FROM resolved WHERE selected QUALIFY count(*) OVER (PARTITION BY station_id) > 1""",
    "city_without_station": "SELECT city FROM cities WHERE city NOT IN (SELECT city FROM resolved WHERE selected)",
    "nearby_stations": f"""SELECT a.station_id AS anchor_id, k.station_id, {KM.format(a='a.latitude', b='a.longitude', c='k.latitude', d='k.longitude')} AS distance_km FROM
(SELECT * FROM stations WHERE regexp_matches(station_name, ' (A|AP|INT)$') QUALIFY row_number() OVER (PARTITION BY station_name ORDER BY station_id) = 1) a
JOIN stations k ON k.country_code = a.country_code AND {KM.format(a='a.latitude', b='a.longitude', c='k.latitude', d='k.longitude')} <= {feed.MAX_KM}""",
    "resolve_stations": "SELECT * FROM resolved",
    "resolution_summary": "SELECT city, province, station_id, station_name, reason, candidates FROM (SELECT *, count(*) OVER (PARTITION BY city, province) AS candidates FROM resolved) WHERE selected",
    "station_report": """SELECT city, province, count(*) AS candidates, count(*) FILTER (starts_with(reason, 'selected')) AS selected, count(*) FILTER (starts_with(reason, 'ranked lower')) AS ranked_lower,
 count(*) FILTER (starts_with(reason, 'reports')) AS reports_too_little, count(*) FILTER (starts_with(reason, 'name')) AS other_name FROM resolved GROUP BY 1, 2""",
    "template_narratives": "SELECT station_id, obs_date, draft AS narrative, len(cited)::INT AS n_cited FROM drafts",
    "nothing_to_report": f"SELECT station_id, city, obs_date FROM sheets WHERE len(list_filter(fact_list, lambda f: f.element IN ('TMAX', 'TMIN', 'PRCP') AND f.status IN {USABLE})) = 0",
    "text_checks": f"SELECT station_id, obs_date, {', '.join(_ERRORS + _WARNS)}, passed FROM text_checked",
    "eval_summary": f"""SELECT 'v' || day(obs_date) % 3 AS version, '{MODEL}' AS model, count(*) AS cases, count(*) FILTER (passed AND narrative <> '') AS passed, sum({' + '.join(f'(NOT {n})::INT' for n in _ERRORS)})::BIGINT AS error_failures,
 sum({' + '.join(f'(NOT {n})::INT' for n in _WARNS)})::BIGINT AS warnings, sum({' + '.join(f'regexp_matches(narrative, {q(p)})::INT' for p in _T.STYLE.values())})::BIGINT AS style_issues, round(avg(length(narrative)), 1) AS avg_chars
FROM text_checked GROUP BY ALL""",
    "pending": f"""SELECT station_id, city, obs_date, input_hash FROM recent WHERE obs_date > last_day - {DAYS} AND ({USER.format('station_id')} + day(obs_date)) % 9 = 0
 AND station_id NOT IN (SELECT station_id FROM quality WHERE freshness = 'stale')""",
    "batches": "SELECT station_id, city, obs_date, (p // 10)::BIGINT AS batch, p // 10 >= 30 AS deferred FROM (SELECT *, row_number() OVER (ORDER BY obs_date DESC, city, station_id) - 1 AS p FROM sheets)",
    "latest_narratives": "SELECT station_id, obs_date, attempt, narrative, passed, failed_checks FROM latest",
    "unrepaired": "SELECT station_id, city, obs_date, narrative, failed_checks FROM recent JOIN latest USING (station_id, obs_date, input_hash) WHERE obs_date > last_day - 14 AND NOT passed AND attempt = 1",
    "latest_per_key": "SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY file ORDER BY loaded_at DESC) = 1",
    "volume_swing": "SELECT * FROM swings",
    "run_ledger": "SELECT * FROM run_ledger",
    "latest_runs": """SELECT * FROM (SELECT stage, run_id, started_at, ended_at, seconds, status, error FROM run_ledger QUALIFY row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, run_id DESC) = 1)
 JOIN (SELECT stage, max(ok) AS last_success, count(*) FILTER (status = 'failed' AND (ok IS NULL OR started_at > ok)) AS failed_since
 FROM (SELECT *, max(started_at) FILTER (status = 'success') OVER (PARTITION BY stage) AS ok FROM run_ledger) GROUP BY 1) USING (stage)""",
    "download_totals": "SELECT run_id, count(*) AS files, count(*) FILTER (changed) AS changed, count(error) AS failed, sum(bytes)::BIGINT AS bytes FROM downloads GROUP BY 1",
    "catalog_columns": """SELECT *, 'True,True,False' AS exists_test, CASE table_name WHEN 'dim_element' THEN (SELECT count(*) FROM elements_in_scope) ELSE (SELECT count(*) FROM selected) END AS n_rows FROM (VALUES
 ('dim_element', 'Elements in scope', 1, 'element', 'string', 'code'), ('dim_element', 'Elements in scope', 2, 'unit', 'string', 'of a reading''s value'), ('dim_element', 'Elements in scope', 3, 'scale', 'double', NULL),
 ('dim_station', 'It''s one row per station', 1, 'station_id', 'string', NULL), ('dim_station', 'It''s one row per station', 2, 'city', 'string', NULL)) v(table_name, table_comment, position, column_name, data_type, column_comment)""",
    "evaluate": "SELECT version, case_id, city, obs_date, outcome, passed, failed, warnings, style, chars FROM evaluated",
    "latest_evaluations": f"""SELECT version, '{MODEL}' AS model, 3 AS runs, 'eval-3-' || version AS eval_id, TIMESTAMP '2024-03-03' AS evaluated_at, count(*) FILTER (passed) AS passed, count(*) AS cases, sum(n_failed)::BIGINT AS error_failures,
 sum(n_warnings)::BIGINT AS warnings, sum(n_style)::BIGINT AS style_issues, count(*) FILTER (passed AND ends_with(case_id, '-tmax')) AS passed_change, count(*) AS n_results, count(*) FILTER (outcome = 'no sheet') AS n_no_sheet
FROM evaluated GROUP BY 1""",
    "health_status": f"""SELECT section, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warn') AS warnings, count(*) FILTER (severity = 'info') AS notes,
 CASE WHEN count(*) FILTER (severity = 'error') > 0 THEN 'ERROR' WHEN count(*) FILTER (severity = 'warn') > 0 THEN 'WARN' ELSE 'OK' END AS status
FROM (SELECT unnest(['runs', 'downloads', 'load', 'volume', 'changes', 'quality', 'tests', 'resolution', 'texts', 'evaluation']) AS section) LEFT JOIN (
 SELECT 'load' AS section, severity FROM load_checks WHERE NOT passed UNION ALL SELECT 'volume', 'warn' FROM swings WHERE abs(swing_pct) > 20
 UNION ALL SELECT 'quality', CASE WHEN freshness = 'stale' THEN 'error' ELSE 'warn' END FROM quality WHERE freshness IN ('stale', 'lagging')
 UNION ALL SELECT 'resolution', 'error' FROM cities WHERE city NOT IN (SELECT city FROM resolved WHERE selected)
 UNION ALL SELECT 'tests', severity FROM failures UNION ALL SELECT 'changes', 'info' FROM change_log WHERE run_id = '{feed.SECOND_RUN}'
 UNION ALL SELECT 'runs', CASE WHEN status = 'failed' THEN 'error' ELSE 'warn' END FROM (SELECT * FROM run_ledger QUALIFY row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, run_id DESC) = 1) WHERE status <> 'success'
 UNION ALL SELECT 'downloads', 'warn' FROM downloads WHERE run_id = 'run-4' AND error IS NOT NULL
 UNION ALL SELECT 'texts', 'warn' FROM latest WHERE NOT passed UNION ALL SELECT 'evaluation', 'warn' FROM text_checked WHERE NOT passed) USING (section) GROUP BY 1""",
}
SQL = {name: whole(sql) for name, sql in FINAL.items()}
