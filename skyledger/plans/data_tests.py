"""The data tests on the run's tables, as plain rows.

A row is (kind, table, columns, argument, severity). Argument: the values accepted, (parent table, its column),
(lower, upper) or nothing. Nulls pass every kind but ``not_null``; ``unique`` of one column ignores them.
"""

from __future__ import annotations

from skyledger.functions.values import QUARANTINED, USABLE

#: What tells a row of a table in a failure.
IDENTITY = {
    "fct": ["station_id", "obs_date_text", "element"], "grid": ["station_id", "obs_date", "element"], "log": ["run_id", "station_id", "obs_date", "element"],
    "quality": ["station_id", "element"], "elements": ["element"], "selected": ["station_id"], "reported": ["station_id", "element", "first_year"],
}
FACT_STATUS = [*USABLE, *QUARANTINED, "removed_at_source"]
FRESHNESS = ["not_expected", "not_applicable", "stale", "lagging", "fresh"]


def _not_null(table: str, *columns: str) -> list[tuple]:
    return [("not_null", table, [c], None, "error") for c in columns]


TESTS = [
    *_not_null("fct", "station_id", "element", "quality_status", "is_usable", "is_deleted", "raw_run_id"),
    *_not_null("grid", "station_id", "obs_date", "element", "status", "is_core", "is_expected"),
    *_not_null("log", "run_id", "station_id", "obs_date", "element", "change"),
    *_not_null("quality", "station_id", "element", "city", "expected_days", "freshness"),
    *_not_null("elements", "element", "scale", "policy_hash"),
    *_not_null("selected", "station_id", "station_name", "city"),
    *_not_null("reported", "station_id", "element", "first_year", "last_year"),
    ("unique", "elements", ["element"], None, "error"),
    ("unique", "selected", ["station_id"], None, "error"),
    ("unique", "fct", IDENTITY["fct"], None, "error"),
    ("unique", "grid", IDENTITY["grid"], None, "error"),
    ("unique", "log", IDENTITY["log"], None, "error"),
    ("unique", "quality", IDENTITY["quality"], None, "error"),
    ("accepted_values", "fct", ["quality_status"], FACT_STATUS, "error"),
    ("accepted_values", "grid", ["status"], [*FACT_STATUS[:-1], "not_expected", "not_reported", "missing"], "error"),
    ("accepted_values", "log", ["change"], ["insert", "update", "delete"], "error"),
    ("accepted_values", "quality", ["freshness"], FRESHNESS, "error"),
    ("relationships", "fct", ["station_id"], ("selected", "station_id"), "error"),
    ("relationships", "fct", ["element"], ("elements", "element"), "error"),
    ("relationships", "grid", ["station_id"], ("selected", "station_id"), "error"),
    ("relationships", "log", ["station_id"], ("selected", "station_id"), "warn"),
    ("within_bounds", "quality", ["completeness"], (0, 1), "error"),
    ("within_bounds", "grid", ["value"], (-300, 300), "warn"),
]
ROW_KINDS = ("not_null", "accepted_values", "within_bounds")


def name_of(kind: str, table: str, columns: list[str]) -> str:
    return f"{kind}_{table}_{'_'.join(columns)}"
