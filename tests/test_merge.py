"""Merging snapshots: revisions, backfill, removal, idempotence, refusals, and incremental builds equal to full ones."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.operators import assess, facts, merge, scope, staging
from skyledger.sources import feed, files
from skyledger.sources.shared import shared_dir
from skyledger.streaming import arrivals

SCHEMA = "file_station string, station_id string, obs_date string, element string, value string, mflag string, qflag string, sflag string, obs_time string"
A, B = "CAN00000001", "CAN00000002"


def rows(spark, items):
    return spark.createDataFrame([(s, s, d, e, v, m, q, "C", None) for s, d, e, v, m, q in items], SCHEMA)


def loaded(spark, items, run="r1", at="2026-01-10 00:00:00"):
    return merge.first_load(merge.dedup(rows(spark, items)), run, at)


def changed(spark, old, new):
    return merge.detect_changes(loaded(spark, old), merge.dedup(rows(spark, new)))


def test_insert_update_delete(spark):
    v1 = [(A, "20260101", "TMAX", "-52", None, None), (A, "20260101", "TMIN", "-93", None, None), (A, "20260102", "PRCP", "0", "T", None)]
    v2 = [(A, "20260101", "TMAX", "-50", None, None), (A, "20260101", "TMIN", "-93", None, "I"), (A, "20260103", "TMAX", "1", None, None)]
    got = {(r.obs_date, r.element): (r.change, r.old_value, r.new_value, r.old_flags, r.new_flags) for r in changed(spark, v1, v2).collect()}
    assert got == {
        ("20260101", "TMAX"): ("update", "-52", "-50", "||C|", "||C|"), ("20260101", "TMIN"): ("update", "-93", "-93", "||C|", "|I|C|"),
        ("20260102", "PRCP"): ("delete", "0", None, "T||C|", None), ("20260103", "TMAX"): ("insert", None, "1", None, "||C|"),
    }


def test_unchanged_reload(spark):
    v1 = [(A, "20260101", "TMAX", "1", None, None)]
    assert changed(spark, v1, v1).count() == 0


def test_duplicate_keeps_first_by_text(spark):
    twice = [(A, "20260101", "TMAX", "-52", None, None), (A, "20260101", "TMAX", "-51", None, None)]
    assert [r.value for r in merge.dedup(rows(spark, twice)).collect()] == ["-51"]
    assert [r.reason for r in merge.row_rejects(rows(spark, twice)).collect()] == ["second row of 20260101, TMAX; the first in order stays"]


def test_foreign_row(spark):
    strange = spark.createDataFrame([(A, B, "20260101", "TMAX", "1", None, None, None, None)], SCHEMA)
    assert merge.dedup(strange).count() == 0
    assert merge.row_rejects(strange).first().reason == f"filed under another station's name: {B}"


def test_too_many_deletes_refused_per_station(spark):
    v1 = [(s, f"202601{d:02d}", "TMAX", "1", None, None) for s in (A, B) for d in range(1, 21)]
    v2 = [r for r in v1 if not (r[0] == A and r[1] <= "20260110") and not (r[0] == B and r[1] == "20260101")]
    stored, changes = loaded(spark, v1), changed(spark, v1, v2)
    guard = {r.station_id: (r.deleted, r.existing, r.refused) for r in merge.deletes_guard(changes, stored, 5.0).collect()}
    assert guard == {A: (10, 20, True), B: (1, 20, False)}
    kept = merge.accepted(changes, merge.deletes_guard(changes, stored, 5.0))
    assert [(r.station_id, r.change) for r in kept.collect()] == [(B, "delete")]


def test_empty_tables(spark):
    none = rows(spark, [])
    assert merge.dedup(none).count() == 0 and merge.detect_changes(loaded(spark, []), merge.dedup(none)).count() == 0


READING = st.tuples(st.sampled_from([A, B]), st.sampled_from(["20260101", "20260102", "2026010"]), st.sampled_from(["TMAX", "TMIN", "PRCP"]),
                    st.sampled_from(["-10", "5", "12", "900", "x"]), st.sampled_from([None, "T"]), st.sampled_from([None, None, "I"]))


def context(spark):
    selected = spark.createDataFrame([(A,), (B,)], "station_id string")
    inventory = spark.createDataFrame([(s, e, 2020, 2030) for s in (A, B) for e in ("TMAX", "TMIN", "PRCP")], "station_id string, element string, first_year int, last_year int")
    elements = scope.elements_in_scope(inventory, selected, staging.typed_elements(feed.catalog(spark)), feed.policy(spark), feed.scope(spark).withColumn("end_date", F.lit("2026-02-01").cast("date")))
    return selected, elements


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(READING, min_size=1, max_size=12), st.lists(READING, max_size=12))
def test_incremental_equals_full_and_merge_is_idempotent(spark, v1, v2):
    selected, elements = context(spark)
    stored, incoming = loaded(spark, v1), merge.dedup(rows(spark, v2))
    changes = merge.detect_changes(stored, incoming)
    first_log = merge.logged(merge.detect_changes(loaded(spark, []), merge.dedup(rows(spark, v1))), "r1", "2026-01-10 00:00:00")
    log = first_log.unionByName(merge.logged(changes, "r2", "2026-01-20 00:00:00"))
    merged = merge.merge(stored, incoming, changes, log, "r2", "2026-01-20 00:00:00")
    assert merge.detect_changes(merged, incoming).count() == 0
    stamp = lambda t: t.withColumnsRenamed({"last_changed_at": "raw_changed_at", "run_id": "raw_run_id"})
    before, after = (assess.assess(staging.typed_observations(stamp(t)), selected, elements) for t in (stored, merged))
    full = facts.fct_full(after, log, selected, elements)
    build = facts.fct_incremental(facts.fct_full(before, first_log, selected, elements), staging.typed_observations(stamp(merged)), log, elements, selected)
    as_set = lambda t: sorted(map(str, t.select(*sorted(t.columns)).collect()))
    assert as_set(full) == as_set(build)


def write_arrivals(spark, path, items):
    lines = [(s, n, ",".join([s, d, e, v, m or "", q or "", "C", ""])) for n, (s, d, e, v, m, q) in enumerate(items)]
    files.write_files(spark.createDataFrame(lines, "file_station string, event_id long, line string"), path)


def test_arrivals_keep_the_merge_promises(spark):
    path, root = shared_dir(spark, "arriving"), shared_dir(spark, "arrivals")
    day = lambda s, n: (s, f"202601{n:02d}", "TMAX", str(n), None, None)
    one, two = [day(A, n) for n in range(1, 21)], [day(B, n) for n in range(1, 21)]
    loads = [one + two, one[:10] + two[1:], two]
    for n, load in enumerate(loads, 1):
        write_arrivals(spark, f"{path}/load={n}", load)
        table = arrivals.merge_arrivals(spark, path, root, f"2026-02-0{n} 00:00:00").collect()
    got = {(r.station_id, r.obs_date): (r.first_loaded_at.day, r.last_changed_at.day) for r in table}
    # A lost half its rows with the second file: refused, so it is as first loaded. B lost one row and got it back.
    assert sum(s == A for s, _ in got) == 20 and {v for (s, _), v in got.items() if s == A} == {(1, 1)}
    assert got[B, "20260101"] == (1, 3) and {v for (s, d), v in got.items() if s == B and d != "20260101"} == {(1, 1)}
    # The last batch wrote the rows of its own station only.
    versions = spark.read.parquet(f"{root}/table").groupBy("version", "station_id").count().collect()
    assert {r.station_id for r in versions if r.version == max(v.version for v in versions)} == {B}
