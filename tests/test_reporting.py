"""The run ledger, evaluations, nested documents, wide tables that change, the catalog and plain names."""

import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.functions.values import plain_name
from skyledger.operators import evaluation, grid, ledger, report
from skyledger.operators.textcheck import CHECKS
from skyledger.sources import sinks

AT = datetime.datetime(2026, 1, 1)


def minutes(n):
    return AT + datetime.timedelta(minutes=n)


def test_events_are_paired_to_runs(spark):
    rows = [
        ("a", "ingest", "started", 0, None), ("a", "ingest", "finished", 5, None), ("b", "ingest", "failed", 12, "no route"), ("b", "ingest", "started", 10, None), ("b", "ingest", "started", 10, None),
        ("c", "report", "started", 3, None), ("d", "report", "finished", 9, None), ("e", "ingest", "started", 20, None), ("e", "ingest", "failed", 21, "first"), ("e", "ingest", "finished", 25, None)]
    events = spark.createDataFrame([(r, s, e, minutes(n), x) for r, s, e, n, x in rows], "run_id string, stage string, event string, at timestamp, error string")
    found = ledger.runs(events)
    assert {r.run_id: (r.status, r.seconds, r.error) for r in found.collect()} == {
        "a": ("success", 300, None), "b": ("failed", 120, "no route"), "c": ("unfinished", None, None), "d": ("unknown", None, None), "e": ("success", 300, None)}
    assert {r.stage: r.run_id for r in ledger.latest_runs(found).collect()} == {"ingest": "e", "report": "c"}
    assert {r.stage: (r.last_success, r.failed_since) for r in ledger.since_success(found.where("run_id <> 'e'")).collect()} == {"ingest": (AT, 1), "report": (None, 0)}
    assert ledger.latest_runs(ledger.runs(events.limit(0))).count() == 0


def test_download_totals(spark):
    rows = [("r", "u1", 2_000_000, True, None), ("r", "u2", None, False, "timed out"), ("s", "u1", 1, False, None)]
    found = ledger.download_totals(spark.createDataFrame(rows, "run_id string, url string, bytes long, changed boolean, error string"))
    assert {r.run_id: (r.files, r.changed, r.failed, r.mb) for r in found.collect()} == {"r": (2, 1, 1, 2.0), "s": (1, 0, 0, 0.0)}


def test_every_case_has_an_outcome(spark):
    day = datetime.date(2026, 1, 1)
    cases = spark.createDataFrame([("good", "X", day), ("bad", "Y", day), ("silent", "Z", day), ("undrafted", "W", day), ("outside", "X", datetime.date(2020, 1, 1))], "case_id string, city string, obs_date date")
    sheets = spark.createDataFrame([(c, c, day) for c in "XYZW"], "station_id string, city string, obs_date date")
    schema = "version string, station_id string, obs_date date, narrative string, " + ", ".join(f"{n} boolean" for n, _ in CHECKS)
    wrong = [n != "numbers_grounded" for n, _ in CHECKS]
    checked = spark.createDataFrame([("v1", "X", day, "A high of 21.0 degrees C.", *[True] * len(CHECKS)), ("v1", "Y", day, "A high of 99 °C.", *wrong), ("v1", "Z", day, "", *wrong)], schema)
    found = evaluation.results(cases, sheets, checked)
    got = {r.case_id: (r.outcome, r.passed, r.failed, r.style) for r in found.collect()}
    assert got == {
        "good": ("passed", True, [], ["units_as_symbols", "no_trailing_zero"]), "bad": ("failed", False, ["numbers_grounded"], []),
        "silent": ("no text", False, [], []), "undrafted": ("no text", False, [], []), "outside": ("no sheet", False, [], [])}
    run = lambda n, rows: evaluation.run_record(rows, F.lit(f"e{n}"), "m", F.lit(minutes(n)))
    records = run(1, found.where("case_id <> 'good'")).unionByName(run(2, found))
    last = evaluation.latest_evaluations(records).first()
    assert (last.eval_id, last.cases, last.passed, last.passed_change, last.runs) == ("e2", 5, 1, 1, 2)
    assert [x.case_id for x in records.where("eval_id = 'e2'").first().results] == ["bad", "good", "outside", "silent", "undrafted"]


def test_extracts_are_nested_by_key(spark):
    base = spark.createDataFrame([("s1", "X"), ("s2", "Y")], "station_id string, city string")
    days = spark.createDataFrame([("s1", 2, "b"), ("s1", 1, "a"), ("s1", 1, "a"), ("s3", 9, "z")], "station_id string, n int, value string")
    other = spark.createDataFrame([("s2", 5)], "station_id string, n int")
    got = {r.station_id: r for r in report.nested(base, "station_id", {"days": days, "value": other}).collect()}
    assert [tuple(x) for x in got["s1"].days] == [(1, "a"), (1, "a"), (2, "b")] and got["s1"].value == [] and got["s2"].days == [] and [tuple(x) for x in got["s2"].value] == [(5,)]
    assert set(got) == {"s1", "s2"}
    facts = spark.createDataFrame([('[{"element": "TMAX", "value": 1.5, "unit": null, "status": "valid"}]',), ("rubbish",), (None,)], "facts string")
    assert [len(r[0] or []) for r in facts.select(report.parsed_facts(F.col("facts"))).collect()] == [1, 0, 0]


def test_columns_are_taken_on_and_retired(spark):
    stored = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "k string, tmax int, snow int")
    after = sinks.wide_after(stored, spark.createDataFrame([("b", 9, 8)], "k string, wind int, tmax int"), ["k"])
    assert after.columns == ["k", "wind", "tmax"] and sorted(map(tuple, after.collect()), key=str) == [("a", None, 1), ("b", 9, 8)]
    assert grid.scoped_codes(spark.createDataFrame([("B",), ("A",), ("B",)], "element string")) == ["A", "B"]
    with pytest.raises(ValueError, match="too many"):
        grid.scoped_codes(spark.createDataFrame([("B",), ("A",)], "element string"), most=1)


def test_catalog_keeps_comments(spark):
    spark.sql("CREATE DATABASE kept_layer")
    try:
        sinks.register(spark, spark.range(3), "kept_layer.numbers", "It's \\ numbers", {"id": "a 'number'"})
        assert [tuple(r) for r in sinks.catalog_columns(spark, "kept_layer").collect()] == [("numbers", "It's \\ numbers", 1, "id", "bigint", "a 'number'")]
        assert sinks.table_exists(spark, "kept_layer.numbers") and not sinks.table_exists(spark, "kept_layer.nothing")
    finally:
        spark.sql("DROP DATABASE kept_layer CASCADE")


def test_forms_of_several_letters(spark):
    names = ["Ĳmuiden", "ﬁeld", "½ way", "Montréal", "℃ x", "日本", "plain", " ﬀ ", None]
    rows = spark.createDataFrame([(n, x) for n, x in enumerate(names)], "n int, name string").select("n", plain_name(F.col("name"))).collect()
    assert [r[1] for r in sorted(rows)] == ["IJMUIDEN", "FIELD", "12 WAY", "MONTREAL", "C X", "", "PLAIN", "FF", None]


def test_a_large_record_is_in_parts(spark):
    """No row of a record holds all results of a version; the parts hold each result once, and the record counts as one run."""
    rows = [(v, f"c{n:04d}", "X", None, "no sheet" if n % 9 == 0 else "passed", n % 9 > 0, [], ["w"], [], n, "text") for v in ("v1", "v2", None) for n in range(1000)]
    found = spark.createDataFrame(rows, "version string, case_id string, city string, obs_date date, outcome string, passed boolean, failed array<string>, warnings array<string>, style array<string>, chars int, narrative string")
    record = evaluation.run_record(found, F.concat(F.lit("e-"), F.coalesce("version", F.lit("none"))), "m", F.lit(minutes(1)), most=50).cache()
    got = record.collect()
    assert max(len(r.results) for r in got) < 120 and {r.cases for r in got} == {1000} and {r.no_sheet for r in got} == {112} and {r.avg_chars for r in got} == {499.5}
    for v in ("v1", "v2", None):
        assert sorted(x.case_id for r in got if r.version == v for x in r.results) == [f"c{n:04d}" for n in range(1000)]
        assert sorted(r.part for r in got if r.version == v) == list(range(20))
    assert {(r.version, r.runs, r.passed) for r in evaluation.latest_evaluations(record).collect()} == {(v, 1, 888) for v in ("v1", "v2", None)}
    assert evaluation.run_record(found.limit(0), F.lit("e"), "m", F.lit(minutes(1))).count() == 0
