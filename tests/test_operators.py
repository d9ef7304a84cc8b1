"""Small cases of single operators."""

import datetime

from pyspark.sql import functions as F

from skyledger.functions.values import compass, obs_day, plain_name, short
from skyledger.operators import assess, checks, grid, narrative, resolve, textcheck
from skyledger.sources import files, sinks
from skyledger.sources.shared import shared_dir

D = datetime.date


def test_assess_statuses(spark):
    obs = spark.createDataFrame(
        [("S", D(2026, 1, 1), "TMAX", 50, None, None), ("S", D(2026, 1, 1), "TMIN", 80, None, None), ("S", D(2026, 1, 2), "TMAX", 100, None, None), ("S", D(2026, 1, 2), "TMIN", 20, None, None),
         ("S", D(2026, 1, 3), "TMAX", 10, None, "I"), ("S", D(2026, 1, 3), "TMIN", 20, None, None), ("S", D(2026, 1, 4), "TMAX", 900, None, None), ("S", D(2026, 1, 5), "TMAX", 0, "T", None), ("S", None, "TMAX", 1, None, None)],
        "station_id string, obs_date date, element string, raw_value int, mflag string, qflag string")
    elements = spark.createDataFrame([(e, "degrees C", 0.1, -60.0, 50.0, "h") for e in ("TMAX", "TMIN")], "element string, unit string, scale double, lower_bound double, upper_bound double, policy_hash string")
    got = {(r.obs_date.day if r.obs_date else None, r.element): r.quality_status for r in assess.assess(obs, spark.createDataFrame([("S",)], "station_id string"), elements).collect()}
    assert got == {(1, "TMAX"): "inconsistent", (1, "TMIN"): "inconsistent", (2, "TMAX"): "valid", (2, "TMIN"): "valid", (3, "TMAX"): "qc_failed", (3, "TMIN"): "valid",
                   (4, "TMAX"): "out_of_bounds", (5, "TMAX"): "trace", (None, "TMAX"): "unparseable"}


def test_grid_persistence(spark):
    scope = spark.createDataFrame([(D(2026, 1, 1), D(2026, 1, 9))], "start_date date, end_date date")
    selected = spark.createDataFrame([("S",)], "station_id string")
    elements = spark.createDataFrame([("SNWD", "mm", True, True, True, "SNOW"), ("SNOW", "mm", True, False, False, None)],
                                     "element string, unit string, is_core boolean, absent_means_zero boolean, persistent boolean, fed_by string")
    reported = spark.createDataFrame([("S", "SNWD", 2020, 2026), ("S", "SNOW", 2020, 2025)], "station_id string, element string, first_year int, last_year int")
    fct = spark.createDataFrame(
        [("S", D(2026, 1, 1), "SNWD", 40.0, "valid", True), ("S", D(2026, 1, 3), "SNWD", 20.0, "valid", True), ("S", D(2026, 1, 5), "SNOW", 3.0, "valid", True), ("S", D(2026, 1, 6), "SNWD", None, "qc_failed", False)],
        "station_id string, obs_date date, element string, value double, quality_status string, is_usable boolean").withColumns(
        {"is_deleted": F.lit(False), "is_trace": F.lit(None).cast("boolean"), "qflag": F.lit(None).cast("string"), "raw_value": F.lit(1)})
    got = {(r.obs_date.day, r.element): (r.status, r.value) for r in grid.station_day_grid(scope, selected, elements, reported, fct).collect()}
    assert {d for d, _ in got} == set(range(1, 7))  # up to the latest reading
    assert got[2, "SNWD"] == ("missing", None)  # between two readings above zero
    assert got[4, "SNWD"] == ("not_reported", 0.0) and got[5, "SNWD"] == ("missing", None)  # new snow fell on the 5th
    assert got[6, "SNWD"] == ("qc_failed", None) and got[1, "SNOW"] == ("not_expected", None) and got[5, "SNOW"] == ("valid", 3.0)


def test_window_before_or_without_readings(spark):
    scope = spark.createDataFrame([(D(2026, 1, 5), D(2026, 1, 9))], "start_date date, end_date date")
    fct = spark.createDataFrame([(D(2026, 1, 1), False)], "obs_date date, is_deleted boolean")
    assert grid.day_spine(scope, fct).count() == 0 and grid.day_spine(scope, fct.limit(0)).count() == 5


def test_values(spark):
    r = spark.range(1).select(compass(F.lit(290.0)).alias("a"), compass(F.lit(350.0)).alias("b"), obs_day(F.lit("2026010")).alias("c"), obs_day(F.lit("20260231")).alias("d"), short(F.lit(21.0)).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == ("W", "N", None, None, "21")


def checked(spark, text, facts, cited=(), city="Toronto", others=("Ottawa",)):
    rows = spark.createDataFrame(
        [(text, list(cited), [(e, float(v) if v is not None else None, s, c) for e, v, s, c in facts], D(2026, 9, 12), city, list(others))],
        "narrative string, cited array<struct<element:string,value:double>>, fact_list array<struct<element:string,value:double,status:string,compass:string>>, obs_date date, city string, other_cities array<string>")
    r = textcheck.text_checks(rows).first().asDict()
    return {n for n, _ in textcheck.CHECKS if not r[n]}


FACTS = [("TMAX", 21.4, "valid", None), ("TMIN", 11, "valid", None), ("PRCP", 0, "valid", None), ("SNWD", 0, "not_reported", None), ("WDFG", 290, "valid", "W"), ("WSFG", 45.0, "valid", None)]
CITED = [("TMAX", 21.4), ("TMIN", 11.0)]


def test_text_checks(spark):
    good = "On September 12th, Toronto had a high of 21 °C and a low of 11 °C. It stayed dry with gusts of 45 km/h from the west."
    assert checked(spark, good, FACTS, CITED) == set()
    assert "numbers_grounded" in checked(spark, "Toronto got 12 mm.", FACTS, CITED)
    assert "high_low_attribution" in checked(spark, "Toronto had a high of 11 °C.", FACTS, CITED)
    assert "compass_matches" in checked(spark, "Toronto: wind from the NW.", FACTS, CITED)
    assert "compass_matches" in checked(spark, "Toronto: wind from the WNW.", FACTS, CITED)
    assert "no_invented_topics" in checked(spark, "Toronto will be sunny tomorrow.", FACTS, CITED)
    assert "names_own_city" in checked(spark, "Ottawa was mild.", FACTS, CITED)
    assert "own_city_named" in checked(spark, "It was mild.", FACTS, CITED)
    # Capitals with accents are the same name; a name inside a word is not; without a city nothing is asked for.
    assert "names_own_city" in checked(spark, "MONTRÉAL was mild.", FACTS, CITED, others=["Montréal"])
    assert "own_city_named" not in checked(spark, "MONTRÉAL was mild.", FACTS, CITED, city="Montréal")
    assert "names_own_city" not in checked(spark, "Montréalais say it was mild.", FACTS, CITED, others=["Montréal"])
    assert not {"own_city_named", "names_own_city"} & checked(spark, "It was mild.", FACTS, CITED, city=None)
    assert "names_own_city" in checked(spark, "Ottawa was mild.", FACTS, CITED, city=None)
    assert "no_false_gaps" in checked(spark, "Toronto: the temperature was not available.", FACTS, CITED)
    assert "cited_values_match" in checked(spark, good, FACTS, [("TMAX", 25.0), ("TMIN", 11.0)])
    assert "mentions_temperatures" in checked(spark, good, FACTS, [("TMAX", 21.4)])
    assert "intensity_supported" in checked(spark, "Toronto had heavy rain.", FACTS, CITED)
    trace = [("PRCP", 0, "trace", None), ("SNOW", 2, "valid", None)]
    assert "no_false_zero" in checked(spark, "Toronto stayed dry.", trace)
    assert "no_false_zero" not in checked(spark, "Toronto had no measurable rain.", trace)
    assert "no_false_zero" in checked(spark, "Toronto had no snow.", trace)
    assert "no_false_zero" not in checked(spark, "Toronto had no snow on the ground.", [*trace, ("SNWD", None, "not_reported", None)])
    assert "acknowledges_gaps" in checked(spark, "Toronto was mild.", [("TMAX", None, "missing", None)])
    assert "length" in checked(spark, "Toronto. " * 5, FACTS, CITED)


def test_layout_and_fixed_width(spark):
    line = "CAN00000001  45.0000  -75.0000  100.5 ON TORONTO A                      GSN     71265"
    row = files.fixed_width_scan(spark.createDataFrame([(line,), ("   ",)], "value string")).collect()
    assert [(r.id, r.latitude, r.name, r.gsn_flag, r.hcn_crn_flag) for r in row] == [("CAN00000001", "45.0000", "TORONTO A", "GSN", None)]
    doc = spark.createDataFrame([("d", "II. X\nIV. FORMAT\nID 1-11 Character\nLATITUDE 13-21 Real")], "doc string, content string")
    declared = spark.createDataFrame([("id", 1, 11), ("latitude", 13, 20)], "variable string, first int, last int")
    assert [(r.variable, r.doc_last) for r in files.layout_drift(files.documented_layout(doc), declared).collect()] == [("latitude", 21)]


def test_rejected_lines(spark):
    lines = spark.createDataFrame([("f", n + 1, x) for n, x in enumerate(["S,20260101,TMAX,1,,,C,", "S,20260101", "S,20260101,TMAX,1,,,C,,9"])], "file_station string, line_number long, line string")
    assert [(r.line_number, r.reason) for r in files.rejected_lines(lines).orderBy("line_number").collect()] == [(2, "MISSING COLUMNS"), (3, "TOO MANY COLUMNS")]


def test_nearby_across_the_date_line(spark):
    anchors = spark.createDataFrame([("c", "CA", "a", 60.0, 179.999)], "city string, country_code string, anchor_id string, anchor_lat double, anchor_lon double")
    stations = spark.createDataFrame([("x", "CA", 60.0, -179.999), ("y", "CA", 60.2, 179.0), ("z", "US", 60.0, 179.999)], "station_id string, country_code string, latitude double, longitude double")
    assert [(r.station_id, r.distance_km) for r in resolve.nearby_stations(anchors, stations, 5.0).collect()] == [("x", 0.1)]


def test_batches_follow_order(spark):
    queue = spark.createDataFrame([(f"s{n % 3}", f"t{n % 3}", D(2026, 1, 1 + n // 3)) for n in range(9)], "station_id string, city string, obs_date date")
    got = narrative.batches(queue, 2, 3).orderBy(F.col("obs_date").desc(), "city").collect()
    assert [r.batch for r in got] == [0, 0, 1, 1, 2, 2, 3, 3, 4] and [r.deferred for r in got] == [False] * 6 + [True] * 3


def test_data_tests(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "k int, v string")
    assert checks.unique(t, "k").count() == 1 and checks.not_null(t, "v").count() == 1 and checks.accepted_values(t, "v", ["a"]).count() == 1
    assert checks.relationships(t, "k", spark.createDataFrame([(2,)], "id int"), "id").count() == 2 and checks.single_row(t).count() == 1
    failed = checks.all_failures([("n", "t", "warn", checks.not_null(t, "v"))]).first()
    assert (failed.test_name, failed.failing_row) == ("n", '{"k":null,"v":null}')


def test_sinks(spark):
    root = shared_dir(spark, "sink-test")
    old, new = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]))
    sinks.publish(spark, {"t": old}, root, "run-1")
    sinks.replace_keys(spark, root, "t", new.withColumn("w", F.lit(1)), ["k"], "run-2")
    assert {(r.k, r.v, r.w) for r in sinks.published(spark, root, "t").collect()} == {(1, "a", None), (2, "c", 1), (3, "d", 1)}
    for n in range(9, 12):  # publications count, not the names of runs
        sinks.publish(spark, {"t": old.withColumn("n", F.lit(n))}, root, f"run-{n}")
    assert {r.n for r in sinks.published(spark, root, "t").collect()} == {11}
    for run in ("r1", "r2", "r1"):
        sinks.append_log(old, f"{root}/log", run)
    assert spark.read.parquet(f"{root}/log").count() == 4
    sinks.write_snapshot(old, f"{root}/snap", {"k": "the key"})
    assert spark.read.parquet(f"{root}/snap").schema["k"].metadata == {"comment": "the key"}
    sinks.write_report(old, f"{root}/report")
    assert spark.read.json(f"{root}/report").count() == 2


def test_data_tests_find_each_kind_of_failure(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("b", "x", 5.0), (None, "y", None)], "k string, v string, n double")
    tests = [
        ("not_null_v", "error", checks.breaks("not_null", "v", None)), ("accepted_v", "error", checks.breaks("accepted_values", "v", ["x"])),
        ("bounds_n", "warn", checks.breaks("within_bounds", "n", (0, 2))), ("not_null_k", "warn", checks.breaks("not_null", "k", None))]
    found = checks.row_failures(rows, "t", [F.col("k")], tests)
    assert sorted((r.test_name, r.severity, r.failing_row) for r in found.collect()) == [
        ("accepted_v", "error", '{"k":null}'), ("bounds_n", "warn", '{"k":"b"}'), ("not_null_k", "warn", '{"k":null}'), ("not_null_v", "error", '{"k":"a"}')]
    named = spark.createDataFrame([("not_null_v", "t", "error"), ("bounds_n", "t", "warn"), ("other", "t", "error")], "test_name string, tested string, severity string")
    assert {r.test_name: (r.failing, r.status) for r in checks.test_status(named, found).collect()} == {"not_null_v": (1, "fail"), "bounds_n": (1, "warn"), "other": (0, "pass")}
    assert checks.row_failures(rows.limit(0), "t", [F.col("k")], tests).count() == 0


def test_health_names_every_section(spark):
    problems = spark.createDataFrame([("load", "warn"), ("load", "error"), ("changes", "info")], "section string, severity string")
    found = {r.section: (r.errors, r.warnings, r.notes, r.status) for r in checks.health_status(problems, ["load", "changes", "texts"]).collect()}
    assert found == {"load": (1, 1, 0, "ERROR"), "changes": (0, 0, 1, "OK"), "texts": (0, 0, 0, "OK")}


def test_plain_names(spark):
    names = ["Montréal", "ＳＡＩＮＴ Jean", "Łódź ", None, "", "São Tomé 北"]
    found = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").select("i", plain_name(F.col("n")).alias("p")).orderBy("i").collect()
    assert [r.p for r in found] == ["MONTREAL", "SAINT JEAN", "ODZ", None, "", "SAO TOME"]


def test_resolution_errors_name_each_case(spark):
    cities = spark.createDataFrame([("A", "X", None), ("B", "X", None), ("C", "X", "p"), ("D", "X", None), ("E", "X", None), ("F", "X", "q")], "city string, province string, pinned_id string")
    resolved = spark.createDataFrame(
        [("B", "X", "s1", False, "name isn't an airport's"), ("C", "X", "p", False, "reports 1 of 3 required elements"), ("D", "X", "s2", True, "selected: a"),
         ("E", "X", "s2", True, "selected: b")], "city string, province string, station_id string, selected boolean, reason string")
    found = {(r.city, r.station_id): r.error for r in resolve.resolution_errors(cities, resolved).collect()}
    several = "station was given to several cities"
    assert found == {
        ("A", None): "no station has the city's name", ("B", None): "no station of that name is an airport's", ("C", None): "pinned station reports too little",
        ("F", None): "pinned station is unknown", ("D", "s2"): several, ("E", "s2"): several}
