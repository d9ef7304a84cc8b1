"""Arriving files under a backlog and with bad lines, commits of several tables, and the reader of rows and dead letters."""

import collections
import threading

import pytest
from pyspark.sql import functions as F

from skyledger.sources import commits, files
from skyledger.sources.shared import shared_dir
from skyledger.streaming import arrivals

A, B = "CAN00000001", "CAN00000002"


def text_of(s, d, e="TMAX", v="1"):
    return f"{s},{d},{e},{v},,,C,"


def put(spark, path, load, lines):
    """Files of raw lines: (station, line)."""
    files.write_files(spark.createDataFrame([(s, n, line) for n, (s, line) in enumerate(lines)], "file_station string, event_id long, line string"), f"{path}/load={load}")


def by_load(load):
    return F.make_timestamp(F.lit(2026), F.lit(2), load, F.lit(0), F.lit(0), F.lit(0))


def held(table):
    return {(r.station_id, r.obs_date): (r.value, r.first_loaded_at.day, r.last_changed_at.day) for r in table.collect()}


@pytest.mark.parametrize("together", [True, False])
def test_waiting_versions_are_applied_in_order(spark, together):
    path, root = shared_dir(spark, "arriving"), shared_dir(spark, "arrivals")
    days = [f"202601{n:02d}" for n in range(1, 31)]
    first = [(s, text_of(s, d)) for s in (A, B) for d in days]
    second = [(A, text_of(A, d, v="2" if d == days[0] else "1")) for d in days[:-1]] + [(B, text_of(B, d)) for d in days[:10]]  # B loses too much
    third = [(A, text_of(A, d, v="2" if d == days[0] else "1")) for d in days] + [(B, text_of(B, d, v="7" if d == days[3] else "1")) for d in days[1:]]
    loads = [first, second, third]
    for n, load in enumerate(loads, 1):
        put(spark, path, n, load)
        if not together:
            arrivals.merge_arrivals(spark, path, root, by_load, buckets=2)
    got = held(arrivals.merge_arrivals(spark, path, root, by_load, buckets=2))
    want = {(A, d): ("1", 1, 1) for d in days} | {(A, days[0]): ("2", 1, 2), (A, days[-1]): ("1", 1, 3)}
    want |= {(B, d): ("1", 1, 1) for d in days[1:]} | {(B, days[3]): ("7", 1, 3)}
    assert got == want
    log = collections.Counter((r.run_id, r.station_id, r.change) for r in arrivals.stored(spark, root, "log").collect())
    assert log == {("run-1", A, "insert"): 30, ("run-1", B, "insert"): 30, ("run-2", A, "update"): 1, ("run-2", A, "delete"): 1, ("run-3", A, "insert"): 1, ("run-3", B, "update"): 1, ("run-3", B, "delete"): 1}
    checks = {(r.station_id, r.load): r.passed for r in arrivals.stored(spark, root, "checks").where("check_name = 'deletes_within_limit'").collect()}
    assert checks == {(A, 2): True, (A, 3): True, (B, 2): False, (B, 3): True}


def test_bad_lines_are_dead_letters(spark):
    path, root = shared_dir(spark, "arriving"), shared_dir(spark, "arrivals")
    good = [(A, text_of(A, f"202601{n:02d}")) for n in range(1, 25)]
    bad = [(A, f"{A},20260131,TMAX,1"), (A, text_of(A, "20260131") + ",9"), (A, text_of(B, "20260131")), (A, text_of(A, "20260101", v="5")), (A, f'{A},20260130,TMAX,"1,5",,,C,')]
    put(spark, path, 1, [*good[:3], *bad, *good[3:]])
    assert len(held(arrivals.merge_arrivals(spark, path, root, by_load, buckets=2))) == 25
    rejects = {(r.line_number, r.reason.split()[0]) for r in arrivals.stored(spark, root, "rejects").collect()}
    assert rejects == {(4, "MISSING"), (5, "TOO"), (6, "filed"), (7, "second")}
    # A file without a good line would remove everything: refused, with its checks.
    put(spark, path, 2, [(A, "rubbish")])
    assert len(held(arrivals.merge_arrivals(spark, path, root, by_load, buckets=2))) == 25
    last = {r.check_name: r.passed for r in arrivals.stored(spark, root, "checks").where("load = 2").collect()}
    assert not last["parseable_rows"] and not last["deletes_within_limit"]


def test_a_batch_reads_its_own_buckets_only(spark):
    path, root = shared_dir(spark, "arriving"), shared_dir(spark, "arrivals")
    stations = [f"CAN{n:08d}" for n in range(30)]
    put(spark, path, 1, [(s, text_of(s, "20260101")) for s in stations])
    arrivals.merge_arrivals(spark, path, root, by_load, buckets=16)
    before = commits.latest(spark, root)
    put(spark, path, 2, [(stations[0], text_of(stations[0], "20260101", v="9"))])
    arrivals.merge_arrivals(spark, path, root, by_load, buckets=16)
    after = commits.latest(spark, root)
    changed = [b for b in before.tables["table"] if before.tables["table"][b] != after.tables["table"].get(b)]
    assert changed == [r[0] for r in spark.createDataFrame([(stations[0],)], "s string").select(arrivals.bucket_of("s", 16)).collect()]
    assert held(arrivals.stored_rows(spark, root))[stations[0], "20260101"][0] == "9"


NUMBERS = "k long, v long, bucket int"


def adding(spark, k, v):
    def build(state):
        old = state.read("t", "k long, v long", [k % 4]).where(F.col("k") != k)
        return {"t": commits.Change(old.unionByName(spark.createDataFrame([(k, v)], "k long, v long")).withColumn("bucket", (F.col("k") % 4).cast("int")), [k % 4]),
                "log": commits.Change(spark.createDataFrame([(k, v, k % 4)], NUMBERS))}
    return build


def test_two_writers_both_land(spark):
    root, ready = shared_dir(spark, "commits"), threading.Barrier(2)

    def write(k):
        build, first = adding(spark, k, k), [True]

        def at_once(state):
            if first.pop() if first else False:
                ready.wait(60)  # both have read the same state
            return build(state)
        commits.commit(spark, root, f"run-{k}", at_once)

    for pair in ((0, 4), (1, 2)):  # of one bucket, and of two
        threads = [threading.Thread(target=write, args=(k,)) for k in pair]
        for t in threads:
            t.start()
        for t in threads:
            t.join(120)
        ready.reset()
    state = commits.latest(spark, root)
    assert state.number == 4
    assert sorted(r.k for r in state.read("t", "k long, v long").collect()) == [0, 1, 2, 4] == sorted(r.k for r in state.read("log", "k long, v long").collect())


def test_a_failing_writer_leaves_nothing(spark):
    root = shared_dir(spark, "commits")
    commits.commit(spark, root, "run-1", adding(spark, 1, 1))

    def broken(state):
        return adding(spark, 5, 5)(state) | {"checks": commits.Change(spark.range(3).select("id", F.expr("raise_error('broken')").cast("int").alias("bucket")))}

    with pytest.raises(Exception, match="broken"):
        commits.commit(spark, root, "run-2", broken)
    state = commits.latest(spark, root)
    assert state.number == 1 and [r.k for r in state.read("t", "k long, v long").collect()] == [1]
    assert commits.commit(spark, root, "run-1", broken).number == 1  # a run that is repeated changes nothing
    commits.commit(spark, root, "run-2", adding(spark, 5, 5))
    assert commits.swept(spark, root, keep=1) == 3  # what the failed run wrote, and what was replaced
    assert sorted(r.k for r in commits.latest(spark, root).read("t", "k long, v long").collect()) == [1, 5]


def test_many_additions_become_one(spark):
    root = shared_dir(spark, "commits")
    for n in range(5):
        commits.commit(spark, root, f"run-{n}", adding(spark, n, n))
    state = commits.compacted(spark, root, {"log": "k long, v long"}, most=1)
    assert len(state.paths("log", [0])) == 1 and sorted(r.k for r in state.read("log", "k long, v long").collect()) == list(range(5))


def test_lines_are_numbered_over_splits(spark):
    path = shared_dir(spark, "lines")
    lines = [f"{n}" + "x" * (n % 40) for n in range(4000)]
    spark.createDataFrame([("f", n, x) for n, x in enumerate(lines)] + [("g", n, f"g{n}") for n in range(7)], "file_station string, n long, line string").repartition(1).sortWithinPartitions("n").select("file_station", "line").write.partitionBy("file_station").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        found = files.split_lines(spark.read, path, "file_station string")
        assert found.select("_from").distinct().count() > 5
        got = {(r.file_station, r.line_number): r.line for r in files.numbered(found).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {("f", n + 1): x for n, x in enumerate(lines)} | {("g", n + 1): f"g{n}" for n in range(7)}


def test_quotes_are_part_of_the_parse(spark):
    path = shared_dir(spark, "quotes")
    lines = ['S,20260101,TMAX,"1,5",,"a ""b"", c",C,', 'S,20260101,TMAX,"1,5",,,C,,9', '"S",20260101', "", "S,20260101,TMAX,7,,,C,", f'S,20260101,TMAX,"{"x," * 20000}",,,C,']
    put_lines = spark.createDataFrame([("S", n, x) for n, x in enumerate(lines)], "file_station string, event_id long, line string")
    files.write_files(put_lines, path)
    found = files.scan_with_rejects(spark, path)
    got = {r.line_number: (r.reason, r.value, r.qflag) for r in found.collect()}
    assert got[1] == (None, "1,5", 'a "b", c') and got[2][0] == "TOO MANY COLUMNS" and got[3][0] == "MISSING COLUMNS" and got[5] == (None, "7", None) and len(got[6][1]) == 40_000 and 4 not in got
    assert files.scan_observations(spark, path).count() == 3


def test_bundles_hold_what_files_would(spark):
    folders, bundles = shared_dir(spark, "folders"), shared_dir(spark, "bundles")
    names = ["CAN1", "CAN2", None, "a b", "50%", "t\tb", "ü"]
    texts = [x for n in range(900) for x in [f"{n}," + "x" * (n % 30)]] + ["", "a\tb", None]
    rows = spark.createDataFrame([(s, n, x) for s in names for n, x in enumerate(texts)] + [("CAN3", 0, "one\n\ntwo\n")], "file_station string, event_id long, line string")
    files.write_files(rows, folders)
    files.write_bundles(rows, bundles)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = lambda df: {r.file_station: r.sha256 for r in df.collect()}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        assert files.bundle_lines(spark.read, bundles).select("_file", "_from").distinct().count() > 20  # a file in several splits, a split with several files
        got = {(r.file_station, r.line_number): r.line for r in files.numbered(files.station_lines(spark.read, bundles, bundled=True)).collect()}
        assert got == {(s, n + 1): x or "" for s in names for n, x in enumerate(texts)} | {("CAN3", n): x for n, x in enumerate(["one", "", "two", ""], 1)}
        assert whole(files.fingerprints(spark, bundles, bundled=True)) == whole(files.fingerprints(spark, folders))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bundles_arrive_like_files(spark):
    days = [f"202601{n:02d}" for n in range(1, 31)]
    loads = [[(s, text_of(s, d)) for s in (A, B) for d in days], [(A, text_of(A, d, v="2")) for d in days[1:]] + [(B, "rubbish")]]
    found = []
    for bundled in (False, True):
        path, root = shared_dir(spark, "arriving"), shared_dir(spark, "arrivals")
        for n, load in enumerate(loads, 1):
            rows = spark.createDataFrame([(s, k, line) for k, (s, line) in enumerate(load)], "file_station string, event_id long, line string")
            (files.write_bundles if bundled else files.write_files)(rows, f"{path}/load={n}")
            table = arrivals.merge_arrivals(spark, path, root, by_load, buckets=2, bundled=bundled)
        found.append([sorted(map(str, df.collect())) for df in (table, *[arrivals.stored(spark, root, n) for n in ("log", "rejects", "checks")])])
    assert found[0] == found[1] and found[0][2]


@pytest.mark.parametrize("name", ["fct_refresh", "stream_merge", "stream_backlog", "stream_backlog_log", "stream_rejects"])
def test_queries_let_bundles_arrive(spark, sf, monkeypatch, name):
    """What arrives are a few files for each load, not one for each station."""
    from skyledger.plans import queries, tables

    def arriving(spark, path, *args, **options):
        raise RuntimeError(path)

    monkeypatch.setattr(queries.arrivals, "merge_arrivals", arriving)
    with pytest.raises(RuntimeError) as e:
        queries.QUERIES[name](spark, sf)
    stations = tables.Tables(spark, sf).first.select("file_station").distinct().count()
    assert spark.read.text(str(e.value)).select("_metadata.file_path").distinct().count() < stations


def test_documents_come_from_bundles(spark, sf):
    """Many documents stand in one file, and each comes out whole."""
    path = shared_dir(spark, "documents")
    texts = {f"d{n}": f"I. TITLE {n}\n\tline\r\n\nend" + "\n" * (n % 2) for n in range(40)}
    files.write_bundles(spark.createDataFrame([(d, 1, x) for d, x in texts.items()], "doc string, n int, line string"), path, key="doc", order="n")
    assert spark.read.text(path).select("_metadata.file_path").distinct().count() < 40
    assert {r.doc: r.content for r in files.load_documents(spark, path, bundled=True).collect()} == {d: x + "\n" for d, x in texts.items()}


def test_files_written_grow_with_bytes(spark, sf):
    """The queries' station files are bundles: as many as there are tasks to write them, not one for each station."""
    from skyledger.plans import queries, tables

    t = tables.Tables(spark, sf)
    path = queries.station_files(t, t.first, False)
    assert t.first.select("file_station").distinct().count() > spark.read.text(path).select("_metadata.file_path").distinct().count()
