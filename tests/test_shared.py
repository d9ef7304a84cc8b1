"""Lookups behind a filter of the keys."""

import threading

import pytest
from pyspark.sql import functions as F

from skyledger.sources import shared


@pytest.fixture
def tables(spark):
    """Rows with keys of two columns, some null, some repeated, and a side of every seventh key."""
    number = F.col("id")
    rows = spark.range(3000).select(
        number.alias("n"), F.when(number % 50 != 0, F.concat(F.lit("f"), (number % 5).cast("string"))).alias("file"), (number % 1000).alias("row"), F.repeat(F.lit("x"), 20).alias("text"))
    side = spark.range(0, 1000, 7).select(F.concat(F.lit("f"), (number % 5).cast("string")).alias("of"), number.alias("at"))
    return shared.written(rows, "test-rows"), shared.written(side, "test-side")


@pytest.mark.parametrize("words", [1, 16, 1 << 20])
def test_lookup_behind_a_filter_equals_a_join(spark, tables, monkeypatch, words):
    """However many keys the filter takes for wanted wrongly: a filter of one word refuses next to nothing."""
    rows, side = tables
    on = {"of": F.col("file"), "at": F.col("row")}
    met = (F.col("file") == F.col("of")) & (F.col("row") == F.col("at"))
    want_in = sorted(r.n for r in rows.join(side, met).collect())
    want_out = sorted(r.n for r in rows.join(side, met, "left_anti").collect())
    assert want_in and len(want_in) + len(want_out) == 3000
    for small in (True, False):
        monkeypatch.setattr(shared, "FILTER_WORDS", words)
        monkeypatch.setattr(shared, "is_small", lambda *_, small=small: small)
        found, rest = shared.those_in(rows, side, on), shared.those_not_in(rows, side, on)
        assert sorted(r.n for r in found.collect()) == want_in
        assert sorted(r.n for r in rest.collect()) == want_out and rest.columns == rows.columns


def test_filter_lets_few_other_rows_through_and_has_a_fixed_size(spark, tables, monkeypatch):
    rows, side = tables
    may, none = shared.may_be_in(rows, side, {"of": F.col("file"), "at": F.col("row")})
    assert may.count() + none.count() == 3000 and may.count() <= 143 * 3 + 5
    monkeypatch.setattr(shared, "FILTER_WORDS", 8)
    word, bits = shared._filter_place(F.col("of"), F.col("at"))
    assert side.select(word.alias("w")).distinct().count() <= 8
    assert side.where(F.bit_count(bits).isin(1, 2)).count() == side.count()


def test_rows_that_surely_have_no_match_are_not_moved(spark, tables, monkeypatch):
    rows, side = tables
    monkeypatch.setattr(shared, "is_small", lambda *_: False)
    none = shared.may_be_in(rows, side, {"of": F.col("file"), "at": F.col("row")})[1]
    plan = none._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_work_tables_of_other_threads_stay(spark):
    kept = []
    with shared.scratch(spark):
        own = shared.written(spark.range(3), "scratch-own")
        other = threading.Thread(target=lambda: kept.append(shared.written(spark.range(4), "scratch-other")))
        other.start()
        other.join()
        with shared.scratch(spark):
            inner = shared.written(spark.range(5), "scratch-inner")
        assert own.count() == 3
    assert kept[0].count() == 4
    for gone in (own, inner):
        with pytest.raises(Exception, match="(?i)not.exist"):
            gone.count()
