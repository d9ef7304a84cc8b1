"""The run's tables, composed from the operators. What several consumers share is written to the shared folder once."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.values import flags
from skyledger.operators import assess, checks, evaluation, facts, grid, marts, merge, narrative, resolve, scope, staging, textcheck
from skyledger.plans import data_tests
from skyledger.sources import feed, files
from skyledger.sources.shared import written

DAYS = 7
MODEL, VERSION = "template-1", "v3"


def csv_lines(rows: DataFrame, spoil: bool) -> DataFrame:
    """(file_station, event_id, line): rows as lines of their station's file; ``spoil`` cuts some short and lengthens others."""
    def written_field(c: str) -> Column:
        text = F.coalesce(c, F.lit(""))
        return F.when(text.rlike('[",]'), F.concat(F.lit('"'), F.regexp_replace(text, '"', '""'), F.lit('"'))).otherwise(text)

    line = F.concat_ws(",", *[written_field(c) for c in feed.COLUMNS])
    if spoil:
        line = F.when(F.col("event_id") % 101 == 0, F.concat_ws(",", *[written_field(c) for c in feed.COLUMNS[:5]])).when(
            F.col("event_id") % 107 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    return rows.select("file_station", "event_id", line.alias("line"))


class Tables:
    """Everything a query may start from, for one folder of source tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    # Sources
    @cached_property
    def feed(self) -> DataFrame:
        return feed.feed(self.spark, self.dir)

    @cached_property
    def first(self) -> DataFrame:
        return feed.first_snapshot(self.feed)

    @cached_property
    def second(self) -> DataFrame:
        return feed.second_snapshot(self.feed)

    @cached_property
    def metadata(self) -> DataFrame:
        return feed.stations(self.spark, self.dir)

    @cached_property
    def scope(self) -> DataFrame:
        return feed.scope(self.spark)

    # Merge of the second snapshot into the first
    @cached_property
    def stored(self) -> DataFrame:
        return merge.first_load(merge.dedup(self.first), feed.FIRST_RUN, feed.LOADED_AT)

    @cached_property
    def incoming(self) -> DataFrame:
        return merge.dedup(self.second)

    @cached_property
    def found_changes(self) -> DataFrame:
        return written(merge.detect_changes(self.stored, self.incoming), "changes")

    @cached_property
    def guard(self) -> DataFrame:
        return merge.deletes_guard(self.found_changes, self.stored, feed.MAX_DELETED_PCT)

    @cached_property
    def changes(self) -> DataFrame:
        return merge.accepted(self.found_changes, self.guard)

    @cached_property
    def first_log(self) -> DataFrame:
        none = F.lit(None).cast("string")
        inserts = self.stored.select(*merge.KEY, F.lit("insert").alias("change"), none.alias("old_value"), F.col("value").alias("new_value"), none.alias("old_flags"), flags().alias("new_flags"))
        return merge.logged(inserts, feed.FIRST_RUN, feed.LOADED_AT)

    @cached_property
    def log(self) -> DataFrame:
        return self.first_log.unionByName(merge.logged(self.changes, feed.SECOND_RUN, feed.CHANGED_AT))

    @cached_property
    def merged(self) -> DataFrame:
        return written(merge.merge(self.stored, self.incoming, self.changes, self.log, feed.SECOND_RUN, feed.CHANGED_AT), "merged")

    @cached_property
    def rejects(self) -> DataFrame:
        return merge.row_rejects(self.second)

    @cached_property
    def load_checks(self) -> DataFrame:
        # The second snapshot's files with some lines spoilt: the reader rejects these and takes the others.
        lines = written(csv_lines(self.second, True), "lines")
        return merge.load_checks(files.parsed_lines(lines), files.rejected_lines(lines), self.guard, feed.MAX_DELETED_PCT)

    # Scope
    @cached_property
    def stations(self) -> DataFrame:
        return staging.typed_stations(self.metadata)

    @cached_property
    def selected(self) -> DataFrame:
        # Few columns and one row per station; everything else finds its station through this.
        return written(scope.stations_selected(feed.selected_stations(self.metadata), self.stations), "selected")

    @cached_property
    def inventory(self) -> DataFrame:
        return staging.typed_inventory(feed.inventory(self.feed))

    @cached_property
    def elements(self) -> DataFrame:
        return written(scope.elements_in_scope(self.inventory, self.selected, staging.typed_elements(feed.catalog(self.spark)), feed.policy(self.spark), self.scope), "elements")

    @cached_property
    def reported(self) -> DataFrame:
        return scope.station_elements(self.selected, self.inventory, self.elements)

    # Facts and marts
    def typed_of(self, table: DataFrame) -> DataFrame:
        return staging.typed_observations(table.withColumnsRenamed({"last_changed_at": "raw_changed_at", "run_id": "raw_run_id"}))

    def assessed_of(self, table: DataFrame) -> DataFrame:
        return assess.assess(self.typed_of(table), self.selected, self.elements)

    @cached_property
    def assessed(self) -> DataFrame:
        return self.assessed_of(self.merged)

    @cached_property
    def assessed_before(self) -> DataFrame:
        return self.assessed_of(self.stored)

    @cached_property
    def fct(self) -> DataFrame:
        return written(facts.fct_full(self.assessed, self.log, self.selected, self.elements), "fct")

    @cached_property
    def fct_before(self) -> DataFrame:
        return facts.fct_full(self.assessed_before, self.first_log, self.selected, self.elements)

    @cached_property
    def grid(self) -> DataFrame:
        return written(grid.station_day_grid(self.scope, self.selected, self.elements, self.reported, self.fct), "grid")

    @cached_property
    def quality(self) -> DataFrame:
        return marts.data_quality(self.grid, self.selected, self.elements, self.scope)

    @cached_property
    def sheets(self) -> DataFrame:
        return marts.fact_sheets(self.grid, self.elements, self.selected)

    # Texts: some are spoilt by rule, so that every check has something to find
    @cached_property
    def drafts(self) -> DataFrame:
        return narrative.template_narratives(self.sheets)

    @cached_property
    def texts(self) -> DataFrame:
        kind = (F.substring("station_id", 4, 8).cast("int") + F.dayofmonth("obs_date")) % 9
        text = F.col("narrative")
        spoilt = (
            F.when(kind == 1, F.concat(text, F.lit(" Expect sunny skies tomorrow."))).when(kind == 2, F.concat(F.lit("A high of 99 °C. "), text))
            .when(kind == 3, F.concat(text, F.lit(" It stayed dry."))).when(kind == 4, F.concat(text, F.lit(" Wind came from the NW.")))
            .when(kind == 5, F.concat(text, F.lit(" Town 3 was dry."))).when(kind == 6, F.concat(F.lit("Heavy rain fell. "), text))
            .when(kind == 7, F.concat(text, F.lit(" No snow on the ground; the temperature was missing."))).when(kind == 8, F.concat(text, F.lit(" Northerly wind, 12.0 degrees C.")))
            .otherwise(text)
        )
        return self.drafts.withColumn("narrative", spoilt).withColumn("other_cities", F.array(*[F.lit(f"Town {n}") for n in (1, 2, 3)])).withColumn("kind", kind)

    @cached_property
    def checked(self) -> DataFrame:
        version = F.concat(F.lit("v"), (F.dayofmonth("obs_date") % 3).cast("string"))
        return textcheck.text_checks(self.texts).withColumn("version", version).withColumn("model", F.lit(MODEL))

    @cached_property
    def cases(self) -> DataFrame:
        """Evaluation cases: of each station its coldest, hottest and wettest day with a reading, and a day before the window."""
        usable = self.grid.where(F.col("status").isin("valid", "trace")).where(F.col("element").isin("TMIN", "TMAX", "PRCP"))
        sign = F.when(F.col("element") == "TMIN", 1).otherwise(-1)
        hard = usable.groupBy("station_id", "element").agg(F.min(F.struct((sign * F.col("value")).alias("v"), "obs_date"))["obs_date"].alias("obs_date"))
        outside = self.selected.select("station_id", F.lit("outside").alias("element"), F.lit("2023-12-31").cast("date").alias("obs_date"))
        return hard.unionByName(outside).join(self.selected.select("station_id", "city"), "station_id").select(
            F.concat_ws("-", F.col("city"), F.lower("element")).alias("case_id"), "city", "obs_date")

    @cached_property
    def evaluated(self) -> DataFrame:
        # Two versions of the texts; some days have no draft, and some drafts are empty.
        drafts = self.checked.where("kind <> 4").withColumn("narrative", F.when(F.col("kind") == 2, "").otherwise(F.col("narrative")))
        versions = F.explode(F.when(F.col("kind") == 7, F.array(F.lit("v1"))).otherwise(F.array(F.lit("v1"), F.lit("v2"))))
        return evaluation.results(self.cases, self.sheets, drafts.drop("version").withColumn("version", versions))

    @cached_property
    def run_events(self) -> DataFrame:
        """Starts and ends of runs: the first of four events in a row starts a run, the last ends it, if it ends."""
        k = F.col("event_id")
        run = (k - k % 4) / 4
        stage = F.element_at(F.array(*[F.lit(x) for x in ("ingest", "transform", "narrate", "report", "evaluate")]), (run % 5 + 1).cast("int"))
        what = F.when(k % 4 == 0, "started").when((k % 4 == 3) & (run % 7 == 0), "failed").when((k % 4 == 3) & (run % 11 != 0), "finished")
        rows = feed.read_table(self.spark, self.dir, "events").select(
            F.format_string("run-%08d", run.cast("long")).alias("run_id"), stage.alias("stage"), what.alias("event"), F.date_trunc("second", "ts").alias("at"),
            F.when(what == "failed", F.concat(F.lit("no answer to event "), k.cast("string"))).alias("error"))
        return rows.where("event is not null")

    @cached_property
    def downloads(self) -> DataFrame:
        k = F.col("page_id")
        return feed.read_table(self.spark, self.dir, "pages").select(
            F.concat(F.lit("run-"), (k % 4 + 1).cast("string")).alias("run_id"), "url", F.octet_length("html").cast("long").alias("bytes"), (k % 3 == 0).alias("changed"),
            F.when(k % 11 == 0, "timed out").alias("error"))

    @cached_property
    def written(self) -> DataFrame:
        """Stored texts: first attempts for most station-days, second ones for some."""
        base = self.checked.where("kind <> 0").select(
            "station_id", "obs_date", "input_hash", F.lit(MODEL).alias("model"), F.lit(VERSION).alias("version"), "narrative", "passed", "failed_checks", "kind")
        again = base.where("kind in (3, 4)").withColumn("attempt", F.lit(2))
        return base.withColumn("attempt", F.lit(1)).unionByName(again).withColumn(
            "generated_at", F.to_timestamp(F.concat(F.lit("2024-03-0"), F.col("attempt").cast("string"), F.lit(" 00:00:00"))))

    @cached_property
    def validation(self) -> DataFrame:
        key = ["station_id", "obs_date", "input_hash", "model", "version", "attempt"]
        return self.written.where("kind <> 5").select(*key, "passed", "failed_checks")

    @cached_property
    def latest(self) -> DataFrame:
        return narrative.latest_narratives(self.written.drop("passed", "failed_checks"), self.validation)

    # Resolution
    @cached_property
    def coverage(self) -> DataFrame:
        return scope.element_coverage(self.inventory, feed.REQUIRED, 2024, 2024)

    @cached_property
    def cities(self) -> DataFrame:
        return feed.cities(self.metadata)

    @cached_property
    def resolved(self) -> DataFrame:
        return resolve.resolve_stations(self.stations, self.coverage, self.cities.withColumn("country", F.lit("CA")), feed.REQUIRED, feed.MAX_KM)

    # Tests
    @cached_property
    def test_results(self) -> list[tuple[str, str, str, DataFrame]]:
        day = lambda rows: rows.withColumn("obs_date", F.col("obs_date").cast("string"))
        return [
            ("not_null_obs_date", "fct_observations", "warn", checks.not_null(self.fct, "obs_date").select("station_id", "obs_date_text", "element")),
            ("value_within_300", "fct_observations", "warn", day(checks.within_bounds(self.fct.where("is_usable"), "value", -300, 300).select("station_id", "obs_date", "element"))),
            ("stations_fresh", "data_quality", "error", self.quality.where("freshness = 'stale'").select("station_id", "element")),
            ("every_city_has_a_station", "cities", "error", self.cities.select("city").join(self.resolved.where("selected").select("city"), "city", "left_anti")),
            ("tavg_within_tmin_tmax", "fct_observations", "warn", day(assess.tavg_outside(self.fct).select("station_id", "obs_date"))),
            ("tmax_not_below_tmin", "fct_observations", "error", day(assess.inverted_usable(self.fct).select("station_id", "obs_date"))),
            ("single_row_scope", "scope", "error", checks.single_row(self.scope)),
            ("single_row_selected", "selected", "warn", checks.single_row(self.selected)),
        ]

    def tested(self, table: str) -> DataFrame:
        return getattr(self, table)

    @cached_property
    def failures(self) -> DataFrame:
        every = [checks.all_failures(self.test_results)]
        for table, identity in data_tests.IDENTITY.items():
            of_rows = [t for t in data_tests.TESTS if t[1] == table and t[0] in data_tests.ROW_KINDS]
            every.append(checks.row_failures(
                self.tested(table), table, [F.col(c).cast("string").alias(c) for c in identity],
                [(data_tests.name_of(kind, table, cols), severity, checks.breaks(kind, cols[0], given)) for kind, _, cols, given, severity in of_rows]))
        for kind, table, cols, given, severity in data_tests.TESTS:
            if kind == "unique":
                texts = self.tested(table).select(*[F.col(c).cast("string").alias(c) for c in cols])
                failing = checks.unique(texts, cols[0]) if len(cols) == 1 else checks.unique_combination(texts, cols)
            elif kind == "relationships":
                parent, column = given
                failing = checks.relationships(self.tested(table), cols[0], self.tested(parent), column).select(
                    *[F.col(c).cast("string").alias(c) for c in data_tests.IDENTITY[table]])
            else:
                continue
            every.append(checks.all_failures([(data_tests.name_of(kind, table, cols), table, severity, failing)]))
        return written(reduce(DataFrame.unionByName, every), "failures")

    @cached_property
    def test_names(self) -> DataFrame:
        rows = [(n, tested, severity) for n, tested, severity, _ in self.test_results]
        rows += [(data_tests.name_of(kind, table, cols), table, severity) for kind, table, cols, _, severity in data_tests.TESTS]
        return self.spark.createDataFrame(rows, "test_name string, tested string, severity string")

    # Ledger of loads: rows per station file and run
    @cached_property
    def loads(self) -> DataFrame:
        count = lambda rows, at: rows.groupBy(F.col("file_station").alias("file")).agg(F.count(F.lit(1)).alias("rows_read")).withColumn("loaded_at", F.lit(at).cast("timestamp"))
        return count(self.first, feed.LOADED_AT).unionByName(count(self.second, feed.CHANGED_AT))
