"""File sources: observation files with dead letters, fixed-width files, documented layouts, catalogs in text, fingerprints.

Files named by a key (a station, a document) come in one of two layouts: a folder ``key=..`` with a file for each key, or bundles. A bundle
is a text file that holds many of these files one after the other; a line of it is the file's name, a tab and the line. With many
small files only bundles grow with their bytes: a file of its own costs a folder, a listing and a share of a task, whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamReader

from skyledger.sources.feed import COLUMNS

#: Positions (first, last; from 1) of the station file.
STATION_LAYOUT = [
    ("id", 1, 11), ("latitude", 13, 20), ("longitude", 22, 30), ("elevation", 32, 37), ("state", 39, 40), ("name", 42, 71), ("gsn_flag", 73, 75), ("hcn_crn_flag", 77, 79), ("wmo_id", 81, 85),
]


def write_files(lines: DataFrame, path: str, key: str = "file_station", order: str = "event_id") -> None:
    """(key, order, line) to one text file per key, lines in order."""
    lines.repartition(key).sortWithinPartitions(key, order).select(key, "line").write.partitionBy(key).text(path)


def write_bundles(lines: DataFrame, path: str, key: str = "file_station", order: str = "event_id") -> None:
    """(key, order, line) to bundles: what ``write_files`` would put into a key's file stands in one of them, in order. A text of several lines is several lines there."""
    name = F.coalesce(F.when(F.col(key).rlike(r"[%\t\r\n]"), F.url_encode(key)).otherwise(F.col(key)), F.lit(""))
    start = F.concat(name, F.lit("\t"))
    text = F.replace(F.coalesce("line", F.lit("")), F.lit("\n"), F.concat(F.lit("\n"), start))
    lines.repartition(key).sortWithinPartitions(key, order).select(F.concat(start, text).alias("value")).write.text(path)


def observation_schema() -> str:
    return ", ".join(f"{c} string" for c in COLUMNS)


def split_lines(reader: DataFrameReader | DataStreamReader, path: str, columns: str = "") -> DataFrame:
    """(line, the partition columns in ``columns``, _file, _from) of text files: each line with its file and the place where its split of the file begins."""
    lines = reader.schema(f"value string{columns and ', ' + columns}").text(path)
    return lines.select(
        F.col("value").alias("line"), *[c.split()[0] for c in columns.split(",") if c], F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_from"))


def bundle_lines(reader: DataFrameReader | DataStreamReader, path: str, columns: str = "", key: str = "file_station") -> DataFrame:
    """(line, the partition columns in ``columns``, key, _member, _file, _from) of bundles: as ``split_lines``, with the name of the file that a line belongs to, also as it is written."""
    lines = reader.schema(f"value string{columns and ', ' + columns}").option("lineSep", "\n").text(path)
    name = F.substring_index("value", "\t", 1)
    return lines.select(
        F.substr(F.col("value"), F.char_length(name) + 2).alias("line"), *[c.split()[0] for c in columns.split(",") if c],
        F.nullif(F.when(name.contains("%"), F.url_decode(name)).otherwise(name), F.lit("")).alias(key), name.alias("_member"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"))


def station_lines(reader: DataFrameReader | DataStreamReader, path: str, columns: str = "", bundled: bool = False) -> DataFrame:
    """The lines of station files in either layout, with file_station and the partition columns in ``columns``."""
    if not bundled:
        return split_lines(reader, path, ", ".join([*[columns] * bool(columns), "file_station string"]))
    line = F.col("line")
    return bundle_lines(reader, path, columns).withColumn("line", F.when(line.endswith("\r"), F.regexp_replace(line, "\r$", "")).otherwise(line))


def numbered(lines: DataFrame) -> DataFrame:
    """``split_lines`` or ``bundle_lines`` with line_number, from 1 in each file, however many splits a file is read in.

    A split's lines of a file stand in one task one after the other. The first row and the lines are counted by a grouping, what the splits
    before hold is a sum over a file's splits (a row each), and a line's number is that plus its place in its split. No file is
    gathered in one task.
    """
    file = [c for c in ("_member", "_file") if c in lines.columns]
    lines = lines.withColumn("_row", F.monotonically_increasing_id())
    splits = lines.groupBy(*file, "_from").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*file).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return lines.join(starts, [*file, "_from"]).withColumn("line_number", F.col("_row") - F.col("_first") + F.col("_before") + 1).drop(*file, "_from", "_row", "_first", "_before")


#: A field in quotes, at its place between separators; quotes inside are doubled.
QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def parsed(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with the eight columns of an observation as text (empty ones null) and reason, which is null for a good line.

    Rows and dead letters come from one parse, which minds quotes: a separator between quotes is part of the field, a doubled quote
    is one. Blank lines are dropped.
    """
    text = F.col(line)
    n = F.size(F.split(F.when(text.contains('"'), F.regexp_replace(text, QUOTED, "$1")).otherwise(text), ",", -1))
    row = F.from_csv(line, F.lit(f"{observation_schema()}, _bad string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "escape": '"', "maxCharsPerColumn": "-1"})
    found = lines.where(F.trim(line) != "").withColumn("_parsed", row).withColumn("_n", n)
    reason = F.when(F.col("_n") < len(COLUMNS), "MISSING COLUMNS").when(F.col("_n") > len(COLUMNS), "TOO MANY COLUMNS").when(F.col("_parsed._bad").isNotNull(), "UNREADABLE")
    good = [F.when(F.col("reason").isNull(), F.nullif(F.col(f"_parsed.{c}"), F.lit(""))).alias(c) for c in COLUMNS]
    return found.withColumn("reason", reason).select(*lines.columns, *good, "reason")


def scan_with_rejects(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """(file_station, line_number, line, the eight columns, reason) of all observation files, good lines and dead letters together."""
    return parsed(numbered(station_lines(spark.read, path, bundled=bundled)))


def scan_observations(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """The well-formed lines of all observation files, every column as text."""
    lines = station_lines(spark.read, path, bundled=bundled).select("line", "file_station")
    return parsed(lines).where("reason is null").select(*COLUMNS, "file_station")


def rejected_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines with too few or too many columns, or that can't be parsed, with the reason."""
    return parsed(lines, line).where("reason is not null").select(*lines.columns, "reason")


def parsed_lines(lines: DataFrame) -> DataFrame:
    """The well-formed lines with every column as text, empty ones null."""
    return parsed(lines, "line").where("reason is null").select("file_station", *COLUMNS)


def fixed_width_line(row_layout: list[tuple[str, int, int]]) -> Column:
    """A line with each column at its place."""
    parts, at = [], 1
    for name, first, last in row_layout:
        parts += [F.lit(" " * (first - at)), F.rpad(F.coalesce(F.col(name), F.lit("")), last - first + 1, " ")]
        at = last + 1
    return F.concat(*parts)


def fixed_width_scan(lines: DataFrame, layout: list[tuple[str, int, int]] = STATION_LAYOUT) -> DataFrame:
    """Cuts (value) lines at the layout's positions; blank fields are null, lines without the first field are dropped."""
    cut = [F.nullif(F.trim(F.substring("value", first, last - first + 1)), F.lit("")).alias(name) for name, first, last in layout]
    return lines.select(*cut).where(F.col(layout[0][0]).isNotNull())


def documented_layout(documents: DataFrame) -> DataFrame:
    """(doc, section, variable, first, last) from texts with section titles and lines such as ``NAME 42-71 Character``.

    The section of a line is the number of titles up to it.
    """
    lines = documents.select("doc", F.posexplode(F.split("content", "\n")).alias("n", "line"))
    title = F.col("line").rlike(r"^[IVX]+\. ")
    section = F.sum(title.cast("int")).over(Window.partitionBy("doc").orderBy("n"))
    field = r"^([A-Z_/ ]+?)\s+([0-9]+)-([0-9]+)\s+[A-Z]"
    part = lambda i: F.regexp_extract("line", field, i)
    return lines.withColumn("section", section).where(F.col("line").rlike(field)).select(
        "doc", "section", F.lower(part(1)).alias("variable"), part(2).cast("int").alias("first"), part(3).cast("int").alias("last"))


def layout_drift(documented: DataFrame, declared: DataFrame) -> DataFrame:
    """Declared fields that a document gives other positions, or none."""
    docs = documented.select("doc").distinct().crossJoin(F.broadcast(declared))
    return docs.join(documented.select("doc", "variable", F.col("first").alias("doc_first"), F.col("last").alias("doc_last")), ["doc", "variable"], "left").where(
        ~F.col("first").eqNullSafe(F.col("doc_first")) | ~F.col("last").eqNullSafe(F.col("doc_last")))


def catalog_from_text(documents: DataFrame) -> DataFrame:
    """Entries ``CODE = description`` with wrapped lines joined; unit and scale from the description.

    An entry goes on until the next line that starts one: a running count of starts numbers the entries.
    """
    lines = documents.select("doc", F.posexplode(F.split("content", "\n")).alias("n", "line")).where(F.trim("line") != "")
    entry = r"^\s*([A-Z0-9*#]{3,12})\s+=\s+(.*)$"
    number = F.sum(F.col("line").rlike(entry).cast("int")).over(Window.partitionBy("doc").orderBy("n"))
    text = F.when(F.col("line").rlike(entry), F.regexp_extract("line", entry, 2)).otherwise(F.trim("line"))
    entries = lines.withColumn("entry", number).where("entry > 0").groupBy("doc", "entry").agg(
        F.max(F.regexp_extract("line", entry, 1)).alias("code"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", F.trim(text).alias("t")))), lambda x: x["t"]), " ").alias("description"))
    inside = F.nullif(F.trim(F.regexp_extract("description", r"\(([^();]*)", 1)), F.lit(""))
    return entries.withColumn("inside", inside).select(
        "doc", "code", "description",
        F.regexp_replace(F.regexp_replace("inside", "^tenths of ", ""), r" \* 10$", "").alias("unit"),
        F.when(F.col("inside").startswith("tenths of ") | F.col("inside").endswith(" * 10"), 0.1).otherwise(1.0).alias("scale"))


def bundled_files(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, content) of the whole files in bundles: a file's lines in order, each with its end."""
    lines = bundle_lines(spark.read, path, key=key).withColumn("_row", F.monotonically_increasing_id())
    line = F.struct("_from", "_row", "line")
    whole = lines.groupBy("_member", "_file", key).agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    return whole.select(key, F.concat(F.array_join(F.col("_lines.line"), "\n"), F.lit("\n")).alias("content"))


def load_documents(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """(doc, content, sha256) of whole text files, in folders ``doc=..`` or bundles."""
    files = bundled_files(spark, path, "doc") if bundled else spark.read.text(path, wholetext=True).withColumnRenamed("value", "content")
    return files.select("doc", "content", F.sha2("content", 256).alias("sha256"))


def fingerprints(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """(file_station, sha256) of each file's bytes."""
    if bundled:
        return bundled_files(spark, path, "file_station").select("file_station", F.sha2("content", 256).alias("sha256"))
    return spark.read.format("binaryFile").load(path).select("file_station", F.sha2("content", 256).alias("sha256"))


def changed_files(current: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose fingerprint isn't that of their last load. ledger: (file_station, loaded_at, sha256)."""
    newest = Window.partitionBy("file_station").orderBy(F.col("loaded_at").desc())
    last = ledger.withColumn("_n", F.row_number().over(newest)).where("_n = 1").select("file_station", F.col("sha256").alias("last_sha256"))
    return current.join(last, "file_station", "left").where(~F.col("sha256").eqNullSafe(F.col("last_sha256")))
