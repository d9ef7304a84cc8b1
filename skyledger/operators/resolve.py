"""Choosing a station for each city from metadata: the city's airport, or the nearest station that reports enough."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.values import km

#: Side of the cells, in degrees, that stations are bucketed to for the distance join.
CELL = 0.25
#: Fixed patterns: names of airports, and of those preferred.
AIRPORT, PREFERRED = r" (A|AP|INT)$", r"\bINT(L|'L|ERCONTINENTAL)?\b"


def nearby_stations(anchors: DataFrame, stations: DataFrame, max_km: float, cell: float = CELL) -> DataFrame:
    """Stations of an anchor's country within ``max_km``, by cells: only neighbouring cells are compared.

    anchors: city, country_code, anchor_id, anchor_lat, anchor_lon. A cell holds ``max_km`` in latitude; towards the poles
    more cells of longitude are looked at.
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("int")
    lat_reach = int(max_km / (111.0 * cell)) + 1
    lon_reach = F.ceil(F.lit(max_km) / (111.0 * cell * F.greatest(F.cos(F.radians(F.abs("anchor_lat") + 1)), F.lit(0.01)))).cast("int")
    wrap = int(360 / cell)
    near = anchors.select(
        "*", F.explode(F.sequence(at("anchor_lat") - lat_reach, at("anchor_lat") + lat_reach)).alias("cell_lat")
    ).select("*", F.explode(F.sequence(at("anchor_lon") - lon_reach, at("anchor_lon") + lon_reach)).alias("_lon")).withColumn("cell_lon", F.pmod("_lon", F.lit(wrap))).drop("_lon").distinct()
    placed = stations.select("*", at("latitude").alias("cell_lat"), F.pmod(at("longitude"), F.lit(wrap)).alias("cell_lon"))
    distance = km(F.col("anchor_lat"), F.col("anchor_lon"), F.col("latitude"), F.col("longitude"))
    return near.join(placed, ["country_code", "cell_lat", "cell_lon"]).withColumn("distance_km", distance).where(F.col("distance_km") <= max_km).drop("cell_lat", "cell_lon")


def resolve_stations(stations: DataFrame, coverage: DataFrame, cities: DataFrame, required: list[str], max_km: float) -> DataFrame:
    """A row per city and candidate: selected, rank (of those that report enough) and the reason, all cities in one job.

    stations: typed stations; coverage: element_coverage; cities: city, province, prefix, country, pinned_id.
    """
    n = len(required)
    known = stations.join(coverage, "station_id", "left").na.fill(0, ["elements", "required_covered"])
    covered = F.concat(F.lit("reports "), F.col("required_covered").cast("string"), F.lit(f" of {n} required elements"))
    enough = F.col("required_covered") == n
    out = ["city", "province", "station_id", "station_name", "selected", "rank", "reason"]

    pinned = cities.where("pinned_id is not null").join(known, F.col("pinned_id") == F.col("station_id")).select(
        "city", "province", "station_id", "station_name", enough.alias("selected"), F.when(enough, 1).alias("rank"),
        F.when(enough, "selected: pinned in config").otherwise(covered).alias("reason"))

    named = cities.where("pinned_id is null").join(
        known, (F.col("country") == F.col("country_code")) & (F.col("province") == F.col("state_code")) & F.col("station_name").startswith(F.col("prefix")))
    order = Window.partitionBy("city", "province").orderBy(
        (~F.col("station_name").rlike(PREFERRED)).asc(), F.col("required_covered").desc(), F.coalesce("last_year", F.lit(0)).desc(),
        (F.coalesce(F.trim("wmo_id"), F.lit("")) == "").asc(), F.col("elements").desc(), F.col("station_id").asc())
    airports = named.where(F.col("station_name").rlike(AIRPORT)).withColumn("place", F.row_number().over(order))
    anchors = airports.where("place = 1").select(
        "city", "province", "country_code", F.col("station_id").alias("anchor_id"), F.col("station_name").alias("anchor_name"),
        F.col("required_covered").alias("anchor_covered"), F.col("latitude").alias("anchor_lat"), F.col("longitude").alias("anchor_lon"))

    near = nearby_stations(anchors, known, max_km)
    closest = Window.partitionBy("city", "province", enough).orderBy(F.col("distance_km").asc(), F.col("elements").desc(), F.col("station_id").asc())
    ranked = near.withColumn("rank", F.when(enough, F.row_number().over(closest)))
    away = F.concat(F.format_string("%.1f", "distance_km"), F.lit(" km from "), "anchor_name")
    reason = (
        F.when(~enough, covered).when(F.col("rank") > 1, F.concat(F.lit("ranked lower: "), away)).when(F.col("station_id") == F.col("anchor_id"), "selected: the airport's own station")
        .otherwise(F.concat(F.lit("selected: "), away, F.lit(", which reports "), F.col("anchor_covered").cast("string"), F.lit(f" of {n}")))
    )
    by_distance = ranked.select("city", "province", "station_id", "station_name", F.coalesce(F.col("rank") == 1, F.lit(False)).alias("selected"), "rank", reason.alias("reason"))
    # Candidates by name that aren't near the anchor keep the reason why they aren't the anchor.
    others = named.join(by_distance.select("city", "province", "station_id"), ["city", "province", "station_id"], "left_anti").join(
        anchors.select("city", "province", "anchor_name"), ["city", "province"], "left")
    left_out = others.select(
        "city", "province", "station_id", "station_name", F.lit(False).alias("selected"), F.lit(None).cast("int").alias("rank"),
        F.when(~F.col("station_name").rlike(AIRPORT), "name isn't an airport's").otherwise(F.concat(F.lit("ranked lower than the city's airport, "), "anchor_name")).alias("reason"))
    every = pinned.select(*out).unionByName(by_distance.select(*out)).unionByName(left_out.select(*out))
    return every.withColumn("rank", F.col("rank").cast("long"))


def twice_chosen(resolved: DataFrame) -> DataFrame:
    """Stations that several cities resolved to."""
    return resolved.where("selected").groupBy("station_id").agg(F.count(F.lit(1)).alias("cities")).where("cities > 1")


def resolution_errors(cities: DataFrame, resolved: DataFrame) -> DataFrame:
    """Cities without a station, and why; stations that several cities were given, once for each of these cities."""
    found = resolved.groupBy("city", "province").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason") == "name isn't an airport's").alias("other"), F.count_if("selected").alias("chosen"))
    n = F.coalesce("n", F.lit(0))
    why = (
        F.when(F.col("pinned_id").isNotNull() & (n == 0), "pinned station is unknown").when(F.col("pinned_id").isNotNull(), "pinned station reports too little")
        .when(n == 0, "no station has the city's name").when(n == F.col("other"), "no station of that name is an airport's")
        .otherwise("no station near enough reports all required elements"))
    without = cities.join(found, ["city", "province"], "left").where(F.coalesce("chosen", F.lit(0)) == 0).select(
        "city", "province", F.lit(None).cast("string").alias("station_id"), why.alias("error"))
    twice = resolved.where("selected").join(twice_chosen(resolved), "station_id").select("city", "province", "station_id", F.lit("station was given to several cities").alias("error"))
    return without.unionByName(twice)


def resolution_summary(resolved: DataFrame) -> DataFrame:
    """The chosen station of each city with the number of its candidates."""
    return resolved.withColumn("candidates", F.count(F.lit(1)).over(Window.partitionBy("city", "province"))).where("selected").select(
        "city", "province", "station_id", "station_name", "reason", "candidates")


def station_report(resolved: DataFrame) -> DataFrame:
    """Candidates of each city by what became of them."""
    starts = lambda p: F.count_if(F.col("reason").startswith(p))
    return resolved.groupBy("city", "province").agg(
        F.count(F.lit(1)).alias("candidates"), starts("selected").alias("selected"), starts("ranked lower").alias("ranked_lower"),
        starts("reports").alias("reports_too_little"), starts("name").alias("other_name"))
