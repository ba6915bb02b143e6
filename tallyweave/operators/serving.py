"""Serving tables and the queries of a map screen: markers, bands, search, ranks, pages, viewports and percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.amounts import half_up
from tallyweave.functions.geo import in_box
from tallyweave.functions.text import searchable_form
from tallyweave.tables import in_ranges, numbered

#: Visit bands, page sizes, and the share of rows that a first view leaves out on each side.
BANDS = ((20, "20+"), (10, "10-19"), (5, "5-9"))
LAST_BAND = "1-4"
MARKER_PAGE, RECORD_PAGE = 50, 100
OUTER_SHARE, LEAST_FOR_SHARE = 0.05, 20


def marker_candidates(visits: DataFrame) -> DataFrame:
    """business, merchant (the last seen), records (in input order), latitude, longitude, conflict (coordinates differ).

    visits: business, record, position, merchant, latitude, longitude.
    """
    low, high = F.min(F.struct("latitude", "longitude")), F.max(F.struct("latitude", "longitude"))
    return visits.groupBy("business").agg(
        F.max_by("merchant", "position").alias("merchant"), F.transform(F.array_sort(F.collect_list(F.struct("position", "record"))), lambda x: x["record"]).alias("records"),
        low["latitude"].alias("latitude"), low["longitude"].alias("longitude"), (low != high).alias("conflict"),
    )


def marker_summary(visits: DataFrame) -> DataFrame:
    """business, visit_count, last_visited_on, total_amount, organizations (sorted, joined by U+0020 and a bar).

    visits: business, spent_on, amount, organization.
    """
    return visits.groupBy("business").agg(F.count("*").alias("visit_count"), F.max("spent_on").alias("last_visited_on"), F.sum("amount").alias("total_amount"), F.array_join(F.array_sort(F.collect_set("organization")), " | ").alias("organizations"))


def visit_band(count: Column) -> Column:
    out = None
    for least, name in BANDS:
        out = F.when(count >= least, name) if out is None else out.when(count >= least, name)
    return out.otherwise(LAST_BAND)


def search(markers: DataFrame, text: Column, query: str, band: str | None = None) -> DataFrame:
    """Markers whose searchable text contains the query (put into the same form: NFKC, stripped, lower case), of a band if one is given."""
    found = markers.where(text.contains(searchable_form(query)))
    return found if band is None else found.where(visit_band(F.col("visit_count")) == band)


def ranked(markers: DataFrame, collation: str | None = None) -> DataFrame:
    """Markers with rank (competition rank by visits) and place (visits, merchant, business).

    Ranks come from the counts of each visit count, and places from ranges of the order, so no task numbers all rows.
    """
    sizes = markers.groupBy("visit_count").agg(F.count("*").alias("n"))  # one row for each distinct count
    above = sizes.select("visit_count", (F.sum("n").over(Window.orderBy(F.desc("visit_count"))) - F.col("n") + 1).alias("rank"))
    if collation is None:
        return numbered(markers, [F.desc("visit_count"), F.col("merchant"), F.col("business")], "place").join(above, "visit_count")
    # the collated name is no column of the table that ranges are written to
    merchant = F.collate(F.col("merchant"), collation)
    return numbered(markers, [F.desc("visit_count"), merchant, F.col("business")], "place").join(above, "visit_count")


def page(markers: DataFrame, number: int, size: int = MARKER_PAGE) -> DataFrame:
    """Rows of a page (from 0) by place."""
    return markers.where(F.col("place").between(number * size + 1, (number + 1) * size))


def viewport_count(markers: DataFrame, bounds: tuple[float, float, float, float]) -> DataFrame:
    """total and in_view: rows, and those in (south, west, north, east), edges included."""
    inside = in_box(F.col("latitude"), F.col("longitude"), *[F.lit(b) for b in bounds])
    return markers.agg(F.count("*").alias("total"), F.count_if(inside).alias("in_view"))


def nearest_rank(values: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """share, value: the value at place round(share * (n - 1)) of the sorted values, rounding half up.

    Exact: from the counts of distinct values, whose running sum is taken by ranges; no task sorts all rows.
    """
    spark = values.sparkSession
    sizes = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    dealt = in_ranges(sizes, [F.col("value")], "_part")
    sums = dealt.groupBy("_part").agg(F.sum("n").alias("m"))
    base = sums.select("_part", (F.sum("m").over(Window.orderBy("_part")) - F.col("m")).alias("_base"))
    upto = F.sum("n").over(Window.partitionBy("_part").orderBy("value"))
    placed = dealt.withColumn("upto", upto).join(F.broadcast(base), "_part").withColumn("upto", F.col("upto") + F.col("_base")).withColumn("before", F.col("upto") - F.col("n"))
    total = dealt.agg(F.sum("n").alias("rows"))
    wanted = spark.createDataFrame([(s,) for s in shares], "share double").join(F.broadcast(total), how="cross").withColumn("at", half_up(F.col("share") * (F.col("rows") - 1)))
    return placed.join(F.broadcast(wanted), (F.col("at") >= F.col("before")) & (F.col("at") < F.col("upto"))).select("share", "value")


def initial_view(markers: DataFrame, bounds: tuple[float, float, float, float]) -> DataFrame:
    """south, west, north, east around the markers in bounds, without the outer 5 % on each side if there are 20 or more.

    All null if no marker is in bounds.
    """
    inside = markers.where(in_box(F.col("latitude"), F.col("longitude"), *[F.lit(b) for b in bounds])).select("latitude", "longitude")
    n = inside.count()
    low = OUTER_SHARE if n >= LEAST_FOR_SHARE else 0.0
    lat = nearest_rank(inside, "latitude", [low, 1 - low]).agg(F.min_by("value", "share").alias("south"), F.max_by("value", "share").alias("north"))
    lon = nearest_rank(inside, "longitude", [low, 1 - low]).agg(F.min_by("value", "share").alias("west"), F.max_by("value", "share").alias("east"))
    return lat.join(F.broadcast(lon), how="cross").select("south", "west", "north", "east")  # one row each


def published_records(records: DataFrame, classified: DataFrame, located: DataFrame) -> DataFrame:
    """Records with classification, map_status, geocode_reason and business_id; without their provenance columns.

    Restaurants are mapped or geocode_failed by their location; others have their classification as map status.
    """
    rows = records.join(classified, "record").join(located, "record", "left")
    eats = F.col("status") == "restaurant"
    status = F.when(eats & (F.col("outcome") == "success"), "mapped").when(eats, "geocode_failed").otherwise(F.col("status"))
    kept = [c for c in records.columns if c not in ("source", "location", "repeats")]
    return rows.select(*kept, F.col("status").alias("classification"), status.alias("map_status"), F.when(eats, F.col("reason")).alias("geocode_reason"), F.when(status == "mapped", F.col("business_id")).alias("business_id"))


def collection_status(organizations: DataFrame, counts: DataFrame) -> DataFrame:
    """organization, records, state: held, collected (records above 0) or empty. organizations: organization, held."""
    rows = organizations.join(counts, "organization", "left").withColumn("records", F.coalesce("records", F.lit(0)).cast("long"))
    return rows.select("organization", "records", F.when(F.col("held"), "held").when(F.col("records") > 0, "collected").otherwise("empty").alias("state"))


def busiest_letter(markers: DataFrame) -> DataFrame:
    """The first character of the merchant with most visits (the first by business of equals)."""
    return markers.agg(F.substring(F.min_by("merchant", F.struct(-F.col("visit_count"), F.col("business"))), 1, 1).alias("query"))
