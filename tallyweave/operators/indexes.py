"""Stored indexes of a map screen's markers: substring search, counts in viewports, and pages of a ranking.

Each index is written once, as partitioned tables; a request then reads the partitions that it needs. What the driver holds
for a request is bounded by the index's own parameters (buckets, cells of a box's edge, ranges), not by the markers.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallyweave.functions.geo import in_box
from tallyweave.functions.text import searchable_form
from tallyweave.tables import fresh_path, quoted

# -- substring search --------------------------------------------------------------------------------------------------

#: Characters of the longest grams, directories of postings, and directories of rows.
GRAM, BUCKETS, SLICES = 3, 64, 64


def _grams(text: Column, size: int) -> Column:
    """Array of the distinct substrings of `size` characters."""
    last = F.length(text) - size + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda k: F.substring(text, k, F.lit(size))))).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class SearchIndex:
    """Postings (bucket, gram, slice, key) and rows (slice, key, text, and all other columns), in directories by bucket and slice."""

    postings: str
    rows: str
    key: str
    text: str
    schema: StructType


def _read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table that may have no file; columns of directories come last."""
    return spark.read.schema(schema).parquet(path)


def write_search_index(rows: DataFrame, key: str, text: str, folder: str | None = None) -> SearchIndex:
    """An index of the grams of one to GRAM characters of column `text`, which is in searchable form already.

    key: a column that tells rows apart. Null texts are found by no query. Columns `bucket`, `gram` and `slice` are the index's own.
    """
    folder = folder or fresh_path(rows.sparkSession)
    sliced = rows.withColumn("slice", (F.crc32(quoted(key).cast("string")) % SLICES).cast("int"))
    found = SearchIndex(f"{folder}/postings", f"{folder}/rows", key, text, sliced.schema)
    sliced.repartition("slice").write.partitionBy("slice").parquet(found.rows)
    held = _read(rows.sparkSession, found.rows, found.schema)
    grams = F.concat(*[_grams(quoted(text), k) for k in range(1, GRAM + 1)])
    postings = held.select(F.explode(grams).alias("gram"), "slice", quoted(key)).withColumn("bucket", (F.crc32("gram") % BUCKETS).cast("int"))
    # ranges go on to the key, so a frequent gram is no single task's or file's
    order = ["bucket", "gram", quoted(key)]
    postings.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("bucket").parquet(found.postings)
    return found


def candidates(spark: SparkSession, index: SearchIndex, form: str) -> DataFrame | None:
    """slice and key of the rows that have all grams of a text in searchable form; None if it is empty and has none."""
    size = min(GRAM, len(form))
    grams = sorted({form[k : k + size] for k in range(len(form) - size + 1)} - {""})
    if not grams:
        return None
    buckets = sorted({zlib.crc32(g.encode()) % BUCKETS for g in grams})
    schema = StructType([StructField("gram", StringType()), StructField("slice", IntegerType()), index.schema[index.key], StructField("bucket", IntegerType())])
    met = _read(spark, index.postings, schema).where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
    # grams of a row are distinct, so their number says whether all are there
    return met.groupBy("slice", index.key).agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).drop("n")


def indexed_search(spark: SparkSession, index: SearchIndex, query: str) -> DataFrame:
    """Rows whose text contains the query (put into searchable form), as `serving.search` finds by reading all rows.

    Postings of the query's grams are intersected; the rows left are read from their directories alone, and verified.
    """
    form = searchable_form(query)
    rows, met = _read(spark, index.rows, index.schema), candidates(spark, index, form)
    if met is None:
        return rows.where(quoted(index.text).isNotNull()).drop("slice")
    slices = [r["slice"] for r in met.select("slice").distinct().collect()]  # at most SLICES
    found = rows.where(F.col("slice").isin(slices) if slices else F.lit(False)).join(met, ["slice", index.key], "left_semi")
    return found.where(quoted(index.text).contains(form)).drop("slice")


# -- counts in viewports -----------------------------------------------------------------------------------------------

#: The deepest level of a pyramid: 2^LEVELS cells a side.
LEVELS = 8


@dataclass(frozen=True)
class Pyramid:
    """Counts (level, z, n) of tiles, and rows (z of the deepest level, latitude, longitude); bounds of the rows, and their number."""

    tiles: str
    rows: str
    south: float
    west: float
    north: float
    east: float
    total: int


_CELL_ROWS = "latitude double, longitude double, z int"


def _place(value, low: float, high: float):
    """A coordinate's cell, as a Column or a number: not decreasing, so that cells between those of two bounds lie between the bounds."""
    side = 1 << LEVELS
    step = (high - low) / side or 1.0
    if isinstance(value, Column):
        return F.least(F.lit(side - 1), F.floor((value - low) / step)).cast("int")
    return -1 if value < low else side if value > high else min(side - 1, math.floor((value - low) / step))


def z_order(x, y):
    """Bits of two cells in turn, as Columns or numbers: the cells of a tile follow one another."""
    if isinstance(x, Column):
        bit = lambda v, k, to: F.shiftleft(F.shiftright(v, k).bitwiseAND(1), to)
        out = F.lit(0)
        for k in range(LEVELS):
            out = out.bitwiseOR(bit(x, k, 2 * k)).bitwiseOR(bit(y, k, 2 * k + 1))
        return out
    return sum((x >> k & 1) << 2 * k | (y >> k & 1) << 2 * k + 1 for k in range(LEVELS))


def write_pyramid(markers: DataFrame, folder: str | None = None) -> Pyramid:
    """Counts of markers in the tiles of LEVELS + 1 levels. Markers without a coordinate count in the total alone.

    Rows are written in the order of their tiles, so a file's least and greatest z say whether it is needed.
    """
    spark = markers.sparkSession
    folder = folder or fresh_path(spark)
    at = markers.select(F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))
    there = F.coalesce((F.abs("latitude") < float("inf")) & (F.abs("longitude") < float("inf")), F.lit(False))
    seen = at.agg(F.count("*"), *[f(F.when(there, F.col(c))) for c in ("latitude", "longitude") for f in (F.min, F.max)]).first()
    total, south, north, west, east = seen[0], *(0.0 if v is None else v for v in seen[1:])
    z = z_order(_place(F.col("longitude"), west, east), _place(F.col("latitude"), south, north))
    found = Pyramid(f"{folder}/tiles", f"{folder}/rows", south, west, north, east, total)
    at.where(there).withColumn("z", z).repartitionByRange("z").sortWithinPartitions("z").write.parquet(found.rows)
    cells = _read(spark, found.rows, _CELL_ROWS).groupBy("z").agg(F.count("*").alias("n"))  # at most 4^LEVELS
    above = F.explode(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: F.struct((LEVELS - k).alias("level"), F.call_function("shiftright", F.col("z"), k * 2).alias("z")))).alias("tile")
    tiles = cells.select(above, "n").groupBy("tile.level", "tile.z").agg(F.sum("n").alias("n"))
    tiles.repartition("level").sortWithinPartitions("z").write.partitionBy("level").parquet(found.tiles)
    return found


def inner_tiles(x0: int, y0: int, x1: int, y1: int) -> list[tuple[int, int]]:
    """(level, z) of the fewest tiles that make up the cells from (x0, y0) to (x1, y1): about as many as cells on their edge."""
    out: list[tuple[int, int]] = []
    todo = [(0, 0, 0)] if x0 <= x1 and y0 <= y1 else []
    while todo:
        level, x, y = todo.pop()
        size = 1 << LEVELS - level
        left, low = x * size, y * size
        if left > x1 or low > y1 or left + size <= x0 or low + size <= y0:
            continue
        if left >= x0 and low >= y0 and left + size - 1 <= x1 and low + size - 1 <= y1:
            out.append((level, z_order(left, low) >> 2 * (LEVELS - level)))
        else:
            todo += [(level + 1, 2 * x + a, 2 * y + b) for a in (0, 1) for b in (0, 1)]
    return out


def edge_cells(x0: int, y0: int, x1: int, y1: int) -> list[int]:
    """z of the cells on the edge of a rectangle of cells, those beyond the pyramid left out."""
    side = range(1 << LEVELS)
    ring = {(x, y) for x in range(x0, x1 + 1) for y in (y0, y1)} | {(x, y) for x in (x0, x1) for y in range(y0, y1 + 1)}
    return sorted(z_order(x, y) for x, y in ring if x in side and y in side)


def counts_in_boxes(spark: SparkSession, pyramid: Pyramid, boxes: list[tuple]) -> DataFrame:
    """box, total and in_view for each (box, south, west, north, east), edges included, as `serving.viewport_count` counts by reading all rows.

    Tiles inside a box are added; only rows of the cells on its edge are read. A box makes at most about 2^(LEVELS + 3) rows.
    """
    inner, edge = [], []
    for box, south, west, north, east in boxes:
        x0, x1 = (_place(v, pyramid.west, pyramid.east) for v in (west, east))
        y0, y1 = (_place(v, pyramid.south, pyramid.north) for v in (south, north))
        if south > north or west > east:
            continue
        inner += [(box, level, z) for level, z in inner_tiles(x0 + 1, y0 + 1, x1 - 1, y1 - 1)]
        edge += [(box, z) for z in edge_cells(x0, y0, x1, y1)]
    named = spark.createDataFrame(boxes, "box long, south double, west double, north double, east double")
    tiles = _read(spark, pyramid.tiles, "z int, n long, level int").where(F.col("level").isin(sorted({level for _, level, _ in inner})) if inner else F.lit(False))
    whole = tiles.join(F.broadcast(spark.createDataFrame(inner, "box long, level int, z int")), ["level", "z"]).select("box", "n")
    cells = spark.createDataFrame(edge, "box long, z int").join(named, "box")
    rows = _read(spark, pyramid.rows, _CELL_ROWS)
    if edge:  # files whose rows all lie before or behind the edges are left out
        rows = rows.where(F.col("z").between(min(z for _, z in edge), max(z for _, z in edge)))
    near = rows.join(F.broadcast(cells), "z").where(in_box(F.col("latitude"), F.col("longitude"), *[F.col(c) for c in ("south", "west", "north", "east")]))
    sums = whole.unionByName(near.groupBy("box").agg(F.count("*").alias("n"))).groupBy("box").agg(F.sum("n").alias("in_view"))
    return named.join(sums, "box", "left").select("box", F.lit(pyramid.total).cast("long").alias("total"), F.coalesce("in_view", F.lit(0).cast("long")).alias("in_view"))


# -- pages of a ranking ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class OrderIndex:
    """Rows in directories by range of an order, and for each range (low, number of rows before it, rows): one entry a range."""

    rows: str
    ranges: tuple[tuple[int, int, int], ...]
    order: tuple[Column, ...]
    schema: StructType
    above: tuple[tuple[object, int], ...]


def ranked_order(collation: str | None = None) -> list[Column]:
    """Visits, greatest first, then merchant and business."""
    merchant = F.col("merchant") if collation is None else F.collate(F.col("merchant"), collation)
    return [F.desc("visit_count"), merchant.asc(), F.col("business").asc()]


def first_page(markers: DataFrame, size: int, collation: str | None = None) -> DataFrame:
    """The first `size` markers with rank (competition rank by visits) and place: a bounded top-k, nothing is sorted whole.

    All markers that rank above one of them are among them, so ranks come from these rows alone.
    """
    order = ranked_order(collation)
    top = markers.orderBy(*order).limit(size)
    ranks = {"rank": F.rank().over(Window.orderBy(F.desc("visit_count"))), "place": F.row_number().over(Window.orderBy(*order))}
    return top.withColumns({name: c.cast("long") for name, c in ranks.items()})


def page_after(markers: DataFrame, last: tuple, size: int) -> DataFrame:
    """The next `size` markers behind the key (visit_count, merchant, business) of the last one shown: a filter that reaches
    the scan, and a bounded top-k.
    """
    visits, merchant, business = last
    behind = (F.col("visit_count") < visits) | ((F.col("visit_count") == visits) & ((F.col("merchant") > merchant) | ((F.col("merchant") == merchant) & (F.col("business") > business))))
    return markers.where(behind).orderBy(*ranked_order()).limit(size)


def write_order(markers: DataFrame, collation: str | None = None, folder: str | None = None) -> OrderIndex:
    """The order of `serving.ranked`, stored: rows in directories by range, and the number of rows of each range."""
    spark = markers.sparkSession
    folder = folder or fresh_path(spark)
    order = ranked_order(collation)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = markers.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    dealt.write.partitionBy("part").parquet(folder)
    held = _read(spark, folder, dealt.schema)
    ranges, before = [], 0
    for r in held.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # one row a range
        ranges.append((r["part"], before, r["n"]))
        before += r["n"]
    above, so_far = [], 0
    for r in held.groupBy("visit_count").agg(F.count("*").alias("n")).orderBy(F.desc("visit_count")).limit(RANKS).collect():
        above.append((r["visit_count"], so_far))
        so_far += r["n"]
    return OrderIndex(folder, tuple(ranges), tuple(order), dealt.schema, tuple(above))


#: Distinct visit counts whose ranks the index itself holds; ranks of others are counted when they are asked for.
RANKS = 10_000


def indexed_page(spark: SparkSession, index: OrderIndex, number: int, size: int) -> DataFrame:
    """Rows of a page (from 0) with rank and place, from the directories of the one or few ranges that hold it."""
    first, last = number * size, (number + 1) * size
    wanted = [(part, before) for part, before, n in index.ranges if before < last and before + n > first]
    held = _read(spark, index.rows, index.schema)
    rows = held.where(F.col("part").isin([p for p, _ in wanted]) if wanted else F.lit(False))
    base = F.element_at(F.create_map(*[F.lit(v) for pair in wanted or [(0, 0)] for v in pair]), F.col("part"))
    place = (base + F.row_number().over(Window.partitionBy("part").orderBy(*index.order))).cast("long")
    rows = rows.withColumn("place", place).where(F.col("place").between(first + 1, last)).drop("part")
    ranks = spark.createDataFrame([(v, n + 1) for v, n in index.above], StructType([held.schema["visit_count"], StructField("rank", LongType())]))
    found = rows.join(F.broadcast(ranks), "visit_count", "left")
    if len(index.above) < RANKS:
        return found
    levels = found.where("rank is null").select("visit_count").distinct()  # at most a page's
    counted = levels.alias("l").join(held.groupBy("visit_count").agg(F.count("*").alias("m")).alias("h"), F.col("h.visit_count") > F.col("l.visit_count")).groupBy(F.col("l.visit_count").alias("visit_count")).agg((F.sum("m") + 1).alias("late"))
    return found.join(counted, "visit_count", "left").withColumn("rank", F.coalesce("rank", "late")).drop("late")
