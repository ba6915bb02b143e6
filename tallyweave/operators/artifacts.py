"""Stage outputs as tables with an envelope: schema version, hashes of their inputs, and a hash of themselves."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyweave.sources.parts import write_parts
from tallyweave.tables import in_ranges, quoted


class Stale(ValueError):
    """A stored output whose inputs, or schema version, are no longer what it was made of."""


def content_hash(df: DataFrame) -> str:
    """A hash of the rows, in any order: sums of row hashes, so that partial sums meet and no rows are moved."""
    h = F.xxhash64(*[F.col(f"`{c}`").cast("string") if dict(df.dtypes)[c].startswith("map") else F.col(f"`{c}`") for c in sorted(df.columns)])
    row = df.select(h.alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x")).first()
    return f"{row['n']}:{row['s'] or 0}:{row['x'] or 0}"


def _path(spark: SparkSession, name: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def save_artifact(df: DataFrame, folder: str, stage: str, version: int, inputs: dict[str, str]) -> str:
    """Writes a stage's rows and then its envelope; an older schema version is moved aside. Returns the content hash."""
    spark = df.sparkSession
    where, files = _path(spark, f"{folder}/{stage}")
    if files.exists(where):
        held = read_envelope(spark, folder, stage)
        if held and held["version"] != version:
            files.rename(where, _path(spark, f"{folder}/{stage}.v{held['version']}")[0])
    df.write.mode("overwrite").parquet(f"{folder}/{stage}/rows")
    own = content_hash(spark.read.parquet(f"{folder}/{stage}/rows"))
    envelope = json.dumps({"stage": stage, "version": version, "inputs": inputs, "content": own}, sort_keys=True)
    spark.createDataFrame([(envelope,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{stage}/envelope")
    return own


def read_envelope(spark: SparkSession, folder: str, stage: str) -> dict | None:
    where, files = _path(spark, f"{folder}/{stage}/envelope")
    return json.loads(spark.read.text(f"{folder}/{stage}/envelope").first()[0]) if files.exists(where) else None


def load_artifact(spark: SparkSession, folder: str, stage: str, version: int, inputs: dict[str, str]) -> DataFrame:
    """A stage's rows, if made by this version from these inputs; else Stale."""
    held = read_envelope(spark, folder, stage)
    if held is None or held["version"] != version or held["inputs"] != inputs:
        raise Stale(stage)
    return spark.read.parquet(f"{folder}/{stage}/rows")


def publish_json(df: DataFrame, path: str) -> None:
    """A serving table as JSON lines, in parts below the size limit that all tasks write, moved into place at once."""
    write_parts(df.select(F.to_json(F.struct(*[quoted(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("line")), path)


def report_or_remove(incidents: DataFrame, path: str) -> int:
    """Incidents as JSON lines, written anew; removed if there are none. Returns their number."""
    spark = incidents.sparkSession
    n = incidents.count()
    if n:
        incidents.write.mode("overwrite").json(path)
    else:
        where, files = _path(spark, path)
        files.delete(where, True)
    return n


def chunked(entries: DataFrame, size: str, most: int, order: str) -> DataFrame:
    """entries with `part`: files of at most `most` bytes (an entry larger than that alone), ascending with the order.

    By the running sum of sizes, from ranges of the order, so no task walks all entries: a file takes the entries that lie
    within one stretch of `most` bytes, and an entry across two stretches is a file of its own. Numbers may have gaps.
    """
    dealt = in_ranges(entries, [F.col(order)], "_part")
    sums = dealt.groupBy("_part").agg(F.sum(size).alias("_m"))
    base = sums.select("_part", (F.sum("_m").over(Window.orderBy("_part")) - F.col("_m")).alias("_base"))
    rows = dealt.withColumn("_upto", F.sum(size).over(Window.partitionBy("_part").orderBy(order))).join(F.broadcast(base), "_part")
    upto = F.col("_upto") + F.col("_base")
    first, last = F.floor((upto - F.col(size)) / most), F.floor((upto - 1) / most)
    return rows.withColumn("part", 2 * first + F.when(last > first, 2).otherwise(1)).drop("_part", "_base", "_upto")


def zipped(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Rows that meet by key and position; `only` names the side of positions without a partner."""
    met = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), key, "full")
    return met.withColumn("only", F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right")).drop("_l", "_r")


def prompt_text(parts: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """keys, prompt: numbered lines in order."""
    lines = F.array_sort(F.collect_list(F.struct(order, text)))
    numbered = F.transform(lines, lambda x, k: F.concat((k + 1).cast("string"), F.lit(". "), x[text].cast("string")))
    return parts.groupBy(*keys).agg(F.array_join(numbered, "\n").alias("prompt"))


def sheet_preview(rows: DataFrame, most_rows: int = 12, most_characters: int = 40) -> DataFrame:
    """source, sheet, preview: the first rows that are not blank, with their own numbers, cells cut short.

    Only the rows shown are gathered.
    """
    filled = rows.where(F.exists("cells", lambda c: c != "")).withColumn("_turn", F.row_number().over(Window.partitionBy("source", "sheet").orderBy("row"))).where(F.col("_turn") <= most_rows)
    cut = F.transform("cells", lambda c: F.left(c, F.lit(most_characters)))
    line = F.concat(F.col("row").cast("string"), F.lit(": "), F.array_join(cut, " | "))
    shown = filled.groupBy("source", "sheet").agg(F.array_sort(F.collect_list(F.struct("row", line.alias("line")))).alias("r"))
    return shown.select("source", "sheet", F.array_join(F.transform("r", lambda r: r["line"]), "\n").alias("preview"))


def top_with_rest(problems: DataFrame, key: str, order: list, text: str, most: int = 20) -> DataFrame:
    """key, number, line: the first `most` problems of each key in order, and one line for how many more there are."""
    w = Window.partitionBy(key)
    first = problems.withColumn("number", F.row_number().over(w.orderBy(*order))).where(F.col("number") <= most).select(key, "number", F.col(text).alias("line"))
    more = problems.groupBy(key).agg((F.count("*") - most).alias("rest")).where("rest > 0")
    return first.union(more.select(key, F.lit(most + 1).alias("number"), F.concat(F.lit("and "), F.col("rest").cast("string"), F.lit(" more")).alias("line")))


def scope_sentence(counts: list[tuple[str, Column]]) -> Column:
    """The sentences of `count_sentence` for each count above zero, joined by commas; null if all are zero."""
    said = F.array_compact(F.array(*[count_sentence(label, n) for label, n in counts]))
    return F.when(F.size(said) > 0, F.array_join(said, ", "))


def first_failures(reports: DataFrame) -> DataFrame:
    """source, reason: of the first failing sheet of each source. reports: source, sheet_index, reason."""
    return reports.groupBy("source").agg(F.min_by("reason", F.when(F.col("reason").isNotNull(), F.col("sheet_index"))).alias("reason"))


def first_verified(variants: DataFrame) -> DataFrame:
    """source, sheet, variant: the newest variant (highest revision) whose verification found no problem; null if none.

    variants: source, sheet, revision, variant, problem.
    """
    return variants.groupBy("source", "sheet").agg(F.max_by("variant", F.when(F.col("problem").isNull(), F.col("revision"))).alias("variant"))


def summary_rows(results: DataFrame, keys: list[str], column: str) -> DataFrame:
    """A row for each entry of a map column."""
    return results.select(*keys, F.explode(column).alias("scenario", "value"))


def count_sentence(label: str, count: Column) -> Column:
    """`label 1,234건`; null for zero."""
    return F.when(count > 0, F.concat(F.lit(label + " "), F.format_number(count, 0), F.lit("건")))
