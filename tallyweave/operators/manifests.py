"""Files as relations: manifests, differences, references between pages, containers by magic bytes, and key coverage."""

from __future__ import annotations

import posixpath
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.tables import cut_lineage
from pyspark.sql.types import StringType

# The first bytes of containers, in the order of trial; a spreadsheet marker within the first 4096 bytes.
MAGIC = (("ole2", "D0CF11E0A1B11AE1"), ("zip", "504B0304"), ("pdf", "255044462D"))
XML_MAGIC, XML_MARKER, XML_WITHIN = "3C3F786D6C", b"urn:schemas-microsoft-com:office:spreadsheet", 4096
# End of fixed values.


def _bytes(hexed: str) -> Column:
    return F.unhex(F.lit(hexed))


def container(content: Column) -> Column:
    """empty, ole2, zip, pdf, spreadsheet_xml or unsupported; the first whose bytes fit."""
    out = F.when(content.isNull() | (F.length(content) == 0), "empty")
    for name, magic in MAGIC:
        out = out.when(F.startswith(content, _bytes(magic)), name)
    marked = F.contains(F.substring(content, 1, XML_WITHIN), _bytes(XML_MARKER.hex()))
    return out.when(F.startswith(content, _bytes(XML_MAGIC)) & marked, "spreadsheet_xml").otherwise("unsupported")


def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """path, sha256, bytes of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def manifest_difference(expected: DataFrame, present: DataFrame) -> DataFrame:
    """path, problem: missing, unexpected or changed. Both: path, sha256."""
    x, y = expected.select("path", F.col("sha256").alias("wanted")), present.select("path", F.col("sha256").alias("found"))
    met = x.join(y, "path", "full")
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("wanted").isNull(), "unexpected").when(F.col("wanted") != F.col("found"), "changed")
    return met.select("path", problem.alias("problem")).where("problem is not null")


#: Paths that a leaf of a manifest's hash tree has, about; leaves of the coarse level.
LEAF_PATHS, COARSE_LEAVES = 8, 4096


def _leaf_digests(rows: DataFrame, leaf: str) -> DataFrame:
    """One row for each leaf: sums and XORs of its rows' hashes, which partial aggregates meet without moving rows."""
    h = F.xxhash64("path", "sha256")
    return rows.groupBy(leaf).agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64("sha256", "path", F.lit(1))).alias("y"))


def _differing(left: DataFrame, right: DataFrame, leaf: str) -> DataFrame:
    """Leaves whose digests differ, or that one side lacks."""
    x, y = (_leaf_digests(side, leaf) for side in (left, right))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("n", "x", "y")]
    met = x.alias("l").join(y.alias("r"), leaf, "full")
    return met.where(~(same[0] & same[1] & same[2])).select(leaf)


def manifest_difference_by_tree(expected: DataFrame, present: DataFrame) -> DataFrame:
    """As manifest_difference, through a hash tree of two levels: only rows of leaves that differ meet in a join.

    A path's leaf is given by its hash. A leaf holds about LEAF_PATHS paths, so where one path in a thousand differs, less than one
    row in a hundred is joined; a coarse leaf that is equal on both sides is not looked into. Digests are two 64-bit XORs and a
    count: leaves that differ and have equal digests are as unlikely as a collision of 128 bits. Both: path (distinct), sha256; read
    three times, so they should be written tables.
    """
    hashed = [side.select("path", "sha256").withColumn("_h", F.xxhash64("path")).withColumn("_coarse", F.pmod("_h", F.lit(COARSE_LEAVES))) for side in (expected, present)]
    coarse = _differing(*hashed, "_coarse")  # at most COARSE_LEAVES
    leaves = max(1, expected.count() // LEAF_PATHS)
    fine = [side.join(F.broadcast(coarse), "_coarse", "left_semi").withColumn("_leaf", F.pmod(F.xxhash64("_h"), F.lit(leaves))) for side in hashed]
    open_ = cut_lineage(_differing(*fine, "_leaf"))
    return manifest_difference(*[side.join(open_, "_leaf", "left_semi").select("path", "sha256") for side in fine])


def oversized(files: DataFrame, most: int) -> DataFrame:
    return files.where(F.col("bytes") > most)


def file_totals(files: DataFrame, most: int) -> DataFrame:
    """One row: files, bytes, oversized (how many are above the limit), largest."""
    size = F.coalesce("bytes", F.lit(0))
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.count_if(size > most).alias("oversized"), F.coalesce(F.max(size), F.lit(0)).alias("largest"))


def not_stored(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """What is still to be stored: the first of each path that is not there yet; what is stored is never written again."""
    first = wanted.groupBy("path").agg(F.min(F.struct(*[c for c in wanted.columns if c != "path"])).alias("row")).select("path", "row.*")
    return first.join(stored.select("path").distinct(), "path", "left_anti")


def key_coverage(actual: DataFrame, expected: DataFrame, key: str | list[str]) -> DataFrame:
    """key, problem: duplicate, missing or unexpected keys (one column or several); no rows if the keys are exactly the expected ones."""
    keys = [key] if isinstance(key, str) else key
    counts = actual.groupBy(*keys).agg(F.count("*").alias("n"))
    met = counts.join(expected.select(*keys).distinct().withColumn("_wanted", F.lit(True)), keys, "full")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("_wanted").isNull(), "unexpected").when(F.col("n") > 1, "duplicate")
    return met.select(*keys, problem.alias("problem")).where("problem is not null")


def disjoint_cover(parts: list[DataFrame], whole: DataFrame, key: str) -> DataFrame:
    """key, problem: keys in several parts (overlap) or in none (uncovered), or outside the whole (unexpected)."""
    every = parts[0].select(key)
    for p in parts[1:]:
        every = every.union(p.select(key))
    found = key_coverage(every, whole, key)
    return found.withColumn("problem", F.when(F.col("problem") == "duplicate", "overlap").when(F.col("problem") == "missing", "uncovered").otherwise(F.col("problem")))


@F.arrow_udf(StringType())
def _resolved(pages: pa.Array, references: pa.Array) -> pa.Array:
    out = []
    for page, reference in zip(pages.to_pylist(), references.to_pylist(), strict=True):
        if page is None or reference is None:
            out.append(None)
            continue
        parts = urlsplit(reference)
        if parts.scheme or parts.netloc or not parts.path:
            out.append(None)
            continue
        path = unquote(parts.path)
        path = posixpath.normpath(path.lstrip("/") if path.startswith("/") else posixpath.join(posixpath.dirname(page), path))
        out.append(None if path.startswith("..") else posixpath.join(path, "index.html") if parts.path.endswith("/") else path)
    return pa.array(out, pa.string())


def resolve_reference(page: Column, reference: Column) -> Column:
    """The file that a page's reference names; null if it leads elsewhere."""
    return _resolved(page, reference)


def references(pages: DataFrame, path: str = "path", html: str = "html") -> DataFrame:
    """path, reference: distinct href and src attributes of pages."""
    found = F.regexp_extract_all(html, F.lit(r"(?:href|src)=\"([^\"]*)\""), F.lit(1))
    return pages.select(path, F.explode(F.array_distinct(found)).alias("reference"))


def broken_references(refs: DataFrame, files: DataFrame) -> DataFrame:
    """References (with `target`) whose target is no file. files: target."""
    return refs.where("target is not null").join(files.select("target").distinct(), "target", "left_anti")


def public_paths(cities: DataFrame, files: list[str], shell: list[str]) -> DataFrame:
    """path: each city's files, and the shell's. An explode of a fixed list, not a cross join."""
    spark = cities.sparkSession
    own = cities.select(F.explode(F.array(*[F.concat(F.col("slug"), F.lit("/" + f)) for f in files])).alias("path"))
    return own.union(spark.createDataFrame([(s,) for s in shell], "path string")).distinct()


def built_cities(cities: DataFrame, directories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cities that have a directory, directories that are no city's). Both: slug."""
    return cities.join(directories.select("slug").distinct(), "slug", "left_semi"), directories.select("slug").distinct().join(cities, "slug", "left_anti")
