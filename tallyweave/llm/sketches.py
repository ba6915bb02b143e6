"""Document fingerprints by invertible Bloom lookup tables (IBLT).

A text's paragraphs (lines, cut further at the ends of sentences) are digested to 64 bits. A
digest is in 3 cells of a sketch; a cell holds the count, the XOR of its digests and the XOR of their checks. The sketches
of two versions subtract cell by cell, which leaves the digests that differ; cells with one digest are peeled until
none is left, which recovers the differing digests. Where that fails, the digests are dealt by a hash into 4 sketches of
the same size, each subtracted and peeled alone, and so on: 4 times the cells at each retry, for the failed parts only. A
failed part hands its digests on to its own 4, so a retry costs in proportion to the digests of the parts that failed.

Native: arrays and higher-order functions within the row. Neighbours come from a window over id ranges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import quoted, shuffle_partitions, spare_names

#: Cells of each of the 3 parts of a sketch; a digest is in one cell of each.
PART, PARTS = 8, 3
CELLS = PART * PARTS
#: Rounds of peeling, and sketches that a pair is dealt into at each try.
ROUNDS, TRIES = 12, (1, 4, 16, 64, 256, 1024, 4096)
#: A line end, or white space after the end of a sentence.
PARAGRAPH_END = r"\n+|(?<=[.!?])[ \t]+"
COARSE_RANGES, FINE_RANGES, RANGE_ROWS = 256, 64, 20_000
#: Ranges up to which their first ids are broadcast (about 60 bytes each).
MOST_BROADCAST = 200_000
_CELL = "array<struct<c:bigint,k:bigint,x:bigint>>"
_FOUND = "array<struct<k:bigint,c:bigint>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs."""
    pieces = F.filter(F.split(text, PARAGRAPH_END, -1), lambda p: p != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit(0xFFFFFFFF))


def _masks() -> Column:
    """Of each cell, the bits that choose it and what they must be: a digest is in cell b of a part if three bits of it are b."""
    cells = [(7 << (part * 8 + 3), b << (part * 8 + 3)) for part in range(PARTS) for b in range(PART)]
    return F.array(*[F.struct(F.lit(mask).cast("long").alias("mask"), F.lit(want).cast("long").alias("want")) for mask, want in cells])


def sketch(values: Column) -> Column:
    """The cells of an array of distinct digests."""

    def cell(own: Column, m: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("x"))
        here = F.filter(own, lambda d: d.bitwiseAND(m["mask"]) == m["want"])
        return F.aggregate(here, zero, lambda s, d: F.struct((s["c"] + 1).alias("c"), s["k"].bitwiseXOR(d).alias("k"), s["x"].bitwiseXOR(_check(d)).alias("x")))

    return _let(values, lambda own: F.transform(_masks(), lambda m: cell(own, m)))


def _subtracted(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["c"] - y["c"]).alias("c"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["x"].bitwiseXOR(y["x"]).alias("x")))


def peel(cells: Column) -> Column:
    """Struct (found: the digests with count 1 or -1, left: cells that are not empty) of a sketch."""
    start = F.struct(cells.cast(_CELL).alias("cells"), F.array().cast(_FOUND).alias("found"), F.lit(True).alias("go"))

    def cleared(state: Column, pure: Column) -> Column:
        def cell(x: Column, m: Column) -> Column:
            own = F.filter(pure, lambda p: p["k"].bitwiseAND(m["mask"]) == m["want"])
            return F.aggregate(own, x, lambda s, p: F.struct((s["c"] - p["c"]).alias("c"), s["k"].bitwiseXOR(p["k"]).alias("k"), s["x"].bitwiseXOR(_check(p["k"])).alias("x")))

        none = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("go"))
        some = F.struct(F.zip_with(state["cells"], _masks(), cell).alias("cells"), F.concat(state["found"], pure).alias("found"), F.lit(True).alias("go"))
        return F.when(F.size(pure) == 0, none).otherwise(some)

    def step(state: Column, _: Column) -> Column:
        single = F.filter(state["cells"], lambda x: (F.abs(x["c"]) == 1) & (_check(x["k"]) == x["x"]))
        pure = F.array_distinct(F.transform(single, lambda x: F.struct(x["k"].alias("k"), x["c"].alias("c"))))
        return F.when(state["go"], _let(pure, lambda p: cleared(state, p))).otherwise(state)

    left = lambda s: F.size(F.filter(s["cells"], lambda x: (x["c"] != 0) | (x["k"] != 0) | (x["x"] != 0)))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.struct(s["found"].alias("found"), left(s).alias("left")))


_OPEN = "array<struct<a:array<bigint>,b:array<bigint>>>"


def with_difference(rows: DataFrame, out: str, a: str, b: str, sketch_a: str, sketch_b: str) -> DataFrame:
    """Adds column `out`: the digests (k, c) only in array column a (c = 1) or only in b (c = -1), by their sketches.

    A part that even the last try leaves is compared digest by digest: it holds more differing digests than a sketch has
    room for, after the last try's split into as many parts as its number says. Other columns, whatever their names, are kept.
    """
    (state_name,) = spare_names([*rows.columns, out], "_state")

    def split(part: Column, level: Column) -> Column:
        """A failed part's digests in 4 parts, by two bits of the digest that no level before has used."""
        bits = lambda d: F.call_function("shiftrightunsigned", d, (level * 2 + 32).cast("int")).bitwiseAND(F.lit(3).cast("long"))
        of = lambda values, t: F.filter(values, lambda d: bits(d) == t)
        return F.transform(F.array(*[F.lit(t).cast("long") for t in range(4)]), lambda t: F.struct(of(part["a"], t).alias("a"), of(part["b"], t).alias("b")))

    def sorted_out(found: Column, tried: Column, level: Column) -> Column:
        """What is found, and the parts of those that failed. tried: (part, r) with what peeling gave."""
        done = F.flatten(F.transform(F.filter(tried, lambda x: x["r"]["left"] == 0), lambda x: x["r"]["found"]))
        failed = F.flatten(F.transform(F.filter(tried, lambda x: x["r"]["left"] > 0), lambda x: split(x["part"], level)))
        return F.struct(F.concat(found, done).cast(_FOUND).alias("found"), failed.cast(_OPEN).alias("open"))

    def retried(state: Column, level: Column) -> Column:
        tried = F.transform(state["open"], lambda part: F.struct(part.alias("part"), peel(_subtracted(sketch(part["a"]), sketch(part["b"]))).alias("r")))
        return F.when(F.size(state["open"]) > 0, _let(tried, lambda t: sorted_out(state["found"], t, level))).otherwise(state)

    whole = F.struct(F.struct(F.col(a).alias("a"), F.col(b).alias("b")).alias("part"), peel(_subtracted(F.col(sketch_a), F.col(sketch_b))).alias("r"))
    rows = rows.withColumn(state_name, _let(F.array(whole), lambda t: sorted_out(F.array().cast(_FOUND), t, F.lit(0))))
    if len(TRIES) > 1:
        again = F.aggregate(F.sequence(F.lit(1), F.lit(len(TRIES) - 1)), F.col(state_name), retried)
        rows = rows.withColumn(state_name, F.when(F.size(f"{state_name}.open") > 0, again).otherwise(F.col(state_name)))
    side = lambda x, y, c: F.transform(F.array_except(x, y), lambda d: F.struct(d.alias("k"), F.lit(c).cast("long").alias("c")))
    rest = F.flatten(F.transform(f"{state_name}.open", lambda p: F.concat(side(p["a"], p["b"], 1), side(p["b"], p["a"], -1))))
    return rows.withColumn(out, F.concat(F.col(f"{state_name}.found"), rest)).drop(state_name)


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Common digests as a share of all of both; 1 if both have none."""
    both, gone = F.size(a) + F.size(b), F.size(differing)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - gone) / (both + gone))


def sketch_text(cells: Column) -> Column:
    """A sketch as hex: count (8 digits, as no array has 2^31 members), digests (16) and checks (8) of each cell."""
    one = lambda x: F.concat(F.lpad(F.hex(x["c"]), 8, "0"), F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["x"]), 8, "0"))
    return F.lower(F.array_join(F.transform(cells, one), ""))


def with_next_text(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with next_text: the text of the next row by descending doc_id; the last row's is the first's.

    Rows with equal ids are in the order of their text's hash, descending; null ids come last. Rows are dealt into id
    ranges, which are sorted each on its own; each range also gets the first row of the next one. The bounds of the ranges
    are percentiles of the ids, and percentiles of the ids between two of these, held by the driver; only between bounds so
    near is a stretch cut by equal widths, so clustered ids spread, too. An id that is a bound has a range of its own, and if
    it holds several percentiles of the rows, as many as its rows need, by ranges of the hash; so have null ids.
    """
    doc_id = F.col("doc_id")
    stats = docs.agg(F.count("*").alias("n"), F.count_if(doc_id.isNull()).alias("nulls"), F.percentile_approx("doc_id", [k / COARSE_RANGES for k in range(COARSE_RANGES + 1)]).alias("cuts")).first()
    every = sorted(stats["cuts"] or [])
    cuts = sorted(set(every))
    several = [c for c in cuts if every.count(c) > 2]
    subs = stats["n"] // RANGE_ROWS + 1
    wanted = max(stats["n"] // RANGE_ROWS, 8 * shuffle_partitions(docs))
    fine = min(FINE_RANGES, -(-wanted // COARSE_RANGES))
    finer = -(-wanted // (COARSE_RANGES * fine))
    literal = lambda ids: F.array(*[F.lit(c).cast("long") for c in ids])
    bounds = literal(cuts) if cuts else F.array().cast("array<bigint>")
    coarse = F.greatest(F.lit(1), F.size(F.filter(bounds, lambda c: c <= doc_id)))
    inner = {k: [c] for k, c in enumerate(cuts, 1)}
    if fine > 1 and cuts:
        between = docs.where(doc_id.isNotNull()).groupBy(coarse.alias("k")).agg(F.percentile_approx("doc_id", [j / fine for j in range(1, fine)]).alias("ids"))
        for r in between.collect():  # at most COARSE_RANGES + 1 rows of FINE_RANGES ids
            inner[r["k"]] = sorted({*inner[r["k"]], *r["ids"]})
            if stats["n"] > COARSE_RANGES * fine * RANGE_ROWS:
                several += [c for c in set(r["ids"]) if r["ids"].count(c) > 2 and c not in several]

    def within(k: Column) -> Column:
        """The place of an id at or after the k-th bound and before the next."""
        after = F.element_at(bounds, F.least(k + 1, F.lit(len(cuts))))
        return _let(F.element_at(F.array(*[literal(inner[j]) for j in range(1, len(cuts) + 1)]), k), lambda own: _let(F.greatest(F.lit(1), F.size(F.filter(own, lambda c: c <= doc_id))), lambda j: stretch(k, own, j, after)))

    def stretch(k: Column, own: Column, j: Column, after: Column) -> Column:
        """At or after the j-th of its inner bounds: the bound alone, or one of `finer` stretches."""
        low, high = F.element_at(own, j), F.when(j < F.size(own), F.element_at(own, F.least(j + 1, F.size(own)))).otherwise(after)
        width = F.greatest(high.cast("double") - low.cast("double"), F.lit(1.0))
        at = F.floor((doc_id.cast("double") - low.cast("double")) * finer / width)
        return (k.cast("long") * (fine + 2) + j) * (finer + 1) + F.when(doc_id == low, F.lit(0)).otherwise(1 + F.least(F.lit(finer - 1), F.greatest(F.lit(0), at)))

    place = _let(coarse, within).cast("long") if cuts else F.lit(0).cast("long")
    # hash ranges ascend with the hash
    hashed = F.least(F.lit(subs - 1), F.floor((F.col("_hash").cast("double") / 2.0**64 + 0.5) * subs)).cast("long")
    split = doc_id.isNull() | (doc_id.isin(several) if several else F.lit(False))
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    rows = rows.withColumns({"_range": F.when(doc_id.isNull(), F.lit(-1).cast("long")).otherwise(place), "_sub": F.when(split, hashed).otherwise(F.lit(0).cast("long"))})
    # a row for each range; its first row follows the last of the range above, and the topmost that of the lowest
    in_order = Window.orderBy("_range", "_sub")
    here = F.struct("_range", "_sub")
    tops = rows.groupBy("_range", "_sub").agg(F.max(F.struct("doc_id", "_hash")).alias("_top"))
    heads = tops.select("_top", here.alias("_of"), F.coalesce(F.lead(here).over(in_order), F.first(here).over(in_order)).alias("_to"))
    if len(cuts) * (fine + 1) * (finer + 1) + (len(several) + 1) * subs <= MOST_BROADCAST:  # the number of ranges at most
        heads = F.broadcast(heads)
    first = rows.join(heads, doc_id.eqNullSafe(F.col("_top.doc_id")) & (F.col("_hash") == F.col("_top._hash")) & (F.col("_range") == F.col("_of._range")) & (F.col("_sub") == F.col("_of._sub")))
    first = first.select("doc_id", "text", "_hash", F.col("_to._range").alias("_range"), F.col("_to._sub").alias("_sub"), F.lit(1).alias("_copy"))
    order = Window.partitionBy("_range", "_sub").orderBy("_copy", F.desc_nulls_last("doc_id"), F.desc("_hash"))
    both = rows.withColumn("_copy", F.lit(0)).union(first)
    return both.withColumn("next_text", F.lead("text").over(order)).where("_copy = 0").drop("_range", "_sub", "_hash", "_copy")


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_text, digests, sketch, edited_sketch, edited_diff, next_diff, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document, by descending doc_id, after the last the first. edited_diff and next_diff are the digests recovered from the
    subtracted sketches; likeness is the share of common digests. Null texts count as empty, with an empty sketch; two
    empty texts have likeness 1. Repeated rows are rows of their own (see with_next_text). Other columns are ignored.
    An empty table gives no rows.
    """
    kept = docs.select(quoted(id_column).cast("long").alias("doc_id"), F.coalesce(quoted(text_column).cast("string"), F.lit("")).alias("text"))
    rows = with_next_text(kept).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited_text", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumns({"digests": digests(F.col("text")), "edited_digests": digests(F.col("edited_text")), "next_digests": digests(F.col("next_text"))})
    rows = rows.drop("text", "next_text").withColumns({"sketch": sketch(F.col("digests")), "edited_sketch": sketch(F.col("edited_digests")), "next_sketch": sketch(F.col("next_digests"))})
    for name in ("edited", "next"):
        rows = with_difference(rows, f"{name}_diff", "digests", f"{name}_digests", "sketch", f"{name}_sketch")
    near = lambda name: likeness(F.col("digests"), F.col(f"{name}_digests"), F.col(f"{name}_diff")).alias(f"near_{name}")
    return rows.select("doc_id", "n_chars", "edited_text", "digests", "sketch", "edited_sketch", "edited_diff", "next_diff", near("edited"), near("next"))
