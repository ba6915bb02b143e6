"""Mixing sources to target weights by sampling fixed-length word blocks.

The words of a source, document after document, are one sequence, packed into blocks of `block_words` words; the last
block is shorter. A source's target in words fixes how often it is passed: some whole rounds, then a part of a round, whose
last block is cut to the words still wanted. So a source's slots are numbered, and slot k takes block P(k) of its round, P
being a pseudorandom permutation of the source's full blocks for that round (the short block comes last).

The mix is written in output shards. Each shard draws how many of its slots fall to each source from the multinomial with
the sources' shares, given what is left of them: shards are drawn in shelves of a few, a shelf's totals being the sources'
totals in proportion, with the remainder carried to the next shelf. So the mix meets its targets over every few shards, any
task draws any shelf alone, and the draws decide in which shard, and at which place there, a block is written. Slots and
documents meet by an equi-join on (source, block).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import WORD_PATTERN, cut_lineage, quoted, shuffle_partitions, spare_names

MOST_REPEATS = 3
#: Words of a block, slots of a shard (about), shards of a shelf (at most).
BLOCK_WORDS, SLOTS, SHELF = 512, 2048, 16
#: Documents of a source are dealt into at most so many buckets, each of which gets its offset from the buckets before.
MOST_BUCKETS, BUCKET_ROWS = 65_536, 256
#: Sources are a list that people weigh: the driver holds a row for each, and refuses more than this.
MOST_SOURCES = 100_000


@dataclass(frozen=True)
class Source:
    """One row for each source: `number` is its place by code point (null last)."""

    number: int
    name: str | None
    size: int
    rows: int
    target: float
    #: blocks of a round, of which `full` have block_words words
    blocks: int
    full: int
    #: slots of the mix, and the words that the last one takes
    slots: int
    last: int


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 if null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Shares of the sum of sizes by weight, none above `most` times its size; the excess is reshared by weight."""
    total, out, free = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left, weight = total - sum(out), sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / weight > most * sizes[i]}
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else left * weights[i] / weight
        if not over:
            break
        free -= over
    return out


def plan_sources(found: list[tuple[str | None, int, int]], cycle: tuple[int, ...], block_words: int) -> list[Source]:
    found = sorted(found, key=lambda x: (x[0] is None, x[0] or ""))
    goals = targets([x[1] for x in found], [cycle[k % len(cycle)] for k in range(len(found))])
    out = []
    for k, ((name, size, rows), goal) in enumerate(zip(found, goals, strict=True)):
        rounds, rest = divmod(min(round(goal), MOST_REPEATS * size), size) if size else (0, 0)
        blocks, tail = -(-size // block_words), size % block_words
        more = -(-rest // block_words)
        last = rest - block_words * (more - 1) if rest else tail or block_words
        out.append(Source(k, name, size, rows, goal, blocks, size // block_words, rounds * blocks + more, last))
    return out


def _mixed(x: np.ndarray, key: np.ndarray | int) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift) of x and key."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where a pseudorandom permutation of range(n) puts each k: a four-round Feistel network, walked until below n."""
    if n < 2:
        return k
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, out, todo = np.uint64((1 << half) - 1), k.astype(np.uint64), np.arange(len(k))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for turn in range(4):
            left, right = right, left ^ (_mixed(right, (key * 4 + turn) & (2**64 - 1)) & mask)
        out[todo] = x = (left << np.uint64(half)) | right
        todo = todo[x >= n]
    return out.astype(np.int64)


def shelf_counts(shelf: int, shelves: int, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """A shelf's slots by source, and those of all shelves before it: totals in proportion, the remainder carried."""
    upto = lambda j: np.array([(2 * j * c + shelves) // (2 * shelves) for c in counts], np.int64)
    before = upto(shelf)
    return upto(shelf + 1) - before, before


def shard_counts(own: np.ndarray, shelf: int, seed: int, slots_per_shard: int) -> np.ndarray:
    """How many slots of each source (columns) each shard (rows) of a shelf takes: multinomial, given the shelf's totals."""
    total = int(own.sum())
    shards = max(1, -(-total // slots_per_shard))
    rng, left, out = np.random.default_rng([seed, shelf]), own.copy(), []
    for k in range(shards):
        drawn = rng.multivariate_hypergeometric(left, (k + 1) * total // shards - k * total // shards, method="marginals")
        out.append(drawn)
        left = left - drawn
    return np.array(out).reshape(shards, len(own))


def slot_blocks(k: np.ndarray, source: Source, seed: int, block_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Round, block and words of a source's slots k."""
    turn, block = k // source.blocks, k % source.blocks
    for t in np.unique(turn):
        here = np.flatnonzero((turn == t) & (block < source.full))
        block[here] = permuted(block[here], source.full, seed * 1_000_003 + source.number * 8 + int(t))
    words = np.where(block < source.full, block_words, source.size - source.full * block_words)
    return turn, block, np.where(k == source.slots - 1, np.minimum(words, source.last), words)


SLOT_COLUMNS = "shard long, place long, number long, round long, block long, words long"


def draw_slots(spark, sources: list[Source], seed: int, block_words: int = BLOCK_WORDS, slots_per_shard: int = SLOTS) -> DataFrame:
    """The mix: a row for each slot, with its shard, its place there, and the source, round, block and words that it takes."""
    counts = [s.slots for s in sources]
    total = sum(counts)
    shelves = -(-total // (SHELF * slots_per_shard))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shelf in batch.column(0).to_pylist():
                own, before = shelf_counts(shelf, shelves, counts)
                for k, drawn in enumerate(shard_counts(own, shelf, seed, slots_per_shard)):
                    some = np.flatnonzero(drawn)
                    parts = [slot_blocks(before[s] + np.arange(drawn[s]), sources[s], seed, block_words) for s in some]
                    turn, block, words = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
                    before = before + drawn
                    shard = shelf * (SHELF + 1 + len(counts) // slots_per_shard) + k  # rounding may give a shelf a few slots more
                    place = np.random.default_rng([seed, shelf, k]).permutation(len(block))
                    yield pa.RecordBatch.from_pydict({"shard": np.full(len(block), shard), "place": place, "number": np.repeat(some, drawn[some]), "round": turn, "block": block, "words": words})

    tasks = max(1, min(shelves, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, shelves, 1, tasks).mapInArrow(draw, SLOT_COLUMNS)


def with_offsets(sized: DataFrame, sources: list[Source]) -> DataFrame:
    """Adds `number`, the source's, and `began`, the words of its source before a document.

    A source's rows are dealt by `key`, a hash of doc_id and text, into buckets whose number follows its rows; buckets' sums
    give their offsets, and rows within a bucket are summed in order. So no task holds a whole source.
    """
    spark = sized.sparkSession
    names = spark.createDataFrame([(s.name, s.number, max(1, min(MOST_BUCKETS, -(-s.rows // BUCKET_ROWS)))) for s in sources], "name string, number long, buckets long")
    dealt = sized.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name")))
    dealt = dealt.withColumn("bucket", F.pmod("key", "buckets")).drop("name", "buckets")
    sums = dealt.groupBy("number", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("number", "bucket").orderBy("doc_id", "size", "key", "row").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return dealt.join(sums, ["number", "bucket"]).withColumn("began", F.col("base") + F.col("own")).drop("bucket", "base", "own", "key")


def taken_spans(sized: DataFrame, sources: list[Source], seed: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (row, shard, place, round, block, low, high): the words from low to before high of a document that a slot takes.

    sized: row, doc_id, source, size. A span lies in one block, at (shard, place) of the mix.
    """
    placed = with_offsets(sized.where("size > 0"), sources)
    first, last = F.floor(F.col("began") / block_words), F.floor((F.col("began") + F.col("size") - 1) / block_words)
    placed = placed.select("row", "number", "began", "size", F.explode(F.sequence(first, last)).alias("block"))
    slots = draw_slots(sized.sparkSession, sources, seed, block_words)
    met = placed.join(slots.hint("merge"), ["number", "block"])
    begins = F.col("block") * block_words - F.col("began")
    low, high = F.greatest(begins, F.lit(0)), F.least(begins + F.col("words"), F.col("size"))
    return met.select("row", "shard", "place", "round", "block", low.alias("low"), high.alias("high")).where("low < high")


def _planned(sized: DataFrame, cycle: tuple[int, ...], block_words: int) -> list[Source]:
    found = sized.groupBy("source").agg(F.sum("size"), F.count("*")).limit(MOST_SOURCES + 1).collect()  # one row for each source
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources to weigh")
    return plan_sources([tuple(r) for r in found], cycle, block_words)


def _sized(docs: DataFrame, row: Column, id_column: str, text_column: str, source_column: str, *more: Column) -> DataFrame:
    doc_id, text = quoted(id_column).cast("long"), quoted(text_column).cast("string")
    return docs.select(row.alias("row"), doc_id.alias("doc_id"), quoted(source_column).cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(doc_id, text).alias("key"), *more)


def mix_sources(
    docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), seed: int = 17, block_words: int = BLOCK_WORDS, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source"
) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken (words, repeats counted), source, slots.

    slots lists where the mix holds the document's words: arrays of (shard, place, round, block, words), in that order.
    Sources (by code point, null last) weigh `cycle` in turn and share all words; none gets more than 3 times its own,
    and no document is taken more than 3 times. A source's taken words are its target, rounded.
    Null and empty texts have size 0 and are never taken. Repeated rows are rows of their own. A null doc_id is kept.
    Other columns are ignored. An empty table gives no rows. The list of sources (a row each, at most MOST_SOURCES) is
    held by the driver.
    """
    sized = cut_lineage(_sized(docs, F.monotonically_increasing_id(), id_column, text_column, source_column))
    sources = _planned(sized, cycle, block_words)
    words = F.col("high") - F.col("low")
    slot = F.struct("shard", "place", "round", "block", words.alias("words"))
    sums = taken_spans(sized, sources, seed, block_words).groupBy("row").agg(F.sum(words).alias("taken"), F.array_sort(F.collect_list(slot)).alias("slots"))
    facts = sized.sparkSession.createDataFrame([(s.name, s.size, s.target) for s in sources], "name string, source_size long, target double")
    out = sized.join(sums, "row", "left").join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("name")))  # facts: MOST_SOURCES rows at most
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "source", F.coalesce("slots", F.array().cast(sums.schema["slots"].dataType)).alias("slots"))


def slots_text(slots: str) -> Column:
    """shard:place:round:block:words of each slot, joined by commas."""
    return F.array_join(F.transform(slots, lambda s: F.concat_ws(":", *[s[c].cast("string") for c in ("shard", "place", "round", "block", "words")])), ",")


def _sliced(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Each text's slices between words low and high, as a list."""
    out = []
    for text, own in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        edges = [m.start() for m in re.finditer(WORD_PATTERN, text)] + [len(text)]
        out.append([text[edges[x["low"]] : edges[x["high"]]].rstrip("\x20\t\n\x0b\x0c\r") for x in own])
    return pa.array(out, pa.list_(pa.string()))


def mixed_texts(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), seed: int = 17, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix, written out: for each slot and each document in its block, a row with the words taken, in the mix's order.

    Columns are those of `docs` (doc_id, text, source at least), with `text` replaced and `n_chars`, if there, its length;
    names that are the operator's own, too, and any others (with dots, say) are kept. Rows are dealt by shard, and sorted by
    shard, place in it, and place in the block, so files hold whole shards in order. Words keep the white space between
    them. Nulls, repeated rows and empty tables: as in mix_sources.
    """
    row, spans_, text_, taken, at, fact = spare_names(docs.columns, "_row", "_spans", "_text", "_taken", "_at", "_fact")
    every = [quoted(c) for c in docs.columns]
    facts = _sized(docs, F.monotonically_increasing_id(), "doc_id", "text", "source", F.struct(*every).alias(fact))
    kept = cut_lineage(facts.select(F.struct("row", "doc_id", "source", "size", "key").alias(at), quoted(fact)))
    sized = kept.select(f"{at}.*")
    kept = kept.select(f"{fact}.*", F.col(f"{at}.row").alias(row))
    spans = taken_spans(sized, _planned(sized, cycle, block_words), seed, block_words)
    # words before the document in its block tell the order of a block's documents
    span = F.struct("shard", "place", "block", "low", "high")
    runs = spans.groupBy(F.col("row").alias(at)).agg(F.collect_list(span).alias(spans_))
    met = kept.join(runs, quoted(row) == quoted(at)).withColumn(text_, F.arrow_udf(_sliced, "array<string>")(F.col("text"), quoted(spans_)))
    each = met.withColumn(taken, F.explode(F.arrays_zip(quoted(spans_).alias("s"), quoted(text_).alias("t"))))
    new = {"text": F.col(f"{taken}.t"), "n_chars": F.length(F.col(f"{taken}.t")).cast("long")}
    chosen = [new.get(c, quoted(c)).alias(c) for c in docs.columns]
    shard, place, order = spare_names(docs.columns, "_shard", "_place", "_order")
    rows = each.select(*chosen, F.col(f"{taken}.s.shard").alias(shard), F.col(f"{taken}.s.place").alias(place), quoted(row).alias(order))
    # a shard is of one size, whatever the input's
    dealt = rows.repartition(shuffle_partitions(docs), shard).sortWithinPartitions(shard, place, order)
    return dealt.select(*[quoted(c) for c in docs.columns])
