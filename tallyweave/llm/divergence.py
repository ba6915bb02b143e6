"""Source divergence audit: how far the words of each source lie from those of other sources, and which words set it apart.

Words that at least LEAST_DOCS documents of a language have are its kept terms. Each group (language, source), and each
language, gives a kept term p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two of them differ at a term by
floor((p - q)^2 / (p + q)), all in exact integers.

Documents are counted in their tasks, so what is shuffled is a row for each word of a task and source. Words are dealt by
(language, word) and sorted; stretches of them become chunks: the sorted array of the kept terms, ids by searchsorted, and
counts by bincount for each source. Ids keep the order of UTF-8, so ties break by id. A chunk's dense vectors, a block of
sources at a time, give its share of each pair's sum. No task holds all terms of a language, or all its sources.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import cut_lineage, quoted, shuffle_partitions

LEAST_DOCS, TOP_TERMS, UNIT = 10, 10, 1_000_000_000
#: Words that a task holds before it sends their counts; bytes of a text that are split at once.
WORDS_HELD, STRETCH = 400_000, 1 << 20
#: Rows of a chunk, about; sources of a block; terms of a block that are compared at once.
CHUNK_ROWS, BLOCK_SOURCES, TERMS_HELD = 65_536, 64, 8_192
#: ASCII letters become small ones, all other ASCII a space; other bytes stay.
_TABLE = bytes(c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalpha() else 0x20 for c in range(256))


def stretches(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in stretches of about STRETCH bytes."""
    at = 0
    while at < len(text):
        end = min(at + STRETCH, len(text))
        while end < len(text) and _TABLE[text[end]] != 0x20:
            end += 1
        yield text[at:end].translate(_TABLE).split()
        at = end


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> occurrences of each term, and documents that have it, of this task. A group also gives a row without a term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = [None, *n]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())], schema=_COUNTS)
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text")), strict=True):
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(n), set()
            for terms in stretches(text.as_py()):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            size += len(n) - before
            if size > WORDS_HELD:
                yield from sent()
                size = 0
    yield from sent()


_ENCODED = "lang string, chunk long, source string, n_terms int, ids array<int>, ns array<long>, terms array<string>, lang_ns array<long>"
_ENCODED_ARROW = pa.schema([("lang", pa.string()), ("chunk", pa.int64()), ("source", pa.string()), ("n_terms", pa.int32()), ("ids", pa.list_(pa.int32())), ("ns", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("lang_ns", pa.list_(pa.int64()))])


def _encoding(least_docs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts sorted by (lang, term) -> a row for each source of each chunk, and one without a source for the chunk.

    Groups without terms give a row with the chunk -1.
    """

    def encoded(lang: str, table: pa.Table, chunk: int) -> list[tuple]:
        terms = np.array(table.column("term").to_pylist(), object)
        n, docs = (table.column(c).to_numpy() for c in ("n", "docs"))
        first = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])  # sorted, so equal terms are neighbours
        kept = terms[first][np.add.reduceat(docs, first) >= least_docs]
        if not len(kept):
            return []
        at = np.searchsorted(kept, terms)
        here = np.flatnonzero(kept[np.minimum(at, len(kept) - 1)] == terms)
        ids, n = at[here], n[here]
        total = _summed(ids, n, len(kept))
        names, source = np.unique(np.array(table.column("source").to_pylist(), object)[here], return_inverse=True)
        order = np.argsort(source, kind="stable")
        cuts = np.searchsorted(source[order], np.arange(len(names) + 1))
        rows = [(lang, chunk, None, len(kept), None, None, None, None)]
        for k, name in enumerate(names):
            mine = order[cuts[k] : cuts[k + 1]]
            counts = _summed(ids[mine], n[mine], len(kept))
            used = np.flatnonzero(counts)
            rows.append((lang, chunk, name, len(kept), used.astype(np.int32), counts[used], [t.decode() for t in kept[used]], total[used]))
        return rows

    def solved(table: pa.Table, chunk: int) -> Iterator[pa.RecordBatch]:
        rows = []
        bare = table.filter(pc.is_null(table.column("term")))
        for lang, source in {(r["lang"], r["source"]) for r in bare.select(["lang", "source"]).to_pylist()}:
            rows.append((lang, -1, source, 0, [], [], [], []))
        table = table.filter(pc.is_valid(table.column("term")))
        langs = table.column("lang").to_numpy() if table.num_rows else np.zeros(0, object)
        first = np.flatnonzero(np.r_[True, langs[1:] != langs[:-1]]) if len(langs) else []
        for a, b in zip(first, [*first[1:], len(langs)], strict=True):
            rows += encoded(langs[a], table.slice(a, b - a), chunk)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENCODED_ARROW, strict=True)], schema=_ENCODED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held, seen = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            seen += batch.num_rows
            if seen < CHUNK_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            lang, term = table.column("lang").to_numpy(), np.array(table.column("term").to_pylist(), object)
            cut = len(term) - 1
            while cut and (lang[cut - 1], term[cut - 1]) == (lang[-1], term[-1]):  # the last term may go on
                cut -= 1
            if cut:
                yield from solved(table.slice(0, cut), chunk)
                chunk, held, seen = chunk + 1, table.slice(cut).to_batches(), seen - cut
        if held:
            yield from solved(pa.Table.from_batches(held).combine_chunks(), chunk)

    return run


def _summed(ids: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sum of n by id; bincount adds doubles, so both halves are added on their own."""
    high, low = np.divmod(n, 1 << 26)
    return (np.bincount(ids, high, size).astype(np.int64) << 26) + np.bincount(ids, low, size).astype(np.int64)


def share(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(UNIT (count + 2) / (total + 2 terms)), by long division in steps of 1000, so that nothing leaves 64 bits."""
    below = total + 2 * terms
    whole, rest = np.divmod(count.astype(np.int64) + 2, below)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + more
    return whole + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


_PAIRS = "lang string, source string, item string, value long"


def _compared(table: pa.Table) -> pa.Table:
    """A unit (a chunk and two blocks of sources) -> its share of each pair's sum; a pair in one order only.

    Its rows: one without a source, that holds both blocks' sources and totals, and one for each source that the chunk has.
    """
    head = next(r for r in table.filter(pc.is_null(table.column("source"))).to_pylist())
    names, totals, low = head["names"], head["totals"], head["low_size"]
    place, n_terms = {s: k for k, s in enumerate(names)}, head["n_terms"]
    rows = table.filter(pc.is_valid(table.column("source")))
    mine = [(place[s], ids, ns) for s, ids, ns in zip(rows.column("source").to_pylist(), rows.column("ids"), rows.column("ns"), strict=True)]
    out = np.zeros((len(names), len(names)), np.int64)
    count = np.zeros((len(names), n_terms), np.int64)
    for k, ids, ns in mine:
        count[k, ids.values.to_numpy()] = ns.values.to_numpy()
    same = head["a"] == head["b"]
    for at in range(0, n_terms, TERMS_HELD):
        p = np.stack([share(count[k, at : at + TERMS_HELD], totals[k], head["v"]) for k in range(len(names))])
        for i in range(len(names) if same else low):
            others = slice(i + 1, None) if same else slice(low, None)
            out[i, others] += gaps(p[i][None, :], p[others]).sum(1)
    i, j = np.nonzero(np.triu(np.ones_like(out), 1)) if same else (x.ravel() for x in np.meshgrid(np.arange(low), np.arange(low, len(names)), indexing="ij"))
    named = np.array(names, object)
    return pa.table({"lang": pa.array([head["lang"]] * len(i), pa.string()), "source": pa.array(named[i], pa.string()), "item": pa.array(named[j], pa.string()), "value": out[i, j]})


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, source) rows with totals -> its TOP_TERMS terms that the group has more of than its language."""
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            r = {c: batch.column(c)[k] for c in batch.schema.names}
            terms, own, all_of = (r[c].values for c in ("terms", "ns", "lang_ns"))
            p, q = share(own.to_numpy(), r["total"].as_py(), r["v"].as_py()), share(all_of.to_numpy(), r["lang_total"].as_py(), r["v"].as_py())
            more = np.flatnonzero(p > q)
            value = gaps(p[more], q[more])
            best = np.lexsort((more, -value))[:TOP_TERMS]
            rows += [(r["lang"].as_py(), r["source"].as_py(), terms[int(more[b])].as_py(), int(value[b])) for b in best]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], pa.int64())], ["lang", "source", "item", "value"])


def _pair_sums(encoded: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for all ordered pairs of sources of a language. groups: lang, source, total, v."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    placed = groups.withColumn("block", F.floor(place / BLOCK_SOURCES))
    inner = F.sort_array(F.collect_list(F.struct("source", "total")))  # at most BLOCK_SOURCES
    blocks = placed.groupBy("lang", "block", "v").agg(inner.alias("inner"))
    low, high = blocks.alias("low"), blocks.alias("high")
    both = low.join(high, (F.col("low.lang") == F.col("high.lang")) & (F.col("low.block") <= F.col("high.block")))
    same = F.col("low.block") == F.col("high.block")
    inner = F.when(same, F.col("low.inner")).otherwise(F.concat("low.inner", "high.inner"))
    both = both.select(F.col("low.lang").alias("lang"), F.col("low.block").alias("a"), F.col("high.block").alias("b"), "low.v", F.size("low.inner").alias("low_size"), inner["source"].alias("names"), inner["total"].alias("totals"))
    heads = encoded.where("source is null").select("lang", "chunk", "n_terms").join(both, "lang")
    count = placed.groupBy("lang").agg(F.max("block").alias("last"))
    rows = encoded.where("source is not null and chunk >= 0").select("lang", "chunk", "source", "ids", "ns").join(placed.select("lang", "source", "block"), ["lang", "source"]).join(count, "lang")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    rows = rows.select("lang", "chunk", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "source", "ids", "ns")
    units = heads.unionByName(rows, allowMissingColumns=True)
    found = units.groupBy("lang", "chunk", "a", "b").applyInArrow(_compared, _PAIRS)
    sums = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ways = F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("source", "item"), ("item", "source"))])
    return sums.select("lang", "value", F.inline(ways)).select("lang", "source", "item", "value")


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, lang_column: str = "lang", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """lang, source, part, item, value and rank: `pair` rows compare a group with each other source of its language, `term`
    rows name the TOP_TERMS terms that it has more of than its language.

    Null texts, languages and sources count as empty strings; texts without terms, and very long ones (split in stretches),
    as any other. Repeated rows are documents of their own. Equal values are ranked by UTF-8. A language without kept terms
    has pairs of value 0. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    text = lambda c, n: F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n)
    rows = docs.select(text(lang_column, "lang"), text(source_column, "source"), text(text_column, "text")).withColumn("text", F.col("text").cast("binary"))
    counts = rows.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    dealt = counts.repartition(shuffle_partitions(docs), "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    encoded = cut_lineage(dealt.sortWithinPartitions("lang", "term").mapInArrow(_encoding(least_docs), _ENCODED))
    total = F.sum(F.aggregate("ns", F.lit(0).cast("long"), lambda a, x: a + x))
    groups = encoded.where("source is not null").groupBy("lang", "source").agg(total.alias("total"))
    langs = encoded.where("source is null").groupBy("lang").agg(F.sum("n_terms").alias("v"))
    groups = cut_lineage(groups.join(langs, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0).cast("long"))))
    pairs = _pair_sums(encoded, groups.where("v > 0"))
    bare = groups.where("v = 0").select("lang", "source")
    other = bare.select("lang", F.col("source").alias("item"))
    pairs = pairs.unionByName(bare.join(other, "lang").where("source <> item").withColumn("value", F.lit(0).cast("long")))
    sums = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    asked = encoded.where("source is not null and chunk >= 0").select("lang", "source", "ns", "terms", "lang_ns").join(groups, ["lang", "source"]).join(sums, "lang")
    terms = asked.mapInArrow(_distinct_terms, _PAIRS)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = lambda part, name: part.select("lang", "source", F.lit(name).alias("part"), "item", "value", rank.alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= TOP_TERMS))
