"""SimHash near-duplicates by BK-trees.

A document's fingerprint has a bit set where more than half the 64-bit hashes of its word shingles have it. Equal
fingerprints form one class at once. Two fingerprints that differ in at most 3 bits agree in m - 3 of any m blocks of the
64 bits, so classes are dealt into shards by the values of m - 3 blocks; m grows with the number of classes, so that
shards stay small. Each shard builds a BK-tree: a node's children are keyed by their Hamming distance to it, and a search
follows only the edges within the radius of the distance at hand, and no edge to a subtree that is linked with the query
already, so a tight group of any size costs one step. Trees are built and searched level by level over arrays, for all
shards of a task at once. A unit gives a spanning forest of its links, not its pairs. In a shard above a bound, rows that share
a further key are first linked with the least of them; then it is split into tree parts and query parts, each pair of
parts a unit of its own, but for parts of one component, which have nothing left to find. Components over all links
come from alternating large-star and small-star steps.

`near_copies` finds documents whose shingle sets are similar: the same trees with a wider radius, in shards of documents
that share some least hashes of their shingles, each hit verified by the share of equal least hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallyweave.llm.common import cut_lineage, quoted, shuffle_partitions, spare_names, with_facts
from tallyweave.operators.graphs import components

RADIUS = 3
#: Rows of a tree part; shards above it are split.
PART_ROWS = 1024
#: Rows that a shard is meant to have at most; more classes get longer keys.
SHARD_ROWS = 256
#: Query and node pairs of one step of a search.
STEP_PAIRS = 1 << 19
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of a text: ASCII lower case, words, shingles with repeats, XXH64 with seed 42; 0 without words."""
    words = (text or b"").lower().split()
    return majority(shingle_hashes(words, shingle)) if words else 0


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    found = np.array([fingerprint(t.as_py()) for t in texts], np.uint64)
    return pa.array(found.view(np.int64))


def fingerprint_column(text: str) -> Column:
    return _fingerprints(F.col(text).cast("string").cast("binary"))


def hex_column(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


class Forest:
    """BK-trees of many units: within a unit, a node's children are keyed by their distance to it.

    Node k holds the value at place[k], below parent[k] (-1: a root). Children of k with distance d: found by (k, d) in the
    sorted `edges`. Parents have smaller numbers than their children; `levels` has the first node of each level.
    """

    def __init__(self, unit: np.ndarray, value: np.ndarray):
        self.value = value
        place, edge_key, edge_to, above, levels = [], [], [], [], []
        # unit: small integers; rows not yet placed, by the (parent node, distance) they hang from; at first by unit
        _, group = np.unique(unit, return_inverse=True)
        rows, made, top = np.arange(len(value)), 0, True
        self.root = np.full(int(unit.max()) + 1 if len(unit) else 0, -1, np.int64)
        parent = distance = None
        while len(rows):
            order = np.argsort(group, kind="stable")
            rows, group = rows[order], group[order]
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            size = np.diff(np.r_[first, len(rows)])
            node = made + np.arange(len(first))
            place.append(rows[first])
            levels.append(made)
            above.append(np.full(len(first), -1) if top else parent[order][first])
            if top:
                self.root[unit[rows[first]]] = node
                top = False
            else:
                edge_key.append(parent[order][first] * 65 + distance[order][first])
                edge_to.append(node)
            made += len(first)
            own = np.repeat(node, size)
            gap = np.bitwise_count(value[rows] ^ value[np.repeat(rows[first], size)]).astype(np.int64)
            stay = np.ones(len(rows), bool)
            stay[first] = False
            rows, parent, distance = rows[stay], own[stay], gap[stay]
            group = parent * 65 + distance
        self.place = np.concatenate(place) if place else np.zeros(0, np.int64)
        self.parent = np.concatenate(above) if above else np.zeros(0, np.int64)
        self.levels = [*levels, len(self.place)]
        keys = np.concatenate(edge_key) if edge_key else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.edges, self.to = keys[order], (np.concatenate(edge_to) if edge_to else keys)[order]

    def start(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, node): the root of each query's unit, where it has one."""
        node = np.where(unit < len(self.root), self.root[np.minimum(unit, len(self.root) - 1)], -1)
        query = np.flatnonzero(node >= 0)
        return query, node[query]

    def below(self, query: np.ndarray, node: np.ndarray, gap: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node): the children within the radius of the distance at hand."""
        low = np.searchsorted(self.edges, node * 65 + np.maximum(gap - radius, 0))
        high = np.searchsorted(self.edges, node * 65 + np.minimum(gap + radius, 64), "right")
        size = high - low
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.repeat(query, size), self.to[at]

    def near(self, unit: np.ndarray, value: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) pairs within the radius, level by level."""
        query, node = self.start(unit)
        while len(node):
            gap = np.bitwise_count(value[query] ^ self.value[self.place[node]]).astype(np.int64)
            hit = gap <= radius
            yield query[hit], self.place[node[hit]]
            query, node = self.below(query, node, gap, radius)

    def uniform(self, label: np.ndarray) -> np.ndarray:
        """Whether all rows below each node, and its own, have one label. label: by row."""
        own, out = label[self.place], np.ones(len(self.place), bool)
        for k in range(len(self.levels) - 2, 0, -1):
            node = np.arange(self.levels[k], self.levels[k + 1])
            out[self.parent[node[~out[node] | (own[node] != own[self.parent[node]])]]] = False
        return out


def linked(unit: np.ndarray, value: np.ndarray, tree: np.ndarray, ask: np.ndarray, radius: int, holds: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """A label for each row, the same for rows that links connect: links lead from rows `ask` to rows `tree` of their unit
    within the radius, where holds(a, b) if it is given. The label is a row of the group.
    """
    label = np.arange(len(value))
    if not len(tree) or not len(ask):
        return label
    forest = Forest(unit[tree], value[tree])
    same = forest.uniform(label[tree])
    query, node = forest.start(unit[ask])
    todo = [(query, node)]
    while todo:
        query, node = todo.pop()
        if len(node) > STEP_PAIRS:
            todo += [(query[k : k + STEP_PAIRS], node[k : k + STEP_PAIRS]) for k in range(0, len(node), STEP_PAIRS)]
            continue
        a, b = ask[query], tree[forest.place[node]]
        go = ~same[node] | (label[a] != label[b])
        query, node, a, b = query[go], node[go], a[go], b[go]
        gap = np.bitwise_count(value[a] ^ value[b]).astype(np.int64)
        hit = np.flatnonzero((gap <= radius) & (label[a] != label[b]))
        if holds is not None:
            hit = hit[holds(a[hit], b[hit])]
        if len(hit):
            x, y = spanning(label[a[hit]], label[b[hit]])
            to = np.arange(len(label))
            to[x] = y
            label = to[label]
            same = forest.uniform(label[tree])
        query, node = forest.below(query, node, gap, radius)
        if len(node):
            todo.append((query, node))
    return label


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links (a, b) connect, each from a node to its component's smallest."""
    nodes, flat = np.unique(np.r_[a, b], return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    apart = label != np.arange(len(nodes))
    return nodes[apart], nodes[label[apart]]


def _linker(radius: int, least_equal: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (unit, is_query, is_tree, fp, rep, and sig if least_equal), sorted by unit -> links (rep, rep) of each unit.

    least_equal: how many bytes of their sigs two rows must have in common.
    """

    def solve(table: pa.Table) -> pa.RecordBatch:
        unit, value, rep = (table.column(c).to_numpy() for c in ("unit", "fp", "rep"))
        tree, ask = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("is_tree", "is_query"))
        _, dense = np.unique(unit, return_inverse=True)
        holds = None
        if least_equal:
            sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(unit), -1)

            def holds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                return np.concatenate([np.zeros(0, bool), *((sigs[a[k : k + 65_536]] == sigs[b[k : k + 65_536]]).sum(1) >= least_equal for k in range(0, len(a), 65_536))])

        label = linked(dense, value.view(np.uint64), tree, ask, radius, holds)
        apart = np.flatnonzero(rep != rep[label])
        return pa.RecordBatch.from_pydict({"a": rep[apart], "b": rep[label[apart]]})

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            seen += batch.num_rows
            if seen < 50_000:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            unit = table.column("unit").to_numpy()
            cut = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on
            if cut:
                yield solve(table.slice(0, cut))
                held, seen = table.slice(cut).to_batches(), len(unit) - cut
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return solved


def _verified(radius: int, least_equal: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows and heads (rep, fp, sig, and the head's) -> links (a, b) of those that are within the radius and have equal bytes enough."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, fp, head, head_fp = (batch.column(c).to_numpy() for c in ("rep", "fp", "head", "head_fp"))
            hit = (np.bitwise_count((fp ^ head_fp).view(np.uint64)) <= radius) & (rep != head)
            if least_equal and hit.any():
                at = pa.array(np.flatnonzero(hit))
                own, other = (np.frombuffer(b"".join(batch.column(c).take(at).to_pylist()), np.uint8).reshape(len(at), -1) for c in ("sig", "head_sig"))
                hit[hit] = (own == other).sum(1) >= least_equal
            yield pa.RecordBatch.from_arrays([pa.array(head[hit]), pa.array(rep[hit])], ["a", "b"])

    return checked


def _near_heads(hot: DataFrame, radius: int, least_equal: int) -> DataFrame:
    """Links (a, b) of rows of a shard with the least of those that share a further key: eight bytes of their sigs, or all bits
    of their fingerprints but a byte. Rows of a group of near copies mostly share some, so these links make no pairs.
    """
    if least_equal:
        keys = [F.xxhash64(F.lit(k), F.substring("sig", k + 1, 8)) for k in range(0, LEAST_HASHES, 8)]
    else:
        keys = [F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(~(255 << 8 * k) if k < 7 else (1 << 56) - 1))) for k in range(8)]
    more = ["sig"] if least_equal else []
    keyed = hot.select("rep", "fp", *more, F.explode(F.transform(F.array(*keys), lambda k: F.xxhash64("shard", k))).alias("key"))
    least = F.min(F.struct("rep", "fp", *more)).alias("head")
    heads = keyed.groupBy("key").agg(least, F.count("*").alias("n")).where("n > 1")
    heads = cut_lineage(heads.select("key", "n", F.col("head.rep").alias("head"), F.col("head.fp").alias("head_fp"), *[F.col("head.sig").alias("head_sig") for _ in more]))
    return with_facts(keyed, heads, "key", "n").mapInArrow(_verified(radius, least_equal), "a long, b long").distinct()


def _hot_units(hot: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with unit, is_query and is_tree, of shards above PART_ROWS.

    hot: shard, rep and more. links: those found already. Rows of a component that has more than PART_ROWS in a shard make parts
    of their own, others share parts; parts are paired, but not those of one component. So a shard of near copies makes
    no pairs of parts, whatever its size, and each row that is not linked meets all others.
    """
    named = hot.join(components(links), F.col("rep") == F.col("node"), "left").withColumn("group", F.coalesce("component", "rep")).drop("node", "component")
    named = cut_lineage(named)
    sizes = named.groupBy("shard", "group").agg(F.count("*").alias("n"))
    # groups below the bound are one mixed group: null
    groups = sizes.groupBy("shard", F.when(F.col("n") > PART_ROWS, F.col("group")).alias("group")).agg(F.sum("n").alias("n")).withColumn("parts", F.ceil(F.col("n") / PART_ROWS))
    by_shard = Window.partitionBy("shard").orderBy("group")
    groups = groups.withColumn("first", F.sum("parts").over(by_shard) - F.col("parts")).withColumn("all", F.sum("parts").over(Window.partitionBy("shard")))
    large = sizes.where(F.col("n") > PART_ROWS)
    keyed = named.withColumn("of", F.struct("shard", "group"))
    mine = with_facts(keyed, cut_lineage(sizes.select(F.struct("shard", "group").alias("of"), F.col("n").alias("size"))), "of", "size") if not large.isEmpty() else keyed.withColumn("size", F.lit(0).cast("long"))
    mine = mine.withColumn("of", F.struct("shard", F.when(F.col("size") > PART_ROWS, F.col("group")).alias("group"))).drop("size", "group")
    placed = with_facts(mine, cut_lineage(groups.select(F.struct("shard", "group").alias("of"), F.col("group").isNull().alias("mixed"), "n", "parts", "first", "all")), "of", "n")
    placed = placed.withColumn("part", F.col("first") + F.pmod(F.xxhash64("rep"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)))
    met = placed.where("mixed or other < first or other >= first + parts")
    same = F.col("part") == F.col("other")
    # the tree of the lower part is asked by both; within a part it is asked by itself
    unit = F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other"))
    return met.select(unit.alias("unit"), (same | (F.col("part") > F.col("other"))).alias("is_query"), (same | (F.col("part") < F.col("other"))).alias("is_tree"), *[c for c in hot.columns if c != "shard"])


def _shard_links(rows: DataFrame, radius: int, least_equal: int = 0) -> DataFrame:
    """Links (a, b) of rep that connect all rows of a shard within the radius. rows: fp, rep, shard, and sig if least_equal."""
    more = ["sig"] if least_equal else []
    rows = rows.select("shard", "fp", "rep", *more)
    large = cut_lineage(rows.groupBy("shard").count().where(F.col("count") > PART_ROWS).select("shard"))
    whole = rows if large.isEmpty() else rows.join(large, "shard", "left_anti")
    units = whole.select(F.col("shard").alias("unit"), F.lit(True).alias("is_query"), F.lit(True).alias("is_tree"), "fp", "rep", *more)
    found = None
    if not large.isEmpty():
        hot = cut_lineage(rows.join(large, "shard", "left_semi"))
        found = cut_lineage(_near_heads(hot, radius, least_equal))
        units = units.unionByName(_hot_units(hot, found))
    dealt = units.repartition(shuffle_partitions(rows), "unit").sortWithinPartitions("unit")
    links = dealt.mapInArrow(_linker(radius, least_equal), "a long, b long")
    return links if found is None else links.union(found)


def block_count(classes: int, radius: int = RADIUS) -> int:
    """Into how many blocks to cut 64 bits, so that shards of equal blocks (all but `radius`) have SHARD_ROWS rows or fewer, if bits are even."""
    m = radius + 1
    while m < 2 * radius + 2 and classes > SHARD_ROWS << (64 * (m - radius) // m):
        m += 1
    return m


def similar_links(classes: DataFrame, blocks: int = RADIUS + 1) -> DataFrame:
    """Links (a, b) of rep that connect all fingerprints within the radius. classes: fp (distinct), rep.

    blocks: into how many the bits are cut; each choice of all but 3 is a key. More blocks make more and smaller shards, and
    the same links.
    """
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for k, chosen in enumerate(combinations(range(blocks), blocks - RADIUS)):
        mask = sum(((1 << edges[c + 1]) - 1) ^ ((1 << edges[c]) - 1) for c in chosen)
        keys.append(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    return _shard_links(classes.select("fp", "rep", F.explode(F.array(*keys)).alias("shard")), RADIUS)


def _classed(prints: DataFrame) -> DataFrame:
    """Adds component_id to prints (doc_id, fp, ...): the smallest doc_id of all fingerprints that its own can reach."""
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(similar_links(classes.where("rep is not null"), block_count(classes.count())))
    named = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp")


def simhash_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fp (long) and component_id, the smallest doc_id that links of 3 or fewer differing bits reach.

    Null texts and texts without words have fingerprint 0 and link like any other. Repeated rows give a row each. A row
    with a null doc_id gets the component of its fingerprint; null, if all rows of that fingerprint have null ids. An
    empty table gives no rows. Other columns are ignored.
    """
    prints = cut_lineage(docs.select(F.col(id_column).cast("long").alias("doc_id"), fingerprint_column(text_column).alias("fp")))
    return _classed(prints).select("doc_id", "fp", "component_id")


#: Least hashes that a document is described by (a byte of each), and bands of them: documents with an equal band share a shard.
LEAST_HASHES, BANDS, BAND_ROWS = 128, 6, 3
#: How far an estimate from 128 least hashes may fall below the wanted similarity (1.3 standard deviations at 0.8).
SLACK = 0.045
_MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, LEAST_HASHES, dtype=np.uint64) | np.uint64(1)
_PRINT = "struct<key binary, fp bigint, sig binary, bands array<bigint>>"


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of a text's shingles, repeats included; of the whole sequence, if it has fewer words."""
    from xxhash import xxh64_intdigest

    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    return np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half the hashes have."""
    planes = hashes.view(np.uint8).reshape(-1, 8)
    ones = [np.bincount(planes[:, k], minlength=256) @ _BITS for k in range(8)]
    return int.from_bytes(np.packbits(np.concatenate(ones) * 2 > len(hashes), bitorder="little").tobytes(), "little")


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least of the hashes under each of LEAST_HASHES multiplications."""
    out = np.full(LEAST_HASHES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), 2048):
            out = np.minimum(out, (hashes[k : k + 2048, None] * _MULTIPLIERS).min(0))
    return out


def _describe(text: bytes | None, shingle: int) -> tuple[bytes, int, bytes, list[int]]:
    from xxhash import xxh3_128_digest

    words = (text or b"").lower().split()
    key = xxh3_128_digest(b" ".join(words))
    if not words:
        return key, 0, bytes(LEAST_HASHES), []
    hashes = shingle_hashes(words, shingle)
    least = least_hashes(np.unique(hashes))
    bands = least[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    with np.errstate(over="ignore"):
        mixed = np.arange(BANDS, dtype=np.uint64)
        for c in bands.T:
            mixed = (mixed ^ c) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return key, majority(hashes), (least & np.uint64(255)).astype(np.uint8).tobytes(), mixed.view(np.int64).tolist()


def hamming_radius(similarity: float) -> int:
    """Bits in which fingerprints of sets of this similarity (of equal sizes) differ, and two standard deviations more."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(64 * share + 2 * math.sqrt(64 * share * (1 - share)))


def _described(text: Column, shingle: int) -> Column:
    @F.arrow_udf(_PRINT)
    def described(texts: pa.Array) -> pa.Array:
        rows = [_describe(t.as_py(), shingle) for t in texts]
        kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        columns = [pa.array([int(r[1]) - (1 << 64) if r[1] >> 63 else int(r[1]) for r in rows] if k == 1 else [r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, ["key", "fp", "sig", "bands"])

    return described(text.cast("string").cast("binary"))


def _grouped(prints: DataFrame, similarity: float) -> DataFrame:
    """Adds component to prints (row, p: what _described gives, ...), less p."""
    # rows of a key have the same values
    classes = prints.groupBy("p.key").agg(F.min("row").alias("rep"), *[F.first(f"p.{c}").alias(c) for c in ("fp", "sig", "bands")])
    classes = cut_lineage(classes)
    rows = classes.select("fp", "rep", "sig", F.explode("bands").alias("shard"))
    found = components(_shard_links(rows, hamming_radius(similarity), math.ceil(LEAST_HASHES * (similarity - SLACK))))
    named = classes.select("key", "rep").join(found, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("component", "rep").alias("component"))
    rest = [c for c in prints.columns if c != "p"]
    return prints.select(*rest, F.col("p.key").alias("key")).join(named, "key").select(*rest, "component")


def near_copies(docs: DataFrame, row: str, text_column: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """row, component: the groups of documents that links of similar sets of word shingles connect.

    docs: a column `row` (long, distinct, not null) and the text. Texts with the same words (ASCII case aside) are one class
    at once. Two classes are linked if they share a band of least hashes, their fingerprints lie within the radius that
    the similarity implies, and their estimated similarity is at least `similarity` less SLACK. Null texts and texts without
    words form one class, linked to no other. component is the row of a member. Repeated rows share their component. An
    empty table gives no rows.
    """
    return _grouped(cut_lineage(docs.select(quoted(row).alias("row"), _described(quoted(text_column), shingle).alias("p"))), similarity)


def keep_representatives(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of `near_copies` stays, with all its columns: that with the smallest doc_id (null last).

    docs: doc_id and text at least; other columns, whatever their names, are kept. Of repeated rows with one id and text one
    stays. Null texts and empty tables: as in near_copies. Texts are dealt once, by id and text hash, and not stored again.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    # the same three columns join and number the rows, so the texts are dealt once
    marks = [F.coalesce(doc_id, F.lit(0)), doc_id.isNull(), F.xxhash64(F.coalesce(text, F.lit("")))]
    own = spare_names(docs.columns, "_id", "_none", "_hash", "_turn")
    facts = docs.select(F.monotonically_increasing_id().alias("row"), *[m.alias(n) for m, n in zip(marks, ("id", "none", "hash"), strict=True)], _described(text, shingle).alias("p"))
    groups = _grouped(cut_lineage(facts), similarity).groupBy("component")
    stay = groups.agg(F.min(F.struct("none", "id", "hash", "row")).alias("m")).select(*[F.col(f"m.{c}").alias(n) for c, n in zip(("id", "none", "hash"), own, strict=False)])
    rows = docs.select(*[quoted(c) for c in docs.columns], *[m.alias(n) for m, n in zip(marks, own, strict=False)]).join(stay, own[:3], "left_semi")
    turn = F.row_number().over(Window.partitionBy(*own[:3]).orderBy(F.lit(0)))
    return rows.withColumn(own[3], turn).where(F.col(own[3]) == 1).select(*[quoted(c) for c in docs.columns])
