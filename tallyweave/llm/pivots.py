"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors, thinned so that no two are near copies. A vector is
described by its nearest pivots in order, as far as they are about as near as the nearest one; it stands in the inverted list
of each of these (with more vectors than single pivots can tell apart: of each set of them). Two vectors meet in the
lists of the pivots they share; the counts of shared pivots say which of these lists is their first, where the pair is
verified, by block matrix products of unit vectors in double precision. How near is near enough is measured on the sample:
pairs at the very limit angle shall share a pivot with the wanted probability.

Equal vectors of a label are one class at once, so copies make no pairs. A list above PART_ROWS classes is cut into parts,
and each pair of parts is a unit of its own. Units give each class the number of its links and one link of a spanning
forest, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import cut_lineage, quoted, shuffle_partitions, with_facts
from tallyweave.llm.simhash import spanning
from tallyweave.operators.graphs import components

LIMIT = 0.98
#: Pivots at most, and vectors of the sample that the margin is measured on. Classes that a pivot is meant to be nearest to.
MOST_PIVOTS, MEASURED, PIVOT_ROWS = 4096, 512, 512
#: The share of pairs at the limit angle that shall share a pivot.
FOUND = 0.985
#: Classes of a part of a list; classes that one set of pivots is meant to be nearest to at most, before sets get larger.
PART_ROWS, LIST_ROWS = 4096, 8192
#: Rows of a block of a matrix product; rows that a task holds before it solves their units.
BLOCK, HELD = 1024, 16_384


def comparable(vector: Column) -> Column:
    """Whether a vector has a direction: all components there and finite, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: pa.ListArray) -> np.ndarray:
    """Unit vectors in double precision of vectors of one length."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square leaves the range of doubles
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def thinned(sample: np.ndarray, wanted: int, limit: float) -> np.ndarray:
    """Up to `wanted` of the sample, of which no two are within twice the limit angle."""
    near, kept = 2 * limit * limit - 1, np.zeros((0, sample.shape[1]))
    free = np.ones(len(sample), bool)
    for k in range(len(sample)):
        if len(kept) == wanted:
            break
        if free[k]:
            kept = np.vstack([kept, sample[k]])
            free &= sample @ sample[k] < near
    return kept


def set_size(classes: int, pivots: int = MOST_PIVOTS, rows: int = LIST_ROWS) -> int:
    """How many pivots a list stands for, so that no more than `rows` of evenly spread classes have a list as their nearest."""
    size = 1
    while size < 8 and classes > rows * math.comb(pivots, size):
        size += 1
    return size


def _sets(gap: np.ndarray, size: int, margin: float) -> list[int]:
    """Numbers of the sets of pivots whose summed gaps are within the margin of the least sum. gap: of each pivot, from the nearest."""
    order = np.argsort(gap, kind="stable")
    least = gap[order[:size]].sum()
    # the pivots of such a set lie within the margin of what the others of the best set leave
    near = order[: max(size, int(np.searchsorted(gap[order], margin + least, "right")))]
    return sorted(sum(int(p) * len(gap) ** k for k, p in enumerate(sorted(s))) for s in combinations(near.tolist(), size) if gap[list(s)].sum() <= margin + least)


def nearest_lists(x: np.ndarray, pivots: np.ndarray, size: int, margin: float) -> list[np.ndarray]:
    """For each unit vector the sorted numbers of its lists."""
    cosine = x @ pivots.T
    gap = cosine.max(1, keepdims=True) - cosine
    size = min(size, len(pivots))
    if size > 1:
        return [np.array(_sets(g, size, margin), np.int64) for g in gap]
    row, pivot = np.nonzero(gap <= margin)
    return np.split(pivot, np.searchsorted(row, np.arange(1, len(x))))


def margin_for(pivots: np.ndarray, sample: np.ndarray, limit: float, size: int, found: float = FOUND) -> float:
    """The margin with which a share `found` of pairs at the limit angle share a list. Partners of the sample's vectors lie off
    in the direction of differences of its vectors.
    """
    if len(sample) < 3 or len(pivots) < 2:
        return 0.05
    x = sample
    off = np.roll(x, 1, axis=0) - np.roll(x, 2, axis=0)
    off -= (off * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(off, axis=1, keepdims=True)
    x, off = x[length[:, 0] > 1e-9], off[length[:, 0] > 1e-9] / length[length[:, 0] > 1e-9]
    if not len(x):
        return 0.05
    y = limit * x + math.sqrt(1 - limit * limit) * off
    gaps = [(c := z @ pivots.T).max(1, keepdims=True) - c for z in (x, y)]
    size = min(size, len(pivots))
    if size == 1:
        need = np.maximum(*gaps).min(1)
    else:
        need = np.empty(len(x))
        for k, (a, b) in enumerate(zip(*gaps, strict=True)):
            near = sorted({*np.argsort(a)[: size + 4].tolist(), *np.argsort(b)[: size + 4].tolist()})
            least = [np.sort(g)[:size].sum() for g in (a, b)]
            need[k] = min(max(a[list(s)].sum() - least[0], b[list(s)].sum() - least[1]) for s in combinations(near, size))
    return float(np.quantile(need, found)) + 1e-9


def _fitted(rows: DataFrame, classes: int, limit: float) -> dict[int, tuple[np.ndarray, int, float]]:
    """Length of vectors -> (pivots, pivots of a set, margin), from a sample of at most 1.5 x MOST_PIVOTS + MEASURED vectors."""
    wanted = min(MOST_PIVOTS, max(8, -(-classes // PIVOT_ROWS)))
    most = wanted + wanted // 2 + MEASURED
    share = min(1.0, 1.2 * most / max(1, classes))
    drawn = rows.where(F.pmod(F.xxhash64("k2", "k1"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").limit(most).toArrow()
    held: dict[int, list] = {}
    for v in drawn.column("v").to_pylist():
        held.setdefault(len(v), []).append(v)
    fitted = {}
    for length, vectors in held.items():
        sample = units(pa.array(vectors, pa.list_(pa.float64())))
        measured = min(MEASURED, len(sample) // 3)
        pivots = thinned(sample[measured:], wanted, limit)
        size = set_size(classes)
        fitted[length] = pivots, size, margin_for(pivots, sample[:measured], limit, size)
    return fitted


def _describing(fitted: dict[int, tuple[np.ndarray, int, float]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds lists to classes. A length of vectors that the sample lacks has one list."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = part.column("v")
                sizes = np.diff(vectors.offsets.to_numpy())
                lists = [np.zeros(1, np.int64)] * len(sizes)
                for length in np.unique(sizes):
                    if int(length) in fitted:
                        here = np.flatnonzero(sizes == length)
                        for k, found in zip(here, nearest_lists(units(vectors.take(pa.array(here))), *fitted[int(length)]), strict=True):
                            lists[k] = found
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int64()))], [*part.schema.names, "lists"])

    return described


def unit_links(x: np.ndarray, many: np.ndarray, lists: list[np.ndarray], own: int, low: np.ndarray, high: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(vectors linked with each row, a row of its group) of a unit: pairs of rows `low` and `high`, that have `own` as their first shared list.

    many: vectors of each class. low and high are the same rows, or have none in common.
    """
    label, count = np.arange(len(x)), np.zeros(len(x), np.int64)
    earlier = [s[s < own] for s in lists]
    has = np.array([len(e) > 0 for e in earlier])
    same = len(low) == len(high) and (low == high).all()
    for a in range(0, len(low), BLOCK):
        for b in range(a if same else 0, len(high), BLOCK):
            i, j = low[a : a + BLOCK], high[b : b + BLOCK]
            hit = x[i] @ x[j].T >= limit
            if same and a == b:
                hit = np.triu(hit, 1)
            if not hit.any():
                continue
            rows, columns = np.flatnonzero(hit.any(1) & has[i]), np.flatnonzero(hit.any(0) & has[j])
            if len(rows) and len(columns):
                met = np.unique(np.concatenate([earlier[i[r]] for r in rows]))
                marks = [np.zeros((len(group), len(met)), np.float32) for group in (rows, columns)]
                for mark, group, side in zip(marks, (rows, columns), (i, j), strict=True):
                    for k, r in enumerate(group):
                        mark[k, np.searchsorted(met, np.intersect1d(earlier[side[r]], met))] = 1
                shared = marks[0] @ marks[1].T  # how many earlier lists the pair shares
                hit[np.ix_(rows, columns)] &= shared == 0
            count[i] += hit @ many[j]
            count[j] += many[i] @ hit
            p, q = np.nonzero(hit & (label[i][:, None] != label[j][None, :]))
            if len(p):
                from_, to = spanning(label[i[p]], label[j[q]])
                moved = np.arange(len(label))
                moved[from_] = to
                label = moved[label]
    return count, label


_LINKS = "k1 long, k2 long, links long, h1 long, h2 long"


def _verifying(limit: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (unit, list, side, k1, k2, many, lists, v), sorted by unit -> the links of each class in each unit, and a class of its group."""

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, side, own, many = (table.column(c).to_numpy() for c in ("unit", "side", "list", "many"))
        k1, k2 = (table.column(c).to_numpy() for c in ("k1", "k2"))
        cuts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
        vectors, lists = table.column("v").chunk(0), table.column("lists").chunk(0)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            low, high = np.flatnonzero(side[a:b] != 2), np.flatnonzero(side[a:b] != 1)
            if not len(low) or not len(high):
                continue
            held = lists.slice(a, b - a)
            at = held.offsets.to_numpy() - held.offsets[0].as_py()
            each = np.split(held.flatten().to_numpy(), at[1:-1])
            count, label = unit_links(units(vectors.slice(a, b - a)), many[a:b], each, int(own[a]), low, high, limit)
            used = a + np.flatnonzero(count)
            head = a + label[used - a]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (k1[used], k2[used], count[used - a], k1[head], k2[head])], ["k1", "k2", "links", "h1", "h2"])

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            seen += batch.num_rows
            if seen < HELD:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            unit = table.column("unit").to_numpy()
            cut = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on
            if cut:
                yield from solve(table.slice(0, cut).combine_chunks())
                held, seen = table.slice(cut).to_batches(), len(unit) - cut
        if held:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    return solved


def _links(described: DataFrame, limit: float) -> DataFrame:
    """k1, k2, links, h1, h2 of the units of all lists. described: label, k1, k2, many, v, lists."""
    listed = described.withColumn("list", F.explode("lists")).withColumn("whole", F.xxhash64("label", F.size("v"), "list"))
    large = listed.groupBy("whole").agg(F.count("*").alias("n")).where(F.col("n") > PART_ROWS)
    large = cut_lineage(large.withColumn("parts", F.ceil(F.col("n") / PART_ROWS)))
    if large.isEmpty():
        rows = listed.withColumn("parts", F.lit(1).cast("long"))
    else:
        rows = listed.join(large.select("whole"), "whole", "left_anti").withColumn("parts", F.lit(1).cast("long"))
        rows = rows.unionByName(with_facts(listed, large, "whole", "n").drop("n").select(*rows.columns))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("k1", "k2"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
    rows = rows.select(F.xxhash64("whole", F.least("part", "other"), F.greatest("part", "other")).alias("unit"), side.alias("side"), "list", "k1", "k2", "many", "lists", "v")
    dealt = rows.repartition(shuffle_partitions(rows), "unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(_verifying(limit), _LINKS)


def near_vectors(table: DataFrame, limit: float = LIMIT, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept: vectors of equal labels are linked if their cosine is at least `limit`.

    Rows with a null label, and vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing, as do vectors of different lengths. Links are verified in double precision; a few pairs near the limit may
    not be found (the share depends on FOUND). Repeated rows are vectors of their own. component_id is the smallest vec_id that is not null; kept says
    whether it is the row's own (null equals null). An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    vector = quoted(vector_column)
    plain = table.select(quoted(id_column).cast("long").alias("vec_id"), quoted(label_column).alias("label"), vector.alias("v"))
    meets = comparable(F.col("v")) & F.col("label").isNotNull()
    whole = plain.select("vec_id", "label", "v", meets.alias("meets"), F.xxhash64("label", "v").alias("k1"), F.xxhash64(F.lit("second"), "v", "label").alias("k2"))
    rows = cut_lineage(whole.select("vec_id", "meets", "k1", "k2"))
    apart = rows.where("not meets").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    met = rows.where("meets").select("vec_id", F.struct("k1", "k2").alias("k"))
    classes = cut_lineage(met.groupBy("k").agg(F.min("vec_id").alias("least"), F.count("*").alias("many")))
    n_classes = classes.count()
    if n_classes:
        vectors = whole.where("meets").groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("many"))
        fitted = _fitted(whole.where("meets"), n_classes, limit)
        kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
        described = cut_lineage(vectors.mapInArrow(_describing(fitted), ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", lists array<long>"))
        links = cut_lineage(_links(described, limit))
        node = lambda a, b: F.struct(F.col(a).alias("k1"), F.col(b).alias("k2"))
        found = components(links.select(node("k1", "k2").alias("a"), node("h1", "h2").alias("b")))
        counts = links.groupBy(node("k1", "k2").alias("k")).agg(F.sum("links").alias("links"))
        named = classes.join(counts, "k", "left").join(found.select(F.col("node").alias("k"), "component"), "k", "left")
        named = cut_lineage(named.select("k", "least", "many", (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "k").alias("component")))
        groups = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
        facts = with_facts(named, cut_lineage(groups), "component", "size").select("k", "many", "n_links", "component_id")
        apart = apart.unionByName(with_facts(met, cut_lineage(facts), "k", "many").select("vec_id", "n_links", "component_id"))
    return apart.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
