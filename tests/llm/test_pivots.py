"""Near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest

from tallyweave.llm import pivots, queries
from tests.conftest import DATA


def plain(rows, limit=0.98):
    """Links by comparing all pairs, in doubles: sets of row numbers for each row."""
    links = [set() for _ in rows]
    kept = [k for k, (_, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for place, a in enumerate(kept):
        for b in kept[:place]:
            x, y = (np.array(rows[k][1], float) for k in (a, b))
            if rows[a][2] == rows[b][2] and len(x) == len(y):
                x, y = x / abs(x).max(), y / abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= limit:
                    links[a].add(b)
                    links[b].add(a)
    return links


def closed(rows, links):
    """(vec_id, n_links, component_id, kept) of each row."""
    out, seen = [None] * len(rows), set()
    for start in range(len(rows)):
        if start in seen:
            continue
        group, todo = {start}, [start]
        while todo:
            for other in links[todo.pop()] - group:
                group.add(other)
                todo.append(other)
        seen |= group
        least = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        for k in group:
            out[k] = (rows[k][0], len(links[k]), least, rows[k][0] == least)
    return sorted(out, key=str)


def ran(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_groups(seed, n, d=32, labels=3, spread=0.1):
    """Vectors alone, copies, scaled copies, and groups whose cosines lie around the limit."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        centre = rng.normal(size=d)
        centre /= np.linalg.norm(centre)
        label = int(rng.integers(labels))
        for _ in range(int(rng.choice([1, 1, 1, 2, 3, 40]))):
            v = centre + rng.normal(size=d) * spread * rng.random() / math.sqrt(d) * 2
            out.append((len(out), [float(x) for x in v], label))
            if rng.random() < 0.1:
                out.append((len(out), [2.0 * float(x) for x in v], label))
                out.append((len(out), [float(x) for x in v], label))
    return out


def recall(found, want):
    """Share of the links of the brute force that the counts hold; none may be too many."""
    have, all_of = {r[0]: r[1] for r in found}, {r[0]: r[1] for r in want}
    assert all(have[k] <= all_of[k] for k in all_of)
    return sum(have.values()) / sum(all_of.values()) if any(all_of.values()) else 1.0


def table(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").selectExpr("*", "1 as v", "2 as k1", "'x' as kept", "3 as lists", "4 as `a.b`")


@pytest.mark.parametrize("part", [4096, 16])
def test_groups(spark, monkeypatch, part):
    """Whole lists and lists cut into parts find the same links, nearly all there are."""
    monkeypatch.setattr(pivots, "PART_ROWS", part)
    rows = near_groups(part, 1500)
    want = closed(rows, plain(rows))
    assert sum(r[1] for r in want) > 2000
    assert recall(ran(pivots.near_vectors(table(spark, rows))), want) >= 0.97


def test_sets_of_pivots(spark, monkeypatch):
    """Lists of two pivots each, as for very many vectors."""
    monkeypatch.setattr(pivots, "set_size", lambda classes: 2)
    monkeypatch.setattr(pivots, "PIVOT_ROWS", 20)
    rows = near_groups(5, 1200)
    assert recall(ran(pivots.near_vectors(table(spark, rows))), closed(rows, plain(rows))) >= 0.95


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    found = queries.op11_pivot_near_dedup(spark, DATA)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert recall(ran(found), closed(rows, plain(rows))) >= 0.97


def test_edges(spark):
    """Vectors without direction, null labels and ids, repeated rows and ids, lengths that differ, extreme sizes."""
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [1.0, 0.0], [3.0, 0.01], [1e300, 1e298], [1e-310, 1e-312], [0.0, 1.0], [0.0, 1.0, 0.0], [-1.0, 0.0], [5.0]]
    rows = [(k % 20 if k % 7 else None, v, (None, 1, 2)[k % 3]) for k, v in enumerate(vectors * 3)]
    assert ran(pivots.near_vectors(table(spark, rows))) == closed(rows, plain(rows))
    for few in ([], rows[:3], [(1, [1.0], 1)], [(1, None, 1)]):
        assert ran(pivots.near_vectors(table(spark, few, "float"))) == closed(few, plain(few))


def test_hot_copies(spark, monkeypatch):
    """A vector with most rows, and a hub: both are looked up through broadcasts."""
    from tallyweave import tables

    monkeypatch.setattr(tables, "HOT_ROWS", 20)
    rng = np.random.default_rng(3)
    rest = [0.0] * 21
    rows = [(k, [1.0, 2.0, 3.0, *rest] if k % 3 else [float(x) for x in rng.normal(size=24)], 0) for k in range(600)]
    rows += [(600 + k, [1.0, 2.0, 3.0 + k / 1000, *rest], 0) for k in range(40)]
    assert ran(pivots.near_vectors(table(spark, rows))) == closed(rows, plain(rows))


def test_key_size_grows():
    assert [pivots.set_size(n) for n in (10, 10**7, 10**9, 10**12)] == [1, 1, 2, 3]
