"""Interval containment over a dyadic tree against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import traces


def plain(children, parents):
    return sorted((c[1], p[1]) for c in children for p in parents if c[0] is not None and c[0] == p[0] and None not in (*c[2:], *p[2:]) and c[2] >= p[2] and c[3] <= p[3])


def made(rng, n, number):
    rows = []
    for k in range(n):
        low = number(rng)
        length = abs(number(rng)) * rng.choice([0, 1e-3, 1])
        rows.append((rng.choice(["a", "b", None]), k, low, low if length != length else max(low, low + length)))
    return [*rows, ("a", n, None, rows[0][3]), ("a", n + 1, rows[0][2], None), rows[0], rows[1]]


@pytest.mark.parametrize(
    ("kind", "number"),
    [
        ("long", lambda r: r.randrange(-40, 40)),
        ("long", lambda r: r.choice([-1, 1]) * int(10 ** (r.random() * 15))),
        ("double", lambda r: r.uniform(-1, 1)),
        ("double", lambda r: r.choice([-1, 1]) * 10 ** (r.random() * 30 - 15)),
        ("double", lambda r: float(r.randrange(3))),
        ("double", lambda r: r.choice([0.5, -3.0, 1e300, float("inf"), float("-inf")])),
    ],
)
def test_pairs(spark, kind, number):
    """Whole and broken bounds, negative ones, far ranges, points, equal intervals, repeated rows, nulls, clashing columns."""
    rng = random.Random(4)
    of = int if kind == "long" else float
    tables = [[(k, i, *(x if x is None else of(x) for x in (a, b))) for k, i, a, b in made(rng, n, number)] for n in (120, 90)]
    schema = f"k string, id long, start {kind}, stop {kind}"
    children, parents = (spark.createDataFrame(t, schema) for t in tables)
    found = traces.contained(children.selectExpr("*", "1 as _low", "2 as _node", "'x' as _at"), parents.selectExpr("*", "3 as _level"), ["k"])
    assert found.columns == ["k", "id", "start", "stop", "_low", "_node", "_at", "parent", "parent_start", "parent_stop"]
    assert sorted((r["id"], r["parent"]) for r in found.collect()) == plain(*tables)
    alone = sorted(r["id"] for r in traces.not_contained(children, parents, ["k"]).collect())
    met = {c for c, _ in plain(*tables)}
    assert alone == sorted(c[1] for c in tables[0] if c[1] not in met)
    assert traces.contained(children.limit(0), parents, ["k"]).count() == traces.contained(children, parents.limit(0), ["k"]).count() == 0


def test_nodes_cover_once(spark):
    """Each number of an interval lies in one node; an interval makes at most two rows a level."""
    rng = random.Random(2)
    spans = [(0, 0), (-1, 0), (-8, 7), (5, 4), (1, 10_000_000), (-(2**40), 2**50)] + [(a := rng.randrange(-70, 70), a + rng.randrange(60)) for _ in range(60)]
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(spans)], "k int, a long, b long").select("k", traces.dyadic_nodes(F.col("a"), F.col("b")).alias("n"))
    for r in rows.collect():
        a, b = spans[r["k"]]
        nodes = [(x["level"], x["node"]) for x in r["n"] or []]
        assert sum(1 << k for k, _ in nodes) == b - a + 1 and len(nodes) <= max(1, 2 * (b - a + 1).bit_length())
        if b - a < 1000:
            assert sorted(x for k, n in nodes for x in range(n << k, (n + 1) << k)) == list(range(a, b + 1))
        else:
            assert all(a <= n << k and ((n + 1) << k) - 1 <= b for k, n in nodes)
