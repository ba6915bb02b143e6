"""Order statistics, neighbours and pairs of large keys against plain Python, with and without the parallel ways."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import scans, traces


@pytest.fixture(params=[5, 1_000_000])
def small(request, monkeypatch):
    monkeypatch.setattr(scans, "KEY_ROWS", request.param)
    return request.param


def keyed(rows):
    out = {}
    for k, *rest in rows:
        out.setdefault(k, []).append(rest if len(rest) > 1 else rest[0])
    return out


VALUES = {
    "even": lambda r: r.random(),
    "ratios": lambda r: r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300),
    "ties": lambda r: float(r.randrange(3)),
    "clusters": lambda r: r.choice([0.0, 1e9, -1e9]) + r.randrange(50) * 1e-3,
    "ends": lambda r: r.choice([math.inf, -math.inf, 0.0, 1.0, 2.0]),
}


@pytest.mark.parametrize("kind", sorted(VALUES))
def test_upper_medians(spark, small, kind):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), VALUES[kind](rng)) for _ in range(201)] + [("one", 3.0), ("none", None), ("a", None)]
    found = scans.upper_medians(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()
    want = {k: sorted(x for x in v if x is not None) for k, v in keyed(rows).items()}
    assert sorted((str(r["k"]), r["median"]) for r in found) == sorted((str(k), v[len(v) // 2]) for k, v in want.items() if v)


def test_places_of_one_key_take_few_rounds(spark):
    from tallyweave.tables import cut_lineage

    n = 200_000
    values = cut_lineage(spark.range(n).select(F.lit(1).alias("k"), F.pow(F.lit(10.0), F.pmod(F.xxhash64("id"), F.lit(600)) - 300).alias("v")))
    want = sorted(r[0] for r in values.select("v").collect())
    for place in (0, n // 2, n - 1):
        found = scans.at_places(values, ["k"], "v", spark.createDataFrame([(1, place)], "k int, place long")).collect()
        assert [tuple(r) for r in found] == [(1, want[place])]


def test_rows_before(spark, small):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), k, rng.randrange(9) if k % 7 else None) for k in range(300)]
    found = scans.rows_before(spark.createDataFrame(rows, "k string, at long, v long").repartition(5), ["k"], ["at"], "v", "last").collect()
    want, held = {}, {}
    for k, at, v in rows:
        want[at] = held.get(k)
        held[k] = v
    assert {r["at"]: r["last"] for r in found} == want


def plain_pairs(events):
    out, open_ = [], {}
    for k, phase, ts, _ in sorted(events, key=lambda e: (str(e[0]), e[2], e[3])):
        mine = open_.setdefault(k, [])
        if phase == "b":
            mine.append(ts)
        elif mine:
            out.append((k, mine.pop(), ts))
    return sorted(out, key=str)


@pytest.mark.parametrize("lean", [0.3, 0.5, 0.7])
def test_pairs(spark, small, lean):
    """Traces with too many ends, too many begins and both, over many ranges."""
    rng = random.Random(int(lean * 10))
    events = [(rng.choice(["a", "b", None]), "b" if rng.random() < lean else "e", rng.randrange(200), k) for k in range(600)]
    table = spark.createDataFrame(events, "k string, phase string, ts long, seq long").repartition(7)
    found = traces.pair_events(table, ["k"])
    assert sorted((tuple(r) for r in found.select("k", "began", "ended").collect()), key=str) == plain_pairs(events)


def test_one_trace_spreads_over_tasks(spark, monkeypatch):
    """A trace of 300,000 events, nested and in a row, in ranges of which none is the whole."""
    monkeypatch.setattr(scans, "KEY_ROWS", 1000)
    n = 300_000
    phase = F.when(F.pmod(F.floor(F.col("id") / 3), F.lit(2)) == 0, "b").otherwise("e")
    events = spark.range(n).select(F.lit("t").alias("k"), phase.alias("phase"), F.col("id").alias("ts"), F.col("id").alias("seq"))
    parts = []
    ranged = scans.in_ranges
    monkeypatch.setattr(scans, "in_ranges", lambda *a: parts.append(ranged(*a)) or parts[-1])
    found = traces.pair_events(events, ["k"])
    assert found.agg(F.count("*"), F.min(F.col("ended") - F.col("began")), F.max(F.col("ended") - F.col("began"))).first() == (n // 2, 1, 5)
    sizes = [r["count"] for r in parts[0].groupBy(parts[0].columns[-1]).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.5 * n
