"""Repost pairs and links: multisets as sets of items, long sources, blocks of wide lines."""

import random
from collections import Counter
from itertools import combinations

import pytest

from tallyweave.operators import reposts


def carried(seed, sources=60):
    rng = random.Random(seed)
    bases = [[f"e{rng.randrange(40)}" for _ in range(rng.randint(1, 9))] for _ in range(10)]
    out = {}
    for k in range(sources):
        own = list(rng.choice(bases)) + [f"e{rng.randrange(40)}" for _ in range(rng.randint(0, 3))] + [f"own {k}"]
        out[k] = Counter(own + ["hot"] * rng.choice([0, 1, 1, 3]) + ["warm"] * rng.choice([0, 0, 1]))
    return out


def table(spark, held):
    return spark.createDataFrame([(s, e, n) for s, c in held.items() for e, n in c.items()], "source long, expense string, n long")


def by_hand(held, apart=()):
    gone = {(a, b): {e for e, x, y in apart if (x, y) == (a, b)} for _, a, b in apart}
    found = {}
    for a, b in combinations(sorted(held), 2):
        shared = sum(n for e, n in (held[a] & held[b]).items() if e not in gone.get((a, b), ()))
        if shared >= 2:
            found[a, b] = shared
    return found


@pytest.mark.parametrize(("block", "long"), [(1024, 128), (7, 128), (7, 4), (1024, 0)])
def test_pairs_as_by_hand(spark, monkeypatch, block, long):
    monkeypatch.setattr(reposts, "BLOCK", block)
    monkeypatch.setattr(reposts, "LONG_SOURCE", long)
    held = carried(block + long)
    rows = reposts.repost_pairs(table(spark, held)).collect()
    assert {(r["a"], r["b"]): r["shared"] for r in rows} == by_hand(held) and len(rows) == len(by_hand(held))
    apart = [(next(iter(held[a] & held[b])), a, b) for a, b in list(by_hand(held))[::3]]
    rows = reposts.repost_pairs(table(spark, held), spark.createDataFrame(apart, "expense string, a long, b long")).collect()
    assert {(r["a"], r["b"]): r["shared"] for r in rows} == by_hand(held, apart) and len(rows) == len(by_hand(held, apart))


def test_pairs_are_not_shuffled(spark, monkeypatch):
    """Pairs of short sources, of which there may be very many, are made by the last join and never dealt again."""
    monkeypatch.setattr(reposts, "LONG_SOURCE", 10**6)
    plan = reposts.repost_pairs(table(spark, carried(1)))._jdf.queryExecution().optimizedPlan().toString()
    short = plan[: plan.index("Aggregate")] if "Aggregate" in plan else plan
    assert "array_intersect" in short and "Distinct" not in short


@pytest.mark.parametrize(("narrow", "seed"), [(8, 1), (1, 2), (3, 3)])
def test_components_without_pairs(spark, monkeypatch, narrow, seed):
    """Narrow lines by pairs, wide ones by stars."""
    monkeypatch.setattr(reposts, "NARROW", narrow)
    monkeypatch.setattr(reposts, "BLOCK", 5)
    held = carried(seed)
    pairs = by_hand(held)
    want = {}
    for e in {e for c in held.values() for e in c}:
        of = {s: s for s in held if e in held[s]}
        for _ in of:
            for a, b in pairs:
                if a in of and b in of:
                    of[a] = of[b] = min(of[a], of[b])
        want |= {(e, s): c for s, c in of.items()}
    found = reposts.repost_components(table(spark, held)).collect()
    assert {(r["expense"], r["source"]): r["component"] for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize(("narrow", "seed"), [(8, 5), (1, 6), (1, 7)])
def test_confirmations_of_many_pairs(spark, monkeypatch, narrow, seed):
    """Many separated pairs, also of the sources that stars would hang on; no pairs are made of all sources of a line."""
    from tests.test_operators import merged, plain_merge

    monkeypatch.setattr(reposts, "NARROW", narrow)
    monkeypatch.setattr(reposts, "repost_pairs", None)
    held = {f"s{k:02d}": c for k, c in carried(seed, 30).items()}
    records = [(f"{s}-{e}-{i}", s, e, f"{e}-{i}") for s, c in held.items() for e, n in c.items() for i in range(n)]
    rng, said = random.Random(seed), []
    for e in sorted({e for c in held.values() for e in c}):
        of = sorted(s for s in held if e in held[s])
        if len(of) > 2 and rng.random() < 0.7:
            said.append((e, rng.choice(["same_expense", "separate_expenses", "separate_expenses"]), of[: rng.randint(2, len(of))]))
    kept, tally = merged(spark, records, {s: None for s in held}, said)
    want, counts = plain_merge(records, {s: None for s in held}, said)
    assert kept == want and tally == counts and len(said) > 7
