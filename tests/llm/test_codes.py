"""Vector codes against plain Python."""

import hashlib
import math

import pytest

from tallyweave import tables
from tallyweave.llm import codes, queries
from tests.conftest import DATA


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, digest) by loops over Python integers."""
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, _, v in kept) // parts) * parts
    kept = [(i, lab, v + [0] * (width - len(v))) for i, lab, v in kept]
    step = width // parts
    cut = lambda v, p: v[p * step : (p + 1) * step]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]

    def assign(v, p):
        gaps = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)) for e in books[p]]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            met = {}
            for _, _, v in kept:
                met.setdefault(assign(v, p)[0], []).append(cut(v, p))
            for k, vs in met.items():
                new[p][k] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[assign(v, p) for p in range(parts)] for _, _, v in kept]
    errors = [sum(e for _, e in f) for f in found]
    by_label = {}
    for (_, lab, _), e in zip(kept, errors, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    return [(i, "".join(f"{c:02x}" for c, _ in f), e, by_label[lab], digest) for (i, lab, _), f, e in zip(kept, found, errors, strict=True)]


def ran(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    found = queries.op13_vector_codes(spark, DATA)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert ran(found) == sorted(plain([(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]), key=str)


@pytest.mark.parametrize("labels", [[None], [None, 1, 2], [7]])
def test_edges(spark, labels):
    """Unusable vectors, ties, repeated rows and ids, ragged and negative vectors, null ids and labels, clashing columns."""
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [nan] * 16, [inf] + [0.0] * 15, [None] + [0.0] * 15, [0.5] * 16, [0.5] * 16, [-0.001] * 16, [0.0] * 16, [1.0, -2.0], [0.25] * 20]
    rows = [(k % 9 if k % 10 else None, v, labels[k % len(labels)]) for k, v in enumerate(vectors * 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as v", "'x' as code", "2 as error", "3 as n", "4 as `a.b`")
    assert ran(codes.compress_vectors(table, entries=4)) == sorted(plain(rows, entries=4), key=str)


def test_empty(spark):
    for rows in ([], [(1, None, 2), (2, [None], 2)]):
        assert codes.compress_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")).collect() == []
    only = codes.compress_vectors(spark.createDataFrame([(1, [], "a")], "vec_id long, embedding array<float>, label string")).collect()
    assert [(r["code"], r["error"]) for r in only] == [("00" * 16, 0)]


def test_large_components_saturate(spark):
    rows = [(k, [1e300 * (-1) ** k] * 16, 0) for k in range(3)]
    found = codes.compress_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert all(r["error"] == 0 for r in found)


def test_hot_label(spark, monkeypatch):
    """A label with nearly all rows is looked up through a broadcast; rare ones by a shuffle."""
    monkeypatch.setattr(tables, "HOT_ROWS", 50)
    rows = [(k, [k % 7 / 8.0] * 16, "hot" if k % 50 else f"rare{k}") for k in range(5000)]
    found = codes.compress_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string"), entries=3)
    assert ran(found) == sorted(plain(rows, entries=3), key=str)
