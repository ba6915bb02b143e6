"""The divergence audit against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyweave.llm import divergence


def plain(rows, least=10):
    """lang, source, part, item, value, rank, by Python integers."""
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (k, s), c in counts.items() if k == lang}
        whole = sum(groups.values(), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q, ps = shares(whole), {s: shares(c) for s, c in groups.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, p in ps.items():
            parts = {"pair": [(sum(f(p[t], o[t]) for t in kept), other) for other, o in ps.items() if other != s], "term": [(f(p[t], q[t]), t) for t in kept if groups[s][t] and p[t] > q[t]]}
            for part, items in parts.items():
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[: 10 if part == "term" else None], 1)]
    return sorted(out)


def ran(spark, rows, least=10):
    table = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 as n", "'x' as term", "2 as chunk", "3 as `a.b`", "4 as block")
    return sorted(tuple(r) for r in divergence.source_divergence(table, least).collect())


def made(seed, n, sources=6):
    rng = np.random.default_rng(seed)
    words = ["Alpha", "beta", "été", "Été", "naïve", "日本", "x1y", "don't", "z", "Z", "ß", "ȷ", " ", "gamma-ray"]
    rows = [(str(rng.choice(["en", "fr"])), f"s{rng.integers(sources)}", " ".join(rng.choice(words, rng.integers(0, 9)))) for _ in range(n)]
    return [*rows, (None, None, None), ("", "s", ""), ("en", None, "Alpha 12 ..."), ("bare", "a", "once"), ("bare", "b", None), ("fr", "s9", ""), ("alone", "a", "x"), rows[0], rows[0]]


@pytest.mark.parametrize("chunk_rows", [3, 65_536])
@pytest.mark.parametrize("block", [2, 64])
def test_audit(spark, monkeypatch, chunk_rows, block):
    """Small chunks and blocks of sources give the same rows. Nulls, empty texts, ties, repeated rows, clashing columns."""
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", block)
    encoding, compared = divergence._encoding, divergence._compared

    def small(least):
        def run(batches):
            divergence.CHUNK_ROWS = chunk_rows
            yield from encoding(least)(b.slice(k, 2) for b in batches for k in range(0, b.num_rows, 2))

        return run

    def few(table):
        divergence.TERMS_HELD = 3
        return compared(table)

    monkeypatch.setattr(divergence, "_encoding", small)
    monkeypatch.setattr(divergence, "_compared", few)
    rows = made(chunk_rows, 300)
    assert ran(spark, rows) == plain(rows)


def test_empty_and_long(spark):
    assert ran(spark, []) == []
    rows = [("en", "a", "word " * 700_000 + "y" * 3_000_000), ("en", "b", "word Other"), ("en", "a", "other")] * 5
    assert ran(spark, rows, 5) == plain(rows, 5)


def test_terms_and_shares():
    text = ("Ab9c été_Ünï\x00x " * 9).encode()
    assert [t for s in divergence.stretches(text) for t in s] == [t.encode() for t in ["ab", "c", "été", "Ünï", "x"]] * 9
    for total, terms in ((0, 1), (7, 3), (4 * 10**15, 10**9)):
        for count in (0, 1, total):
            assert divergence.share(np.array([count]), total, terms)[0] == 1 + 10**9 * (count + 2) // (total + 2 * terms)
    big = np.array([2**40 + 1, 5, 2**52 + 3])
    assert divergence._summed(np.array([0, 1, 0]), big, 2).tolist() == [2**40 + 1 + 2**52 + 3, 5]
