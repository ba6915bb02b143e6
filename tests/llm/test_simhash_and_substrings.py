import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyweave.llm import queries, simhash, substring
from tests.conftest import DATA


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", "One", "one TWO", "a b c", "É b\tc\x0bd e f f f " * 9, "x" * 5000):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def plain_components(rows):
    """rows: (id, fingerprint) -> component of each."""
    out = {}
    for k, f in rows:
        near = {c for j, g in rows if bin(f ^ g).count("1") <= 3 and j in out for c in [out[j]]}
        head = min([k, *near])
        out = {j: head if c in near else c for j, c in out.items()}
        out[k] = head
    return out


def test_forest_finds_what_a_scan_finds():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    value = np.array([b ^ np.uint64((1 << int(rng.integers(64))) | (1 << int(rng.integers(64))) if rng.random() < 0.8 else 0) for b in rng.choice(base, 500)], np.uint64)
    value = np.unique(value)
    unit = np.arange(len(value)) % 3
    forest = simhash.Forest(unit, value)
    found = {(int(q), int(r)) for qs, rs in forest.near(unit, value, 3) for q, r in zip(qs, rs, strict=True)}
    assert found == {(i, j) for i in range(len(value)) for j in range(len(value)) if unit[i] == unit[j] and int(value[i] ^ value[j]).bit_count() <= 3}


def test_spanning_keeps_components():
    a, b = np.array([5, 9, 2, 7]), np.array([9, 2, 30, 8])
    x, y = simhash.spanning(a, b)
    assert sorted(zip(x.tolist(), y.tolist(), strict=True)) == [(5, 2), (8, 7), (9, 2), (30, 2)]


def test_similar_links_with_split_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART_ROWS", 8)
    rng = random.Random(4)
    prints = set()
    for _ in range(12):
        f = rng.getrandbits(63)
        for _ in range(25):  # chains of near copies
            prints.add(f)
            for _ in range(rng.choice([1, 2, 3, 5])):
                f ^= 1 << rng.randrange(63)
    rows = list(enumerate(sorted(prints, key=lambda x: x * 7919 % 1009)))
    classes = spark.createDataFrame([(f, k) for k, f in rows], "fp long, rep long")
    found = {r["node"]: r["component"] for r in simhash.components(simhash.similar_links(classes)).collect()}
    assert {k: found.get(k, k) for k, _ in rows} == plain_components(rows)


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_more_blocks_give_the_same_links(spark, blocks):
    rng = random.Random(blocks)
    prints = set()
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(6):
            prints.add(f)
            for _ in range(rng.choice([1, 3, 4])):
                f ^= 1 << rng.randrange(64)
    rows = list(enumerate(sorted(prints)))
    classes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, k) for k, f in rows], "fp long, rep long")
    found = {r["node"]: r["component"] for r in simhash.components(simhash.similar_links(classes, blocks)).collect()}
    assert {k: found.get(k, k) for k, _ in rows} == plain_components(rows)


def test_blocks_grow_with_the_classes():
    sizes = [simhash.block_count(n) for n in (0, 10**6, 10**8, 10**10, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == 4 and sizes[-1] > 4


def test_tight_groups_are_searched_once():
    """Labels equal the components of all links, and a tight group costs about one step for each member."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    value = np.unique(np.array([b ^ np.uint64(1 << int(rng.integers(60))) ^ np.uint64(1 << int(rng.integers(60))) for b in rng.choice(base, 3000)], np.uint64))
    unit, every = np.zeros(len(value), np.int64), np.arange(len(value))
    seen = []
    label = simhash.linked(unit, value, every, every, 4, lambda a, b: seen.append(len(a)) or np.ones(len(a), bool))
    for b in base:
        near = np.flatnonzero(np.bitwise_count(value ^ b) <= 2)
        assert len(set(label[near].tolist())) == 1
    assert len(set(label.tolist())) == 3 and sum(seen) < 6 * len(value)
    half = every[::2]
    split = simhash.linked(unit, value, half, every, 4)
    assert len(set(split.tolist())) == 3
    assert (simhash.linked(unit, value, every, every, 4, lambda a, b: np.zeros(len(a), bool)) == every).all()


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar_pairs(texts, least):
    """Pairs of different texts with so similar sets of five-word shingles, by an index of shingles."""
    sets, index = [shingle_set(t) for t in texts], {}
    for k, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(k)
    shared = Counter((a, b) for own in index.values() if len(own) < 400 for i, a in enumerate(own) for b in own[i + 1 :])
    return {p for p, n in shared.items() if n >= least * (len(sets[p[0]]) + len(sets[p[1]]) - n)}


def test_near_copies_of_made_texts(spark):
    """Texts with words changed: all pairs far above 0.8 meet, no pair below 0.7 does."""
    rng = random.Random(12)
    texts = []
    for k in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts.append(" ".join(words))
        for changes in (1, 2, 5, 30):
            new = list(words)
            for at in rng.sample(range(300), changes):
                new[at] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(new))
    texts += [texts[0].upper(), texts[0], None, "", "one two", "ONE two", "x " * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string").repartition(4)
    group = {r["row"]: r["component"] for r in simhash.near_copies(docs, "k").collect()}
    assert len(group) == len(texts)
    strong = similar_pairs(texts, 0.8)
    assert np.mean([group[a] == group[b] for a, b in strong]) > 0.95
    own = lambda k: k // 5 if k < 300 else 0 if k < 302 else {302: -1, 303: -1, 304: -2, 305: -2, 306: -3}[k]
    for k, c in group.items():
        assert own(k) == own(c) and (k >= 300 or k % 5 < 4 or c == k)
    assert simhash.near_copies(docs.limit(0), "k").count() == 0


def test_near_copies_of_the_documents(spark):
    """Recall of pairs of different texts with a similarity of 0.8 or more, by brute force, on 10,000 documents."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    texts = [t for _, t in rows]
    pairs = similar_pairs(texts, 0.8)
    different = {p for p in pairs if texts[p[0]].lower().split() != texts[p[1]].lower().split()}
    group = {r["row"]: r["component"] for r in simhash.near_copies(docs, "doc_id").collect()}
    met = [group[rows[a][0]] == group[rows[b][0]] for a, b in different]
    print(len(pairs), len(different), np.mean(met))
    assert len(different) > 20 and np.mean(met) >= 0.9
    # nothing is joined that links of 0.7 would not join
    loose = {k: k for k in range(len(rows))}

    def find(x):
        while loose[x] != x:
            x = loose[x]
        return x

    for a, b in similar_pairs(texts, 0.7):
        x, y = find(a), find(b)
        loose[max(x, y)] = min(x, y)
    place = {k: i for i, (k, _) in enumerate(rows)}
    wrong = [k for k, c in group.items() if texts[place[k]].split() and find(place[k]) != find(place[c])]
    assert len(wrong) <= 0.001 * len(rows)


def test_components_of_long_paths(spark):
    n = 300
    links = spark.createDataFrame([(k, k + 1) for k in range(0, n)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    found = {r["node"]: r["component"] for r in simhash.components(links).collect()}
    assert found == {k: 0 for k in range(1, n + 1)} | {1001: 1000}
    assert simhash.components(links.limit(0)).count() == 0


EDGE = [(50, None), (51, ""), (52, "  \n"), (60, "one"), (61, "ONE"), (60, "one"), (None, "one"), (None, "alone here"), (70, "word " * 40_000)]


def test_duplicates_with_edge_rows(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in EDGE], "doc_id long, text string, fp string").repartition(3)
    found = simhash.simhash_duplicates(docs).collect()
    assert len(found) == len(EDGE)
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"]) for r in found), key=str)
    want = [(50, 50), (51, 50), (52, 50), (60, 60), (60, 60), (61, 60), (-1, 60), (-1, None), (70, 70)]
    assert got == sorted(want, key=str)
    assert simhash.simhash_duplicates(docs.limit(0)).count() == 0


def test_representatives(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, t in EDGE] + [(62, "ONE", 2)], "doc_id long, text string, n_chars long")
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(50, None), (60, "one"), (70, "word " * 40_000), (None, "alone here")], key=str)
    clash = docs.selectExpr("*", "1 as _row", "2 as `a.b`", "3 as _turn", "4 as _text_hash", "5 as component", "6 as `row`", "7 as key", "8 as _kept")
    out = simhash.keep_representatives(clash)
    assert out.columns == clash.columns and out.count() == 4 and tuple(out.first()[3:]) == tuple(range(1, 9))
    assert simhash.keep_representatives(clash.limit(0)).count() == 0


def test_simhash_query_against_a_scan(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    prints = [(k, plain_fingerprint(t)) for k, t in docs]
    want = plain_components(prints)
    found = queries.op4_simhash_bktree(spark, DATA).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {k: (format(f, "016x"), want[k]) for k, f in prints}


def plain_removal(rows):
    """rows: (id, text) -> sorted (id, words, removed, kept text); rows with one id count as one document."""
    first = {}
    split = [(k, (t or "").encode().split()) for k, t in rows]
    for k, w in sorted(split, key=lambda x: x[0]):
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            first[key] = min(first.get(key, (k, s)), (k, s))
    out = []
    for k, w in split:
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] != (k, s):
                gone |= set(range(s, s + 20))
        out.append((k, len(w), len(gone), " ".join(x.decode() for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def test_cover_brings_all_pairs_together():
    d, p = substring.COVER, substring.PERIOD
    for i in range(p):
        for j in range(p):
            assert any((i + s) % p in d and (j + s) % p in d for s in range(p))


def test_routes_follow_the_bytes():
    assert substring.deal(0, 8) == (24, 8) and substring.deal(10**9, 8)[0] >= 60
    for size in (10**6, 10**9, 10**14):
        routes, parts = substring.deal(size, 200)
        assert size / routes <= substring.ROUTE_BYTES and routes <= 3 * parts


def test_removal_equals_a_plain_scan(spark, monkeypatch):
    monkeypatch.setattr(substring, "FLUSH_WORDS", 300)
    rng = random.Random(7)
    passages = [[f"p{k}w{i}" for i in range(rng.randint(15, 60))] for k in range(6)]
    rows = []
    for k in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"r{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30))]
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 2)
            words += p[a : rng.randint(a, len(p))]
        if k % 10 == 0:
            words = ["same"] * rng.randint(0, 90)
        rows.append((rng.randrange(10**6), " ".join(words)))
    rows += [rows[3], rows[4], (rows[5][0], rows[6][1] + " more"), (1, None), (2, ""), (3, "short text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("x")).repartition(5)
    found = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in substring.remove_repeats(docs).collect())
    assert found == plain_removal(rows)
    assert sum(r[2] for r in found) > 500
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_removal_query_against_a_plain_scan(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = [(k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in plain_removal(rows)]
    assert sorted(tuple(r) for r in queries.op6_substring_dedup(spark, DATA).collect()) == want


def test_null_ids_come_last(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(None, text), (7, text)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring.remove_repeats(docs).collect()} == {None: 25, 7: 0}


def test_rows_without_ids_are_dealt_over_routes():
    """50,000 texts without an id: routes follow the texts."""
    ids = np.full(50_000, substring.NO_ID)
    tags = np.array([substring._tag(b"text %d" % k) for k in range(50_000)], np.int64)
    met = np.bincount(substring._document_routes(ids, tags, 24), minlength=24)
    assert met.min() > 1800 and met.max() < 2400


def test_a_hot_band_of_template_texts(spark, monkeypatch):
    """200,000 near copies in one shard are linked by stars; only rows that are not linked meet all parts."""
    n = 200_000
    part = F.pmod(F.xxhash64("id"), F.lit(128)).cast("int")
    sig = F.unhex(F.concat(F.substring(F.lit("ab" * 128), F.lit(1), part * 2), F.lpad(F.hex(F.col("id") % 251), 2, "0"), F.substring(F.lit("ab" * 128), F.lit(1), 254 - part * 2)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(8)).cast("int"))
    rows = spark.range(n).select(F.lit(7).cast("long").alias("shard"), F.lit(0x0F0F0F0F0F).bitwiseXOR(bit).alias("fp"), F.col("id").alias("rep"), sig.alias("sig"))
    rows = rows.union(spark.createDataFrame([(7, -1 - k, n + k, bytes([k] * 128)) for k in range(3)], rows.schema)).repartition(8)
    made = []
    units = simhash._hot_units
    monkeypatch.setattr(simhash, "_hot_units", lambda *a: made.append(units(*a)) or made[-1])
    links = simhash.cut_lineage(simhash._shard_links(rows, 16, 97))
    assert {r["component"] for r in simhash.components(links).where(f"node < {n}").collect()} == {0}
    assert links.where(f"a >= {n} or b >= {n}").count() == 0
    met = made[0].groupBy("unit").count().agg(F.sum("count"), F.max("count"), F.count("*")).first()
    assert met[0] < 2 * n and met[1] < 2 * simhash.PART_ROWS and met[2] > n / simhash.PART_ROWS


def test_large_shards_lose_no_links(spark, monkeypatch):
    """Shards above the bound, with some large components and rows alone, have the same components as brute force."""
    monkeypatch.setattr(simhash, "PART_ROWS", 20)
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 40, 4)
    prints = {int(c) ^ int(sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 3), replace=False))) for c in centres for _ in range(90)} | {int(x) for x in rng.integers(0, 1 << 40, 60)}
    rows = [(k, fp) for k, fp in enumerate(sorted(prints))]
    table = spark.createDataFrame([(1, fp, k) for k, fp in rows], "shard long, fp long, rep long")
    found = {r["node"]: r["component"] for r in simhash.components(simhash._shard_links(table, 3)).collect()}
    assert {k: found.get(k, k) for k, _ in rows} == plain_components(rows)
