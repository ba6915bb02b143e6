import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyweave.llm import mixing, packing, queries
from tests.conftest import DATA


def test_targets_share_by_weight_and_stop_at_three_times():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    found = mixing.targets([1000, 1000, 10], [1, 2, 3])
    assert found[2] == 30 and found[0] == pytest.approx(660) and found[1] == pytest.approx(1320)
    assert mixing.targets([0, 5], [1, 2]) == [0, 5] and mixing.targets([], []) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_permutations_are_permutations(n):
    for key in (0, 5, 10**12):
        assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))
    if n > 16:
        assert not np.array_equal(mixing.permuted(np.arange(n), n, 1), mixing.permuted(np.arange(n), n, 2))


@pytest.mark.parametrize("counts", [[5000, 300, 0, 77], [1], [3, 3, 3], [10**12, 7, 10**10]])
def test_shelves_and_shards_add_up(counts):
    shelves, before = 9, np.zeros(len(counts), np.int64)
    for shelf in range(shelves):
        own, seen = mixing.shelf_counts(shelf, shelves, counts)
        assert (seen == before).all() and (own >= 0).all()
        assert all(abs(o - c / shelves) <= 1 for o, c in zip(own, counts, strict=True))
        before = before + own
        if sum(counts) < 10**6:
            drawn = mixing.shard_counts(own, shelf, 4, 64)
            assert (drawn.sum(0) == own).all() and drawn.sum(1).max() <= 64 and np.ptp(drawn.sum(1)) <= 1
    assert before.tolist() == counts


def test_draws_are_multinomial_given_the_totals():
    own = np.array([8192, 16384, 8192])
    drawn = np.concatenate([mixing.shard_counts(own, shelf, 1, 2048) for shelf in range(40)])
    share, sd = drawn.mean(0) / 2048, drawn.std(0)
    assert np.allclose(share, [0.25, 0.5, 0.25], atol=1e-9)
    want = np.sqrt(2048 * share * (1 - share) * 15 / 16)
    assert (abs(sd / want - 1) < 0.15).all()


def spark_hash(value, seed):
    """XXH64 of a long or a text, as Spark takes it; nulls leave the seed."""
    if value is None:
        return seed
    raw = value.to_bytes(8, "little", signed=True) if isinstance(value, int) else value.encode()
    return xxhash.xxh64_intdigest(raw, seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_mix(rows, seed=17, cycle=(1, 2, 3), block=mixing.BLOCK_WORDS):
    """rows: (doc_id, text, source) -> (taken words, slots) of each, slot by slot in plain Python."""
    sizes = [len((t or "").encode().split()) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    totals = [sum(n for n, r in zip(sizes, rows, strict=True) if r[2] == s) for s in names]
    goals = mixing.targets(totals, [cycle[k % len(cycle)] for k in range(len(names))])
    slots, words = [], []
    for number, (total, goal) in enumerate(zip(totals, goals, strict=True)):
        own, left = [], min(round(goal), 3 * total)
        full, turn = total // block, 0
        while left > 0:
            order = mixing.permuted(np.arange(full), full, seed * 1_000_003 + number * 8 + turn).tolist() + ([full] if total % block else [])
            for b in order:
                n = min(left, block, total - b * block)
                if n > 0:
                    own.append((turn, b, n))
                    left -= n
            turn += 1
        slots.append(own)
        words.append([])
    for number, name in enumerate(names):
        own = [k for k, r in enumerate(rows) if r[2] == name]
        buckets = max(1, min(mixing.MOST_BUCKETS, -(-len(own) // mixing.BUCKET_ROWS)))
        key = lambda k: signed(spark_hash(rows[k][1], spark_hash(rows[k][0], 42)))
        own.sort(key=lambda k: (key(k) % buckets, rows[k][0] is not None, rows[k][0] or 0, sizes[k], key(k)))  # noqa: B023
        words[number] = [k for k in own for _ in range(sizes[k])]
    shelves = -(-sum(map(len, slots)) // (mixing.SHELF * mixing.SLOTS))
    taken, found, before = Counter(), defaultdict(list), [0] * len(names)
    for shelf in range(shelves):
        own = np.array([(2 * (shelf + 1) * len(s) + shelves) // (2 * shelves) - b for s, b in zip(slots, before, strict=True)])
        for k, drawn in enumerate(mixing.shard_counts(own, shelf, seed, mixing.SLOTS)):
            shard = [(number, *slots[number][before[number] + i]) for number, n in enumerate(drawn) for i in range(n)]
            place = np.random.default_rng([seed, shelf, k]).permutation(len(shard))
            for at, (number, turn, b, n) in zip(place, shard, strict=True):
                for doc, m in Counter(words[number][b * block : b * block + n]).items():
                    taken[doc] += m
                    found[doc].append((shelf * (mixing.SHELF + 1) + k, int(at), turn, b, m))
            before = [b + int(n) for b, n in zip(before, drawn, strict=True)]
    return [(taken[k], sorted(found[k])) for k in range(len(rows))]


def test_mix_query_by_hand(spark, monkeypatch):
    """taken and slots of every row of the query against a loop over slots and words."""
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = {d[0]: x for d, x in zip(docs, plain_mix(docs), strict=True)}
    for r in queries.op3_source_mixing(spark, DATA).collect():
        taken, slots = want[r["doc_id"]]
        assert r["taken"] == taken and r["slots"] == ",".join(":".join(map(str, s)) for s in slots)
    assert queries.op3_source_mixing(spark, DATA).columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]


def test_mix_of_many_shards_by_hand(spark, monkeypatch):
    for name, value in (("SLOTS", 16), ("SHELF", 2), ("BUCKET_ROWS", 20)):
        monkeypatch.setattr(mixing, name, value)
    rng = np.random.default_rng(2)
    docs = [(k if k % 9 else None, " ".join(f"w{k}x{i}" for i in range(int(rng.integers(0, 60)))), f"s{int(rng.integers(0, 40)) // 13}") for k in range(300)] + [(7, None, "s0"), (8, "tail", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    drawn = mixing.draw_slots
    monkeypatch.setattr(mixing, "draw_slots", lambda spark, sources, seed, block_words: drawn(spark, sources, seed, block_words, 16))
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["taken"], [tuple(s) for s in r["slots"]]) for r in mixing.mix_sources(frame, block_words=20).collect())
    want = sorted((d[0] if d[0] is not None else -1, len((d[1] or "").split()), *x) for d, x in zip(docs, plain_mix(docs, block=20), strict=True))
    assert found == want and len({s[0] for r in found for s in r[3]}) > 10
    # the draws decide where blocks go
    monkeypatch.setattr(mixing, "shard_counts", lambda own, shelf, seed, size: np.array([own]))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["taken"], [tuple(s) for s in r["slots"]]) for r in mixing.mix_sources(frame, block_words=20).collect()) != want


def test_small_sources_meet_their_targets(spark):
    rows = [(k, "a " * 100, "large") for k in range(200)] + [(1000 + k, "b " * n, f"small{k}") for k, n in enumerate((1, 2, 5, 511, 512, 513, 1500))]
    found = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in found:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(taken[s] == round(t) for s, t in target.items())


def mixed_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string, size int")
    return docs, mixing.mix_sources(docs).collect()


def test_mix_hits_targets_with_ties_nulls_and_a_hot_source(spark):
    rows = [(k, "w " * (k % 50), "hot" if k % 3 else None, "x", 1) for k in range(600)]
    rows += [(1, "a b c", "hot", "x", 1)] * 2 + [(9000, None, "hot", "x", 1), (None, "x y", "hot", "x", 1), (9001, "long " * 20_000, "big", "x", 1)]
    rows += [(10_000 + k, "one two three", "tiny", "x", 1) for k in range(5)]
    _, found = mixed_rows(spark, rows)
    assert len(found) == len(rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    taken, target, size = Counter(), {}, Counter()
    for r in found:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], size[r["source"]] + r["size"]
        assert r["source_size"] == sum(len((t or "").split()) for _, t, s, _, _ in rows if s == r["source"])
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s in target:
        assert abs(taken[s] - target[s]) <= max(2, 0.01 * target[s])
    again = mixed_rows(spark, rows)[1]
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"])
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_mix_of_nothing(spark):
    assert mixed_rows(spark, [])[1] == []
    assert [r["taken"] for r in mixed_rows(spark, [(1, "", "a", None, 0), (2, None, None, None, 0)])[1]] == [0, 0]


def test_mixed_texts_carry_the_words_taken(spark):
    rows = [(k, f"start{k}  " + "\n".join(f"w{k}_{i}" for i in range(k % 40)) + " end.", "de", f"s{k % 4}", 5) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["row", "round", "block", "low", "high", "_spans", "_row", "_size", "shard", "s.t", "key"]
    docs = docs.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    out = mixing.mixed_texts(docs)
    assert out.columns == docs.columns and tuple(out.first()[5:]) == tuple(range(len(names)))
    words = Counter()
    original = {r[0]: Counter(r[1].split()) for r in rows}
    for r in out.collect():
        own = Counter(r["text"].split())
        assert not own - original[r["doc_id"]] and r["n_chars"] == len(r["text"])
        words[r["doc_id"]] += sum(own.values())
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs).collect()}
    assert {k: v for k, v in taken.items() if v} == dict(words)
    # rows come in the mix's order within each file
    place = {}
    for r in mixing.mix_sources(docs).collect():
        for s in r["slots"]:
            place.setdefault(r["doc_id"], []).append((s["shard"], s["place"], s["words"]))
    for part in out.select("doc_id", "text").rdd.glom().collect():
        at = (-1, -1)
        for r in part:
            at = min((p[:2] for p in place[r["doc_id"]] if p[:2] >= at and p[2] == len(r["text"].split())), default=None)
            assert at is not None


def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_path())


def test_word_tokens_equal_the_tokenizers():
    texts = ["It's we're 'tis o'clock's ΣΑΣ ΑΣ. İstanbul ÉTÉ ñandú ẞ ﬁn x² ½", "<|endoftext|>foo<|startoftext|> a　b\x1cc\x85d ​", "漢字かな 12ab!!?;:)", "été Å", ""]
    words = packing.WordTokens(queries.tokenizer_path())
    for text in texts * 2:
        ids = np.frombuffer(b"".join(map(words.__getitem__, text.encode().split())), np.uint32).tolist()
        same = np.frombuffer(b"".join(map(words.__getitem__, packing.simplified(text.encode()).split())), np.uint32).tolist()
        assert ids == same == tokenizer().encode(text, add_special_tokens=False).ids


def plain_plan(cuts, costs, capacity):
    best, back = [0] + [10**9] * (len(cuts) - 1), [0] * len(cuts)
    for j in range(1, len(cuts)):
        for i in range(j):
            n = cuts[j] - cuts[i]
            if n <= capacity:
                pad = 0 if n & (n - 1) == 0 else capacity - n
                best[j] = min(best[j], best[i] + pad + costs[j] + packing.WINDOW_COST)
    return best[-1]


def test_plans_are_cheapest(monkeypatch):
    monkeypatch.setattr(packing, "LEAST_POWER", 1)
    rng = np.random.default_rng(3)
    for _ in range(30):
        cuts = [0, *np.cumsum(rng.integers(1, 12, 60)).tolist()]
        costs = [0, *rng.choice([0, 2, 24], 60).tolist()]
        path = [0, *packing.plan_windows(cuts, costs, 32)]
        assert path[-1] == 60
        cost = 0
        for i, j in zip(path, path[1:], strict=False):
            n = cuts[j] - cuts[i]
            assert n <= 32
            cost += (0 if n & (n - 1) == 0 else 32 - n) + costs[j] + packing.WINDOW_COST
        assert cost == plain_plan(cuts, costs, 32)


def check_pieces(pieces, texts):
    whole = tokenizer()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = whole.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    sizes = [sum(p["length"] for p in own) for own in by_sequence.values()]
    return sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes) / sum(sizes)


def test_packing_is_whole_and_tight(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert check_pieces(queries.op5_window_packing(spark, DATA).collect(), texts) < 0.05


def test_packing_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 3000)
    texts = {1: None, 2: "", 3: "x " * 9000, 4: "Some. Words! Here?\n\nMore", 5: "nostop" * 3000}
    docs = spark.createDataFrame([(k, t, 0) for k, t in texts.items()], "doc_id long, text string, start int").coalesce(1)
    check_pieces(packing.pack_documents(docs, queries.tokenizer_path()).collect(), texts)
    assert packing.pack_documents(docs.limit(0), queries.tokenizer_path()).count() == 0
    twice = packing.pack_documents(docs.where("doc_id = 4").union(docs.where("doc_id = 4")), queries.tokenizer_path()).agg(F.sum("length"), F.max("doc_tokens")).first()
    assert twice[0] == 2 * twice[1]


def test_stream_replans_the_end_of_a_block():
    words = packing.WordTokens(queries.tokenizer_path())
    stream = packing.Stream(words, 1, 64, 0)
    pieces, n = [], 0
    for k in range(400):
        stream.add(k, b"one two three. four five. " * (k % 5))
        n += stream.docs[-1][2]
        if stream.size > 700:
            pieces += stream.planned(final=False)
    pieces += stream.planned(final=True)
    assert sum(p[2] for p in pieces) == n and stream.size == 0


def test_every_sentence_end_is_a_cut_and_every_power_of_two_needs_no_padding():
    words = packing.WordTokens(queries.tokenizer_path())
    stream = packing.Stream(words, 1, 2048, 0)
    sentence = [b"one two three.", b"four!", b"five " * 70 + b"end."]
    stream.add(7, b" ".join(sentence * 3))
    sizes = [len(tokenizer().encode(s.decode(), add_special_tokens=False).ids) for s in sentence * 3]
    ends = np.cumsum(sizes).tolist()
    assert set(ends[:-1]) < set(stream.cuts) and stream.cuts[-1] == ends[-1] + 1
    for p in (1, 2, 4, 8, 16):
        cuts, costs = [0, 1024, 2048, 2048 + p], [0, 2, 2, 0]
        assert packing.plan_windows(cuts, costs) == [2, 3]
    rng = np.random.default_rng(5)
    for _ in range(30):
        cuts = [0, *np.cumsum(rng.integers(1, 12, 60)).tolist()]
        costs = [0, *rng.choice([0, 2, 24], 60).tolist()]
        path = [0, *packing.plan_windows(cuts, costs, 32)]
        gaps = [(cuts[j] - cuts[i], costs[j]) for i, j in zip(path, path[1:], strict=False)]
        assert sum((0 if n & (n - 1) == 0 else 32 - n) + c + packing.WINDOW_COST for n, c in gaps) == plain_plan(cuts, costs, 32)


def test_other_tokenizers_run_whole(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.known(path) and packing.known(queries.tokenizer_path())
    whole = Tokenizer.from_file(path)
    texts = {1: None, 2: "", 3: "Some. Words! Here?\n\nMore  of É.", 4: "word " * 3000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    by_doc = defaultdict(list)
    for p in packing.pack_documents(docs, path).collect():
        by_doc[p["doc_id"]].append(p)
    for k, text in texts.items():
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[k], key=lambda p: p["start"])
        assert [p["start"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1].tolist()] and sum(p["length"] for p in own) == len(ids)
        assert all(p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for p in own)


def test_query_windows_are_the_cheapest(spark):
    """The packing of one ordered stream costs what a plain program over all its cuts finds, and rows of one id are told apart."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(60).select("doc_id", "text")
    docs = docs.union(docs.limit(2)).coalesce(1)
    whole, cuts, costs = tokenizer(), [0], [0]
    count = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    for r in docs.collect():
        began = at = cuts[-1]
        for sentence in re.split(r"\n|(?<=[.!?]) ", r["text"]):
            n = count(sentence)
            cuts += [at + p for p in range(packing.LONG_GRID, n, packing.LONG_GRID)]
            costs += [packing.BREAK_COST] * len(range(packing.LONG_GRID, n, packing.LONG_GRID))
            at += n
            if n:
                cuts.append(at)
                costs.append(packing.SPLIT_COST)
        if cuts[-1] == at and at > began:
            cuts.pop()
            costs.pop()
        cuts.append(at + 1)
        costs.append(0)
    best, first = [0] + [10**12] * (len(cuts) - 1), 0
    for j in range(1, len(cuts)):
        while cuts[j] - cuts[first] > 2048:
            first += 1
        for i in range(first, j):
            n = cuts[j] - cuts[i]
            best[j] = min(best[j], best[i] + (0 if n & (n - 1) == 0 else 2048 - n) + costs[j] + packing.WINDOW_COST)
    pieces = packing.pack_documents(docs, queries.tokenizer_path()).collect()
    penalty = dict(zip(cuts, costs, strict=True))
    sizes = Counter()
    for p in pieces:
        sizes[p["sequence_id"]] += p["length"]
    at = total = 0
    for _, n in sorted(sizes.items()):
        at += n
        total += (0 if n & (n - 1) == 0 else 2048 - n) + penalty[at] + packing.WINDOW_COST
    assert at == cuts[-1] and total == best[-1]
    by_row = Counter()
    for p in pieces:
        by_row[p["row_key"]] += p["length"]
    assert len(by_row) == 62 and all(by_row[p["row_key"]] == p["doc_tokens"] for p in pieces)
