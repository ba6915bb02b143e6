import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tallyweave.llm import langid, queries
from tests.conftest import DATA
from tests.llm.test_secrets_and_sketches import plain_base
from tests.llm.test_simhash_and_substrings import similar_pairs


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "secret_scan", "source_mixing", "packing"]
    assert corpus_pipeline.queries() == {"pipeline": corpus_pipeline.run}


def test_each_stage_works_on_what_is_left(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    results = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        assert k == 4 or out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        results.append(docs.collect())
    found, alone, clean, mixed, packed = results

    first = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    kept = {r["doc_id"] for r in found}
    lost = [r for r in first if r["doc_id"] not in kept]
    assert len(lost) <= 0.05 * len(first) and all(re.search("[^\\W\\d_]", r["text"]) for r in found)

    # similar sets of five-word shingles: links of 0.8 or more are found, and nothing goes that links of 0.7 do not reach
    kept_ids = {r["doc_id"] for r in alone}
    rows = sorted((r["doc_id"], r["text"]) for r in found)
    words = {}
    for k, t in rows:
        words.setdefault(" ".join(t.lower().split()), []).append(k)
    assert all(set(own[1:]).isdisjoint(kept_ids) for own in words.values())
    strong = similar_pairs([t for _, t in rows], 0.8)
    assert strong and np.mean([not {rows[a][0], rows[b][0]} <= kept_ids for a, b in strong]) >= 0.9
    head = {k: k for k, _ in rows}

    def top(k):
        while head[k] != k:
            k = head[k]
        return k

    for a, b in similar_pairs([t for _, t in rows], 0.7):
        x, y = top(rows[a][0]), top(rows[b][0])
        head[max(x, y)] = min(x, y)
    assert all(k in kept_ids or top(k) != k for k, _ in rows)

    texts = {r["doc_id"]: r["text"] for r in alone}
    assert {r["doc_id"] for r in clean} == set(texts)
    for r in clean:
        assert not plain_base(r["text"]) and r["n_chars"] == len(r["text"])
        if not plain_base(texts[r["doc_id"]]) and "[SECRET]" not in r["text"]:
            assert r["text"] == texts[r["doc_id"]]
    assert sum("[SECRET]" in r["text"] for r in clean) >= sum(bool(plain_base(t)) for t in texts.values())

    size = {}
    for r in clean:
        size[r["source"]] = size.get(r["source"], 0) + len(r["text"].split())
    taken = dict.fromkeys(size, 0)
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    from tallyweave.llm.mixing import targets

    goals = dict(zip(sorted(size), targets([size[s] for s in sorted(size)], [1 + k % 3 for k in range(len(size))]), strict=True))
    assert all(abs(taken[s] - goals[s]) <= max(3, 0.02 * goals[s]) for s in size)

    whole = Tokenizer.from_file(queries.tokenizer_path())
    ids = [whole.encode(r["text"], add_special_tokens=False).ids + [1] for r in mixed]
    assert sum(p["length"] for p in packed) == sum(map(len, ids))
    # each row of the mix is packed whole, and its pieces are told apart from those of other rows of the document
    by_row = {}
    for p in packed:
        by_row.setdefault(p["row_key"], []).append(p)
    want = sorted((r["doc_id"], zlib.crc32(np.array(x, "<u4").tobytes())) for r, x in zip(mixed, ids, strict=True))
    assert len(by_row) == len(mixed)
    by_doc = {}
    for r, x in zip(mixed, ids, strict=True):
        by_doc.setdefault(r["doc_id"], []).append(x)
    for own in by_row.values():
        own.sort(key=lambda p: p["start"])
        assert len({p["doc_id"] for p in own}) == 1 and sum(p["length"] for p in own) == own[0]["doc_tokens"]
        fits = [x for x in by_doc[own[0]["doc_id"]] if all(zlib.crc32(np.array(x[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for p in own) and len(x) == own[0]["doc_tokens"]]
        assert fits
        by_doc[own[0]["doc_id"]].remove(fits[0])
    assert len(want) == len(mixed) and not any(by_doc.values())


def test_other_columns_pass_through(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    docs = docs.selectExpr("*", "1 as lang_pred", "2 as score", "3 as _row", "4 as `a.b`", "5 as spans", "6 as row")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        assert {tuple(r)[5:] for r in out.collect()} == {(1, 2, 3, 4, 5, 6)}, name


def test_run_and_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, DATA).count() > 0
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() == 0
        docs = docs if out.columns != docs.columns else out


def test_rejected_languages_go(spark):
    rows = [(k, "kari mo tusen rika " * 5, "aa", "s", 1) for k in range(30)] + [(99, "123 !!", "aa", "s", 1), (98, None, None, "s", 1), (97, "mori", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert set(left) == {*range(30), 97} and left[97] == "aa"
    assert langid.UNKNOWN not in left.values()
