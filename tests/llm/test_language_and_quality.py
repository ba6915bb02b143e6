import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyweave.llm import langid, quality, queries
from tests.conftest import DATA

SYLLABLES = {"aa": ["ka", "ri", "mo", "tu", "sen"], "bb": ["schl", "ung", "ein", "pf", "gro"]}


def made_texts(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = "aa" if k % 3 else "bb"
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 40))]
        rows.append((k, " ".join(words), lang))
    return rows


def test_language_held_out_and_edge_rows(spark):
    docs = spark.createDataFrame(made_texts(300), "doc_id long, text string, lang string")
    model = langid.fit_language_model(docs.where("doc_id < 200"))
    assert model.labels == ["aa", "bb"]
    edge = [(900, None, None), (901, "", "aa"), (902, "12 34 !!", "aa"), (903, "kari " * 30_000, "aa"), (903, "kari " * 30_000, "aa"), (None, "schlung einpf gro", None)]
    rows = spark.createDataFrame(made_texts(300)[200:] + edge, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    found = langid.identify_language(rows, model).collect()
    assert len(found) == 106 and set(found[0].asDict()) == {"doc_id", "text", "lang", "lang_pred", "score", "lang_rejected"}
    by = {r["doc_id"]: r for r in found}
    assert all(by[k]["lang_pred"] == langid.UNKNOWN and by[k]["score"] == 0 and by[k]["lang_rejected"] for k in (900, 901, 902))
    assert by[903]["lang_pred"] == "aa" and by[None]["lang_pred"] == "bb"
    held = [r for r in found if r["doc_id"] is not None and 200 <= r["doc_id"] < 300]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_empty_table_and_no_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit_language_model(empty)
    assert langid.identify_language(empty, model).count() == 0
    row = langid.identify_language(spark.createDataFrame([(1, "words", None)], empty.schema), model).first()
    assert row["lang_pred"] == langid.UNKNOWN and row["lang_rejected"]


def test_word_cache_matches_direct_sum():
    model = langid.train(*zip(*[(t, lang) for _, t, lang in made_texts(60)], strict=True))
    text = "kari mo schlung einpf"
    at = [g for w in text.split() for g in langid.ngrams(w)]
    z = (model.logits[at].mean(0) + model.bias) / model.temperature
    p = np.exp(z - z.max())
    label, score, _ = next(langid.predict(model, [text.encode()]))
    assert label == model.labels[int(p.argmax())] and abs(score - p.max() / p.sum()) < 1e-5


def test_language_query_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = queries.op1_language_id(spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.9


def test_quality_ranks_and_edge_rows(spark):
    rng = random.Random(2)
    rows = []
    for k in range(200):
        words = [rng.choice(["ama", "boro", "cila", "dun"]) for _ in range(30)]
        rows.append((k, " ".join(words) if k % 4 else "!! ".join(words).upper(), int(k % 4 > 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None), (999, 0)], "doc_id long, quality int")
    model = quality.fit_quality_model(docs, labels)
    edge = spark.createDataFrame([(1000, None), (1001, ""), (1002, "word " * 50_000), (1002, "word " * 50_000)], "doc_id long, text string")
    found = quality.score_quality(docs.union(edge).withColumn("SCORE", F.lit(1)), model).collect()
    assert len(found) == 204 and all(0 <= r["score"] <= 1 for r in found)
    by = {r["doc_id"]: r["score"] for r in found}
    assert by[1000] == by[1001]
    assert np.mean([(by[k] >= quality.CUT_SCORE) == bool(y) for k, _, y in rows]) > 0.97
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.score_quality(empty, quality.fit_quality_model(empty, labels)).count() == 0


def test_quality_query_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = queries.op2_quality_ranking(spark, DATA).join(labels, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert np.mean([r["predicted"] == r["quality"] for r in found]) > 0.8


CLASHES = ["_language", "_id", "_label", "i", "t", "l", "d", "j", "y", "a.b", "a`c"]


def test_other_columns_of_any_name(spark):
    rows = spark.createDataFrame(made_texts(60), "doc_id long, text string, lang string").select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])
    model = langid.fit_language_model(rows)
    assert model.labels == ["aa", "bb"]
    found = langid.identify_language(rows, model)
    assert found.columns == [*rows.columns, "lang_pred", "score", "lang_rejected"] and tuple(found.first()[3:14]) == tuple(range(11))
    labels = rows.select("doc_id", (F.col("lang") == "aa").cast("int").alias("quality"), *[F.col(f"`{c.replace('`', '``')}`") for c in CLASHES])
    scored = quality.score_quality(rows, quality.fit_quality_model(rows, labels))
    assert scored.columns == [*rows.columns, "score"] and scored.count() == 60


def test_training_without_usable_texts(spark):
    for texts in (["", ""], ["12", "!!"], []):
        assert langid.train(texts, ["aa"] * len(texts)).labels == []
    docs = spark.createDataFrame([(1, "", "aa"), (2, "34", "bb"), (3, None, "aa")], "doc_id long, text string, lang string")
    model = langid.fit_language_model(docs)
    assert [r["lang_pred"] for r in langid.identify_language(docs, model).collect()] == [langid.UNKNOWN] * 3
    one = langid.train(["kari mo"], ["aa"])
    assert one.labels == ["aa"] and next(langid.predict(one, [b"kari"]))[0] == "aa"


def test_samples_are_bounded_with_repeated_ids(spark):
    docs = spark.createDataFrame([(7, f"kari mo {k} tu" + "x" * k, "aa") for k in range(300)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(7, 1), (7, 0), (7, 1)], "doc_id long, quality int")
    assert len(quality.fit_quality_model(docs, labels, rows=10).weight) and langid.fit_language_model(docs, rows_per_label=10).labels in ([], ["aa"])


def plain_language(model, text):
    """Label and score by summing the logits of every n-gram of the text, one word at a time."""
    total, n = np.zeros(len(model.labels)), 0
    for word in (text or "").split():
        word = "".join(c for c in word.lower() if c.isalpha())
        if word:
            marked = f"<{word}>"
            grams = [word] + [marked[i : i + k] for k in (2, 3, 4) for i in range(len(marked) - k + 1)]
            for g in grams:
                total += model.logits[zlib.crc32(g.encode()) % langid.BUCKETS]
            n += len(grams)
    if not n:
        return langid.UNKNOWN, 0.0
    z = (total / n + model.bias) / model.temperature
    p = np.exp(z - z.max())
    return model.labels[int(p.argmax())], p.max() / p.sum()


def test_language_query_by_hand(spark):
    """Each row of the query against a direct sum over its text, with a model trained apart on the same rows."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = langid.fit_language_model(docs.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    for r in queries.op1_language_id(spark, DATA).collect():
        label, score = plain_language(model, rows[r["doc_id"]]["text"])
        assert r["lang_pred"] == label and abs(r["score"] - score) < 1e-4


def test_quality_query_by_hand(spark):
    """Each row of the query: the logistic of weighted features, recomputed text by text in plain Python."""
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit_quality_model(docs, labels.where("crc32(cast(doc_id as string)) % 5 <> 0"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in queries.op2_quality_ranking(spark, DATA).collect():
        raw = texts[r["doc_id"]].encode()
        words, lines = raw.split(), raw.split(b"\n")
        found = quality.features(raw)
        n = max(1, len(raw))
        for k, members in enumerate(quality._BYTE_SETS):
            share = sum(b in members for b in raw) / n
            assert abs(found[k] - share) < 1e-9 and abs(found[k + len(quality._BYTE_SETS)] - share**0.5) < 1e-9
        rest = found[2 * len(quality._BYTE_SETS) :]
        w = max(1, len(words))
        repeats = max((words.count(x) for x in set(words)), default=0) if len(words) < 500 else None
        assert rest[3] == len(set(words)) / w and (repeats is None or rest[4] == repeats / w) and rest[8] == len(set(lines)) / len(lines)
        z = sum(min(6, max(-6, (x - m) / s)) * v for x, m, s, v in zip(found, model.mean, model.scale, model.weight, strict=True))
        want = 1 / (1 + np.exp(-(z - model.cut + np.log(0.3 / 0.7))))
        assert abs(r["score"] - want) < 1e-6


def test_quality_is_learned_from_all_labelled_rows(spark):
    """Mean, scale, weights and cut against all 9,000 labelled rows, and all pairs of them, in numpy."""
    rng = random.Random(5)
    rows = []
    for k in range(9000):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcAB1!,") for _ in range(rng.randint(1, 5 + good))) for _ in range(rng.randint(1, 9))]
        rows.append((k, ("\n" if rng.random() < 0.3 else " ").join(words), int(good)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = quality.fit_quality_model(docs, labels)
    x, y = np.array([quality.features(r[1].encode()) for r in rows]), np.array([r[2] for r in rows])
    assert np.allclose(model.mean, x.mean(0), atol=1e-6) and np.allclose(model.scale, x.std(0) + 1e-6, atol=1e-6)
    x = np.clip((x - model.mean) / model.scale, -6, 6)
    s, bad = np.sort(x @ model.weight), int((y == 0).sum())
    assert s[bad - 1] - 2e-6 <= model.cut <= s[bad] + 2e-6

    def slope(w):
        lost = 1 / (1 + np.exp((x[y == 1] @ w)[:, None] - x[y == 0] @ w))
        return (lost.sum(0) @ x[y == 0] - lost.sum(1) @ x[y == 1]) / lost.size + 1e-4 * w

    assert np.abs(slope(model.weight)).max() < 1e-4 and np.abs(slope(np.zeros_like(model.weight))).max() > 0.05
    again = quality.fit_quality_model(docs.repartition(3), labels.repartition(2))
    assert again.cut == model.cut and all((getattr(again, c) == getattr(model, c)).all() for c in ("mean", "scale", "weight"))
