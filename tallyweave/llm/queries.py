"""The registered queries of this package; each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import crc_mod, cut_lineage, read_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.langid import fit_language_model, identify_language

    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    model = fit_language_model(docs.where(~held_out))
    return identify_language(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.quality import CUT_SCORE, describe, fit_described, score_described

    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = crc_mod("doc_id", 5) == 0
    described = cut_lineage(describe(docs.select("doc_id", held_out.alias("held_out"), "text")).drop("text"))
    model = fit_described(described, labels.where(~held_out))
    scored = score_described(described, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.mixing import mix_sources, slots_text

    return mix_sources(read_table(spark, sf_dir, "documents")).withColumn("slots", slots_text("slots"))


def op4_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.simhash import hex_column, simhash_duplicates

    found = simhash_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_column("fp").alias("fingerprint"), "component_id")


def op5_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.substring import remove_repeats

    kept = remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: verdict, host, path
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good) of pages whose path names a labelled document: good if of quality and not toxic."""
    from tallyweave.llm.reputation import host_column, path_column

    numbered = pages.select(host_column("url").alias("host"), F.regexp_extract(path_column("url"), r"/(\d{1,18})(?:/|\.html)?$", 1).alias("number"))
    known = labels.where("quality is not null or toxic is not null").select(F.col("doc_id").alias("labelled"), ((F.coalesce("quality", F.lit(1)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
    return numbered.where("number <> ''").join(known, F.col("number").cast("long") == F.col("labelled")).select("host", "good")


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.reputation import judge_urls

    pages, labels = read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels")
    return judge_urls(pages.select("page_id", "url"), page_outcomes(pages, labels), URL_RULES).drop("url")


def op8_wav_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.media import feature_text, with_media, with_media_features

    rows = with_media_features(with_media(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    stored = [F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature_text().alias("feature")]
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", *stored)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.secrets_scan import scan_secrets, spans_text

    rows = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans_text("base_spans"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))


def op10_iblt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.sketches import fingerprint_documents, sketch_text

    rows = fingerprint_documents(read_table(spark, sf_dir, "documents"))
    prints = [sketch_text(F.col("sketch")).alias("fingerprint"), sketch_text(F.col("edited_sketch")).alias("edited_fingerprint")]
    return rows.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), *prints, "near_edited", "near_next")


def op11_pivot_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.pivots import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.divergence import source_divergence

    return source_divergence(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyweave.llm.codes import compress_vectors

    return compress_vectors(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


#: Every window of 20 words by its text; a word goes if one of the windows over it has an earlier place.
_OP6_SQL = r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, words FROM d),
h AS (SELECT doc_id, place, words[place] AS word, CASE WHEN place + 19 <= len(words) THEN md5(array_to_string(words[place:place + 19], ' ')) END AS win FROM w),
m AS (SELECT *, first_value(doc_id) OVER (PARTITION BY win ORDER BY doc_id, place) AS fd, first_value(place) OVER (PARTITION BY win ORDER BY doc_id, place) AS fp FROM h),
g AS (SELECT doc_id, place, word, max(CASE WHEN win IS NOT NULL AND (fd <> doc_id OR fp <> place) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM m),
k AS (SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY place) FILTER (gone = 0), '') AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""


def _concentration_sql(groups: str) -> str:
    """As reputation._concentration, over a relation of good, n, mean."""
    return f"""(SELECT CASE WHEN count(*) = 0 OR avg(n) <= 1 OR sum(n * (good / n - mean) * (good / n - mean) / (mean * (1 - mean))) / count(*) <= 1 THEN 10000e0
ELSE least(10000e0, greatest(1e0, (avg(n) - 1) / (sum(n * (good / n - mean) * (good / n - mean) / (mean * (1 - mean))) / count(*) - 1) - 1)) END FROM {groups} WHERE n > 0 AND mean > 0 AND mean < 1)"""


def _op7_sql() -> str:
    fits = lambda r: f"((host = '{r[1]}' OR host LIKE '%.{r[1]}') AND starts_with(path, '{r[2]}'))"
    ordered = sorted(URL_RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r[1] + r[2]}'" for r in ordered) + " END"
    said = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r[0]}'" for r in ordered) + " END"
    return rf"""WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
o AS (SELECT host, CASE WHEN coalesce(quality, 1) = 1 AND coalesce(toxic, 0) = 0 THEN 1e0 ELSE 0e0 END AS good FROM (SELECT host, regexp_extract(path, '/([0-9]{{1,18}})(?:/|\.html)?$', 1) AS number FROM p) x JOIN labels l ON number <> '' AND CAST(nullif(number, '') AS BIGINT) = l.doc_id WHERE quality IS NOT NULL OR toxic IS NOT NULL),
h0 AS (SELECT host, sum(good) AS good, sum(n) AS n FROM (SELECT host, 0e0 AS good, 0e0 AS n FROM p UNION ALL SELECT host, good, 1e0 FROM o) GROUP BY host),
h AS (SELECT *, regexp_extract(host, '([^.]+\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix FROM h0),
d0 AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM h GROUP BY 1, 2), s0 AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM d0 GROUP BY 1),
s1 AS (SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN (sum(good) + 1) / (sum(n) + 2) ELSE 0.5e0 END FROM s0) AS mean FROM s0), s2 AS (SELECT *, {_concentration_sql("s1")} AS m FROM s1),
s AS (SELECT suffix, (good + m * mean) / (n + m) AS rate FROM s2),
d1 AS (SELECT d0.*, s.rate AS mean FROM d0 JOIN s ON s.suffix = d0.suffix), d2 AS (SELECT *, {_concentration_sql("d1")} AS m FROM d1), d AS (SELECT domain, suffix, (good + m * mean) / (n + m) AS rate FROM d2),
h1 AS (SELECT h.*, d.rate AS mean FROM h JOIN d ON d.domain = h.domain AND d.suffix = h.suffix), h2 AS (SELECT *, {_concentration_sql("h1")} AS m FROM h1),
h3 AS (SELECT host, good + m * mean AS a, n - good + m * (1 - mean) AS b FROM h2), j AS (SELECT host, a / (a + b) - 1.645e0 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM h3)
SELECT page_id, p.host AS host, path, {rule.replace("host ", "p.host ")} AS rule, coalesce({said.replace("host ", "p.host ")}, CASE WHEN bound >= 0.5e0 THEN 'allow' ELSE 'block' END) AS verdict FROM p LEFT JOIN j ON j.host = p.host"""


#: p and q of every kept term and group, in 128 bits where a product needs them.
_OP12_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c0 AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY 1, 2, 3),
kept AS (SELECT lang, term, sum(n) AS ln FROM c0 GROUP BY 1, 2 HAVING sum(docs) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
grid AS (SELECT g.lang, g.source, k.term, coalesce(c0.n, 0) AS n, k.ln FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c0 ON c0.lang = g.lang AND c0.source = g.source AND c0.term = k.term),
p AS (SELECT lang, source, term, n, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER s + 2 * count(*) OVER s) AS BIGINT) AS p, CAST(1 + (CAST(1000000000 AS HUGEINT) * (ln + 2)) // (sum(ln) OVER s + 2 * count(*) OVER s) AS BIGINT) AS q FROM grid WINDOW s AS (PARTITION BY lang, source)),
sums AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
both_parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM both_parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op6_substring_dedup": _OP6_SQL, "op7_host_reputation": _op7_sql(), "op12_source_divergence": _OP12_SQL}
