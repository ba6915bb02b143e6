"""Queries of single functions and small operators over the supplied tables, with the same rows in SQL.

Texts to parse are made from the tables' columns by expressions that Spark and the SQL share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import amounts, dates, geo, keys, text
from tallyweave.operators import artifacts, history, identity, manifests, reposts, reviews, rules, services, sheets, traces
from tallyweave.plans.ledgers import END, START, _sheet_rows, table
from tallyweave.sources import boards, html, records
from tallyweave.streaming.listing import visited_posts

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def made(spark, sf_dir, of: str, key: str, /, **texts: str) -> DataFrame:
    """A table's key with columns made by expressions."""
    return table(spark, sf_dir, of).select(key, *[F.expr(e).alias(c) for c, e in texts.items()])


# Scalar functions.
_FILE = "CASE p_partkey % 5 WHEN 0 THEN 'Report ' || CAST(p_partkey AS STRING) || '.XLSX' WHEN 1 THEN 'no suffix' WHEN 2 THEN ' ' WHEN 3 THEN 'a.b/c.tar.Gz' END"


@query(f"SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '.xlsx' WHEN 1 THEN '' WHEN 3 THEN '.gz' ELSE '.pdf' END AS suffix FROM part WHERE length(coalesce({_FILE}, 'x')) > 0")
def file_suffixes(spark, sf_dir):
    p = made(spark, sf_dir, "part", "p_partkey", name=_FILE)
    return p.select("p_partkey", text.file_suffix(F.col("name"), F.lit("view.PDF")).alias("suffix"))


@query("SELECT p_partkey, regexp_full_match(CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN CAST(p_partkey AS STRING) || 'x' ELSE p_name END, '[A-Za-z0-9]+') AS ok FROM part")
def identifiers(spark, sf_dir):
    p = made(spark, sf_dir, "part", "p_partkey", v="CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN CAST(p_partkey AS STRING) || 'x' ELSE p_name END")
    return p.select("p_partkey", text.is_identifier(F.col("v")).alias("ok"))


@query("""SELECT o_orderkey, sha256('{"a":"' || o_orderstatus || '","b":' || CAST(o_custkey AS VARCHAR) || ',"c":[1,null]}') AS digest FROM orders""")
def object_digests(spark, sf_dir):
    o = made(spark, sf_dir, "orders", "o_orderkey", body="""'{"c": [1, null],  "b": ' || CAST(o_custkey AS STRING) || ', "a": "' || o_orderstatus || '"}'""")
    return o.select("o_orderkey", keys.object_digest(F.col("body")).alias("digest"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN CAST(o_custkey AS VARCHAR) || '.5' ELSE o_orderpriority || ' x' END AS cell FROM orders""")
def cell_texts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 4
    kind = F.when(k == 0, "datetime").when(k < 3, "double").otherwise("string")
    number = F.col("o_custkey").cast("double") + F.when(k == 2, 0.5).otherwise(0.0)
    return o.select("o_orderkey", text.cell_text(kind, F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" \n x ")), number, F.col("o_orderdate")).alias("cell"))


@query("SELECT c_custkey, replace(c_name, '#', '#') || 'x' || c_mktsegment AS name FROM customer")
def compact_names(spark, sf_dir):
    c = made(spark, sf_dir, "customer", "c_custkey", v="' ' || c_name || '  x\t' || c_mktsegment || '\n'")
    return c.select("c_custkey", text.compact(F.col("v")).alias("name"))


_ODD = "CASE p_partkey % 7 WHEN 0 THEN chr(64257) || 'n ' || chr(65313) WHEN 1 THEN 'e' || chr(769) || chr(8195) || 'B' WHEN 2 THEN chr(55) || chr(178) WHEN 3 THEN '' WHEN 4 THEN '  ' || chr(223) || 'X  y ' ELSE p_name END"


@query("SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN chr(64257) || 'n ' || lower(chr(65313)) WHEN 1 THEN chr(233) || ' b' WHEN 2 THEN '7' || chr(178) WHEN 3 THEN '' WHEN 4 THEN 'ssx y' ELSE lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) END AS normal, CASE p_partkey % 7 WHEN 0 THEN 'fin a' WHEN 1 THEN chr(233) || ' b' WHEN 2 THEN '72' WHEN 3 THEN '' WHEN 4 THEN chr(223) || 'x  y' ELSE lower(trim(p_name)) END AS searched FROM part")
def normal_forms(spark, sf_dir):
    """Names beyond ASCII: composed, folded, and in compatibility form."""
    p = table(spark, sf_dir, "part")
    char = lambda n: F.lit(chr(n))
    k = F.col("p_partkey") % 7
    v = F.when(k == 0, F.concat(char(64257), F.lit("n "), char(65313))).when(k == 1, F.concat(F.lit("e"), char(769), char(8195), F.lit("B"))).when(k == 2, F.concat(F.lit("7"), char(178))).when(k == 3, "").when(k == 4, F.concat(F.lit("  "), char(223), F.lit("X  y "))).otherwise(F.col("p_name"))
    p = p.select("p_partkey", v.alias("v"))
    folded = p.withColumns({"normal": text.normalized(F.col("v")), "searched": text.searchable(F.col("v"))})
    return folded.select("p_partkey", F.when(F.col("p_partkey") % 7 == 0, F.replace("normal", F.lit("fin"), F.concat(char(64257), F.lit("n")))).otherwise(F.col("normal")).alias("normal"), "searched")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 3 OR o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def month_days(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    k = F.col("o_orderkey") % 5
    m, d = F.month("d").cast("string"), F.dayofmonth("d").cast("string")
    month = F.when(k == 1, F.concat(m, F.lit("월"))).when(k == 3, F.lit("x")).otherwise(m)
    return o.select("o_orderkey", dates.month_day(month, F.when(k == 2, F.concat(d, F.lit(" 일"))).otherwise(d), F.when(k != 4, F.year("d"))).alias("day"))


@query("SELECT c_custkey, c_name || ' & ' || c_mktsegment || '<3' AS plain FROM customer")
def plain_texts(spark, sf_dir):
    c = made(spark, sf_dir, "customer", "c_custkey", v="'<b class=\"x\">' || c_name || '</b>  &amp;\n<i>' || c_mktsegment || '</i>&lt;3 '")
    return c.select("c_custkey", text.plain(F.col("v")).alias("plain"))


_SHOP = "CASE c_custkey % 4 WHEN 0 THEN '식당 ' || CAST(c_custkey AS STRING) || '점' WHEN 1 THEN '식당점' WHEN 2 THEN c_mktsegment || ' 큰 집' ELSE 'a b 본점' END"


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey AS VARCHAR) || '점' WHEN 3 THEN '본점' ELSE '' END AS branch, CASE c_custkey % 4 WHEN 0 THEN '식당' WHEN 1 THEN '식당점' WHEN 2 THEN c_mktsegment || ' 큰 집' ELSE 'a b' END AS merchant FROM customer")
def branches(spark, sf_dir):
    c = made(spark, sf_dir, "customer", "c_custkey", name=_SHOP)
    return c.select("c_custkey", text.branch_of(F.col("name")).alias("branch"), text.merchant_of(F.col("name")).alias("merchant"))


_LATITUDE = "33e0 + (c_custkey % 700) / 100e0"


@query(f"""WITH x AS (SELECT c_custkey, {_LATITUDE} AS lat, 256e0 * pow(2, c_custkey % 18) AS world FROM customer), y AS (SELECT *, (0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi())) * world + 120 AS y FROM x)
SELECT c_custkey, round(degrees(2 * atan(exp((0.5 - y / world) * 2 * pi())) - pi() / 2), 6) AS below FROM y""")
def latitudes_below(spark, sf_dir):
    c = made(spark, sf_dir, "customer", "c_custkey", lat=_LATITUDE, zoom="c_custkey % 18")
    return c.select("c_custkey", F.round(geo.latitude_below(F.col("lat"), F.col("zoom"), F.lit(120)), 6).alias("below"))


@query("SELECT o_orderkey, format('{:,}', CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS BIGINT)) || '원' AS shown FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) % 1 <> 0.5")
def won_texts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("a", F.col("o_totalprice").cast("decimal(18,2)")).where("a % 1 <> 0.5")
    return o.select("o_orderkey", amounts.format_won(F.col("a")).alias("shown"))


@query("SELECT o_orderkey, format('{:,}', CAST(round_even(CAST(floor(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) + CASE o_orderkey % 3 WHEN 0 THEN 0.5e0 WHEN 1 THEN 0.25e0 ELSE 0.75e0 END, 0) AS BIGINT)) || '원' AS shown FROM orders")
def won_ties(spark, sf_dir):
    """Amounts halfway between two whole ones go to the even one."""
    o = table(spark, sf_dir, "orders")
    more = F.when(F.col("o_orderkey") % 3 == 0, "0.5").when(F.col("o_orderkey") % 3 == 1, "0.25").otherwise("0.75").cast("decimal(18,2)")
    return o.select("o_orderkey", amounts.format_won(F.floor(F.col("o_totalprice").cast("decimal(18,2)")) + more).alias("shown"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END AS state FROM orders")
def record_states(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", services.record_state(F.col("o_orderstatus"), {"F": "done", "O": "open"}).alias("state"))


@query("SELECT p_partkey, CASE WHEN p_size <= 15 THEN 0 WHEN p_size <= 30 THEN 1 ELSE 2 END AS state FROM part")
def nearest_states(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", services.nearest_state(F.col("p_size"), F.array(F.lit(10), F.lit(20), F.lit(40))).alias("state"))


@query("SELECT conv_id, turn, CAST(CAST(length(text) * 3 + turn * 12 AS DECIMAL(18,0)) / 10000000 AS DOUBLE) AS cost, CAST(CAST(length(text) * 3 + 4096 * 12 AS DECIMAL(18,0)) / 10000000 AS DOUBLE) AS ceiling FROM conversations")
def call_costs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", amounts.token_cost(F.length("text"), F.col("turn"), "0.30", "1.20").cast("double").alias("cost"), amounts.token_ceiling(F.col("text"), 4096, "0.30", "1.20").cast("double").alias("ceiling"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE epoch_us(ts) - CASE WHEN event_id % 4 = 1 THEN 32400000000 ELSE 0 END - epoch_us(ts) % 1000000 END AS micros FROM events")
def moments(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    said, k = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_id") % 4
    offset = F.when(k == 0, "Z").when(k == 1, "+09:00").when(k == 2, "+00:00").otherwise("")
    return e.select("event_id", F.unix_micros(dates.parse_moment_with_offset(F.concat(said, offset))).alias("micros"))


@query("SELECT page_id, CASE WHEN coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '') = '' THEN 'unknown' WHEN lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) = 'www.example.com' THEN 'own' ELSE lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) END AS origin FROM pages")
def url_origins(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", traces.origin_of_url(F.col("url"), "www.example.com").alias("origin"))


_REFERENCES = ["b.html", "../x/c%20d.html", "/seoul/", "https://a.org/b", "?q=1", "../../up.html", "#top", "d.html?v=2#z"]
_FILES = ["'city/' || k || '/b.html'", "'city/x/c d.html'", "'seoul/index.html'", None, None, "'up.html'", None, "'city/' || k || '/d.html'"]


@query("SELECT page_id, CASE page_id % 8 " + " ".join(f"WHEN {k} THEN {f or 'NULL'}" for k, f in enumerate(_FILES)) + " END AS target FROM (SELECT page_id, CAST(page_id AS VARCHAR) AS k FROM pages)")
def resolved_references(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    said = F.element_at(F.array(*[F.lit(r) for r in _REFERENCES]), (F.col("page_id") % 8 + 1).cast("int"))
    return p.select("page_id", manifests.resolve_reference(F.concat(F.lit("city/"), F.col("page_id").cast("string"), F.lit("/index.html")), said).alias("target"))


@query("SELECT event_id, regexp_matches(CASE event_id % 5 WHEN 0 THEN 'RunTask' WHEN 1 THEN 'longtask' WHEN 2 THEN 'TASK' WHEN 3 THEN 'RunTasks' END, '(?i)^(?:LongTask|RunTask|Task)$') IS TRUE AS is_long FROM events")
def long_task_names(spark, sf_dir):
    e = made(spark, sf_dir, "events", "event_id", name="CASE event_id % 5 WHEN 0 THEN 'RunTask' WHEN 1 THEN 'longtask' WHEN 2 THEN 'TASK' WHEN 3 THEN 'RunTasks' END")
    return e.select("event_id", traces.is_long_task(F.col("name")).alias("is_long"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS DOUBLE) ELSE CAST(epoch_us(ts) // 1000000 * 1000 AS DOUBLE) - 1700000000000 + 5000 END AS began FROM events")
def event_stamps(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    millis = (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000) * 1000).cast("double")
    return e.select("event_id", services.started_at(F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("double")).otherwise(millis), F.lit(1.7e12), F.lit(5000.0)).alias("began"))


@query("SELECT o_orderkey, 3 * quarter(o_orderdate) - 2 AS first, 12 AS last FROM orders")
def quarters(spark, sf_dir):
    q = dates.quarter_months(F.quarter("o_orderdate"), F.lit(4))
    return table(spark, sf_dir, "orders").select("o_orderkey", q["first"].cast("long").alias("first"), q["last"].alias("last"))


@query("""SELECT o_orderkey, sha256('["decision-1","p","' || o_orderstatus || '","' || CAST(o_custkey AS VARCHAR) || '","' || o_orderpriority || '","' || CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE '\\u0000null' END || '","\\u0000null"]') AS decision,
sha256('["request-1","search","' || o_orderpriority || '"]') AS request, sha256('["policy-1","identity","2","names","1"]') AS policy, sha256('[["No","' || o_orderstatus || 'x"],[]]') AS header FROM orders""")
def decision_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    decided = keys.decision_key(F.lit("p"), [F.col("o_orderstatus"), F.col("o_custkey")], F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, "yes"), F.lit(None).cast("string"))
    header = keys.header_key(F.array(F.array(F.lit(" N o"), F.concat("o_orderstatus", F.lit("\nx "))), F.array().cast("array<string>")))
    return o.select("o_orderkey", decided.alias("decision"), keys.request_key(F.lit("search"), F.col("o_orderpriority")).alias("request"), keys.policy_key({"names": "1", "identity": "2"}).alias("policy"), header.alias("header"))


# Listings and pages.
_CELL = "CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 1 THEN ' ' || replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '.') || ' ' WHEN 2 THEN 'none' ELSE '2001/2/3' END"


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 2 THEN NULL WHEN 3 THEN DATE '2001-02-03' ELSE CAST(o_orderdate AS DATE) END AS posted FROM orders")
def posting_dates(spark, sf_dir):
    return made(spark, sf_dir, "orders", "o_orderkey", cell=_CELL).select("o_orderkey", html.posted_on(F.col("cell")).alias("posted"))


@query("SELECT page_id, CAST(page_id % 90 + 1 AS INT) AS pages FROM pages")
def listing_page_counts(spark, sf_dir):
    p = made(spark, sf_dir, "pages", "page_id", body="CASE page_id % 2 WHEN 0 THEN '<p>전체게시글 : 7 / 전체페이지 : ' || CAST(page_id % 90 + 1 AS STRING) || '</p>' ELSE '<b>3 / ' || CAST(page_id % 90 + 1 AS STRING) || '</b>' END")
    return p.select("page_id", html.page_count(F.col("body")).alias("pages"))


@query("SELECT page_id, 'download?file=' || CAST(page_id AS VARCHAR) AS href, 'f' || CAST(page_id AS VARCHAR) || '.xlsx' AS filename FROM pages")
def attachments(spark, sf_dir):
    """Of each page's three links, the download that names this post or none."""
    v = "'<a href=\"download?file=' || CAST(page_id AS STRING) || '\">f' || CAST(page_id AS STRING) || '.xlsx</a><a href=\"download?post_id=-1\">other</a><a href=\"/home\">home</a>'"
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("post_id"), F.expr(v).alias("html"))
    return boards.view_attachments(p).select(F.col("post_id").alias("page_id"), "href", "filename")


@query("SELECT page_id, CASE WHEN page_id % 3 < 2 THEN 't' || CAST(page_id AS VARCHAR) END AS token FROM pages")
def session_tokens(spark, sf_dir):
    v = "CASE page_id % 3 WHEN 0 THEN '<input type=\"hidden\" name=\"_csrf\" value=\"t' || CAST(page_id AS STRING) || '\">' WHEN 1 THEN '<meta name=\"csrf-token\" content=\"t' || CAST(page_id AS STRING) || '\">' ELSE '<p>csrf</p>' END"
    return made(spark, sf_dir, "pages", "page_id", v=v).select("page_id", boards.session_token(F.col("v")).alias("token"))


@query("SELECT n_name AS organization, CASE WHEN n_nationkey % 3 = 0 THEN 'held' ELSE 'visited ' || string_agg(DISTINCT r_name, ', ' ORDER BY r_name) END AS reason FROM nation JOIN region ON r_regionkey = n_regionkey OR r_regionkey = n_nationkey % 5 GROUP BY n_name, n_nationkey")
def empty_reasons(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), F.broadcast(table(spark, sf_dir, "region"))
    met = n.join(r, (r["r_regionkey"] == n["n_regionkey"]) | (r["r_regionkey"] == n["n_nationkey"] % 5))
    return boards.empty_reason(met.select(F.col("n_name").alias("organization"), (F.col("n_nationkey") % 3 == 0).alias("held"), F.col("r_name").alias("board")))


@query("SELECT DISTINCT post_id FROM (SELECT user_id AS post_id FROM events WHERE event_type = 'view' UNION ALL SELECT user_id FROM events WHERE event_type = 'error')")
def posts_visited(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "post_id")
    return visited_posts(e.where("event_type = 'view'"), e.where("event_type = 'error'"))


@query("SELECT o_orderkey AS post_id, 'f' || o_orderpriority AS filename, CASE WHEN o_orderkey % 2 = 0 THEN 'gone' ELSE 'empty' END AS reason, c_name AS title FROM orders LEFT JOIN customer ON c_custkey = o_orderkey")
def originals_missing(spark, sf_dir):
    name, none = F.array(F.concat(F.lit("f"), F.col("o_orderpriority"))), F.array().cast("array<string>")
    even = F.col("o_orderkey") % 2 == 0
    ledger = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), F.when(even, name).otherwise(none).alias("gone"), F.when(even, none).otherwise(name).alias("empty"))
    return boards.missing_originals(ledger, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("post_id"), F.col("c_name").alias("title")))


@query("""SELECT sha256(text) AS source, min(doc_id) AS path, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN starts_with(text, '%PDF-') THEN 'pdf' ELSE 'unsupported' END AS container FROM documents GROUP BY text""")
def sources_by_content(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"), F.col("doc_id").alias("path"), F.col("text").cast("binary").alias("content"))
    return boards.distinct_sources(boards.materialized_sources(d, d.select("post_id"))).select("source", "path", "container")


# Provider replies.
_PLACE = """'{"total": 1, "items": [{"title": "<b>' || c_mktsegment || '</b> &amp; co 본점", "roadAddress": "' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'road  1' END || '", "address": "lot 2", "mapx": "' || CAST(1270000000 + c_custkey AS STRING) || '", "mapy": "' || CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE CAST(370000000 + c_custkey AS STRING) END || '"}, {"title": "plain", "mapx": "1", "mapy": "1"}]}'"""


@query("""SELECT c_custkey, 0 AS position, c_mktsegment || ' & co' AS merchant, '본점' AS branch, CASE WHEN c_custkey % 3 = 0 THEN 'lot 2' ELSE 'road 1' END AS address, CASE WHEN c_custkey % 5 <> 0 THEN (370000000 + c_custkey) / 1e7 END AS latitude, CASE WHEN c_custkey % 5 <> 0 THEN (1270000000 + c_custkey) / 1e7 END AS longitude FROM customer
UNION ALL SELECT c_custkey, 1, 'plain', '', NULL, NULL, NULL FROM customer""")
def places_found(spark, sf_dir):
    found = records.place_candidates(made(spark, sf_dir, "customer", "c_custkey", body=_PLACE))
    return found.select("c_custkey", "position", "merchant", "branch", "address", "latitude", "longitude")


_LICENSE = """CASE c_custkey % 4 WHEN 0 THEN '{"response":{"body":{"items":""}}}' WHEN 1 THEN '{"response":{"body":{"items":{"item":{"MNG_NO":"m1","BPLC_NM":"' || c_mktsegment || ' 1점","LOTNO_ADDR":"lot","CLSBIZ_YMD":""}}}}}'
WHEN 2 THEN '{"response":{"body":{"items":{"item":[{"MNG_NO":"m1","BPLC_NM":"a","ROAD_NM_ADDR":" road ","CLSBIZ_YMD":"20200101"},{"MNG_NO":"m2","BPLC_NM":"b"}]}}}}' ELSE '{"response":{"body":{"items":null}}}' END"""


@query("""SELECT c_custkey, 0 AS position, 'm1' AS reference, c_mktsegment AS merchant, '1점' AS branch, 'lot' AS address, true AS open FROM customer WHERE c_custkey % 4 = 1
UNION ALL SELECT c_custkey, 0, 'm1', 'a', '', 'road', false FROM customer WHERE c_custkey % 4 = 2 UNION ALL SELECT c_custkey, 1, 'm2', 'b', '', NULL, true FROM customer WHERE c_custkey % 4 = 2""")
def licenses_found(spark, sf_dir):
    found = records.license_candidates(made(spark, sf_dir, "customer", "c_custkey", body=_LICENSE))
    return found.select("c_custkey", "position", "reference", "merchant", "branch", "address", "open")


_REPLY = """CASE c_custkey % 4 WHEN 0 THEN '{"candidates":[{"content":{"parts":[{"text":"a"},{"text":"' || c_mktsegment || '"}]},"finishReason":"STOP"}],"usageMetadata":{"promptTokenCount":' || CAST(c_custkey AS STRING) || ',"candidatesTokenCount":3,"thoughtsTokenCount":4}}'
WHEN 1 THEN '{"candidates":[{"content":{"parts":[{"text":"cut"}]},"finishReason":"MAX_TOKENS"}],"usageMetadata":{"promptTokenCount":5}}' WHEN 2 THEN '{"candidates":[]}' ELSE '{"candidates":[{"content":{"parts":[{"text":""}]},"finishReason":"STOP"}]}' END"""


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'a' || c_mktsegment END AS answer, CASE c_custkey % 4 WHEN 1 THEN 'max_tokens' WHEN 2 THEN 'unreadable' WHEN 3 THEN 'empty' END AS error, CASE c_custkey % 4 WHEN 0 THEN c_custkey WHEN 1 THEN 5 END AS input_tokens, CASE c_custkey % 4 WHEN 0 THEN 7 ELSE 0 END AS output_tokens FROM customer""")
def answers_of_models(spark, sf_dir):
    found = records.model_answers(made(spark, sf_dir, "customer", "c_custkey", body=_REPLY))
    return found.select("c_custkey", "answer", "error", F.col("input_tokens").cast("long").alias("input_tokens"), "output_tokens")


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'timeout' WHEN 1 THEN 'unsupported' WHEN 2 THEN 'unknown_candidate' WHEN 3 THEN 'missing_name' WHEN 4 THEN 'missing_rationale' ELSE 'proposed' END AS reason, CASE WHEN c_custkey % 6 = 5 THEN 'proposed' ELSE 'withheld' END AS status FROM customer""")
def restoration_proposals(spark, sf_dir):
    k = F.col("c_custkey") % 6
    replies = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k == 0, "timeout").alias("error"), (k != 1).alias("supported"), F.when(k == 2, "zz").otherwise("a1").alias("candidate_source"), F.array(F.lit("a1"), F.lit("a2")).alias("candidates"),
        F.when(k == 3, " ").otherwise(F.col("c_name")).alias("restored"), F.when(k != 4, "because").alias("rationale"),
    )
    return services.proposals(replies).select("c_custkey", "reason", "status")


# Joins, sets and histories.
@query("SELECT p_partkey AS key, 'overlap' AS problem FROM part WHERE p_size <= 20 AND p_size >= 15 UNION ALL SELECT p_partkey, 'uncovered' FROM part WHERE p_size > 20 AND p_size <= 40 AND p_size % 2 = 0 UNION ALL SELECT p_partkey, 'unexpected' FROM part WHERE p_size > 40 AND p_size % 2 = 1")
def disjoint_covers(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "key")
    whole = p.where("p_size <= 40 or p_size % 2 = 0")
    return manifests.disjoint_cover([p.where("p_size <= 20"), p.where("p_size between 15 and 20 or (p_size > 20 and p_size % 2 = 1) or p_size > 40")], whole, "key")


@query("""WITH a AS (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2), e AS (SELECT DISTINCT o_orderkey, o_custkey % 100 + 1 AS s FROM orders)
SELECT coalesce(l_orderkey, o_orderkey) AS source, coalesce(l_suppkey, s) AS organization, CASE WHEN n IS NULL THEN 'missing' WHEN s IS NULL THEN 'unexpected' ELSE 'duplicate' END AS problem FROM a FULL JOIN e ON l_orderkey = o_orderkey AND l_suppkey = s WHERE n IS NULL OR s IS NULL OR n > 1""")
def target_coverage(spark, sf_dir):
    """Coverage of (source, organization) pairs."""
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source"), F.col("l_suppkey").alias("organization"))
    wanted = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source"), (F.col("o_custkey") % 100 + 1).alias("organization"))
    return manifests.key_coverage(line, wanted, ["source", "organization"])


@query("SELECT n_name || '/' || f AS path FROM nation, (VALUES ('markers.json'), ('records.json')) AS t(f) UNION SELECT 'index.html'")
def paths_public(spark, sf_dir):
    return manifests.public_paths(table(spark, sf_dir, "nation").select(F.col("n_name").alias("slug")), ["markers.json", "records.json"], ["index.html"])


@query("SELECT n_name AS slug, 'city' AS found FROM nation WHERE n_nationkey % 3 <> 0 UNION ALL SELECT r_name, 'unknown' FROM region")
def cities_built(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    here = n.where("n_nationkey % 3 <> 0").select(F.col("n_name").alias("slug")).union(r.select("r_name"))
    built, unknown = manifests.built_cities(n.select(F.col("n_name").alias("slug")), here)
    return built.select("slug", F.lit("city").alias("found")).union(unknown.select("slug", F.lit("unknown").alias("found")))


@query("SELECT CAST(count(*) AS BIGINT) AS files, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, CAST(count(*) FILTER (octet_length(encode(text)) > 4000) AS BIGINT) AS oversized, CAST(max(octet_length(encode(text))) AS BIGINT) AS largest FROM documents")
def totals_of_files(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.octet_length("text").cast("long").alias("bytes"))
    return manifests.file_totals(d, 4000)


@query("SELECT o_custkey AS path, min(o_orderkey) AS content FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL) GROUP BY 1")
def originals_to_store(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("content"), "o_orderstatus")
    return manifests.not_stored(o.select("path", "content"), o.where("o_orderstatus = 'F'"))


@query("""WITH l AS (SELECT l_orderkey AS source, l_linenumber AS at, l_partkey AS a FROM lineitem WHERE l_returnflag <> 'R'), r AS (SELECT l_orderkey AS source, l_linenumber AS at, l_suppkey AS b FROM lineitem WHERE l_linestatus = 'F')
SELECT coalesce(l.source, r.source) AS source, coalesce(l.at, r.at) AS at, a, b, CASE WHEN r.source IS NULL THEN 'left' WHEN l.source IS NULL THEN 'right' END AS only FROM l FULL JOIN r ON l.source = r.source AND l.at = r.at""")
def zipped_rows(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source"), F.col("l_linenumber").alias("at"), "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    left = line.where("l_returnflag <> 'R'").select("source", "at", F.col("l_partkey").alias("a"))
    return artifacts.zipped(left, line.where("l_linestatus = 'F'").select("source", "at", F.col("l_suppkey").alias("b")), ["source", "at"]).select("source", "at", "a", "b", "only")


_MERGED = "SELECT c_custkey AS record, CASE WHEN c_custkey % 5 = 0 THEN 'timeout' WHEN c_custkey % 7 = 0 THEN 'quota' ELSE 'ok' END AS status, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'a' || CAST(c_custkey AS VARCHAR) || ',' END || 'b1,b2' AS candidates FROM customer"


def _merged_lookups(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k, none = F.col("c_custkey"), F.array().cast("array<string>")
    first = c.select(k.alias("record"), F.lit(1).alias("number"), F.when(k % 5 == 0, "timeout").otherwise("ok").alias("status"), F.when(k % 5 == 0, none).otherwise(F.array(F.concat(F.lit("a"), k.cast("string")))).alias("candidates"))
    second = c.select(k.alias("record"), F.lit(2).alias("number"), F.when(k % 7 == 0, "quota").otherwise("ok").alias("status"), F.array(F.lit("b1"), F.lit("b2")).alias("candidates"))
    return identity.merged_lookups(second.union(first))


@query(_MERGED)
def lookups_merged(spark, sf_dir):
    return _merged_lookups(spark, sf_dir).select("record", "status", F.array_join("candidates", ",").alias("candidates"))


@query(f"SELECT o_orderkey AS record, coalesce(m.status, 'error') AS status, CASE WHEN m.record IS NULL THEN 'not_supplied' END AS error FROM orders LEFT JOIN ({_MERGED}) m ON m.record = o_orderkey")
def default_lookups(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record"))
    return identity.with_default_lookup(o, _merged_lookups(spark, sf_dir).withColumn("error", F.lit(None).cast("string"))).select("record", "status", "error")


@query("SELECT c_custkey AS record, CASE WHEN l.quality = 1 THEN 'restored ' || CAST(c_custkey AS VARCHAR) ELSE c_name END AS name FROM customer LEFT JOIN labels l ON l.doc_id = c_custkey")
def names_displayed(spark, sf_dir):
    c, label = table(spark, sf_dir, "customer"), table(spark, sf_dir, "labels").where("quality = 1")
    restored = label.select(F.col("doc_id").alias("record"), F.concat(F.lit("restored "), F.col("doc_id").cast("string")).alias("restored"))
    return identity.display_names(c.select(F.col("c_custkey").alias("record"), F.col("c_name").alias("merchant")), restored)


@query("SELECT DISTINCT lower(p_brand) AS key FROM part WHERE lower(p_brand) NOT IN (SELECT lower(p_brand) FROM part WHERE p_size > 49)")
def names_pending(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lower("p_brand").alias("key"), "p_size")
    return identity.pending_names(p.select("key").distinct(), p.where("p_size > 49"))


@query("SELECT p_brand AS key, min(p_partkey) AS position, arg_min(p_name, p_partkey) AS name FROM part GROUP BY 1")
def spellings_first(spark, sf_dir):
    return identity.first_spellings(table(spark, sf_dir, "part").select(F.col("p_brand").alias("key"), F.col("p_name").alias("name"), F.col("p_partkey").alias("position")))


_RESULT = "SELECT c_custkey AS record, CASE c_custkey % 3 WHEN 0 THEN 'no_match' WHEN 1 THEN 'unconfirmed_name' ELSE 'ambiguous' END AS reason FROM customer"


@query(f"SELECT r.record, r.reason, c_name AS merchant, m.candidates FROM ({_RESULT}) r JOIN customer ON c_custkey = record JOIN ({_MERGED}) m ON m.record = r.record AND m.status = 'ok' WHERE r.reason <> 'ambiguous' AND r.record % 4 <> 1 AND r.record IN (SELECT doc_id FROM labels WHERE quality = 0)")
def comparisons(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    results = c.select(k.alias("record"), F.lit("failed").alias("outcome"), F.when(k % 3 == 0, "no_match").when(k % 3 == 1, "unconfirmed_name").otherwise("ambiguous").alias("reason"), F.when(k % 4 == 1, "x").alias("restoration"), F.lit(None).cast("string").alias("confirmation"))
    asked = table(spark, sf_dir, "labels").where("quality = 0").select(F.col("doc_id").alias("record"))
    found = identity.comparison_candidates(asked, c.select(k.alias("record"), F.col("c_name").alias("merchant")), results, _merged_lookups(spark, sf_dir))
    return found.select("record", "reason", "merchant", F.array_join("candidates", ",").alias("candidates"))


@query(f"""SELECT o_orderkey AS record, coalesce(m.status, 'error') AS status, CASE WHEN l.quality = 1 THEN 'new name' ELSE o_orderpriority END AS name, CASE WHEN o_orderkey % 9 = 0 THEN 'place ' || CAST(o_custkey AS VARCHAR) END AS confirmed_place, CASE WHEN o_custkey % 2 = 0 THEN 'success' END AS decision
FROM orders LEFT JOIN ({_MERGED}) m ON m.record = o_orderkey LEFT JOIN labels l ON l.doc_id = o_orderkey""")
def inputs_of_geocoding(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").alias("record"), F.col("o_orderpriority").alias("merchant"), F.col("o_custkey").alias("lookup_key"))
    confirmed = o.where("o_orderkey % 9 = 0").select(F.col("o_orderkey").alias("record"), F.concat(F.lit("place "), F.col("o_custkey").cast("string")).alias("confirmed_place"))
    restored = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("record"), F.lit("new name").alias("restored"))
    previous = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("lookup_key"), F.lit("success").alias("decision"))
    return identity.geocode_inputs(rows, _merged_lookups(spark, sf_dir), confirmed, restored, previous).select("record", "status", "name", "confirmed_place", "decision")


@query("""WITH r AS (SELECT * FROM (VALUES ('BUILDING', NULL, 'p1'), ('BUILDING', 1, 'p2'), ('MACHINERY', 2, 'p3'), ('MACHINERY', NULL, 'p3')) AS t(s, n, p)), m AS (SELECT c_custkey, min(p) AS low, max(p) AS high FROM customer JOIN r ON s = c_mktsegment AND (n IS NULL OR n = c_nationkey) GROUP BY 1)
SELECT c_custkey AS record, CASE WHEN low = high THEN low END AS place, low <> high AS conflict FROM m""")
def places_confirmed(spark, sf_dir):
    said = spark.createDataFrame([("BUILDING", None, "p1"), ("BUILDING", 1, "p2"), ("MACHINERY", 2, "p3"), ("MACHINERY", None, "p3")], "segment string, nation int, place string")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    return identity.confirmed_places(rules.rule_matches(c, said, "segment", ["nation"]))


@query("SELECT n_name AS organization, n_regionkey AS department, CASE WHEN n_regionkey = 3 THEN 'city' END AS problem FROM nation WHERE n_regionkey = 3 UNION ALL SELECT n_name, n_regionkey, 'duplicate' FROM nation WHERE n_nationkey % 4 = 0")
def problems_of_scopes(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("organization"), F.col("n_regionkey").alias("department"), F.when(F.col("n_regionkey") == 3, "other").otherwise("here").alias("city"), "n_nationkey")
    twice = n.where("n_nationkey % 4 = 0 and n_regionkey <> 3").union(n.where("n_nationkey % 4 = 0 and n_regionkey = 3").withColumn("city", F.lit("here"))).drop("n_nationkey")
    return rules.scope_problems(n.drop("n_nationkey").union(twice), ["organization", "department"], "here")


@query("SELECT doc_id AS source FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'de')")
def reviews_stale(spark, sf_dir):
    reports = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source"), F.when(F.col("lang") == "de", "unresolved").otherwise("parsed").alias("status"))
    return reviews.stale_source_reviews(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("source")), reports)


@query("SELECT n_nationkey AS review FROM nation WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_mktsegment IS NOT DISTINCT FROM CASE n_nationkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'nowhere' END)")
def reviews_in_scope(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("review"), F.col("n_nationkey").alias("organization"), F.expr("CASE n_nationkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'nowhere' END").alias("segment"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("organization"), F.col("c_mktsegment").alias("segment"))
    return reviews.scoped_reviews(n, c, ["organization", "segment"]).select("review")


_LATEST = "SELECT user_id AS key, arg_max(event_type, event_id) FILTER (event_type <> 'error') AS value, max(event_id) AS top FROM events GROUP BY 1"


@query(f"SELECT c_custkey AS key, coalesce(top + 1, 1) AS revision, CASE WHEN c_custkey % 2 = 0 THEN 'view' ELSE 'click' END AS value FROM customer LEFT JOIN ({_LATEST}) l ON l.key = c_custkey WHERE value IS DISTINCT FROM CASE WHEN c_custkey % 2 = 0 THEN 'view' ELSE 'click' END")
def history_changes(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("revision"), (F.col("event_type") != "error").alias("valid"), F.col("event_type").alias("value"))
    found = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'view' ELSE 'click' END").alias("value"))
    return history.changed_entries(found, e)


@query("""WITH n AS (SELECT user_id AS key, event_id + CASE WHEN event_id % 3 = 0 THEN 1000000 ELSE 0 END AS revision, CASE WHEN event_id % 3 = 1 THEN 'changed' ELSE event_type END AS value FROM events)
SELECT n.key, n.revision, n.value, CASE WHEN e.event_id IS NULL THEN 'append' ELSE 'conflict' END AS what FROM n LEFT JOIN events e ON e.user_id = n.key AND e.event_id = n.revision WHERE e.event_id IS NULL OR e.event_type <> n.value""")
def history_appends(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("revision"), F.col("event_type").alias("value"))
    k = F.col("revision") % 3
    new = e.select("key", (F.col("revision") + F.when(k == 0, 1_000_000).otherwise(0)).alias("revision"), F.when(k == 1, "changed").otherwise(F.col("value")).alias("value"))
    fresh, conflicts = history.append_entries(e, new)
    return fresh.withColumn("what", F.lit("append")).union(conflicts.withColumn("what", F.lit("conflict"))).select("key", "revision", "value", "what")


@query("""WITH c AS (SELECT user_id AS entry_id, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2) SELECT entry_id, kind, CASE WHEN n = 1 AND entry_id % 3 <> 0 THEN 'append' ELSE 'refused' END AS what FROM c""")
def ledger_appends(spark, sf_dir):
    new = table(spark, sf_dir, "events").select(F.col("user_id").alias("entry_id"), F.col("event_type").alias("kind"))
    fresh, refused = history.append_ledger(new.where("entry_id % 3 = 0"), new)
    return fresh.select("entry_id", "kind", F.lit("append").alias("what")).union(refused.select("entry_id", "kind", F.lit("refused").alias("what")))


@query("SELECT user_id AS key, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS p FROM events) WHERE p <= 3")
def rows_last(spark, sf_dir):
    return history.last_rows(table(spark, sf_dir, "events"), ["user_id"], 3, ["ts", "event_id"]).select(F.col("user_id").alias("key"), "event_id")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS name FROM lineitem GROUP BY l_orderkey HAVING count(*) <> count(DISTINCT l_linenumber % 4 + 1) OR min(l_linenumber % 4 + 1) <> 1 OR max(l_linenumber % 4 + 1) <> count(*)")
def parts_broken(spark, sf_dir):
    return history.part_problems(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("name"), (F.col("l_linenumber") % 4 + 1).alias("part")))


# Sheets, reports, prompts.
@query("SELECT l_orderkey AS source, arg_min('failed at ' || CAST(l_linenumber AS VARCHAR), l_linenumber) FILTER (l_returnflag = 'R') AS reason FROM lineitem GROUP BY 1")
def failures_first(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return artifacts.first_failures(line.select(F.col("l_orderkey").alias("source"), F.col("l_linenumber").alias("sheet_index"), F.when(F.col("l_returnflag") == "R", F.concat(F.lit("failed at "), F.col("l_linenumber").cast("string"))).alias("reason")))


@query("SELECT l_orderkey AS source, 's' AS sheet, max(l_linenumber) FILTER (l_returnflag <> 'R') * 10 AS variant FROM lineitem GROUP BY 1")
def variants_verified(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return artifacts.first_verified(line.select(F.col("l_orderkey").alias("source"), F.lit("s").alias("sheet"), F.col("l_linenumber").alias("revision"), (F.col("l_linenumber") * 10).alias("variant"), F.when(F.col("l_returnflag") == "R", "bad").alias("problem")))


@query("SELECT conv_id, string_agg(CAST(p AS VARCHAR) || '. ' || text, chr(10) ORDER BY p) AS prompt FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS p FROM conversations) GROUP BY 1")
def prompts(spark, sf_dir):
    return artifacts.prompt_text(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text")


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations WHERE text <> '') SELECT conv_id AS source, 's' AS sheet, string_agg(CAST(turn AS VARCHAR) || ': ' || role || ' | ' || left(text, 40), chr(10) ORDER BY turn) AS preview FROM l WHERE p <= 12 GROUP BY 1""")
def previews(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").where("text <> ''").select(F.col("conv_id").alias("source"), F.lit("s").alias("sheet"), F.col("turn").alias("row"), F.array("role", "text").alias("cells"))
    return artifacts.sheet_preview(rows)


@query("""WITH e AS (SELECT event_type, event_id, user_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS p, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, p AS number, 'user ' || CAST(user_id AS VARCHAR) AS line FROM e WHERE p <= 20 UNION ALL SELECT DISTINCT event_type, 21, 'and ' || CAST(n - 20 AS VARCHAR) || ' more' FROM e WHERE n > 20""")
def report_lines(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("text", F.concat(F.lit("user "), F.col("user_id").cast("string")))
    return artifacts.top_with_rest(e, "event_type", [F.col("event_id")], "text").withColumn("number", F.col("number").cast("long"))


@query("""SELECT user_id, CASE WHEN p + v + s > 0 THEN concat_ws(', ', CASE WHEN p > 0 THEN 'purchases ' || format('{:,}', p) || '건' END, CASE WHEN v > 0 THEN 'views ' || format('{:,}', v) || '건' END, CASE WHEN s > 0 THEN 'thousands ' || format('{:,}', s) || '건' END) END AS sentence
FROM (SELECT user_id, count(*) FILTER (event_type = 'purchase' AND event_id % 7 = 0) AS p, count(*) FILTER (event_type = 'view' AND event_id % 5 = 0) AS v, 1000 * count(*) FILTER (event_type = 'error' AND event_id % 3 = 0) AS s FROM events GROUP BY 1)""")
def sentences(spark, sf_dir):
    n = lambda kind, k: F.count_if((F.col("event_type") == kind) & (F.col("event_id") % k == 0))
    c = table(spark, sf_dir, "events").groupBy("user_id").agg(n("purchase", 7).alias("p"), n("view", 5).alias("v"), (1000 * n("error", 3)).alias("s"))
    return c.select("user_id", artifacts.scope_sentence([("purchases", F.col("p")), ("views", F.col("v")), ("thousands", F.col("s"))]).alias("sentence"))


@query("SELECT user_id, event_type AS scenario, CAST(count(*) AS BIGINT) AS value FROM events GROUP BY 1, 2")
def summaries(spark, sf_dir):
    each = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("found"))
    return artifacts.summary_rows(each, ["user_id"], "found")


# Sheets of two sections: lines 1 and 2, a subtotal, their total; a repeated header, the other lines, a total told by its count
# (wrong for every 10th order), an unclear total for every 6th order, a note for every 7th.
_TWO = "s AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)"


def _two_sections(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("p"), F.to_date("l_shipdate").alias("d"))
    early = F.col("l_linenumber") <= 2
    shown = lambda x: F.array(F.lit(""), x["d"].cast("string"), F.concat(F.lit("part "), x["l_partkey"].cast("string")), x["p"].cast("string"))
    lines = lambda cond, name: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("l_linenumber", "l_partkey", "p", "d")))), shown).alias(name)
    sums = line.groupBy("k").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(early, F.col("p"))), F.lit(0)).alias("s1"), F.coalesce(F.sum(F.when(~early, F.col("p"))), F.lit(0)).alias("s2"), lines(early, "first"), lines(~early, "second"))
    row = lambda *cells: F.array(F.array(*[c if not isinstance(c, str) else F.lit(c) for c in cells]))
    none = F.array().cast("array<array<string>>")
    head = row("No", "일 자", "상호", "금액")
    cells = F.concat(
        head, "first", row("소 계", "", "", "1"), row("계", "", "", F.col("s1").cast("string")), row("N o", "일자", "상 호", "금액"), "second",
        row(F.concat(F.col("n").cast("string"), F.lit(" 건")), "", "", (F.col("s2") + F.when(F.col("k") % 10 == 0, 1).otherwise(0)).cast("string")),
        F.when(F.col("k") % 6 == 0, row("3월 누계", "", "", "5")).otherwise(none), F.when(F.col("k") % 7 == 0, row("참고", "", "", "")).otherwise(none),
    )
    rows = sums.select(F.lit("s").alias("source"), F.col("k").cast("string").alias("sheet"), F.posexplode(cells).alias("at", "cells"))
    columns = F.create_map(*[F.lit(x) for kv in (("spent_on", 1), ("merchant", 2), ("amount_krw", 3)) for x in kv])
    maps = sums.select(F.lit("s").alias("source"), F.col("k").cast("string").alias("sheet"), F.lit("table").alias("layout"), F.array(F.lit(1)).alias("header_rows"), F.lit(2).alias("data_start"), columns.alias("columns"), F.lit(1).alias("multiplier"))
    return rows.select("source", "sheet", (F.col("at") + 1).alias("row"), "cells"), maps


@query(f"""WITH {_TWO} SELECT CAST(k AS VARCHAR) AS sheet, 'candidate' AS kind, CAST(n AS BIGINT) AS sheet_rows FROM s UNION ALL SELECT CAST(k AS VARCHAR), t.kind, t.c FROM s, (VALUES ('header', 1), ('subtotal', 1), ('total', 2)) AS t(kind, c)
UNION ALL SELECT CAST(k AS VARCHAR), 'unclear_total', 1 FROM s WHERE k % 6 = 0 UNION ALL SELECT CAST(k AS VARCHAR), 'note', 1 FROM s WHERE k % 7 = 0""")
def kinds_of_sections(spark, sf_dir):
    return sheets.classify_rows(*_two_sections(spark, sf_dir)).groupBy("sheet", "kind").agg(F.count("*").alias("sheet_rows"))


@query(f"WITH {_TWO} SELECT CAST(k AS VARCHAR) AS sheet, CAST(n AS BIGINT) AS candidates, CASE WHEN k % 10 = 0 THEN 'mismatch' WHEN k % 6 = 0 THEN 'ambiguous' ELSE 'matched' END AS total_check FROM s")
def totals_of_sections(spark, sf_dir):
    return sheets.extract_sheets(*_two_sections(spark, sf_dir), START, END)[1].select("sheet", "candidates", "total_check")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS sheet, CAST(CASE WHEN l_linenumber <= 2 THEN 0 ELSE 1 END AS BIGINT) AS section, CAST(count(*) AS BIGINT) AS records FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' GROUP BY 1, 2")
def records_of_sections(spark, sf_dir):
    found, _ = sheets.extract_sheets(*_two_sections(spark, sf_dir), START, END)
    return found.groupBy("sheet", "section").agg(F.count("*").alias("records"))


@query("SELECT l_orderkey AS source, l_linenumber AS row, 'non_positive_amount' AS flag FROM lineitem WHERE l_extendedprice <= 20000")
def flags_for_review(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source"), F.lit("s").alias("sheet"), F.col("l_linenumber").alias("row"), (F.col("l_extendedprice") - 20000).alias("amount"))
    return sheets.review_flags(line).drop("sheet")


@query("SELECT CAST(k % 500 AS VARCHAR) AS source, CAST(k AS VARCHAR) AS sheet, CAST(CASE WHEN k % 5 = 4 THEN 2 WHEN k % 10 = 0 THEN 3 ELSE 1 END AS INT) AS revision, k % 5 <> 4 AND k % 10 <> 0 AS verified FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem) WHERE k % 5 <> 3")
def headers_resolved(spark, sf_dir):
    """Mappings of a header in three revisions: 2 has its columns mixed up, 3 reads the total row as data; sheets whose signature has revisions to choose from."""
    rows, maps = _sheet_rows(spark, sf_dir)
    k = F.col("sheet").cast("long")
    signature = F.when(k % 5 == 3, "unknown").when(k % 5 == 4, "mixed").when(k % 10 == 0, "late").otherwise("good")
    tables = maps.select("source", "sheet", signature.alias("signature"))
    columns = lambda a, b, c: {"spent_on": a, "merchant": b, "amount_krw": c}
    known = [("good", 1, columns(1, 2, 3)), ("good", 2, columns(2, 1, 3)), ("mixed", 1, columns(3, 2, 1)), ("mixed", 2, columns(2, 1, 3)), ("late", 1, columns(1, 2, 3)), ("late", 3, columns(1, 2, 0))]
    variants = spark.createDataFrame([(s, r, "table", [1], 2, c, 1) for s, r, c in known], "signature string, revision int, layout string, header_rows array<int>, data_start int, columns map<string,int>, multiplier int")
    return sheets.resolve_headers(rows, tables, F.broadcast(variants), START, END)


@query("SELECT CAST(min(doc_id) AS VARCHAR) AS key, 1 AS revision, lang AS value FROM documents WHERE lang <> 'de' GROUP BY lang")
def headers_remembered(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("lang is not null").groupBy("lang").agg(F.min("doc_id").cast("string").alias("key"))
    found = d.select("key", F.col("lang").alias("value"), F.when(F.col("lang") == "de", "bad").alias("problem"), F.array(F.lit(1)).alias("header_rows"), F.lit(2).alias("data_start"))
    low = found.where("problem is null").select(F.concat(F.lit("x"), "key").alias("key"), "value", "problem", F.array(F.lit(3)).alias("header_rows"), F.lit(3).alias("data_start"))
    none = spark.createDataFrame([], "key string, revision int, valid boolean, value string")
    return history.remembered_headers(found.union(low), none)


@query("""SELECT p_partkey AS sheet, CASE p_partkey % 4 WHEN 1 THEN 'duplicate role' WHEN 2 THEN 'column out of bounds' WHEN 3 THEN 'data start before header' END AS problem, CASE WHEN p_partkey % 4 = 0 THEN 'amount_krw=2,merchant=1' END AS columns, CASE WHEN p_size > 25 THEN 1000 ELSE 1 END AS multiplier FROM part""")
def mappings_settled(spark, sf_dir):
    k = F.col("p_partkey") % 4
    pair = lambda c, r: F.struct(c.alias("column"), r.alias("role"))
    answers = table(spark, sf_dir, "part").select(
        F.lit("s").alias("source"), F.col("p_partkey").alias("sheet"), F.lit("table").alias("layout"), F.array(F.lit(3)).alias("header_rows"), F.when(k == 3, 3).otherwise(4).alias("data_start"),
        F.array(pair(F.lit(1), F.lit("merchant")), pair(F.when(k == 2, 9).otherwise(2), F.when(k == 1, "merchant").otherwise("amount_krw"))).alias("columns"), F.when(F.col("p_size") > 25, "thousand").otherwise("one").alias("unit"), F.lit(5).alias("width"),
    )
    found = rules.settled_mapping(answers)
    said = F.array_join(F.array_sort(F.transform(F.map_entries("columns"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ",")
    return found.select("sheet", "problem", said.alias("columns"), "multiplier")


@query("""WITH m AS (SELECT l_orderkey AS batch, l_linenumber AS i, min(l_partkey) AS name, max(l_returnflag) = 'R' AND l_linenumber = 2 AS wrong FROM lineitem GROUP BY 1, 2) SELECT batch, i AS index, name, 'yes' AS status FROM m WHERE batch NOT IN (SELECT batch FROM m WHERE wrong)""")
def batches_verified(spark, sf_dir):
    asked = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("index")).agg(F.min("l_partkey").alias("name"), F.max("l_returnflag").alias("flag"))
    said = asked.select("batch", "index", F.when((F.col("flag") == "R") & (F.col("index") == 2), F.lit(-1)).otherwise(F.col("name")).alias("name"), F.lit("yes").alias("status"))
    return rules.verified_batches(asked.drop("flag"), said)


@query("""SELECT doc_id AS source, CAST(count(*) AS BIGINT) AS candidates, CAST(count(*) FILTER (length(line) % 3 <> 0) AS BIGINT) AS kept, CAST(count(*) FILTER (length(line) % 3 = 0) AS BIGINT) AS repeated FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def counts_repeated(spark, sf_dir):
    line = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source"), F.explode(F.split("text", "\n", -1)).alias("line"))
    return reposts.repeated_counts(line, line.where("length(line) % 3 <> 0"))


# Measurements.
@query("""WITH c AS (SELECT user_id, sum(CAST(round(abs(value), 2) AS DECIMAL(18,2))) FILTER (event_type = 'view') AS idle, sum(CAST(round(abs(value), 2) AS DECIMAL(18,2))) AS total FROM events WHERE value IS NOT NULL GROUP BY 1) SELECT round(100e0 * (1 - sum(idle) / sum(total)), 6) AS busy_percent FROM c""")
def busy(spark, sf_dir):
    amount = F.round(F.abs("value"), 2).cast("decimal(18,2)")
    after = table(spark, sf_dir, "events").where("value is not null").groupBy(F.col("user_id").alias("core")).agg(F.coalesce(F.sum(F.when(F.col("event_type") == "view", amount)), F.lit(0)).alias("idle"), F.sum(amount).alias("total"))
    before = after.select("core", F.lit(0).alias("idle"), F.lit(0).alias("total"))
    return traces.busy_percent(before, after).select(F.round(F.col("busy_percent").cast("double"), 6).alias("busy_percent"))


@query("""WITH s AS (SELECT user_id AS parent, event_type AS origin, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1, 2) SELECT parent, arg_min(origin, -n * 10000000 + first) AS origin FROM s GROUP BY 1""")
def origins_nested(spark, sf_dir):
    return traces.nested_origin(table(spark, sf_dir, "events").select(F.col("user_id").alias("parent"), F.col("event_type").alias("origin"), F.col("event_id").alias("start")))


@query("""WITH f AS (SELECT DISTINCT user_id AS trace, epoch_us(ts) AS ts, event_type FROM events), h AS (SELECT DISTINCT trace FROM f WHERE event_type = 'signup') SELECT DISTINCT trace, ts FROM f WHERE event_type = 'signup' OR (event_type = 'view' AND trace NOT IN (SELECT trace FROM h))""")
def frames_presented(spark, sf_dir):
    kind = F.when(F.col("event_type") == "signup", "presented").when(F.col("event_type") == "view", "drawn").otherwise("other")
    return traces.presented_frames(table(spark, sf_dir, "events").select(F.col("user_id").alias("trace"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), kind.alias("kind")))


@query("""SELECT user_id AS trace, event_type AS origin, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(round(value, 2) AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(max(CAST(round(value, 2) AS DECIMAL(18,2))) AS DOUBLE) AS longest FROM events WHERE CAST(round(value, 2) AS DECIMAL(18,2)) >= 50 GROUP BY 1, 2""")
def source_sums(spark, sf_dir):
    tasks = table(spark, sf_dir, "events").where("value is not null").select(F.col("user_id").alias("trace"), F.col("event_type").alias("origin"), F.round("value", 2).cast("decimal(18,2)").alias("duration"))
    return traces.source_attribution(tasks)[0].select("trace", "origin", "n", F.col("total").cast("double").alias("total"), F.col("longest").cast("double").alias("longest"))


@query("""WITH f AS (SELECT user_id AS trace, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) AS ts FROM events), g AS (SELECT trace, ts - lag(ts) OVER (PARTITION BY trace ORDER BY ts) AS gap FROM f),
i AS (SELECT trace, max(gap) AS longest, count(*) FILTER (gap >= 33.3e0) AS stutters, count(*) FILTER (gap >= 100) AS freezes FROM g WHERE gap IS NOT NULL GROUP BY 1),
t AS (SELECT user_id AS trace, event_id AS id, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) AS a, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) + CAST(floor(abs(value)) AS BIGINT) AS b FROM events WHERE value IS NOT NULL AND abs(value) >= 50),
o AS (SELECT trace, count(*) AS n FROM t x WHERE NOT EXISTS (SELECT 1 FROM t y WHERE y.trace = x.trace AND y.id <> x.id AND x.a >= y.a AND x.b <= y.b AND NOT (x.a = y.a AND x.b = y.b AND x.id < y.id)) GROUP BY 1)
SELECT i.trace, longest, CAST(stutters AS BIGINT) AS stutters, CAST(freezes AS BIGINT) AS freezes, CAST(coalesce(n, 0) AS BIGINT) AS long_tasks FROM i LEFT JOIN o ON o.trace = i.trace""")
def trace_summaries(spark, sf_dir):
    minute = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000)
    e = table(spark, sf_dir, "events")
    tasks = e.where("value is not null").select(F.col("user_id").alias("trace"), F.col("event_id").alias("id"), minute.alias("start"), (minute + F.floor(F.abs("value"))).alias("stop"))
    return traces.summarize_traces(e.select(F.col("user_id").alias("trace"), minute.alias("ts")), tasks)
