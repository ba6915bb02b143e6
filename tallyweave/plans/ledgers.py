"""Queries on ledgers, sheets, reposts and rules, over the supplied tables, with the same rows in SQL.

A record is an order; a sheet is an order's lines with a header and a total; a source is a document, and an expense a line of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import amounts, dates, keys, text
from tallyweave.operators import history, manifests, reposts, rules, sheets

QUERIES: dict = {}
SQL: dict[str, str] = {}
START, END = dt.date(1996, 1, 1), dt.date(1996, 6, 30)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""SELECT substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 16) || '-orders-R' || CAST(o_orderkey AS VARCHAR) AS record_id,
  CAST(o_orderdate AS DATE) AS spent_on, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders""")
def ledger_scan(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(keys.record_id(F.sha2(F.col("o_orderkey").cast("string"), 256), F.lit("orders"), F.col("o_orderkey")).alias("record_id"), F.to_date("o_orderdate").alias("spent_on"), F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("amount"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS spent_on FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'")
def period_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("spent_on"))
    return o.where(dates.in_period(F.col("spent_on"), START, END))


def _titled(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    y, q, m, k = F.year("d").cast("string"), F.quarter("d").cast("string"), F.month("d").cast("string"), F.col("o_orderkey") % 6
    title = (
        F.when(k == 0, F.concat(y, F.lit("년 "), q, F.lit("/4분기 내역")))
        .when(k == 1, F.concat(y, F.lit("년도 "), q, F.lit(" ~ 4분기")))
        .when(k == 2, F.concat(y, F.lit("."), q, F.lit("분기")))
        .when(k == 3, F.concat(y, F.lit("년 "), m, F.lit("월~12월")))
        .when(k == 4, F.concat(F.lit("공개 "), F.substring(y, 3, 2), F.lit("년 "), m, F.lit("월")))
        .otherwise(F.concat(y, F.lit("년 "), F.when(F.month("d") <= 6, "상").otherwise("하"), F.lit("반기")))
    )
    return o.withColumn("title", title)


@query("""WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q, CAST(month(o_orderdate) AS INT) AS m, o_orderkey % 6 AS k FROM orders),
s AS (SELECT o_orderkey, CASE WHEN k = 4 THEN 2000 + y % 100 ELSE y END AS y,
  CASE WHEN k IN (0, 1, 2) THEN 3 * q - 2 WHEN k IN (3, 4) THEN m WHEN m <= 6 THEN 1 ELSE 7 END AS a,
  CASE WHEN k IN (0, 2) THEN 3 * q WHEN k IN (1, 3) THEN 12 WHEN k = 4 THEN m WHEN m <= 6 THEN 6 ELSE 12 END AS b FROM o)
SELECT o_orderkey, make_date(y, a, 1) AS span_start, last_day(make_date(y, b, 1)) AS span_end FROM s""")
def title_span(spark, sf_dir):
    span = dates.declared_period(F.col("title"))
    return _titled(spark, sf_dir).select("o_orderkey", span["start"].alias("span_start"), span["end"].alias("span_end"))


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
p AS (SELECT k, CASE WHEN k % 11 = 0 THEN NULL ELSE d END AS posted, CASE WHEN k % 7 = 0 THEN 0 WHEN k % 5 = 0 THEN 1 ELSE 2 END AS t, month(d) AS m, year(d) AS y FROM o)
SELECT CASE WHEN posted IS NULL AND t = 0 THEN 'target' WHEN posted IS NULL OR year(posted) <> 1996 THEN 'posted_out_of_range'
  WHEN t < 2 THEN 'undeclared_in_year' WHEN y = 1996 AND m <= 6 THEN 'target' ELSE 'declared_out_of_range' END AS reason, CAST(count(*) AS BIGINT) AS postings FROM p GROUP BY 1""")
def exclusion_ladder(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("d"))
    title = F.when(F.col("k") % 7 == 0, F.lit(None).cast("string")).when(F.col("k") % 5 == 0, "업무추진비").otherwise(F.concat(F.year("d").cast("string"), F.lit("년 "), F.month("d").cast("string"), F.lit("월 집행내역")))
    posted = F.when(F.col("k") % 11 != 0, F.col("d"))
    return o.select(F.coalesce(dates.exclusion_reason(posted, title, START, END), F.lit("target")).alias("reason")).groupBy("reason").agg(F.count("*").alias("postings"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 2 AND year(o_orderdate) < 2000 THEN NULL WHEN o_orderkey % 6 = 4 THEN make_date(CAST(2000 + year(o_orderdate) % 100 AS INT), CAST(month(o_orderdate) AS INT), CAST(day(o_orderdate) AS INT)) ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def parse_date_notations(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    k, form = F.col("o_orderkey") % 6, lambda p: F.date_format("d", p)
    raw = F.when(k == 0, form("yyyy-MM-dd")).when(k == 1, F.concat(form("yyyy.M.d"), F.lit(".(수)"))).when(k == 2, form("yyyyMMdd")).when(k == 3, F.concat(form("yyyy"), F.lit("년 "), form("M"), F.lit("월 "), form("d"), F.lit("일"))).when(k == 4, F.concat(F.lit("'"), form("yy. M. d."), F.lit(" 12:15"))).otherwise(form("M/d"))
    return o.withColumn("raw", raw).select("o_orderkey", dates.parse_date_text(F.col("raw"), F.year("d")).alias("parsed"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) WHEN 1 THEN -CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) WHEN 2 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount FROM orders""")
def parse_amount(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("a", F.col("o_totalprice").cast("decimal(18,2)"))
    k, s = F.col("o_orderkey") % 4, F.col("a").cast("string")
    raw = F.when(k == 0, F.concat(F.format_number("a", 2), F.lit("원"))).when(k == 1, F.concat(F.lit("△"), s)).when(k == 2, F.concat(s, F.lit("e3"))).otherwise(F.concat(F.lit(" "), s, F.lit(" 원")))
    return o.withColumn("raw", raw).select("o_orderkey", amounts.parse_amount(F.col("raw")).cast("double").alias("amount"))


# Sheets: header in row 1; the order's lines; a total (wrong for every 10th order), then a note for every 7th order.
_SHEET = """l AS (SELECT l_orderkey AS k, CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_shipdate AS DATE) AS d FROM lineitem),
s AS (SELECT k, count(*) AS n, sum(p) AS total, count(*) FILTER (d NOT BETWEEN DATE '1996-01-01' AND DATE '1996-06-30') AS far FROM l GROUP BY k)"""


def _sheet_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("p"), F.to_date("l_shipdate").alias("d"))
    sums = line.groupBy("k").agg(F.count("*").alias("n"), F.sum("p").alias("total"), F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "p", "d"))), lambda x: F.array(F.lit(""), x["d"].cast("string"), F.concat(F.lit("part "), x["l_partkey"].cast("string")), x["p"].cast("string"))).alias("lines"))
    shown = F.col("total") + F.when(F.col("k") % 10 == 0, 1).otherwise(0)
    head = F.array(F.array(F.lit("No"), F.lit("일 자"), F.lit("상호"), F.lit("금액")))
    foot = F.array(F.array(F.lit("합 계"), F.lit(""), F.lit(""), shown.cast("string")))
    note = F.when(F.col("k") % 7 == 0, F.array(F.array(F.lit("참고"), F.lit(""), F.lit(""), F.lit("")))).otherwise(F.array().cast("array<array<string>>"))
    rows = sums.select((F.col("k") % 500).cast("string").alias("source"), F.col("k").cast("string").alias("sheet"), F.posexplode(F.concat(head, "lines", foot, note)).alias("at", "cells"))
    columns = F.create_map(*[F.lit(x) for kv in (("spent_on", 1), ("merchant", 2), ("amount_krw", 3)) for x in kv])
    maps = sums.select((F.col("k") % 500).cast("string").alias("source"), F.col("k").cast("string").alias("sheet"), F.lit("table").alias("layout"), F.array(F.lit(1)).alias("header_rows"), F.lit(2).alias("data_start"), columns.alias("columns"), F.lit(1).alias("multiplier"))
    return rows.select("source", "sheet", (F.col("at") + 1).alias("row"), "cells"), maps


@query(f"""WITH {_SHEET} SELECT CAST(k AS VARCHAR) AS sheet, 'candidate' AS kind, CAST(n AS BIGINT) AS sheet_rows FROM s
UNION ALL SELECT CAST(k AS VARCHAR), 'total', CAST(1 AS BIGINT) FROM s UNION ALL SELECT CAST(k AS VARCHAR), 'note', CAST(1 AS BIGINT) FROM s WHERE k % 7 = 0""")
def row_kind(spark, sf_dir):
    return sheets.classify_rows(*_sheet_rows(spark, sf_dir)).groupBy("sheet", "kind").agg(F.count("*").alias("sheet_rows"))


@query(f"""WITH {_SHEET} SELECT CAST(k AS VARCHAR) AS sheet, CAST(n AS BIGINT) AS candidates, CAST(far AS BIGINT) AS out_of_range,
CASE WHEN k % 10 = 0 THEN 'mismatch' ELSE 'matched' END AS total_check FROM s""")
def section_totals(spark, sf_dir):
    return sheets.extract_sheets(*_sheet_rows(spark, sf_dir), START, END)[1].select("sheet", "candidates", "out_of_range", "total_check")


@query(f"""WITH {_SHEET} SELECT CAST(k % 500 AS VARCHAR) AS source, CASE WHEN bool_or(k % 10 = 0) THEN 'unresolved' ELSE 'parsed' END AS status,
CASE WHEN bool_or(k % 10 = 0) THEN 'validation_failed' END AS reason, CAST(sum(n) AS BIGINT) AS candidates,
CAST(CASE WHEN bool_or(k % 10 = 0) THEN 0 ELSE sum(n) - sum(far) END AS BIGINT) AS records FROM s GROUP BY k % 500""")
def all_or_nothing_sources(spark, sf_dir):
    kept, reports = sheets.accept_sources(*sheets.extract_sheets(*_sheet_rows(spark, sf_dir), START, END))
    counts = kept.groupBy("source").agg(F.count("*").alias("records"))
    return reports.join(counts, "source", "left").select("source", "status", "reason", "candidates", F.coalesce("records", F.lit(0)).alias("records"))


@query("""WITH s AS (SELECT l_orderkey AS k, CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE count(*) END AS c FROM lineitem GROUP BY l_orderkey)
SELECT k % 500 AS source, CASE WHEN bool_and(coalesce(c > 0, false)) THEN CAST(sum(c) AS BIGINT) END AS candidates FROM s GROUP BY 1""")
def denominator_unknown(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("c"))
    return sheets.unresolved_denominators(s.select((F.col("l_orderkey") % 500).alias("source"), F.when(F.col("l_orderkey") % 97 != 0, F.col("c")).alias("candidates")))


#: The scrubbing of purposes, for texts without Hangul (which alone names personal events and masked names).
_SCRUBBED = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[0-9]{6}\s*-\s*[1-4][0-9]{6}', ' ', 'g'), '(^|[^0-9])0[0-9]{1,2}[-. )][0-9]{3,4}[-. ][0-9]{4}($|[^0-9])', '\1 \2', 'g'), '[\pL\pM\pN_.+-]+@[\pL\pM\pN_-]+(\.[\pL\pM\pN_-]+)+', ' ', 'g'), '\s+', ' ', 'g'))"""


@query(f"SELECT doc_id, md5({_SCRUBBED}) AS scrubbed FROM documents")
def pii_scrub(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(text.scrub_purpose(F.col("text")).cast("binary")).alias("scrubbed"))


_CONTACTS = r"""regexp_replace(regexp_replace(regexp_replace({0}, '[0-9]{{6}}\s*-\s*[1-4][0-9]{{6}}', ' ', 'g'), '(^|[^0-9])0[0-9]{{1,2}}[-. )][0-9]{{3,4}}[-. ][0-9]{{4}}($|[^0-9])', '\1 \2', 'g'), '[\pL\pM\pN_.+-]+@[\pL\pM\pN_-]+(\.[\pL\pM\pN_-]+)+', ' ', 'g')"""
#: An event's name stands at the start of a word, or after four other words; 故 stands anywhere.
_EVENT = "(^|[^가-힣]|직원|경사|애사|소속)(축의|부의|조의|축부의|경조사|애경사|별세|빙모|빙부|모친상|부친상|장인상|장모상|장례|근조|순직)|故"
_MASK = r"[가-힣](\s*[*＊○◯ㅇ]){1,2}"


def _scrub_sql(rows: str) -> str:
    """doc_id, purpose and merchant of a relation of the same columns, with all patterns; white space is of ASCII or U+3000."""
    tight = r"regexp_replace(merchant, '[\s\x{3000}]+', '', 'g')"
    return rf"""WITH r AS ({rows}), c AS (SELECT doc_id, merchant, purpose AS said, {_CONTACTS.format("purpose")} AS purpose FROM r),
b AS (SELECT doc_id, merchant, said, CASE WHEN regexp_matches(purpose, '{_EVENT}') THEN regexp_replace(purpose, '\([^)]*\)', ' ', 'g') ELSE purpose END AS purpose FROM c)
SELECT doc_id, trim(regexp_replace(regexp_replace(purpose, '{_MASK}(\s*[가-힣]($|[^가-힣]))?', ' \3', 'g'), '[\s\x{{3000}}]+', ' ', 'g')) AS purpose,
CASE WHEN regexp_matches(trim(merchant), '^{_MASK}(\s*[가-힣])?$') OR regexp_matches({tight}, '^{_MASK}[가-힣]?$')
  OR (regexp_matches({tight}, '^[가-힣]{{2,4}}$') AND {tight} NOT IN ({", ".join(f"'{w}'" for w in text.GENERIC_PAYEES)}) AND regexp_matches(said, '{_EVENT}')) THEN '{text.REDACTED_PAYEE}' ELSE merchant END AS merchant FROM b"""


@query(_scrub_sql("SELECT doc_id, text AS purpose, source AS merchant FROM documents"))
def pii_scrub_full(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.scrub_purpose(F.col("text")).alias("purpose"), text.scrub_merchant(F.col("source"), F.col("text")).alias("merchant"))


#: What stands before a document's text, and who was paid: by doc_id modulo their number.
_LEADS = ["故(Kim 3) ", "직원 부의금(홍길동 부친) ", "정부의 행사(점심) ", "김ㅇㅇ 면담 허 * * ", "축의(가) 박○수 ", "（故）　(전각) ", "환경조성(개인) 한*지", "소속근조(x) 010-1234-5678 ", ""]
_PAYEES = ["홍길동", "박○수", "직원", "김 * 민", "김밥 천국", "홍　길동", "src"]


def _chosen(words: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN doc_id % {len(words)} = {k} THEN '{w}'" for k, w in enumerate(words)) + " END"


@query(_scrub_sql(f"SELECT doc_id, {_chosen(_LEADS)} || text AS purpose, {_chosen(_PAYEES)} AS merchant FROM documents"))
def pii_scrub_events(spark, sf_dir):
    d = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_chosen(_LEADS)} || text as purpose", f"{_chosen(_PAYEES)} as merchant")
    return d.select("doc_id", text.scrub_purpose(F.col("purpose")).alias("purpose"), text.scrub_merchant(F.col("merchant"), F.col("purpose")).alias("merchant"))


# Reposts: a document's trimmed lines that are not empty are its expenses.
_LINES = """lines AS (SELECT doc_id AS source, md5(trim(line)) AS expense, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> '' GROUP BY 1, 2),
pairs AS (SELECT x.source AS a, y.source AS b, CAST(sum(least(x.n, y.n)) AS BIGINT) AS shared FROM lines x JOIN lines y ON x.expense = y.expense AND x.source < y.source GROUP BY 1, 2 HAVING sum(least(x.n, y.n)) >= 2)"""
_CLOSED = """, links AS (SELECT x.expense, p.a, p.b FROM pairs p JOIN lines x ON x.source = p.a JOIN lines y ON y.source = p.b AND y.expense = x.expense),
both_ways AS (SELECT expense, a, b FROM links UNION ALL SELECT expense, b, a FROM links),
reach AS (SELECT expense, source, source AS other FROM lines UNION SELECT r.expense, r.source, l.b FROM reach r JOIN both_ways l ON l.expense = r.expense AND l.a = r.other),
comp AS (SELECT expense, source, min(other) AS component FROM reach GROUP BY 1, 2)"""
_KEPT = """, sized AS (SELECT c.expense, c.component, c.source, l.n, row_number() OVER (PARTITION BY c.expense, c.component ORDER BY l.n DESC, c.source) AS place FROM comp c JOIN lines l ON l.expense = c.expense AND l.source = c.source),
best AS (SELECT expense, component, min(CASE WHEN place = 1 THEN source END) AS keeper, max(n) AS kept, CAST(sum(n) AS BIGINT) AS total FROM sized GROUP BY 1, 2)"""


def _expenses(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return d.where(F.trim("line") != "").select("source", F.md5(F.trim("line").cast("binary")).alias("expense"), F.col("at").cast("string").alias("location"))


def _ranks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source"), F.col("doc_id").alias("rank"))


@query(f"WITH {_LINES} SELECT a, b, shared FROM pairs")
def multiset_overlap(spark, sf_dir):
    return reposts.repost_pairs(reposts.expense_counts(_expenses(spark, sf_dir)))


@query(f"WITH RECURSIVE {_LINES}{_CLOSED} SELECT expense, source, component FROM comp")
def repost_components(spark, sf_dir):
    return reposts.repost_components(reposts.expense_counts(_expenses(spark, sf_dir))).drop("n")


@query(f"WITH RECURSIVE {_LINES}{_CLOSED}{_KEPT} SELECT expense, component, keeper, kept, total FROM best")
def repost_keepers(spark, sf_dir):
    counts = reposts.expense_counts(_expenses(spark, sf_dir))
    return reposts.keepers(counts, reposts.repost_components(counts), _ranks(spark, sf_dir))


@query(f"""WITH RECURSIVE {_LINES}{_CLOSED}{_KEPT}, e AS (SELECT expense, sum(n) AS total, max(n) AS most FROM lines GROUP BY 1),
d AS (SELECT expense, sum(total - kept) AS dropped FROM best GROUP BY 1), f AS (SELECT dropped, total - dropped - most AS unmerged FROM e JOIN d USING (expense))
SELECT CAST(count(*) FILTER (dropped > 0) AS BIGINT) AS merged_expenses, CAST(sum(dropped) AS BIGINT) AS merged_records,
CAST(count(*) FILTER (unmerged > 0) AS BIGINT) AS unmerged_expenses, CAST(sum(unmerged) AS BIGINT) AS unmerged_records,
CAST(0 AS BIGINT) AS confirmed_expenses, CAST(0 AS BIGINT) AS confirmed_records, CAST(0 AS BIGINT) AS separate_expenses, CAST(0 AS BIGINT) AS separate_records FROM f""")
def repost_tally(spark, sf_dir):
    return reposts.merge_repeats(_records(spark, sf_dir), _sources(spark, sf_dir))[1]


def _records(spark, sf_dir) -> DataFrame:
    e = _expenses(spark, sf_dir)
    return e.select(F.concat_ws(":", F.col("source").cast("string"), "location").alias("record"), F.lpad(F.col("source").cast("string"), 19, "0").alias("source"), "expense", "location")


def _sources(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 19, "0").alias("source"), F.lit(None).cast("date").alias("posted"))


_CONFIRMED = """said AS (SELECT expense, min(source) AS a, max(source) AS b, substr(expense, 1, 1) AS d FROM lines GROUP BY expense HAVING count(*) = 2 AND substr(expense, 1, 1) IN ('0', '1')),
fair AS (SELECT x.expense, x.source AS a, y.source AS b, least(x.n, y.n) AS n FROM lines x JOIN lines y ON x.expense = y.expense AND x.source < y.source WHERE (x.expense, x.source, y.source) NOT IN (SELECT (expense, a, b) FROM said WHERE d = '1')),
rule AS (SELECT a, b FROM fair GROUP BY 1, 2 HAVING sum(n) >= 2), links AS (SELECT f.expense, f.a, f.b FROM fair f JOIN rule r ON f.a = r.a AND f.b = r.b UNION SELECT expense, a, b FROM said WHERE d = '0')"""


@query(f"""WITH RECURSIVE {_LINES.split(chr(10))[0].rstrip(",")}, {_CONFIRMED}, {_CLOSED.split(chr(10), 1)[1]}{_KEPT},
r AS (SELECT doc_id AS source, i - 1 AS location, md5(trim(lines[i])) AS expense FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents) WHERE trim(lines[i]) <> '')
SELECT CAST(r.source AS VARCHAR) || ':' || CAST(location AS VARCHAR) AS record, lpad(CAST(r.source AS VARCHAR), 19, '0') AS source, r.expense, CAST(total - kept AS INT) AS n_repeats FROM r JOIN best b ON b.expense = r.expense AND b.keeper = r.source""")
def repost_with_confirmations(spark, sf_dir):
    """Of the expenses of several sources, those whose digest begins with 0 are declared the same, those with 1 separate, in their two least sources."""
    kept, _ = _confirmed_merge(spark, sf_dir)
    return kept.select("record", "source", "expense", F.size("repeats").alias("n_repeats"))


def _confirmed_merge(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    records, sources = _records(spark, sf_dir), _sources(spark, sf_dir)
    several = records.select("expense", "source").distinct().groupBy("expense").agg(F.array_sort(F.collect_set("source")).alias("s")).where("size(s) = 2 and substr(expense, 1, 1) in ('0', '1')")
    said = several.select("expense", F.when(F.substring("expense", 1, 1) == "0", "same_expense").otherwise("separate_expenses").alias("decision"), F.col("s").alias("sources"))
    return reposts.merge_repeats(records, sources, said)


#: As _CLOSED and _KEPT, of the pairs of the rule alone.
_BY_RULE = """, auto_links AS (SELECT x.expense, r.a, r.b FROM rule r JOIN lines x ON x.source = r.a JOIN lines y ON y.source = r.b AND y.expense = x.expense),
auto_both AS (SELECT expense, a, b FROM auto_links UNION ALL SELECT expense, b, a FROM auto_links),
auto_reach AS (SELECT expense, source, source AS other FROM lines UNION SELECT r.expense, r.source, l.b FROM auto_reach r JOIN auto_both l ON l.expense = r.expense AND l.a = r.other),
auto_comp AS (SELECT expense, source, min(other) AS component FROM auto_reach GROUP BY 1, 2),
auto_best AS (SELECT c.expense, c.component, max(n) AS kept, sum(n) AS total FROM auto_comp c JOIN lines l ON l.expense = c.expense AND l.source = c.source GROUP BY 1, 2)"""


@query(f"""WITH RECURSIVE {_LINES.split(chr(10))[0].rstrip(",")}, {_CONFIRMED}, {_CLOSED.split(chr(10), 1)[1]}{_KEPT}{_BY_RULE},
e AS (SELECT expense, sum(n) AS total, max(n) AS most FROM lines GROUP BY 1), d AS (SELECT expense, sum(total - kept) AS dropped FROM best GROUP BY 1), ad AS (SELECT expense, sum(total - kept) AS automatic FROM auto_best GROUP BY 1),
p AS (SELECT s.expense, sum(kept) - max(kept) AS separated FROM said s JOIN best b ON s.d = '1' AND b.expense = s.expense AND b.keeper IN (s.a, s.b) GROUP BY 1),
f0 AS (SELECT e.*, dropped, CASE WHEN s.expense IS NOT NULL THEN automatic ELSE dropped END AS merged, coalesce(separated, 0) AS separated FROM e JOIN d ON d.expense = e.expense JOIN ad ON ad.expense = e.expense LEFT JOIN said s ON s.expense = e.expense AND s.d = '0' LEFT JOIN p ON p.expense = e.expense),
f AS (SELECT merged, dropped - merged AS confirmed, separated, total - dropped - most - separated AS unmerged FROM f0)
SELECT {", ".join(f"CAST(count(*) FILTER ({c} > 0) AS BIGINT) AS {n}_expenses, CAST(coalesce(sum({c}), 0) AS BIGINT) AS {n}_records" for c, n in (("merged", "merged"), ("unmerged", "unmerged"), ("confirmed", "confirmed"), ("separated", "separate")))} FROM f""")
def repost_tally_confirmed(spark, sf_dir):
    """What was merged by the rule, left, merged by confirmations, and kept apart by them."""
    return _confirmed_merge(spark, sf_dir)[1]


@query(f"WITH {_LINES} SELECT source, expense, n FROM lines WHERE n > 1")
def inside_original_repeats_kept(spark, sf_dir):
    """Repeats inside one document: counted, and never reduced."""
    return reposts.expense_counts(_expenses(spark, sf_dir)).where("n > 1")


# Rules: segment, nation or null, customer key or null, status.
_RULES = [("BUILDING", None, None, "restaurant"), ("BUILDING", "FRANCE", None, "non_restaurant"), ("MACHINERY", None, None, "restaurant"), ("MACHINERY", "CHINA", 5, "pending"), ("MACHINERY", "CHINA", None, "restaurant"), ("AUTOMOBILE", None, 7, "restaurant"), ("AUTOMOBILE", "GERMANY", None, "pending"), ("HOUSEHOLD", None, None, "restaurant"), ("HOUSEHOLD", None, None, "pending")]
_VALUES = ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in _RULES)
_MATCHED = f"""r AS (SELECT * FROM (VALUES {_VALUES}) AS t(segment, organization, custkey, status)),
c AS (SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT c_custkey, r.*, CASE WHEN r.organization IS NULL THEN 0 ELSE 1 END + CASE WHEN r.custkey IS NULL THEN 0 ELSE 2 END AS w FROM c JOIN r ON r.segment = c_mktsegment AND (r.organization IS NULL OR r.organization = n_name) AND (r.custkey IS NULL OR r.custkey = c_custkey))"""


def _matches(spark, sf_dir) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    records = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).select(F.col("c_custkey").alias("record"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("organization"), F.col("c_custkey").alias("custkey"))
    said = spark.createDataFrame(_RULES, "segment string, organization string, custkey long, status string")
    return rules.rule_matches(records, said, "segment", ["organization", "custkey"])


@query(f"WITH {_MATCHED} SELECT c_custkey AS record, organization AS rule_organization, custkey AS rule_custkey, status AS rule_status FROM m")
def wildcard_rules(spark, sf_dir):
    return _matches(spark, sf_dir).select("record", "rule_organization", "rule_custkey", "rule_status")


@query(f"""WITH {_MATCHED}, t AS (SELECT c_custkey, min(status) AS low, max(status) AS high FROM (SELECT *, max(w) OVER (PARTITION BY c_custkey) AS top FROM m) WHERE w = top GROUP BY 1)
SELECT c_custkey AS record, CASE WHEN low = high THEN low END AS rule_status, low <> high AS conflict FROM t""")
def most_specific_rule(spark, sf_dir):
    return rules.most_specific(_matches(spark, sf_dir), "record", "rule_status", ["organization", "custkey"], {"organization": 1, "custkey": 2})


@query(f"""WITH {_MATCHED}, t AS (SELECT c_custkey, min(status) AS low, max(status) AS high FROM (SELECT *, max(w) OVER (PARTITION BY c_custkey) AS top FROM m) WHERE w = top GROUP BY 1) SELECT c_custkey AS record FROM t WHERE low <> high""")
def rule_conflicts(spark, sf_dir):
    return most_specific_rule(spark, sf_dir).where("conflict").select("record")


@query("""SELECT x.c_custkey AS record, 'restored ' || CAST(x.c_custkey % 3 AS VARCHAR) AS restored, 'restored ' || CAST(x.c_custkey % 2 AS VARCHAR) AS confirmed FROM customer x WHERE x.c_custkey % 3 <> x.c_custkey % 2""")
def agreement_check(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    named = lambda n, name: c.select(F.col("c_custkey").alias("record"), F.concat(F.lit("restored "), (F.col("c_custkey") % n).cast("string")).alias(name))
    return rules.disagreements(named(3, "restored"), named(2, "confirmed"), "record", "restored", "confirmed")


@query("""SELECT d.doc_id AS record, CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 1 THEN 'restaurant' ELSE 'non_restaurant' END WHEN d.source IN ('src1', 'src2', 'src3') THEN 'restaurant' WHEN d.lang = 'de' THEN 'non_restaurant' ELSE 'pending' END AS status,
CASE WHEN l.doc_id IS NOT NULL THEN 'manual' WHEN d.source IN ('src1', 'src2', 'src3') THEN 'cache' WHEN d.lang = 'de' THEN 'model' ELSE 'none' END AS evidence FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def classify_precedence(spark, sf_dir):
    d, label = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    manual = label.select(F.col("doc_id").alias("record"), F.when(F.col("quality") == 1, "restaurant").otherwise("non_restaurant").alias("status"))
    cache = d.where(F.col("source").isin("src1", "src2", "src3")).select(F.col("doc_id").alias("record"), F.lit("restaurant").alias("status"))
    model = d.where("lang = 'de'").select(F.col("doc_id").alias("record"), F.lit("non_restaurant").alias("status"))
    return rules.precedence(d.select(F.col("doc_id").alias("record")), "record", [("manual", manual), ("cache", cache), ("model", model)])


# Histories: a user's events are the revisions of a key; errors are invalid entries.
def _entries(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("revision"), (F.col("event_type") != "error").alias("valid"), F.col("event_type").alias("value"))


@query("""SELECT user_id AS key, event_id AS revision, event_type AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS p FROM events WHERE event_type <> 'error') WHERE p = 1""")
def history_latest_valid(spark, sf_dir):
    return history.latest_valid(_entries(spark, sf_dir))


@query("SELECT user_id AS key, max(event_id) + 1 AS next_revision FROM events GROUP BY 1")
def history_next_revision(spark, sf_dir):
    return history.next_revisions(_entries(spark, sf_dir))


@query("""WITH b AS (SELECT user_id, event_type, CAST(round(value, 2) AS DECIMAL(18,2)) AS amount FROM events WHERE event_type IN ('signup', 'purchase', 'view') AND value IS NOT NULL), s AS (SELECT DISTINCT user_id FROM b WHERE event_type = 'view')
SELECT CAST(sum(amount) AS DOUBLE) AS committed FROM b WHERE event_type <> 'purchase' OR user_id NOT IN (SELECT user_id FROM s)""")
def budget_committed(spark, sf_dir):
    kind = F.when(F.col("event_type") == "signup", "prior_usage").when(F.col("event_type") == "purchase", "reservation").when(F.col("event_type") == "view", "settlement")
    ledger = table(spark, sf_dir, "events").where("value is not null").select(F.col("user_id").alias("entry_id"), kind.alias("kind"), F.round("value", 2).cast("decimal(18,2)").alias("amount")).where("kind is not null")
    return history.committed(ledger).select(F.col("committed").cast("double").alias("committed"))


@query("""SELECT DISTINCT user_id AS lookup_key, coalesce(e.event_type, 'none') AS outcome, e.event_type IS NOT NULL AS reused FROM events x LEFT JOIN (SELECT user_id AS u, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS p FROM events) WHERE p = 1 AND event_type <> 'error') e ON e.u = x.user_id""")
def decision_reuse(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("outcome"))
    previous = last.select(F.col("user_id").alias("lookup_key"), F.when(F.col("outcome") == "error", "failed").otherwise("success").alias("status"), "outcome")
    asked = e.select(F.col("user_id").alias("lookup_key")).distinct()
    return history.reusable(asked, previous, retry_failed=True).select("lookup_key", F.coalesce("outcome", F.lit("none")).alias("outcome"), "reused")


@query("""SELECT o_orderkey AS key, 'missing' AS problem FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL
SELECT l_orderkey, CASE WHEN l_orderkey NOT IN (SELECT o_orderkey FROM orders) THEN 'unexpected' ELSE 'duplicate' END FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def key_coverage(spark, sf_dir):
    line, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return manifests.key_coverage(line.select(F.col("l_orderkey").alias("key")), o.select(F.col("o_orderkey").alias("key")), "key")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))
