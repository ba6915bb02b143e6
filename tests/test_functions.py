"""Scalar functions on the values that define them."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyweave.functions import amounts, dates, geo, keys, text


def each(spark, values, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"k int, v {kind}")
    return [r["x"] for r in rows.select("k", expression(F.col("v")).alias("x")).orderBy("k").collect()]


def test_date_notations(spark):
    values = ["'25. 10. 17. 12:15", "2026.3.4.(수)", "26. 2. 27.(화) 12:47", "2026/02/25 19:03", "2026-04-9\n12:04", "20260301", "2026년 3월 4일", "2026-02-30", "3.4", "19960304", ""]
    D = dt.date
    assert each(spark, values, dates.parse_date_text) == [D(2025, 10, 17), D(2026, 3, 4), D(2026, 2, 27), D(2026, 2, 25), D(2026, 4, 9), D(2026, 3, 1), D(2026, 3, 4), None, None, None, None]
    assert each(spark, ["3.4", "3월 4", "13.1"], lambda v: dates.parse_date_text(v, F.lit(2026))) == [D(2026, 3, 4), D(2026, 3, 4), None]
    assert each(spark, [46023.0, 20260304.0, 1.5, 100.0, 20261399.0], dates.parse_date_number, "double") == [D(2026, 1, 1), D(2026, 3, 4), None, None, None]


def test_month_and_day(spark):
    rows = spark.createDataFrame([("3월", "14일", 2026), ("3", "14", 2026), ("3", "14", None), ("2", "30", 2026), ("x", "1", 2026)], "m string, d string, y int")
    found = [r[0] for r in rows.select(dates.month_day(F.col("m"), F.col("d"), F.col("y"))).collect()]
    assert found == [dt.date(2026, 3, 14), dt.date(2026, 3, 14), None, None, None]


@pytest.mark.parametrize(
    ("title", "span"),
    [
        ("2026년 1/4분기 업무추진비", ("2026-01-01", "2026-03-31")), ("26년 1~2분기", ("2026-01-01", "2026-06-30")), ("2026. 3분기", ("2026-07-01", "2026-09-30")),
        ("2025년도 11월 ~ 12월", ("2025-11-01", "2025-12-31")), ("2024년 2월", ("2024-02-01", "2024-02-29")), ("2026년 하반기", ("2026-07-01", "2026-12-31")),
        ("2026년 업무", ("2026-01-01", "2026-12-31")), ("2026년 5~3월", None), ("업무추진비", None), (None, None), ("12026년", None),
    ],
)
def test_declared_periods(spark, title, span):
    found = each(spark, [title], dates.declared_period)[0]
    assert (found and (str(found["start"]), str(found["end"]))) == span


def test_exclusion(spark):
    rows = [(None, None), (None, "2026년 1월"), ("2025-05-05", "2026년 1월"), ("2026-05-05", "no period"), ("2026-05-05", "2025년 1월"), ("2026-05-05", "2026년 6월")]
    df = spark.createDataFrame(rows, "p string, t string").withColumn("p", F.to_date("p"))
    found = [r[0] for r in df.select(dates.exclusion_reason(F.col("p"), F.col("t"))).collect()]
    assert found == [None, "posted_out_of_range", "posted_out_of_range", "undeclared_in_year", "declared_out_of_range", None]


def test_amounts(spark):
    values = ["1,234원", "△5", "▲ 1.5", "1e3", "", "12 000", "-7", "1.", None]
    found = each(spark, values, amounts.parse_amount)
    assert [None if x is None else float(x) for x in found] == [1234, -5, -1.5, None, None, 12000, -7, None, None]
    assert each(spark, [["a", "12 건"], ["3건", "4건"], ["건"], []], amounts.count_in, "array<string>") == [12, 3, None, None]
    assert each(spark, [2.5, -2.5, 0.49], amounts.half_up, "double") == [3, -2, 0]
    assert each(spark, [1234567], amounts.format_won, "long") == ["1,234,567원"]
    cost = each(spark, [1000], lambda v: amounts.token_cost(v, F.lit(500), "0.10", "0.40"), "long")[0]
    assert float(cost) == pytest.approx(0.0003)


def test_personal_data(spark):
    values = ["call 010-1234-5678 or a.b@c.co.kr", "no 900101-1234567", "직원 부의금(홍길동 부친)", "정부의 행사(점심)", "김ㅇㅇ 면담 허 * *", None]
    assert each(spark, values, text.scrub_purpose) == ["call or", "no", "직원 부의금", "정부의 행사(점심)", "면담", None]
    rows = spark.createDataFrame([("박○수", "점심"), ("홍길동", "부의금"), ("직원", "부의금"), ("홍길동", "점심"), ("김밥 천국", "축의")], "m string, p string")
    assert [r[0] for r in rows.select(text.scrub_merchant(F.col("m"), F.col("p"))).collect()] == [text.REDACTED_PAYEE, text.REDACTED_PAYEE, "직원", "홍길동", text.REDACTED_PAYEE]


def plain_scrub(purpose):
    for pattern in (text.RESIDENT_NUMBER, text.PHONE, text.EMAIL):
        purpose = re.sub(pattern, " ", purpose)
    if re.search(text.PERSONAL_EVENT, purpose):
        purpose = re.sub(r"\([^)]*\)", " ", purpose)
    return " ".join(re.sub(text.MASKED_NAME, " ", purpose).split())


def plain_merchant(merchant, purpose):
    tight = "".join(merchant.split())
    masked = re.fullmatch(text.MASKED_NAME, merchant.strip()) or re.fullmatch(text.MASKED_NAME, tight)
    event = re.search(text.PERSONAL_EVENT, purpose)
    return text.REDACTED_PAYEE if masked or event and re.fullmatch(text.PERSON_NAME, tight) and tight not in text.GENERIC_PAYEES else merchant


def test_personal_events_without_hangul(spark):
    """The sign of a death is no Hangul syllable; brackets and names go with it alone, mixed, and beside full-width signs."""
    purposes = ["故(Kim 3) 2026", "故", "x (a) 故 (b) y", "（故）　(전각)", "故 홍길동(부친) 김ㅇㅇ", "(a) only", "근조(화환)", "소속근조(화환)", "環境(a)", "김ㅇㅇ가나 (b)", "박○ 수(a)", "(unclosed 故", ""]
    assert each(spark, purposes, text.scrub_purpose) == [plain_scrub(p) for p in purposes]
    pairs = [(m, p) for m in ("홍길동", "홍 길동", "박○수", "직원", "kim", "") for p in purposes]
    found = spark.createDataFrame(pairs, "m string, p string").select(text.scrub_merchant(F.col("m"), F.col("p"))).collect()
    assert [r[0] for r in found] == [plain_merchant(m, p) for m, p in pairs]
    assert text.REDACTED_PAYEE == plain_merchant("홍길동", "故(Kim 3) 2026") and plain_scrub("故(Kim 3) 2026") == "故 2026"


def test_names(spark):
    assert each(spark, ["  Á \t Straße ", None], text.normalized) == ["á strasse", None]
    assert each(spark, ["ＡＢＣ 카페 "], text.searchable) == ["abc 카페"]
    assert each(spark, ["<b>A&amp;B</b>  점"], text.plain) == ["A&B 점"]
    assert each(spark, ["김밥 강남점", "강남점", "a b c점 x"], text.branch_of) == ["강남점", "", ""]
    assert each(spark, ["김밥 강남점", "강남점"], text.merchant_of) == ["김밥", "강남점"]
    assert each(spark, ["a.XLSX", "noext", "x/y.tar.gz", ".hidden"], text.suffix_of) == [".xlsx", "", ".gz", ""]
    assert each(spark, ["ab1", "a-b", "é", None], text.is_identifier) == [True, False, False, False]


def test_cells(spark):
    rows = spark.createDataFrame([("double", None, 3.0, None), ("double", None, 3.5, None), ("string", " a \n b ", None, None), ("datetime", None, None, dt.datetime(2026, 1, 2, 3, 4, 5)), ("string", None, None, None)], "k string, s string, n double, t timestamp")
    assert [r[0] for r in rows.select(text.cell_text(F.col("k"), F.col("s"), F.col("n"), F.col("t"))).collect()] == ["3", "3.5", "a b", "2026-01-02 03:04", ""]


def test_keys(spark):
    import hashlib
    import json

    want = hashlib.sha256(json.dumps(["business-1", "상호", "", "길 1"], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    rows = spark.createDataFrame([("상호", "", "길 1"), ("상호", None, "길 1")], "m string, b string, a string")
    assert [r[0] for r in rows.select(keys.business_id(F.col("m"), F.col("b"), F.col("a"))).collect()] == [want, None]
    assert each(spark, ['{"b": 1, "a": 1e-05}', '{"a":0.00001,"b":1}'], keys.object_digest) == [hashlib.sha256(b'{"a":1e-05,"b":1}').hexdigest()] * 2


def test_coordinates(spark):
    assert each(spark, ["1268901234", "12.5", "x", None], geo.scaled_degrees) == [pytest.approx(126.8901234), None, None, None]
    found = each(spark, [200_000.0], lambda v: geo.belt_to_degrees(v, F.lit(500_000.0)), "double")[0]
    # the belt's origin lies within a few hundred metres of 38 N, 127 E on WGS84
    assert abs(found["latitude"] - 38.0) < 0.005 and abs(found["longitude"] - 127.0) < 0.005
    north = each(spark, [200_000.0], lambda v: geo.belt_to_degrees(v, F.lit(611_000.0)), "double")[0]
    assert north["latitude"] - found["latitude"] == pytest.approx(1.0, abs=0.002)
    below = each(spark, [37.5], lambda v: geo.latitude_below(v, F.lit(12.0), F.lit(100.0)), "double")[0]
    assert 37.4 < below < 37.5
    inside = spark.createDataFrame([(32.0, 124.0), (40.0, 125.0), (39.99, 131.99)], "a double, o double")
    assert [r[0] for r in inside.select(geo.is_believed(F.col("a"), F.col("o"))).collect()] == [True, False, True]
