"""Notations of dates at their edges, and how large their expression is: it is compiled into every stage that types rows."""

import datetime as dt

from pyspark.sql import functions as F

from tallyweave.functions import dates

CASES = {
    "2026.3.4.(수)": dt.date(2026, 3, 4), "'25. 10. 17. 12:15": dt.date(2025, 10, 17), "20260304": dt.date(2026, 3, 4), "2026년 3월 4일": dt.date(2026, 3, 4), "2026-04-9\n12:04": dt.date(2026, 4, 9),
    "2026-13-01": None, "2026-02-30": None, "20260230": None, "26-2-30": None, "2026-3-45": None, "2026": None, "2026-03": None,
    "=2026-3-4": None, "x2026-3-4": None, "": None, "3.4": None, "2026-3-123": None, "‘’26/2/7": dt.date(2026, 2, 7), "202603041": None, "2026　3　": None, "2026-3 - 4 rest\nmore": dt.date(2026, 3, 4),
}


def test_edges_of_notations(spark):
    rows = spark.createDataFrame([(t,) for t in CASES] + [(None,)], "t string")
    found = {r["t"]: r["d"] for r in rows.select("t", dates.parse_date_text(F.col("t")).alias("d")).collect()}
    assert found == CASES | {None: None}
    hinted = spark.createDataFrame([("'3.4",), ("2026-13-01",), ("3월 4일",)], "t string").select("t", dates.parse_date_text(F.col("t"), F.lit(2025)).alias("d"))
    assert {r["t"]: r["d"] for r in hinted.collect()} == {"'3.4": dt.date(2025, 3, 4), "2026-13-01": None, "3월 4일": dt.date(2025, 3, 4)}


def test_a_date_is_found_by_few_patterns(spark):
    plan = spark.createDataFrame([("x",)], "t string").select(dates.parse_date_text(F.col("t")).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_") <= 4
