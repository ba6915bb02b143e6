"""Numbers over ranges of an order: right at sizes where range bounds are sampled, with columns beyond the order."""

import pytest
from pyspark.sql import functions as F

from tallyweave import tables
from tallyweave.operators import identity, rules, serving
from tallyweave.sources import workbooks


@pytest.mark.parametrize(("parts", "collation", "n"), [(8, None, 300_000), (2, "ko", 3_000)])
def test_places_of_many_rows(spark, parts, collation, n):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = spark.range(n).select(F.col("id").alias("business"), (F.xxhash64("id") % 40).alias("visit_count"), F.concat(F.lit("m"), F.col("id") % 977).alias("merchant"), F.repeat(F.lit("x"), 30).alias("other"))
        found = serving.ranked(rows, collation)
        got = found.agg(F.count("*"), F.count_distinct("place"), F.min("place"), F.max("place")).first()
        assert tuple(got) == (n, n, 1, n)
        first = [(r["business"], r["visit_count"]) for r in found.orderBy("place").limit(500).collect()]
        want = rows.orderBy(F.desc("visit_count"), "merchant", "business").limit(500).collect()
        assert first == [(r["business"], r["visit_count"]) for r in want]
        best = rows.groupBy("visit_count").count().orderBy(F.desc("visit_count")).limit(2).collect()
        assert found.where(F.col("visit_count") == best[1]["visit_count"]).agg(F.max("rank")).first()[0] == best[0]["count"] + 1
        names = rows.select(F.col("business").cast("string").alias("key"), "other")
        numbers = identity.number_batches(names).select((F.col("batch") * 40 + F.col("index")).alias("k")).agg(F.count_distinct("k"), F.max("k")).first()
        assert tuple(numbers) == (n, n - 1)
        values = rows.select((F.col("business") * 2).alias("v"), "other")
        assert serving.nearest_rank(values, "v", [0.5]).first()["value"] == 2 * ((n - 1 + 1) // 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_search_puts_the_query_into_the_same_form(spark):
    from tallyweave.functions.text import searchable

    rows = spark.createDataFrame([("Ｃａｆｅ one", 3), ("cafe two", 30), ("bar", 3)], "merchant string, visit_count int").withColumn("s", searchable(F.col("merchant")))
    for query in ("Ｃａｆｅ", " CAFE ", "ｃafe"):
        assert serving.search(rows, F.col("s"), query).count() == 2
    assert serving.search(rows, F.col("s"), "cafe", "20+").count() == 1


def test_precedence_counts_a_repeated_key_once(spark):
    records = spark.createDataFrame([(1,), (2,), (3,), (None,)], "record int")
    strong = spark.createDataFrame([(1, "a"), (1, "a"), (2, "c"), (2, "b"), (None, "x")], "record int, status string")
    weak = spark.createDataFrame([(1, "z"), (3, "z")], "record int, status string")
    found = {r["record"]: (r["status"], r["evidence"]) for r in rules.precedence(records, "record", [("strong", strong), ("weak", weak)]).collect()}
    assert found == {1: ("a", "strong"), 2: ("b", "strong"), 3: ("z", "weak"), None: ("pending", "none")}
    assert [r["record"] for r in rules.layer_conflicts(strong, "record").collect()] == [2]


def test_faulty_workbooks_are_unreadable(spark, tmp_path):
    import io
    import zipfile

    def book(sheet):
        out = io.BytesIO()
        n = workbooks.TRANSITIONAL
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{n}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="s" r:id="rId1"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
            z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{n}"><sheetData><row r="1">{sheet}</row></sheetData></worksheet>')
        return out.getvalue()

    good = book('<c r="A1"><v>5</v></c>')
    files = {"good": good, "index": book('<c r="A1" t="s"><v>7</v></c>'), "reference": book('<c r="1A"><v>5</v></c>'), "number": book('<c r="A1" s="x"><v>5</v></c>'), "cut": good[: len(good) // 2]}
    damaged = bytearray(good)
    at = good.index(b"sheet1.xml") + 10
    damaged[at : at + 20] = b"\xff" * 20
    files["damaged"] = bytes(damaged)
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    status = sorted(r["status"] for r in workbooks.read_workbooks(spark, str(tmp_path)).select("status").collect())
    assert status == ["read"] + ["unreadable"] * 5


def test_shared_tables(spark):
    folder = tables.shared_folder(spark)
    kept = tables.cut_lineage(spark.range(5).toDF("k"))
    assert kept.count() == 5 and folder in kept.inputFiles()[0]
    step = tables.Successive()
    first = step(spark.range(3).toDF("k"))
    second = step(first.where("k > 0"))
    assert second.count() == 2 and step.path in second.inputFiles()[0]
    assert tables.spare_names(["A", "a_", "b"], "a", "A", "c") == ["a__", "A___", "c"]
    assert spark.range(1).select(tables.quoted("id").alias("x`.y")).select(tables.quoted("x`.y")).columns == ["x`.y"]
