"""Parts that are published at once, and boards that are collected page by page, with failures and restarts."""

import json

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import artifacts
from tallyweave.sources import boards, parts
from tallyweave.streaming import listing
from tests import boards_transport


def lines_of(folder):
    return [line for p in sorted(folder.glob("part-*")) for line in p.read_text().splitlines()]


def test_parts_keep_the_limit_and_the_order(spark, tmp_path):
    rows = spark.range(3000).select(F.concat(F.lit("é"), F.lpad(F.col("id").cast("string"), 6, "0"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int"))).alias("line"))
    parts.write_parts(rows.repartition(5).orderBy("line"), str(tmp_path / "out"), header="head", suffix=".txt", limit=2000)
    found = sorted((tmp_path / "out").glob("part-*"))
    assert all(p.stat().st_size <= 2000 and p.read_text().startswith("head\n") for p in found) and len(found) > 40
    assert [x for x in lines_of(tmp_path / "out") if x != "head"] == [r["line"] for r in rows.orderBy("line").collect()]
    parts.write_parts(rows.limit(0), str(tmp_path / "out"))
    assert (tmp_path / "out").exists() and lines_of(tmp_path / "out") == []
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


@pytest.mark.parametrize("bad", ["null", "long", "raised"])
def test_a_failed_write_changes_nothing(spark, tmp_path, bad):
    """The last of many rows fails: no file is left, and what was published stays."""
    path = str(tmp_path / "out")
    parts.write_parts(spark.createDataFrame([("old",)], "line string"), path)
    value = {"null": F.lit(None).cast("string"), "long": F.repeat(F.lit("x"), 500), "raised": F.raise_error(F.lit("bad row")).cast("string")}[bad]
    rows = spark.range(0, 400, 1, 8).select(F.when(F.col("id") == 399, value).otherwise(F.col("id").cast("string")).alias("line"))
    with pytest.raises(Exception):
        parts.write_parts(rows, path, limit=100)
    assert lines_of(tmp_path / "out") == ["old"] and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_what_failed_attempts_leave_is_dropped(tmp_path):
    writer = parts.PartsWriter({"path": str(tmp_path / "out")}, True)
    (tmp_path / writer.pending.rsplit("/", 1)[1]).mkdir()
    for name in ("part-000000-000000-aa.jsonl", "part-000000-000000-bb.jsonl"):
        (tmp_path / writer.pending.rsplit("/", 1)[1] / name).write_text("x\n")
    writer.commit([parts.Written(["part-000000-000000-bb.jsonl"], 1), None])
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["part-000000-000000-bb.jsonl"]


def test_ledgers_are_checked_and_all_tasks_publish(spark, tmp_path):
    from tallyweave.sources import records

    schema = "record_id string, spent_on date, organization string, department string, merchant string, purpose string, amount_krw decimal(38,6), source_hash string, source_location string, repeats array<struct<source_hash:string,location:string>>"
    rows = spark.range(500).selectExpr("concat('r', id) as record_id", "date'2026-01-02' as spent_on", "'o' as organization", "'' as department", "concat('m, \"', id, '\"\n') as merchant", "'' as purpose", "cast(id as decimal(38,6)) as amount_krw", "repeat('a', 64) as source_hash", "'s:R1' as source_location", "cast(array() as array<struct<source_hash:string,location:string>>) as repeats")
    records.write_ledger(rows, str(tmp_path / "l"), limit=5000)
    assert all(p.stat().st_size <= 5000 for p in (tmp_path / "l").iterdir())
    back = records.read_ledger(spark, str(tmp_path / "l"))
    assert back.exceptAll(rows.select(*back.columns)).count() == 0 and back.count() == 500
    with pytest.raises(Exception, match="it lacks merchant"):
        records.write_ledger(rows.withColumn("merchant", F.lit("")), str(tmp_path / "l"))
    assert records.read_ledger(spark, str(tmp_path / "l")).count() == 500
    table = spark.range(40).selectExpr("id as `a.b`", "if(id = 3, null, 'x') as v").repartition(4)
    artifacts.publish_json(table, str(tmp_path / "j"))
    assert sorted(json.loads(x)["a.b"] for x in lines_of(tmp_path / "j")) == list(range(40)) and '{"a.b":3,"v":null}' in lines_of(tmp_path / "j")
    assert len(list((tmp_path / "j").iterdir())) > 1 and schema


def page(posts):
    return "<table>" + "".join(f"<tr><td>{k}</td><td>{title}</td><td>{file}</td></tr>" for k, title, file in posts) + "</table>"


def post(rows):
    cells = F.col("cells")
    return rows.select("organization", "board", "page", "position", cells[0].alias("post_id"), cells[1].alias("title"), (cells[2] == "y").alias("has_file"))


def test_boards_are_collected_by_pages(spark, tmp_path):
    """New pages and a changed first page are read, others are not; a restart gives no post twice, even without the ledger."""
    folder = tmp_path / "pages"
    folder.mkdir()
    options = {"boards": json.dumps([{"organization": "o", "name": "n", "url": f"{folder}/{{page}}"}]), "transport": "tests.boards_transport:from_folder"}

    def publish(pages):
        for k, posts in enumerate(pages, 1):
            (folder / str(k)).write_text(f"<p>전체페이지 : {len(pages)}</p>" * (k == 1) + page(posts))

    def run(ledger):
        (folder / "seen").write_text("")
        listing.collect_boards(spark, options, post, str(tmp_path / ledger), str(tmp_path / "checkpoint")).awaitTermination()
        read = (folder / "seen").read_text().split()
        found = spark.read.parquet(str(tmp_path / ledger)).select("post_id", "title").collect() if (tmp_path / ledger).exists() else []
        return sorted(map(tuple, found)), {int(x) for x in read}

    publish([[(4, "d", "y"), (3, "c", "")], [(2, "b", "y"), (1, "a", "y")]])
    assert run("l")[0] == [("1", "a"), ("2", "b"), ("4", "d")]
    assert run("l") == ([("1", "a"), ("2", "b"), ("4", "d")], {1})
    publish([[(6, "f", "y"), (5, "e", "y")], [(4, "d again", "y"), (3, "c", "y")], [(2, "b", "y"), (1, "a", "y")]])
    found, read = run("l")
    assert found == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("5", "e"), ("6", "f")] and read == {1, 2}
    publish([[(7, "g", "y"), (6, "f", "y")], [(4, "d again", "y"), (3, "c", "y")], [(2, "b", "y"), (1, "a", "y")]])
    assert run("other")[0] == [("7", "g")]
