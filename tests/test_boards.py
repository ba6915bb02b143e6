"""Listings of blocks, declared page counts, sessions that are entered again, and paced requests."""

import io
import json

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import artifacts, reviews
from tallyweave.sources import boards, html
from tests import boards_transport

NESTED = """<div class="head">x</div><div class="body_row"><div class="no"><span class="blind">number</span>7</div><div class="title"><a href="/view?id=7">Title <em>seven</em></a><br><img src="x"></div>
<div class="writer"><div><div>Dept <label class="blind">hidden</label>A</div></div></div><div class="date">2026-03-04</div><a href="/download?id=7">file</a></div>
<div class="body_row"><div>8</div><p>open<div>inner</div></div>"""


def test_rows_of_blocks(spark):
    pages = spark.createDataFrame([(1, NESTED), (2, None), (3, "<p>none</p>")], "page int, html string")
    rows = html.block_rows(pages, ".body_row", "blind").orderBy("page", "position").collect()
    assert [(r["page"], r["position"], r["cells"]) for r in rows] == [(1, 0, ["7", "Title seven", "Dept A", "2026-03-04", "file"]), (1, 1, ["8", "openinner"])]
    assert [(x["href"], x["text"]) for x in rows[0]["links"]] == [("/view?id=7", "Title seven"), ("/download?id=7", "file")]
    found = html.inline_attachments(html.block_rows(pages, ".body_row")).collect()
    assert [(r["href"], r["filename"]) for r in found] == [("/download?id=7", "file")]
    for bad in ("<div class='body_row'><div>1</div>", "<div class='body_row'><div class='body_row'></div></div>"):
        with pytest.raises(Exception, match="a row"):
            html.block_rows(spark.createDataFrame([(1, bad)], "page int, html string"), ".body_row").collect()


def test_boards_declare_their_pages_and_sessions_are_entered_again(spark):
    spark.dataSource.register(boards.BoardSource)
    known = [{"organization": "o1", "name": "c", "url": "mem://c/{page}", "kind": "blocks", "row": "li", "blind": "blind"}]
    rows = spark.read.format("board").option("boards", json.dumps(known)).option("transport", "tests.boards_transport:get").load().orderBy("page", "position").collect()
    assert [(r["page"], r["cells"]) for r in rows] == [(1, ["", "Third one", "deptx", "2026.01.02"]), (1, ["2"]), (2, ["1", "a.xlsx"])]
    with pytest.raises(ValueError, match="page count"):
        boards.BoardReader({"boards": json.dumps([{"organization": "o", "name": "b", "url": "mem://b/{page}"}]), "transport": "tests.boards_transport:get"}).partitions()
    reader = boards.BoardReader({"boards": json.dumps([{"organization": "o", "name": "s", "url": "mem://s/list?t={token}", "enter": "mem://s/enter", "kind": "json", "pages": 1}]), "transport": "tests.boards_transport:ended_once"})
    assert list(reader.read(reader.partitions()[0])) == [("o", "s", 1, 0, ["1", "in"])]
    assert boards_transport.SEEN == ["mem://s/enter", "mem://s/list?t=t1"] * 2
    with pytest.raises(boards.Expired):
        boards.entered(lambda u: b"<html>", "e", "u?{token}", boards._json_list)


def test_sessions_keep_their_pace():
    now, waits, fails = [0.0], [], [True]

    def wait(seconds):
        waits.append(round(seconds, 3))
        now[0] += seconds

    def opened(url):
        now[0] += 0.1
        if url == "flaky" and fails.pop() if fails else False:
            raise TimeoutError
        return io.BytesIO(b"body")

    get = boards.Session(0.5, wait, lambda: now[0], opened)
    assert [get(u) for u in ("a", "b", "c")] == [b"body"] * 3 and waits == [0.4, 0.4]
    assert get("flaky") == b"body" and waits[-1] == boards.WAIT


def test_first_json_rows(spark):
    bodies = spark.createDataFrame([(1, '[{"no": 5, "t": "a"}, {"no": 5, "t": "b"}]'), (2, '[{"no": 6, "t": null}, {"no": 5, "t": "c"}]')], "page int, body string")
    found = sorted(tuple(r) for r in boards.first_json_rows(bodies, "struct<no:int,t:string>", "no").collect())
    assert found == [(5, 1, 0, "a"), (6, 2, 0, None)]
    for bad in ('{"no": 1}', '[{"t": "x"}]', "no"):
        with pytest.raises(Exception, match="no list of rows"):
            boards.first_json_rows(spark.createDataFrame([(1, bad)], "page int, body string"), "struct<no:int,t:string>", "no").collect()


def test_reviews_and_reports(spark):
    said = spark.createDataFrame([("a", None), ("b", "x"), ("c", "x")], "org string, dept string")
    held = spark.createDataFrame([("a", None, 1), ("b", "y", 2), ("c", "x", 3)], "org string, dept string, k int")
    assert sorted(r["org"] for r in reviews.scoped_reviews(said, held, ["org", "dept"]).collect()) == ["a", "c"]
    lines = spark.range(25).select(F.lit("k").alias("key"), "id", F.concat(F.lit("p"), "id").alias("text"))
    found = artifacts.top_with_rest(lines, "key", [F.col("id")], "text").orderBy("number").collect()
    assert len(found) == 21 and found[0]["line"] == "p0" and found[20]["line"] == "and 5 more"
    none = spark.range(1).select(artifacts.scope_sentence([("a", F.lit(0)), ("b", F.lit(0))]).alias("s")).first()
    assert none["s"] is None
