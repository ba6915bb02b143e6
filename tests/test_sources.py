"""Readers, writers, boards, artifacts, services and streams."""

import datetime as dt
import io
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import artifacts, manifests, services
from tallyweave.sources import boards, html, records, workbooks
from tallyweave.streaming import listing


def check_chunks(rows, most):
    """Parts ascend with the order, none is above the limit, and two neighbours are above it together or one holds a straddling entry."""
    rows = sorted(rows, key=lambda r: r["k"])
    parts = [r["part"] for r in rows]
    assert parts == sorted(parts)
    sums = {}
    for r in rows:
        sums[r["part"]] = sums.get(r["part"], 0) + r["size"]
    assert all(v <= most for v in sums.values()) and len(sums) <= 2 * -(-sum(sums.values()) // most)


def test_boards(spark):
    spark.dataSource.register(boards.BoardSource)
    known = [{"organization": "o1", "name": "a", "url": "mem://a/{page}", "pages": 2}, {"organization": "o2", "name": "b", "url": "mem://b/{page}", "pages": 1, "kind": "json"}, {"organization": "o3", "name": "c", "url": "mem://c/1", "pages": 1}]
    rows = spark.read.format("board").option("boards", json.dumps(known)).option("held", '["o3"]').option("transport", "tests.boards_transport:get").load()
    assert rows.where("board = 'a'").count() == 5
    assert [r["cells"] for r in rows.where("board = 'b'").collect()] == [["9", "json", "", "y"]]
    posts = rows.where("board = 'a' and size(cells) = 4 and cells[0] <> 'no'").select(F.col("cells")[0].alias("post_id"), "page", "position", F.col("cells")[1].alias("title"), html.posted_on(F.col("cells")[2]).alias("posted"), (F.col("cells")[3] == "y").alias("has_file"))
    found = listing.new_posts(posts, spark.createDataFrame([("1",)], "post_id string")).collect()
    assert [(r["post_id"], r["title"], r["posted"]) for r in found] == [("3", "Third post", dt.date(2026, 3, 4))]


def test_http_retries(monkeypatch):
    import urllib.error

    waits, codes = [], [503, 500]

    class Body(io.BytesIO):
        pass

    def opened(url, timeout):
        if codes:
            raise urllib.error.HTTPError(url, codes.pop(), "", {}, None)
        return Body(b"fine")

    monkeypatch.setattr(boards.urllib.request, "urlopen", opened)
    assert boards.http("x", waits.append) == b"fine" and waits == [1.0, 2.0]
    codes[:] = [404]
    with pytest.raises(urllib.error.HTTPError):
        boards.http("x", waits.append)
    monkeypatch.setattr(boards, "MOST_BYTES", 2)
    with pytest.raises(boards.TooLarge):
        boards.http("x")


def test_listings_and_views(spark):
    pages = spark.createDataFrame([(1, "<p>전체페이지 : 12</p><table><tr><td>7</td><td>a</td></tr><tr><td>8</td></tr><tr><td>7</td><td>b</td></tr></table><script>x</script>T &amp; U")], "page int, html string")
    assert [tuple(r) for r in html.listing_rows(pages, ["post_id", "title"], "post_id").select("post_id", "title").collect()] == [("7", "a")]
    row = html.parse_pages(pages).select("text", html.page_count(F.col("html")).alias("n")).first()
    assert row["n"] == 12 and row["text"].endswith("T & U") and "x" not in row["text"].split()
    with pytest.raises(Exception, match="declares no page count"):
        spark.createDataFrame([("<p>",)], "html string").select(html.page_count(F.col("html"))).collect()
    view = spark.createDataFrame([("5", '<a href="/download?post_id=5&f=1">a.xlsx</a><a href="/download?post_id=6">b</a><a href="/x">c</a>')], "post_id string, html string")
    assert [(r["href"], r["filename"]) for r in boards.view_attachments(view).collect()] == [("/download?post_id=5&f=1", "a.xlsx")]
    urls = spark.createDataFrame([("http://x/a?q=a%20b+c&r=", "a b[1]:é")], "u string, v string").select(html.url_parameter(F.col("u"), "q"), html.url_parameter(F.col("u"), "r"), html.url_parameter(F.col("u"), "z"), html.encode_parameter(F.col("v"))).first()
    assert tuple(urls) == ("a b c", "", None, "a%20b[1]:%C3%A9")
    token = spark.createDataFrame([('<meta name="_csrf" content="t1">',), ("none",)], "h string").select(boards.session_token(F.col("h"))).collect()
    assert [r[0] for r in token] == ["t1", None]


def xlsx(strict=False):
    main = workbooks.STRICT if strict else workbooks.TRANSITIONAL
    cell = lambda r, v, t="": f'<c r="{r}"{t}><v>{v}</v></c>'
    rows = f'<row r="1">{cell("A1", 0, " t=\"s\"")}{cell("C1", 1.5)}</row><row r="3">{cell("B3", 46023.5, " s=\"1\"")}{cell("C3", 12)}<c r="D3" t="inlineStr"><is><t> in  line </t></is></c></row><row r="4"><c r="A4"/></row>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="urn:r"><sheets><sheet name="표1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><r><t>머리</t></r><r><t>글</t></r></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    for name, content in (("a.xlsx", xlsx()), ("b.xlsx", xlsx(strict=True) + b""), ("c.xls", bytes.fromhex("D0CF11E0A1B11AE1") + b"rest"), ("d.pdf", b"%PDF-1.4"), ("e.bin", b"zz"), ("g.zip", b"PK\x03\x04broken")):
        (tmp_path / name).write_bytes(content)
    found = workbooks.read_workbooks(spark, str(tmp_path)).collect()
    cells = [r["cells"] for r in found if r["status"] == "read"]
    assert sorted(cells, key=str) == sorted([["머리글", "", "1.5"], ["", "2026-01-01 12:00", "12", "in line"]] * 2, key=str)
    assert sorted(r["status"] for r in found if r["status"] != "read") == ["unreadable", "unreadable", "unreadable", "unsupported"]


def test_ledgers(spark, tmp_path):
    rows = [("r0", dt.date(2026, 1, 2), "org", "", 'a, "b"\nc', "p", Decimal("-10.50"), "a" * 64, "s:R2", [("c" * 64, "t:1:R9")]), ("r1", dt.date(2026, 1, 3), "org", "d", "m", "", Decimal(1000), "b" * 64, "s:R3", [])]
    schema = "record_id string, spent_on date, organization string, department string, merchant string, purpose string, amount_krw decimal(38,6), source_hash string, source_location string, repeats array<struct<source_hash:string,location:string>>"
    df = spark.createDataFrame(rows, schema)
    records.write_ledger(df, str(tmp_path / "l"))
    back = records.read_ledger(spark, str(tmp_path / "l"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "bad.csv").write_text("wrong,header\n1,2\n")
    with pytest.raises(Exception):
        records.read_ledger(spark, str(tmp_path / "bad.csv")).collect()
    assert records.read_reviews(spark, str(tmp_path / "none.jsonl"), "a string").count() == 0
    (tmp_path / "led.jsonl").write_text('{"post_id":"1","v":"old","line":1}\n{broken\n{"post_id":"1","v":"new","line":3}\n')
    assert [tuple(r) for r in records.read_numbered_ledger(spark, str(tmp_path / "led.jsonl"), "post_id string, v string", "post_id").collect()] == [("1", "new")]


def test_candidates(spark):
    place = {"items": [{"title": "<b>김밥</b>&amp;면 강남점", "address": "old", "roadAddress": " 새길  1 ", "mapx": "1270000000", "mapy": "375000000"}, {"title": "곳", "address": "old", "roadAddress": "", "mapx": "x", "mapy": "1"}]}
    found = records.place_candidates(spark.createDataFrame([("k", json.dumps(place)), ("bad", "{")], "k string, body string")).orderBy("position").collect()
    assert [(r["merchant"], r["branch"], r["address"], r["latitude"], r["longitude"]) for r in found] == [("김밥&면", "강남점", "새길 1", 37.5, 127.0), ("곳", "", "old", None, None)]
    item = {"MNG_NO": "1", "BPLC_NM": "가게", "ROAD_NM_ADDR": "", "LOTNO_ADDR": "번지", "CLSBIZ_YMD": "", "CRD_INFO_X": "200000.0", "CRD_INFO_Y": "450000.0"}
    body = lambda items: json.dumps({"response": {"body": {"items": items}}})
    rows = [("list", body({"item": [item, item]})), ("one", body({"item": item})), ("blank", body("")), ("none", body({"item": ""})), ("null", None)]
    found = records.license_candidates(spark.createDataFrame(rows, "k string, body string")).collect()
    assert sorted(r["k"] for r in found) == ["list", "list", "one"]
    assert all(r["address"] == "번지" and r["open"] and 37 < r["latitude"] < 38 for r in found)
    replies = [("a", json.dumps({"candidates": [{"content": {"parts": [{"text": "x"}, {"text": "y"}]}, "finishReason": "STOP"}], "usageMetadata": {"promptTokenCount": 3, "candidatesTokenCount": 2, "thoughtsTokenCount": 4}})), ("b", json.dumps({"candidates": [{"finishReason": "MAX_TOKENS"}]})), ("c", "{}"), ("d", "no json")]
    found = {r["k"]: (r["answer"], r["error"], r["output_tokens"]) for r in records.model_answers(spark.createDataFrame(replies, "k string, body string")).collect()}
    assert found == {"a": ("xy", None, 6), "b": (None, "max_tokens", 0), "c": (None, "unreadable", 0), "d": (None, "unreadable", 0)}


def test_artifacts(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    first = artifacts.save_artifact(df, str(tmp_path), "parse", 1, {"fetch": "h1"})
    assert first == artifacts.content_hash(df.orderBy(F.desc("k"))) != artifacts.content_hash(df.where("k = 1"))
    assert artifacts.load_artifact(spark, str(tmp_path), "parse", 1, {"fetch": "h1"}).count() == 2
    for version, inputs in ((1, {"fetch": "h2"}), (2, {"fetch": "h1"})):
        with pytest.raises(artifacts.Stale):
            artifacts.load_artifact(spark, str(tmp_path), "parse", version, inputs)
    artifacts.save_artifact(df, str(tmp_path), "parse", 2, {})
    assert (tmp_path / "parse.v1").exists()
    assert artifacts.report_or_remove(df, str(tmp_path / "inc")) == 2 and (tmp_path / "inc").exists()
    assert artifacts.report_or_remove(df.limit(0), str(tmp_path / "inc")) == 0 and not (tmp_path / "inc").exists()
    artifacts.publish_json(df, str(tmp_path / "out"))
    assert sorted(x for p in (tmp_path / "out").glob("part-*") for x in p.read_text().split()) == ['{"k":1,"v":"a"}', '{"k":2,"v":null}']
    sized = spark.createDataFrame([(k, 40) for k in range(10)], "k int, size int")
    check_chunks(artifacts.chunked(sized, "size", 100, "k").collect(), 100)
    wide = spark.range(2000).selectExpr("id % 1999 * 7 + id as k", "id % 61 + 1 as size", "repeat('x', 20) as other", "id as one")
    found = artifacts.chunked(wide, "size", 150, "k").collect()
    assert len(found) == 2000
    check_chunks(found, 150)
    assert [r["part"] for r in artifacts.chunked(spark.createDataFrame([(1, 500), (2, 1)], "k int, size int"), "size", 100, "k").orderBy("k").collect()] == [2, 11]
    rows = spark.createDataFrame([("s", "t", 1, ["", ""]), ("s", "t", 3, ["long" * 20, "b"]), ("s", "t", 4, ["c", ""])], "source string, sheet string, row int, cells array<string>")
    assert artifacts.sheet_preview(rows).first()["preview"] == "3: " + "long" * 10 + " | b\n4: c | "
    parts = spark.createDataFrame([("b", 2, "y"), ("b", 1, "x")], "k string, at int, text string")
    assert artifacts.prompt_text(parts, ["k"], "at", "text").first()["prompt"] == "1. x\n2. y"
    variants = spark.createDataFrame([("s", "t", 1, "old", None), ("s", "t", 2, "new", None), ("s", "t", 3, "bad", "x"), ("s", "u", 1, "no", "x")], "source string, sheet string, revision int, variant string, problem string")
    assert {(r["sheet"], r["variant"]) for r in artifacts.first_verified(variants).collect()} == {("t", "new"), ("u", None)}
    left, right = (spark.createDataFrame(x, f"k int, {c} string") for x, c in (([(0, "a"), (1, "b")], "l"), ([(0, "A")], "r")))
    assert sorted((r["k"], r["only"]) for r in artifacts.zipped(left, right, ["k"]).collect()) == [(0, None), (1, "left")]


def test_sources_and_missing(spark):
    files = spark.createDataFrame([("1", "p2", bytearray(b"PK\x03\x04x")), ("2", "p1", bytearray(b"PK\x03\x04x")), ("3", "p3", bytearray(b""))], "post_id string, path string, content binary")
    known = spark.createDataFrame([("1", "t1")], "post_id string, title string")
    rows = boards.materialized_sources(files, known)
    assert sorted((r["post_id"], r["container"], r["title"]) for r in rows.fillna("-").collect()) == [("1", "zip", "t1"), ("2", "zip", "-"), ("3", "empty", "-")]
    assert {r["path"] for r in boards.distinct_sources(rows).collect()} == {"p1", "p3"}
    ledger = spark.createDataFrame([("1", ["a"], ["b", "c"]), ("2", [], [])], "post_id string, gone array<string>, empty array<string>")
    assert sorted((r["filename"], r["reason"], r["title"]) for r in boards.missing_originals(ledger, known).collect()) == [("a", "gone", "t1"), ("b", "empty", "t1"), ("c", "empty", "t1")]
    assert [r[0] for r in boards.numeric_like(spark.createDataFrame([("10",), ("9",), ("100",)], "p string"), "p").collect()] == ["9", "10", "100"]
    visited = spark.createDataFrame([("o", False, "b"), ("o", False, "a"), ("h", True, None)], "organization string, held boolean, board string")
    assert {r["organization"]: r["reason"] for r in boards.empty_reason(visited).collect()} == {"o": "visited a, b", "h": "held"}


def test_services(spark):
    budget = services.Budget(Decimal(10), Decimal(2))
    with budget.reserve("a", Decimal(5)) as settle:
        settle(Decimal(1))
    assert budget.spent == 3
    with pytest.raises(services.OverBudget), budget.reserve("b", Decimal(8)):
        pass
    with pytest.raises(ValueError), budget.reserve("c", Decimal(4)):
        raise ValueError
    assert budget.spent == 7
    answers, waits = [None, None, "x"], []
    assert services.poll(lambda: answers.pop(0), 3, waits.append) == "x" and waits == [0, 1]
    assert services.poll(lambda: None, 2, waits.append) is None
    assert services.select_target({"c-1": {"o"}}, "c-1", "o") == ("c-1", "o")
    for args in (("C!",), ("zz",), ("c-1", "p")):
        with pytest.raises((ValueError, LookupError)):
            services.select_target({"c-1": {"o"}}, *args)
    same = spark.createDataFrame([("p", "h")], "path string, sha256 string")
    assert services.release_decision(manifests.manifest_difference(same, same), "v1") == ("keep", None)
    assert services.release_decision(manifests.manifest_difference(same, same.limit(0)), "v1") == ("roll_back", "v1")
    rows = spark.createDataFrame([(None, True, "c1", ["c1"], "n", "r"), (None, True, "c9", ["c1"], "n", "r"), ("timeout", None, None, [], None, None), (None, False, None, [], None, None), (None, True, "c1", ["c1"], " ", "r")], "error string, supported boolean, candidate_source string, candidates array<string>, restored string, rationale string")
    assert [r["reason"] for r in services.proposals(rows).collect()] == ["proposed", "unknown_candidate", "timeout", "unsupported", "missing_name"]
    state = spark.createDataFrame([(30, [10, 25, 35])], "v int, h array<int>").select(services.nearest_state(F.col("v"), F.col("h"))).first()[0]
    assert state == 1


def test_listing_stream(spark, tmp_path):
    folder, ledger, checkpoint = (str(tmp_path / x) for x in ("in", "ledger", "cp"))
    (tmp_path / "in").mkdir()
    row = lambda post, page, file, title="t": json.dumps({"post_id": post, "page": page, "position": 0, "title": title, "posted": "2026-01-01", "has_file": file})
    (tmp_path / "in" / "1.json").write_text("\n".join([row("a", 1, True), row("a", 2, True, "again"), row("b", 1, False), row("b", 2, True)]))
    listing.collect_listing(spark, folder, ledger, checkpoint).awaitTermination()
    assert [(r["post_id"], r["title"]) for r in spark.read.parquet(ledger).collect()] == [("a", "t")]
    (tmp_path / "in" / "2.json").write_text("\n".join([row("a", 1, True, "late"), row("c", 1, True)]))
    for _ in range(2):
        listing.collect_listing(spark, folder, ledger, checkpoint).awaitTermination()
    assert sorted(r["post_id"] for r in spark.read.parquet(ledger).collect()) == ["a", "c"]


def test_impossible_posting_dates_are_errors(spark):
    cells = lambda *v: spark.createDataFrame([(x,) for x in v], "v string").select(html.posted_on(F.col("v")).alias("d"))
    assert [str(r["d"]) for r in cells("등록 2026-02-28", "26.3.4", "none", None).collect()] == ["2026-02-28", "2026-03-04", "None", "None"]
    for bad in ("2026-02-30", "26/13/01", "2026.00.10"):
        with pytest.raises(Exception, match="impossible posting date"):
            cells(bad).collect()


def test_event_windows_stream(spark, tmp_path):
    from tests.conftest import DATA

    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    query = listing.event_windows(stream).writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").agg(F.sum("events")).first()[0] == events.count()
