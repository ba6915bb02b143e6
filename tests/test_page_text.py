"""Pages whose texts were cut off within a character reference."""

from tallyweave.plans import places
from tallyweave.sources import html

PAGE = '<title>a &amp;&amp b&amp</title><a href="/x?a=1&copy=2&amp;c">l &copy; &#65; &#66</a><script>"&amp"</script>'


def test_html_text_keeps_unended_references_as_its_sql_does(spark, tmp_path):
    import duckdb

    spark.createDataFrame([(1, "u", PAGE), (2, "u", "<p>x&amp</p>"), (3, "u", "")], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = sorted(tuple(r) for r in places.html_text(spark, str(tmp_path)).collect())
    with duckdb.connect() as held:
        held.execute(f"CREATE VIEW pages AS SELECT page_id, url, replace(html, '&#65;', 'A') AS html FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
        want = sorted(held.execute(places.SQL["html_text"]).fetchall())
    assert found == want
    assert found[0][2] == "a &&amp b&amp l © A &#66" and found[1][2] == "x&amp"


def test_parse_pages_reads_references_as_browsers_unless_told(spark):
    pages = spark.createDataFrame([(PAGE,), (None,)], "html string")
    plain, ended = (html.parse_pages(pages, ended=e).collect() for e in (False, True))
    assert plain[0]["text"] == "a && b& l © A B" and ended[0]["text"] == "a &&amp b&amp l © A &#66"
    assert plain[0]["links"][0]["href"] == "/x?a=1©=2&c" and ended[0]["links"][0]["href"] == "/x?a=1&copy=2&c"
    assert plain[1]["text"] == ended[1]["text"] == ""
