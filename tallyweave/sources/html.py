"""HTML pages as relations: links, text, and rows of listings and views."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.text import collapse

_SILENT = ("script", "style")


class _Reader(HTMLParser):
    """Collects links with their text, body text, and the cells of table or list rows."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[list[str]] = []
        self.words: list[str] = []
        self.rows: list[list[str]] = []
        self.open_link = False
        self.silent = 0
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SILENT:
            self.silent += 1
        elif tag == "a" and (href := dict(attrs).get("href")) is not None:
            self.links.append([href, ""])
            self.open_link = True
        elif tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "a":
            self.open_link = False
        elif tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        self.words += data.split()
        if self.open_link:
            self.links[-1][1] += data
        if self.cell is not None:
            self.cell.append(data)


def _read(html: str | None) -> _Reader:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return reader


#: An ampersand that begins a character reference without a semicolon, as where a text was cut off.
_UNENDED = re.compile(r"&(?=#?[0-9A-Za-z]+(?![0-9A-Za-z;]))")


def parse_pages(pages: DataFrame, html: str = "html", ended: bool = False) -> DataFrame:
    """Adds links (array of href, text), text (body, white space collapsed) and table_rows (array of cell arrays).

    A null page has no links, rows or text. ended: only character references that end with a semicolon are read; browsers
    read some that don't (`&amp`), which else holds here too.
    """
    schema = pa.struct([("links", pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))), ("text", pa.string()), ("table_rows", pa.list_(pa.list_(pa.string())))])

    @F.arrow_udf("links array<struct<href:string,text:string>>, text string, table_rows array<array<string>>")
    def parsed(values: pa.Array) -> pa.Array:
        out = []
        for value in values.to_pylist():
            r = _read(_UNENDED.sub("&amp;", value) if ended and value else value)
            out.append({"links": [{"href": h, "text": " ".join(t.split())} for h, t in r.links], "text": " ".join(r.words), "table_rows": [x for x in r.rows if x]})
        return pa.array(out, schema)

    rows = pages.withColumn("_parsed", parsed(html))
    return rows.select(*pages.columns, "_parsed.*")


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Blocks(HTMLParser):
    """Rows that are blocks: elements of a tag, or (`.name`) of a class. A row's cells are its child elements."""

    def __init__(self, row: str, blind: str | None):
        super().__init__(convert_charrefs=True)
        self.row, self.blind = row, blind
        #: open elements within the row, each with whether it hides its text
        self.open: list[tuple[str, bool]] = []
        self.rows: list[dict] = []
        self.links: list[dict] = []
        self.problem: str | None = None
        self.link: dict | None = None

    def _is_row(self, tag: str, classes: list[str]) -> bool:
        return self.row[1:] in classes if self.row.startswith(".") else tag == self.row

    def handle_starttag(self, tag: str, attrs: list) -> None:
        said = dict(attrs)
        classes = (said.get("class") or "").split()
        if self._is_row(tag, classes):
            if self.open:
                self.problem = self.problem or "a row begins before the one before it ends"
            self.open, self.link = [(tag, False)], None
            self.rows.append({"cells": [], "links": []})
            return
        if not self.open or tag in _VOID:
            return
        if len(self.open) == 1:
            self.rows[-1]["cells"].append("")
        self.open.append((tag, tag in _SILENT or self.blind in classes))
        if tag == "a" and said.get("href") is not None:
            self.link = {"href": said["href"], "text": ""}
            self.rows[-1]["links"].append(self.link)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.link = None
        at = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag), None)
        if at is not None:  # elements that are left open end with the one around them
            del self.open[at:]

    def handle_data(self, data: str) -> None:
        if len(self.open) > 1 and not any(hidden for _, hidden in self.open):
            self.rows[-1]["cells"][-1] += data
            if self.link is not None:
                self.link["text"] += data

    def close(self) -> None:
        super().close()
        if self.open:
            self.problem = self.problem or "a row does not end"


def _blocks(html: str | None, row: str, blind: str | None) -> _Blocks:
    reader = _Blocks(row, blind)
    reader.feed(html or "")
    reader.close()
    tight = lambda t: " ".join(t.split())
    for r in reader.rows:
        r["cells"] = [tight(c) for c in r["cells"]]
        r["links"] = [{"href": x["href"], "text": tight(x["text"])} for x in r["links"]]
    return reader


def block_rows(pages: DataFrame, row: str, blind: str | None = None, html: str = "html") -> DataFrame:
    """position, cells and links (href, text) of the rows of listings that are made of blocks, beside the pages' other columns.

    row: a tag (`li`) or a class (`.body_row`). Texts in elements of class `blind` are left out. A row within a row, or one that
    does not end, would swallow the rows after it: an error. A page without rows gives none.
    """
    kind = "array<struct<cells:array<string>,links:array<struct<href:string,text:string>>>>"
    schema = pa.struct([("rows", pa.list_(pa.struct([("cells", pa.list_(pa.string())), ("links", pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())])))]))), ("problem", pa.string())])

    @F.arrow_udf(f"struct<rows:{kind},problem:string>")
    def parsed(values: pa.Array) -> pa.Array:
        found = [_blocks(v, row, blind) for v in values.to_pylist()]
        return pa.array([{"rows": f.rows, "problem": f.problem} for f in found], schema)

    rows = pages.withColumn("_found", parsed(html))
    sound = F.when(F.col("_found.problem").isNull(), F.col("_found.rows")).otherwise(F.raise_error(F.col("_found.problem")).cast(kind))
    kept = [c for c in pages.columns if c != html]
    return rows.select(*kept, F.posexplode(sound).alias("position", "_row")).select(*kept, "position", "_row.cells", "_row.links")


def inline_attachments(rows: DataFrame, mark: str = "download") -> DataFrame:
    """The rows' own download links, one row each (href, filename): listings that link their files without a page for each post."""
    kept = [c for c in rows.columns if c != "links"]
    each = rows.select(*kept, F.explode(F.filter("links", lambda x: x["href"].contains(mark))).alias("_link"))
    return each.select(*kept, F.col("_link.href").alias("href"), F.col("_link.text").alias("filename"))


def href_column(html: Column | str) -> Column:
    """Array of href attributes in double quotes: the native form, for well-formed pages."""
    return F.regexp_extract_all(html, F.lit(r"<a href=\"([^\"]*)\""), F.lit(1))


def text_column(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags; character references stay."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")
    return collapse(bare)


def listing_rows(pages: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Rows of listing pages (page, html) as named columns with their position; rows with another number of cells are left out.

    The first row of each key stays; filters on the rows (on attachments, say) belong after this.
    """
    parsed = parse_pages(pages).select("page", F.posexplode("table_rows").alias("position", "cells")).where(F.size("cells") == len(columns))
    rows = parsed.select("page", "position", *[F.col("cells")[k].alias(c) for k, c in enumerate(columns)])
    first = rows.groupBy(key).agg(F.min_by(F.struct("page", "position", *[c for c in columns if c != key]), F.struct("page", "position")).alias("row"))
    return first.select(key, "row.*")


# Where pages declare their number, and sessions their token.
PAGES = r"(?:전체페이지\s*:\s*|/\s*)(\d+)"
TOKEN = r"name=\"_?csrf[^\"]*\"\s+(?:value|content)=\"([^\"]*)\""
# End of fixed values.


def declared_pages(html: str) -> int:
    found = re.search(PAGES, html)
    if found is None:
        raise ValueError("a listing page declares no page count")
    return int(found[1])


def token_of(html: str) -> str | None:
    found = re.search(TOKEN, html)
    return found[1] if found else None


def page_count(html: Column) -> Column:
    """The declared number of pages (`전체페이지 : N`, or `N / M`); an error if a page declares none."""
    found = F.regexp_extract(html, PAGES, 1)
    return F.when(found != "", found.cast("int")).otherwise(F.raise_error(F.lit("a listing page declares no page count")))


def posted_on(text: Column) -> Column:
    """Date of a listing's date cell (`2026-03-04`, `2026.03.04`, `26/03/04`); null if there is none, an error if it is an impossible one."""
    y, m, d = (F.regexp_extract(text, r"(\d{4}|\d{2})[-./](\d{1,2})[-./](\d{1,2})", k) for k in (1, 2, 3))
    year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    day = F.try_to_date(F.concat_ws("-", year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))
    impossible = F.raise_error(F.concat(F.lit("an impossible posting date: "), text)).cast("date")
    return F.when(y != "", F.when(day.isNotNull(), day).otherwise(impossible))


def url_parameter(url: Column, name: str) -> Column:
    """Decoded value of a query parameter; null if missing."""
    raw = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.when(url.rlike(rf"[?&]{name}="), F.try_url_decode(raw))


def url_address(url: Column) -> Column:
    """A url without query and fragment."""
    return F.regexp_extract(url, r"^([^?#]*)", 1)


def encode_parameter(value: Column) -> Column:
    """Percent-encoding with spaces as %20 and `[`, `]`, `:` as they are."""
    out = F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))
    for code, mark in (("%5B", "["), ("%5D", "]"), ("%3A", ":")):
        out = F.replace(out, F.lit(code), F.lit(mark))
    return out


def read_stream(pages: Iterator[tuple[str, str]]) -> Iterator[tuple[str, list[str]]]:
    """Pages (name, html) with the hrefs of each, for readers on the driver."""
    for name, html in pages:
        yield name, [h for h, _ in _read(html).links]
