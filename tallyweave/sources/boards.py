"""Bulletin boards as a Spark data source: one partition for each page of a listing, read through an exchangeable transport.

    spark.dataSource.register(BoardSource)
    spark.read.format("board").option("boards", json_list).option("transport", "package.module:function").load()

A board is {"organization", "name", "url", "kind"}; `{page}` in the url is the page number. Without `pages`, the first page must
declare their number. kind is `html` (rows of table cells), `blocks` (rows of elements: `row` is their tag or class, `blind` the
class of hidden labels) or `json` (a list of objects; with `enter`, a page whose token goes into the url as `{token}`). Held organizations are left out before reading. A transport maps a
url to bytes; the default one retries transient failures with growing waits and limits sizes.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tallyweave.operators.manifests import container
from tallyweave.sources.html import TOKEN, _blocks, _read, declared_pages, token_of

#: Statuses worth another try, tries, first wait in seconds, most bytes of an answer.
TRANSIENT = (408, 425, 429, 500, 502, 503, 504)
TRIES, WAIT, MOST_BYTES = 3, 1.0, 20_000_000


class TooLarge(ValueError):
    """An answer above the limit."""


class Expired(ValueError):
    """An answer that is none of the session's: it has to be entered again."""


def _tried(opened: Callable[[str], object], url: str, wait: Callable[[float], None]) -> bytes:
    """The body behind a url. Only transient failures are tried again, after waits that double."""
    for k in range(TRIES):
        try:
            with opened(url) as answer:
                body = answer.read(MOST_BYTES + 1)
            if len(body) > MOST_BYTES:
                raise TooLarge(url)
            return body
        except urllib.error.HTTPError as error:
            if error.code not in TRANSIENT or k + 1 == TRIES:
                raise
        except (urllib.error.URLError, TimeoutError):
            if k + 1 == TRIES:
                raise
        wait(WAIT * 2**k)
    raise AssertionError("unreachable")


def http(url: str, wait: Callable[[float], None] = time.sleep) -> bytes:
    """The default transport, without a session."""
    return _tried(lambda u: urllib.request.urlopen(u, timeout=30), url, wait)


class Session:
    """A transport with cookies of its own and a least time between its requests."""

    def __init__(self, interval: float = 0.5, wait: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic, opened: Callable[[str], object] | None = None):
        self.interval, self.wait, self.clock = interval, wait, clock
        self.last: float | None = None
        jar = urllib.request.build_opener(urllib.request.HTTPCookieProcessor(http_cookies()))
        self.opened = opened or (lambda u: jar.open(u, timeout=30))

    def __call__(self, url: str) -> bytes:
        if self.last is not None and (left := self.last + self.interval - self.clock()) > 0:
            self.wait(left)
        self.last = self.clock()
        return _tried(self.opened, url, self.wait)


def http_cookies():
    from http.cookiejar import CookieJar

    return CookieJar()


def entered(get: Callable[[str], bytes], enter_url: str, url: str, read: Callable[[bytes], object]) -> object:
    """What `read` makes of the answer to a url with a session's `{token}`; where it says Expired, the session is entered once more."""
    for last in (False, True):
        token = token_of(get(enter_url).decode("utf-8", "replace"))
        try:
            return read(get(url.replace("{token}", urllib.parse.quote(token or ""))))
        except Expired:
            if last:
                raise
    raise AssertionError("unreachable")


def _json_list(body: bytes) -> list[dict]:
    """Objects of a JSON list; another answer is Expired, as sessions answer with a page once they end."""
    try:
        found = json.loads(body)
    except ValueError as error:
        raise Expired("no JSON") from error
    if not isinstance(found, list) or not all(isinstance(x, dict) for x in found):
        raise Expired("no list of objects")
    return found


class BoardPage(InputPartition):
    def __init__(self, board: dict, page: int):
        super().__init__((board["name"], page))
        self.board, self.page = board, page


class BoardReader(DataSourceReader):
    def __init__(self, options: dict):
        held = set(json.loads(options.get("held", "[]")))
        self.boards = [b for b in json.loads(options["boards"]) if b["organization"] not in held]
        self.transport = options.get("transport", "tallyweave.sources.boards:http")

    def _get(self) -> Callable[[str], bytes]:
        module, _, name = self.transport.partition(":")
        return getattr(importlib.import_module(module), name)

    def _pages(self, board: dict) -> int:
        """A board's pages: as given, or as its first page declares."""
        if "pages" in board:
            return int(board["pages"])
        return declared_pages(self._get()(board["url"].replace("{page}", "1")).decode("utf-8", "replace"))

    def partitions(self) -> list[BoardPage]:
        return [BoardPage(b, p) for b in self.boards for p in range(1, self._pages(b) + 1)]

    def read(self, partition: BoardPage) -> Iterator[tuple]:
        yield from self.rows_of(partition)

    def rows_of(self, partition: BoardPage) -> Iterator[tuple]:
        get, board = self._get(), partition.board
        url, kind = board["url"].replace("{page}", str(partition.page)), board.get("kind", "html")
        if kind == "json":
            found = entered(get, board["enter"], url, _json_list) if "enter" in board else _json_list(get(url))
            rows = [[str(v) if v is not None else "" for v in item.values()] for item in found]
        elif kind == "blocks":
            blocks = _blocks(get(url).decode("utf-8", "replace"), board["row"], board.get("blind"))
            if blocks.problem:
                raise ValueError(blocks.problem)
            rows = [r["cells"] for r in blocks.rows]
        else:
            rows = [r for r in _read(get(url).decode("utf-8", "replace")).rows if r]
        for k, cells in enumerate(rows):
            yield board["organization"], board["name"], partition.page, k, cells


class BoardStream(DataSourceStreamReader):
    """A board that is listed again and again, newest page first. An offset holds, for each board, how many pages it had and a
    digest of its first one. Pages are counted from the oldest, as new posts move the others; so a batch reads the page that was
    the newest, and all pages since, and nothing where neither has changed.
    """

    def __init__(self, options: dict):
        self.reader = BoardReader(options)

    def initialOffset(self) -> dict:
        return {b["name"]: [0, ""] for b in self.reader.boards}

    def latestOffset(self) -> dict:
        get = self.reader._get()
        return {b["name"]: [self.reader._pages(b), hashlib.sha256(get(b["url"].replace("{page}", "1"))).hexdigest()] for b in self.reader.boards}

    def partitions(self, start: dict, end: dict) -> list[BoardPage]:
        out = []
        for board in self.reader.boards:
            (before, old), (pages, new) = start.get(board["name"], [0, ""]), end[board["name"]]
            if (before, old) != (pages, new):
                out += [BoardPage(board, pages - at + 1) for at in range(max(1, min(before, pages)), pages + 1)]
        return out

    def read(self, partition: BoardPage) -> Iterator[tuple]:
        return iter(list(self.reader.rows_of(partition)))

    def commit(self, end: dict) -> None:
        """Nothing is held for batches that are done."""


class BoardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "board"

    def schema(self) -> str:
        return "organization string, board string, page int, position int, cells array<string>"

    def reader(self, schema) -> BoardReader:
        return BoardReader(self.options)

    def streamReader(self, schema) -> BoardStream:
        return BoardStream(dict(self.options))


def json_rows(payload: Column, item: str) -> Column:
    """Items of a JSON list; null if the payload is no such list."""
    return F.when(payload.rlike(r"^\s*\["), F.from_json(payload, f"array<{item}>"))  # one object alone would be read as a list


def first_json_rows(payloads: DataFrame, item: str, key: str, body: str = "body") -> DataFrame:
    """Objects of the payloads' JSON lists, with their position: the first of each key. A payload that is no list, or an object without the key, is an error."""
    kept = [c for c in payloads.columns if c != body]
    found = json_rows(F.col(body), item)
    listed = F.when(found.isNotNull() & ~F.exists(found, lambda x: x[key].isNull()), found).otherwise(F.raise_error(F.lit("no list of rows with their keys")).cast(f"array<{item}>"))
    rows = payloads.select(*kept, F.posexplode(listed).alias("position", "_item")).select(*kept, "position", "_item.*")
    order = F.struct(*kept, "position")
    return rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("_row")).select(key, "_row.*")


def session_token(html: Column) -> Column:
    """The token of a page's hidden `csrf` field or meta tag; null if there is none."""
    found = F.regexp_extract(html, TOKEN, 1)
    return F.when(found != "", found)


def view_attachments(pages: DataFrame) -> DataFrame:
    """post_id, href, filename of the download links of view pages (post_id, html); links that name another post are left out."""
    from tallyweave.sources.html import parse_pages, url_parameter

    links = parse_pages(pages).select("post_id", F.explode("links").alias("link")).select("post_id", "link.href", F.col("link.text").alias("filename"))
    named = url_parameter(F.col("href"), "post_id")
    return links.where(F.col("href").contains("download") & (named.isNull() | (named == F.col("post_id").cast("string"))))


def materialized_sources(files: DataFrame, listing: DataFrame) -> DataFrame:
    """files (post_id, path, content) with source (sha256), container and the listing's attributes where it has the post."""
    rows = files.select("post_id", "path", F.sha2("content", 256).alias("source"), container(F.col("content")).alias("container"))
    return rows.join(listing, "post_id", "left")


def distinct_sources(sources: DataFrame) -> DataFrame:
    """The first source (by path) of each content."""
    columns = [c for c in sources.columns if c != "source"]
    return sources.groupBy("source").agg(F.min_by(F.struct(*columns), "path").alias("row")).select("source", "row.*")


def missing_originals(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """post_id, filename, reason (gone, empty) and the listing's attributes. ledger: post_id, gone, empty (arrays of names)."""
    both = ledger.select("post_id", F.explode("gone").alias("filename"), F.lit("gone").alias("reason")).union(ledger.select("post_id", F.explode("empty").alias("filename"), F.lit("empty").alias("reason")))
    return both.join(listing, "post_id", "left")


def numeric_like(posts: DataFrame, column: str) -> DataFrame:
    """Posts in order of length, then text: as numbers are."""
    return posts.orderBy(F.length(column), column)


def empty_reason(visited: DataFrame) -> DataFrame:
    """organization, reason: `held`, or the boards visited, joined in order; an error if neither explains it. visited: organization, held, board."""
    said = visited.groupBy("organization").agg(F.bool_or("held").alias("held"), F.array_join(F.array_sort(F.collect_set("board")), ", ").alias("boards"))
    reason = F.when(F.col("held"), "held").when(F.col("boards") != "", F.concat(F.lit("visited "), F.col("boards"))).otherwise(F.raise_error(F.lit("an empty result without a reason")))
    return said.select("organization", reason.alias("reason"))
