"""Exact removal of repeated word windows, by difference-cover anchors.

A window of 20 words that also starts earlier (smaller doc_id, or earlier in the same document) is removed, word by word.
Positions modulo 13 in a cover D are anchors: for any two positions there is a shift below 13 that brings both to residues
of D. So two equal 20-word windows contain, at the same shift, equal 8-word anchors, and only anchors are hashed at first.
Where an anchor's hash is found twice anywhere, the windows that contain it are hashed whole and compared (the extension);
of equal windows all but the first are removed.

Hashes travel in blobs, one for each task and hash range, so the shuffles carry bytes and not rows. A hash that a task
has many times travels once, as its earliest place, so a passage that many documents share gathers in no single task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import quoted, shuffle_partitions

WINDOW = 20
#: A perfect difference set: every residue modulo PERIOD is a difference of two of COVER.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Words of a task that are hashed, and marks that are gathered, before blobs are sent.
FLUSH_WORDS, FLUSH_MARKS = 3_000_000, 1_000_000
#: Bytes of a hash that anchors travel with: they only choose what is compared, so a chance match costs time alone.
ANCHOR_BYTES = 6
CACHED_WORDS = 300_000
#: Bytes of text whose places go to one route at most, about: a task holds one route's at a time.
ROUTE_BYTES = 16 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_IS_COVER = np.isin(np.arange(PERIOD), COVER)


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxh3_64_intdigest(word)
        return h


def _tag(text: bytes) -> int:
    """Tells different texts of one id apart."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text) >> 1


def _facts(docs: DataFrame) -> tuple[bool, int]:
    """Whether an id has different texts; bytes of all texts."""
    h = F.xxhash64("text")
    by_id = docs.groupBy("doc_id").agg(F.min(h).alias("a"), F.max(h).alias("b"), F.sum(F.length("text")).alias("n"))
    row = by_id.agg(F.bool_or(F.col("a") != F.col("b")).alias("several"), F.sum("n").alias("n")).first()
    return bool(row["several"]), row["n"] or 0


def deal(size: int, partitions: int) -> tuple[int, int]:
    """(routes, partitions) for so many bytes of text: a route's places fit in memory, whatever the input and the setting."""
    routes = max(3 * partitions, -(-size // ROUTE_BYTES))
    return routes, max(partitions, -(-routes // 3))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = np.uint64(base)
        return np.multiply.accumulate(out)


_inverse = pow(_BASE, -1, 1 << 64)
_held_powers: dict[str, np.ndarray] = {}


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit polynomial hashes of all windows of `width` word hashes, finalized."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    if len(_held_powers.get("up", ())) < n:
        size = max(1 << 16, 1 << n.bit_length())
        _held_powers.update(up=_powers(_BASE, size), down=_powers(_inverse, size))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _held_powers["up"][:n], out=sums[1:])
        h = (sums[width:] - sums[:-width]) * _held_powers["down"][: n - width + 1]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


_ROWS = "route long, kind int, doc_id long, blob binary"
_SCHEMA = pa.schema([("route", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("blob", pa.binary())])
#: Kinds of rows: places of hashes, places of a document's marks, texts. Marks come before texts in a route.
PLACES, MARKS, TEXT = 0, 1, 2


def _pack(key: np.ndarray, *more: np.ndarray, width: int = 8) -> bytes:
    """The key's low `width` bytes as they are; document numbers (first of `more`) as steps; compressed but for the key."""
    columns = [np.diff(c, prepend=c[:1] * 0) if k == 0 else c for k, c in enumerate(more)]
    low = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    rest = zstandard.ZstdCompressor(1).compress(b"".join(c.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns))
    return len(key).to_bytes(4, "little") + bytes([width]) + low + rest


def _unpack(blob: bytes) -> list[np.ndarray]:
    n, width = int.from_bytes(blob[:4], "little"), blob[4]
    key = np.zeros((n, 8), np.uint8)
    key[:, :width] = np.frombuffer(blob, np.uint8, n * width, 5).reshape(n, width)
    rest = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[5 + n * width :]), np.uint8).reshape(-1, 8, n)
    columns = [np.ascontiguousarray(c.T).view("<i8").ravel() for c in rest]
    return [key.view("<u8").ravel(), np.cumsum(columns[0]), *columns[1:]]


def _joined(blobs: list[bytes]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*map(_unpack, blobs), strict=True)]


def _routes(x: np.ndarray, n: int) -> np.ndarray:
    """The route of each document id or hash."""
    with np.errstate(over="ignore"):
        h = x.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        return ((h ^ (h >> np.uint64(35))) % np.uint64(n)).astype(np.int64)


def _document_routes(doc: np.ndarray, tag: np.ndarray, n: int) -> np.ndarray:
    """The route of each document, told by its id and, where ids have several texts (as null ids have), by its text."""
    with np.errstate(over="ignore"):
        return _routes(doc.astype(np.uint64) ^ tag.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), n)


def _sent(kind: int, route: np.ndarray, key: np.ndarray, *more: np.ndarray, width: int = 8) -> Iterator[tuple]:
    """Rows with key and more, dealt by the route; within a route in the order they have."""
    if not len(key):
        return
    order = np.argsort(route, kind="stable")
    route, key, more = route[order], key[order], [m[order] for m in more]
    edges = [*np.flatnonzero(np.r_[True, route[1:] != route[:-1]]).tolist(), len(route)]
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(route[a]), kind, None, _pack(key[a:b], *[m[a:b] for m in more], width=width)


def _places(routes: int, h: np.ndarray, *more: np.ndarray, width: int = 8) -> Iterator[tuple]:
    """Places of hashes, to the hash's route."""
    return _sent(PLACES, _routes(h >> np.uint64(16) if width == 8 else h & np.uint64((1 << 8 * width) - 1), routes), h, *more, width=width)


def _marks(routes: int, doc: np.ndarray, at: np.ndarray, tag: np.ndarray) -> Iterator[tuple]:
    """Places in documents, to the document's route."""
    return _sent(MARKS, _document_routes(doc, tag, routes), at, doc, tag, width=4)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


class Anchors:
    """Collects a task's anchors; gives, for each hash, one place, and as marks all places of hashes that it has twice."""

    def __init__(self, routes: int, tag: Callable[[bytes], int]):
        self.tag = tag
        self.routes, self.words, self.held, self.docs = routes, WordHashes(), [], []
        self.waiting, self.size = 0, 0

    def add(self, doc_id: int, text: bytes) -> None:
        words = text.split()
        if len(words) >= WINDOW:
            self.docs.append((doc_id, self.tag(text), np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))))
            self.waiting += len(words)
            if self.waiting > 200_000:
                self._hash()

    def _hash(self) -> None:
        if not self.docs:
            return
        sizes = np.array([len(w) for _, _, w in self.docs])
        at = np.arange(self.waiting) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        here = np.flatnonzero(_IS_COVER[at % PERIOD] & (at <= np.repeat(sizes, sizes) - ANCHOR))
        hashes = window_hashes(np.concatenate([w for _, _, w in self.docs]), ANCHOR)
        own = [np.repeat(np.array([d[k] for d in self.docs], np.int64), sizes)[here] for k in (0, 1)]
        self.held.append((hashes[here], own[0], at[here], own[1]))
        self.size += self.waiting
        self.docs, self.waiting = [], 0

    def flushed(self) -> Iterator[tuple]:
        self._hash()
        if not self.held:
            return
        h, doc, at, tag = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        order = np.argsort(h, kind="stable")
        h, doc, at, tag = h[order], doc[order], at[order], tag[order]
        first = np.r_[True, h[1:] != h[:-1]]
        twice = ~first | ~np.r_[first[1:], True]
        yield from _marks(self.routes, doc[twice], at[twice], tag[twice])
        own = np.flatnonzero(first)[np.argsort(order[first])]  # in the order of documents, which compresses
        yield from _places(self.routes, h[own], doc[own], at[own], tag[own], twice[own], width=ANCHOR_BYTES)


def _again(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Places (document, position, tag) of hashes found in two tasks, less those marked by their task."""
    h, doc, at, tag, known = _joined(blobs)
    order = np.argsort(h, kind="stable")
    h, doc, at, tag, known = h[order], doc[order], at[order], tag[order], known[order]
    same = h[1:] == h[:-1]
    twice = (np.r_[False, same] | np.r_[same, False]) & (known == 0)
    return doc[twice], at[twice], tag[twice]


def _later(h: np.ndarray, doc: np.ndarray, at: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted by hash and place; which come after the first place of their hash; which repeat the entry before."""
    order = np.lexsort((tag, at, doc, h))
    h, doc, at, tag = h[order], doc[order], at[order], tag[order]
    first = np.r_[True, h[1:] != h[:-1]]
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    equal = ~first & np.r_[False, (doc[1:] == doc[:-1]) & (at[1:] == at[:-1]) & (tag[1:] == tag[:-1])]
    return h, doc, at, tag, (doc != doc[head]) | (at != at[head]), equal


def _later_places(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    _, doc, at, tag, later, _ = _later(*_joined(blobs))
    return doc[later], at[later], tag[later]


def _solved(batches: Iterator[pa.RecordBatch], solve: Callable[[list[bytes]], tuple[np.ndarray, ...]], routes: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route -> marks: those that came as such, and those that `solve` finds among a route's places."""
    route, places, marks, size = None, [], [], 0

    def sent() -> Iterator[pa.RecordBatch]:
        if marks and (rows := list(_marks(routes, *(np.concatenate(x) for x in zip(*marks, strict=True))))):
            yield _batch(rows)

    for batch in batches:
        for r, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if r != route and places:
                marks.append(solve(places))
                size += len(marks[-1][0])
                places = []
            route = r
            if kind == MARKS:
                at, doc, tag = _unpack(blob)
                marks.append((doc, at.view(np.int64), tag))
                size += len(doc)
            else:
                places.append(blob)
            if size > FLUSH_MARKS:
                yield from sent()
                marks, size = [], 0
    if places:
        marks.append(solve(places))
    yield from sent()


def _by_document(blobs: list[bytes]) -> dict[tuple[int, int], np.ndarray]:
    if not blobs:
        return {}
    at, doc, tag = _joined(blobs)
    order = np.lexsort((tag, doc))
    doc, at, tag = doc[order], at[order].view(np.int64), tag[order]
    edges = [*np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]).tolist(), len(doc)]
    return {(int(doc[a]), int(tag[a])): at[a:b] for a, b in zip(edges, edges[1:], strict=False)}


def _marked_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, np.ndarray | None] | None]:
    """Rows sorted by route and kind -> (document, tag, compressed text, marks); None after each batch."""
    route, blobs, marks = None, [], None
    for batch in batches:
        for r, kind, doc, blob in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if r != route:
                route, blobs, marks = r, [], None
            if kind == MARKS:
                blobs.append(blob)
            else:
                if marks is None:
                    marks, blobs = _by_document(blobs), []
                tag = int.from_bytes(blob[:8], "little")
                yield doc, tag, blob[8:], marks.get((doc, tag))
        yield None


def _spread(starts: np.ndarray, low: int, high: int, n: int) -> np.ndarray:
    """Which of n places lie in start + [low, high) of any start."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.clip(starts + low, 0, n), 1)
    np.add.at(edge, np.clip(starts + high, 0, n), -1)
    return np.cumsum(edge[:n]) > 0


def _extended(batches: Iterator[pa.RecordBatch], routes: int) -> Iterator[pa.RecordBatch]:
    """Texts with the places of their repeated anchors -> places of whole windows, and marks of windows that come later."""
    words, held, size, unzip = WordHashes(), [], 0, zstandard.ZstdDecompressor().decompress

    def flushed() -> Iterator[pa.RecordBatch]:
        h, doc, at, tag, later, equal = _later(*(np.concatenate(x) for x in zip(*held, strict=True)))
        stay = ~later & ~equal
        own = np.flatnonzero(stay)
        own = own[np.lexsort((at[own], doc[own]))]
        rows = [*_marks(routes, doc[later], at[later], tag[later]), *_places(routes, h[own], doc[own], at[own], tag[own])]
        if rows:
            yield _batch(rows)

    for row in _marked_texts(batches):
        if row and row[3] is not None:
            own = unzip(row[2]).split()
            hashes = window_hashes(np.fromiter(map(words.__getitem__, own), np.uint64, len(own)), WINDOW)
            at = np.flatnonzero(_spread(row[3], 1 - PERIOD, 1, len(hashes)))
            held.append((hashes[at], np.full(len(at), row[0], np.int64), at, np.full(len(at), row[1], np.int64)))
            size += len(at)
        if size > FLUSH_MARKS:
            yield from flushed()
            held, size = [], 0
    if size:
        yield from flushed()


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the starts of their repeated windows -> doc_id, n_words, n_removed, kept_text."""
    unzip, rows = zstandard.ZstdDecompressor().decompress, []
    for row in _marked_texts(batches):
        if row:
            words = unzip(row[2]).split()
            n = len(words)
            if row[3] is not None:
                gone = _spread(row[3], 0, WINDOW, n)
                words = [words[i] for i in np.flatnonzero(~gone).tolist()]
            rows.append((None if row[0] == NO_ID else row[0], n, n - len(words), b" ".join(words)))
        if rows and (row is None or len(rows) >= 500):
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:3]), pa.array([r[3] for r in rows], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])
            rows = []


#: Stands for a null doc_id: it comes after all others.
NO_ID = (1 << 63) - 1


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_text: the words left, joined by a space, of every row.

    A word goes if a window of 20 words over it also starts earlier in the input: at a smaller doc_id, or earlier in the
    same document. Rows with the same doc_id count as one document in this order, so a window at the same place of
    two of them spares both. A null
    doc_id comes after all others. Null and empty texts have no words. An empty table gives no rows. Windows are compared
    by 64-bit hashes. Documents are dealt by id and text, so many rows without an id are no single task's (rows with one id
    and one text are); a task holds a very long text and its word hashes. Other columns, whatever their names, are ignored.
    """
    kept = docs.select(F.coalesce(quoted(id_column).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(quoted(text_column).cast("string"), F.lit("")).cast("binary").alias("text"))

    # marks are told by id and position; only where an id has several texts do they need to tell these apart
    several, size = _facts(kept)
    tag = _tag if several else lambda _: 0
    routes, parts = deal(size, shuffle_partitions(docs))

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Anchors(routes, tag)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found.add(doc, text.as_py())
                if found.size > FLUSH_WORDS and (rows := list(found.flushed())):
                    yield _batch(rows)
        if rows := list(found.flushed()):
            yield _batch(rows)

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(1).compress
        for batch in batches:
            ids, n = batch.column(0).to_numpy(), batch.num_rows
            if n:
                texts = batch.column(1).to_pylist()
                tags = np.array([tag(t) for t in texts], np.int64)
                blobs = pa.array([k.tobytes() + press(t) for k, t in zip(tags, texts, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(_document_routes(ids, tags, routes)), pa.array(np.full(n, TEXT, np.int32)), pa.array(ids), blobs], schema=_SCHEMA)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "route").sortWithinPartitions("route", "kind")

    def anchors_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _solved(batches, _again, routes)

    def windows_hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _extended(batches, routes)

    def windows_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _solved(batches, _later_places, routes)

    texts = kept.mapInArrow(zipped, _ROWS)
    anchors = dealt(kept.mapInArrow(anchored, _ROWS)).mapInArrow(anchors_met, _ROWS)
    windows = dealt(anchors.union(texts)).mapInArrow(windows_hashed, _ROWS)
    marks = dealt(windows).mapInArrow(windows_met, _ROWS)
    return dealt(marks.union(texts)).mapInArrow(_removed, "doc_id long, n_words long, n_removed long, kept_text string")
