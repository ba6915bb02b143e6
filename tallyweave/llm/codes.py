"""Vector code compression: each vector becomes a few small codes, by integer codebooks that all machines agree on.

Components become integers, floor(256 * x), and a vector is cut into equal parts. Each part position has a codebook, whose
entries start as that part of the vectors with the smallest ids. In each round Arrow batches find each part's nearest entry
(squared distances by the norm expansion |x|^2 - 2 x.e + |e|^2, in exact int64 matrix products; the first of equals), and a
grouped shuffle sums the parts of each entry; the entry becomes their floored mean. Only codebooks (entries x width) and
one sum for each entry and task leave the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import cut_lineage, quoted, with_facts

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integers beyond it are taken for it, so that no distance leaves 64 bits (vectors of up to 8,192 components).
LARGEST = 1 << 24
#: Vectors whose distances are held at once.
ROWS_HELD = 4096


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def integers(vectors: pa.ListArray, width: int) -> np.ndarray:
    """floor(SCALE * x), a row of `width` for each vector; missing components are 0."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    whole = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return whole.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = whole
    return out


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, squared distance) of each vector (rows) and part (columns). books: part, entry, position."""
    parts, _, step = books.shape
    code, error = np.empty((len(x), parts), np.int64), np.empty((len(x), parts), np.int64)
    for p in range(parts):
        own, book = np.ascontiguousarray(x[:, p * step : (p + 1) * step]), books[p]
        gap = (own * own).sum(1)[:, None] - 2 * (own @ book.T) + (book * book).sum(1)[None, :]
        code[:, p] = gap.argmin(1)
        error[:, p] = np.take_along_axis(gap, code[:, p, None], 1)[:, 0]
    return code, error


def _pieces(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS_HELD):
        yield at, integers(batch.column("v").slice(at, ROWS_HELD), width)


def _summing(books: np.ndarray, width: int):
    """Vectors -> for each part and entry of this task: how many parts are nearest to it, and their sums."""
    parts, entries, step = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(parts * entries, np.int64)
        total = np.zeros((parts * entries, step), np.int64)
        for batch in batches:
            for _, x in _pieces(batch, width):
                slot = (nearest(x, books)[0] + np.arange(parts) * entries).ravel()
                order = np.argsort(slot, kind="stable")
                used, first = np.unique(slot[order], return_index=True)
                count[used] += np.diff(np.r_[first, len(slot)])
                if step:
                    total[used] += np.add.reduceat(x.reshape(-1, step)[order], first, axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(used, pa.int64()), "n": count[used], "s": pa.array(list(total[used]), pa.list_(pa.int64()))})

    return summed


def _coding(books: np.ndarray, width: int):
    """Adds code and error to rows."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _pieces(batch, width):
                code, error = nearest(x, books)
                texts = [bytes(row).hex() for row in code.astype(np.uint8)]
                mine = batch.slice(at, len(x))
                yield pa.RecordBatch.from_arrays([mine.column("vec_id"), mine.column("label"), pa.array(texts, pa.string()), pa.array(error.sum(1))], ["vec_id", "label", "code", "error"])

    return coded


def fit_codebooks(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) of `vectors` (vec_id, v: usable arrays of doubles, of at most `width`, a multiple of parts).

    They start as the parts of the vectors with the smallest vec_id (null last; of equal ids the smaller vector first); with
    fewer vectors than entries there are fewer entries. Entries that no part is nearest to stay.
    """
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).toArrow()
    first = integers(seeds.column("v").combine_chunks(), width) if seeds.num_rows else np.zeros((0, width), np.int64)
    books = np.ascontiguousarray(first.reshape(len(first), parts, width // parts).transpose(1, 0, 2))
    if not books.size:
        return books
    step = width // parts
    for _ in range(rounds):
        found = vectors.select("v").mapInArrow(_summing(books, width), "slot long, n long, s array<long>")
        # decimals: sums over any number of rows stay exact
        sums = [F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(step)]
        new = books.reshape(-1, step).copy()
        for row in found.groupBy("slot").agg(F.sum("n").alias("n"), *sums).collect():  # at most parts x entries rows
            new[row["slot"]] = [int(row[f"s{k}"]) // row["n"] for k in range(step)]
        books = new.reshape(books.shape)
    return books


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of each usable vector.

    Rows go whose vector is null or holds null, NaN or infinite components. Vectors shorter than the longest are read as if
    zeros followed, and its length is rounded up to a multiple of `parts`; integers beyond LARGEST (components beyond 65,536)
    count as that. Repeated rows give a row each. Null labels are one label; a label_error that does not fit 64 bits is null.
    An empty table, or one without usable vectors, gives no rows. Other columns are ignored, whatever their names.
    """
    vector = quoted(vector_column).cast("array<double>")
    kept = table.select(quoted(id_column).cast("long").alias("vec_id"), quoted(label_column).alias("label"), vector.alias("v")).where(usable(F.col("v")))
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts) * parts
    books = fit_codebooks(kept, width, parts, entries, rounds)
    kind = table.select(quoted(label_column).alias("label")).schema["label"].dataType.simpleString()
    coded = cut_lineage(kept.mapInArrow(_coding(books, width), f"vec_id long, label {kind}, code string, error long"))
    totals = cut_lineage(coded.groupBy("label").agg(F.count("*").alias("n"), F.try_sum("error").alias("label_error")))
    rows = with_facts(coded, totals, "label", "n")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
