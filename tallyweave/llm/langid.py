"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean embedding of the hashed character n-grams of its words; a linear softmax over it gives the
language. Embeddings and softmax are trained together by stochastic gradient descent in numpy on a bounded sample of
labelled rows. A temperature fitted on rows kept from training calibrates the probabilities, and the confidence that
nearly all correct calibration texts exceed is the rejection threshold.

As the model is linear in the mean, a word adds a fixed vector of logits. These are cached by word, so that a text
costs a lookup for each of its words.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import columns_without, quoted, spare_names, worker_cache

UNKNOWN = "und"
BUCKETS, DIMENSIONS = 1 << 13, 16
#: The bounds of the training sample: about so many labelled rows for each language, and so many in all, of which only
#: n-gram shares reach the driver (at most 6 bytes a bucket for each row, however long its text). Languages that are learned.
ROWS_PER_LABEL, SAMPLE_ROWS, MOST_LABELS = 500, 20_000, 1000
CACHED_WORDS = 250_000


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    #: logits by n-gram bucket (embeddings times softmax weights), and the bias
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


ADDED = ("lang_pred", "score", "lang_rejected")


class _Grams(dict):
    def __missing__(self, gram: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[gram] = k = zlib.crc32(gram.encode()) % BUCKETS
        return k


_bucket = _Grams().__getitem__


def ngrams(word: str) -> list[int]:
    """Buckets of a lower-case word's n-grams of 2 to 4 characters with its ends marked, and of the word."""
    marked = f"<{word}>"
    n = len(marked)
    parts = [marked[i : i + 2] for i in range(n - 1)]
    parts += [marked[i : i + 3] for i in range(n - 2)]
    parts += [marked[i : i + 4] for i in range(n - 3)]
    return [zlib.crc32(word.encode()) % BUCKETS, *map(_bucket, parts)]


#: ASCII characters that are no letters and no white space, and lower case for the others: a text's words come out shorter and fewer.
_NO_LETTERS = bytes(b for b in range(128) if not bytes([b]).isalpha() and not bytes([b]).isspace())
_LOWER = bytes(range(256)).lower()


def _normal(word: str) -> str:
    """The letters of a word, lower-cased; its digits and marks tell no language."""
    return "".join(c for c in word.lower() if c.isalpha())


def _words(text: bytes) -> list[bytes]:
    """A text's words, as training and prediction both take them: split at ASCII white space, without ASCII marks and digits."""
    return text.translate(_LOWER, _NO_LETTERS).split()


def _counts(words: list[str], cache: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    found: list[int] = []
    for w in words:
        if w not in cache:
            if len(cache) > CACHED_WORDS:
                cache.clear()
            cache[w] = ngrams(w)
        found += cache[w]
    at, n = np.unique(np.asarray(found, np.int64), return_counts=True)
    return at.astype(np.int16), (n / max(1, n.sum())).astype(np.float32)


#: What training needs of a text: shares of n-grams of the text and of spans of it.
Spans = list[tuple[np.ndarray, np.ndarray]]


def training_spans(text: bytes, cache: dict[str, list[int]]) -> Spans:
    """The n-gram shares of a text, and of two short spans of its words, drawn by its hash; none for texts without letters."""
    words = [w for w in (_normal(w.decode("utf-8", "replace")) for w in _words(text)) if w]
    if not words:
        return []
    rng, spans = np.random.default_rng(zlib.crc32(text)), [words]
    for _ in range(2):
        n = int(rng.integers(1, 10))
        at = int(rng.integers(0, max(1, len(words) - n + 1)))
        spans.append(words[at : at + n])
    return [_counts(s, cache) for s in spans]


def _is_held(text: bytes) -> bool:
    return zlib.crc32(b"held " + text) % 5 == 0


def train(texts: list[str], labels: list[str], **more) -> LanguageModel:
    """`train_spans` of texts that are at hand."""
    cache: dict[str, list[int]] = {}
    return train_spans([(training_spans(t.encode(), cache), label, _is_held(t.encode())) for t, label in zip(texts, labels, strict=True)], **more)


def train_spans(found: list[tuple[Spans, str, bool]], seed: int = 5, epochs: int = 12, batch: int = 32, rate: float = 20.0, least_steps: int = 1500) -> LanguageModel:
    """found: spans, label, and whether a text is kept for calibration: about a fifth, by hash, so that copies stay together.

    Texts without letters say nothing: labels that have no others are not learned, and without any label the model is empty.
    """
    found = [x for x in found if x[0]]
    names = sorted({x[1] for x in found})
    if not names:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    rows: list[list] = [[], []]
    for spans, label, held in found:
        rows[held] += [(s, names.index(label)) for s in spans]
    fit, held = rows if rows[0] and rows[1] else (rows[0] + rows[1],) * 2
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weight, bias = np.zeros((DIMENSIONS, len(names)), np.float32), np.zeros(len(names), np.float32)
    each = max(1, -(-len(fit) // batch))
    epochs = max(epochs, -(-least_steps // each))  # small samples are passed more often
    steps, done = epochs * each, 0
    for _ in range(epochs):
        order = rng.permutation(len(fit))
        for i in range(0, len(order), batch):
            own = [fit[j] for j in order[i : i + batch]]
            at = np.concatenate([x[0][0] for x in own]).astype(np.int64)
            share = np.concatenate([x[0][1] for x in own])[:, None]
            first = np.cumsum([0, *(len(x[0][0]) for x in own)])[:-1]
            mean = np.add.reduceat(embed[at] * share, first, axis=0)
            z = mean @ weight + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), [x[1] for x in own]] -= 1
            step = np.float32(rate * (1 - done / steps) / len(own))
            back = p @ weight.T
            weight -= step * 0.1 * (mean.T @ p)
            bias -= step * 0.01 * p.sum(0)
            np.subtract.at(embed, at, step * share * np.repeat(back, np.diff([*first, len(at)]), axis=0))
            done += 1
    table = embed @ weight
    z = np.array([(table[c[0]] * c[1][:, None]).sum(0) + bias for c, _ in held])
    y = np.array([label for _, label in held])

    def loss(t: float) -> float:
        q = z / t - (z / t).max(1, keepdims=True)
        return float((np.log(np.exp(q).sum(1)) - q[np.arange(len(y)), y]).mean())

    temperature = min(np.geomspace(0.2, 5, 60), key=loss)
    q = np.exp(z / temperature - (z / temperature).max(1, keepdims=True))
    sure = (q / q.sum(1, keepdims=True)).max(1)[z.argmax(1) == y]
    threshold = float(min(0.5, np.quantile(sure, 0.002))) if len(sure) else 0.0
    return LanguageModel(names, table, bias, float(temperature), threshold)


def fit_language_model(docs: DataFrame, text_column: str = "text", label_column: str = "lang", id_column: str = "doc_id", rows_per_label: int = ROWS_PER_LABEL, most_labels: int = MOST_LABELS) -> LanguageModel:
    """Trains on rows with a label and a text. The sample is by a hash of id and text, a fraction for each label.

    About `rows_per_label` rows a label, at most SAMPLE_ROWS in all, are described in their tasks; their n-gram shares reach the
    driver, never their texts, however long. The `most_labels` labels with most rows are learned (of equals the first by code point): a
    softmax holds a row for each. No usable labelled rows: a model without labels.
    """
    rows = docs.select(quoted(id_column).cast("string").alias("i"), quoted(text_column).cast("string").alias("t"), quoted(label_column).cast("string").alias("l")).where("t is not null and l is not null")
    counts = {r[0]: r[1] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(most_labels).collect()}
    if not counts:
        return train([], [])
    each = min(rows_per_label, max(1, SAMPLE_ROWS // len(counts)))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))])
    rows = rows.withColumn("d", F.pmod(F.xxhash64("i", F.lit("langid")), F.lit(1 << 30)) / (1 << 30))

    @F.arrow_udf("struct<held boolean, sizes array<int>, grams binary, shares binary, tie binary>")
    def described(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache: dict[str, list[int]] = {}
        for part in texts:
            out = []
            for t in part:
                text = t.as_py()
                spans = training_spans(text, cache)
                joined = [b"".join(s[k].tobytes() for s in spans) for k in (0, 1)]
                out.append({"held": _is_held(text), "sizes": [len(s[0]) for s in spans], "grams": joined[0], "shares": joined[1], "tie": hashlib.sha256(text).digest()})
            yield pa.array(out, pa.struct([("held", pa.bool_()), ("sizes", pa.list_(pa.int32())), ("grams", pa.binary()), ("shares", pa.binary()), ("tie", pa.binary())]))

    # the order carries what is sent, and not texts
    picked = rows.where(F.col("d") < F.element_at(share, F.col("l"))).select("d", "l", described.asNondeterministic()(F.col("t").cast("binary")).alias("x"))
    order = ["d", "x.tie", "l"]
    sample = picked.orderBy(*order).limit(min(2 * each * len(counts), 2 * SAMPLE_ROWS)).select("l", "x.*").toArrow().to_pylist()
    found = []
    for r in sorted(sample, key=lambda r: (r["tie"], r["l"])):
        grams, shares, cuts = np.frombuffer(r["grams"], np.int16), np.frombuffer(r["shares"], np.float32), np.cumsum([0, *r["sizes"]])
        found.append(([(grams[a:b], shares[a:b]) for a, b in itertools.pairwise(cuts)], r["l"], r["held"]))
    return train_spans(found)


class _Words(dict):
    """Word (bytes) -> its row in `table`: summed logits, number of n-grams."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.table = np.zeros((1024, len(model.labels) + 1), np.float32)

    def learn(self, words: list[bytes]) -> None:
        """Adds words that are not there, all at once."""
        first = len(self)
        found = [ngrams(x) if (x := _normal(w.decode("utf-8", "replace"))) else [] for w in words]
        while len(self.table) < first + len(found):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        rows = self.table[first : first + len(found)]
        rows[:] = 0
        if sizes.any():
            flat = np.fromiter((g for x in found for g in x), np.int64, int(sizes.sum()))
            starts = np.cumsum(sizes) - sizes
            rows[sizes > 0, :-1] = np.add.reduceat(self.model.logits[flat], starts[sizes > 0], axis=0)
            rows[:, -1] = sizes
        self.update(zip(words, range(first, first + len(found)), strict=True))


def predict(model: LanguageModel, texts: list[bytes | None], words: _Words | None = None) -> Iterator[tuple[str, float, bool]]:
    """Label, calibrated probability and whether it is rejected, of each text."""
    words = _Words(model) if words is None else words
    for text in texts:
        own = _words(text or b"")
        total = np.zeros(len(model.labels) + 1)
        for i in range(0, len(own), 1 << 16):
            part = own[i : i + (1 << 16)]
            distinct = set(part)
            if len(words) + len(distinct) > CACHED_WORDS:
                words.clear()
            if new := [w for w in distinct if w not in words]:
                words.learn(new)
            total += words.table[np.fromiter(map(words.__getitem__, part), np.int64, len(part))].sum(0, dtype=np.float64)
        if total[-1] == 0 or not model.labels:
            yield UNKNOWN, 0.0, True
            continue
        z = (total[:-1] / total[-1] + model.bias) / model.temperature
        p = np.exp(z - z.max())
        score = float(p.max() / p.sum())
        yield model.labels[int(p.argmax())], score, score < model.threshold


def identify_language(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """Adds lang_pred, score (0 to 1) and lang_rejected, from the whole text alone.

    A text that is null or has no letter gets `und`, 0 and is rejected; others get a learned label. Very long texts are read
    whole, 65,536 words at a time. Empty tables, repeated
    rows and other columns, whatever their names, pass through; columns with an added column's name are replaced (a text
    column of such a name is read first).
    """

    # not deterministic to the optimizer: a filter on what is found must not run the function a second time
    @F.arrow_udf("struct<lang_pred string, score double, lang_rejected boolean>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = worker_cache(model.logits.tobytes() + model.bias.tobytes(), lambda: _Words(model))
        for batch in batches:
            rows = list(predict(model, batch.to_pylist(), words))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.StructArray.from_arrays(columns, ADDED)

    (held,) = spare_names(docs.columns, "_language")
    rows = docs.select(*columns_without(docs, *ADDED), found.asNondeterministic()(quoted(text_column).cast("string").cast("binary")).alias(held))
    return rows.select(*columns_without(rows, held), f"{held}.*")
