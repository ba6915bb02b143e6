"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its whole text. Of a pair of a better and a worse document, the better
wins with the logistic of the difference of strengths. Weights are fitted to all pairs of a better and a worse labelled
document by logistic loss, with Newton steps. The cut between good and bad is the quantile of all labelled strengths at
the share of bad labels. A score is the logistic of strength less the cut, shifted so that the cut lies at a given score.

Pairs are never made. What a row adds to the slope is a smooth function of its strength, given how the other label's
strengths are spread, so one pass counts rows by narrow bins of strength (with means and variances), and the next sums
each row's part. The driver holds sums by bin or by feature, never rows. Sums by bin are of integers and weights lie on a
grid, so results don't depend on how rows are dealt.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import columns_without, cut_lineage, quoted

CUT_SCORE = 0.3
DECAY, STEPS, LAST_STEP = 1e-4, 30, 1e-3
#: Bits behind the point, so that sums and products stay exact: of raw features, of standardised features (at most 6), of weights (under 128).
RAW_BITS, X_BITS, W_BITS = 24, 22, 14
#: Strengths beyond 128 count as that in training. Bits of a strength within a bin, of which there are 16 to the unit, and bits left out of offsets.
LIMIT, BIN_BITS, OFF_BITS = 128 << (X_BITS + W_BITS), X_BITS + W_BITS - 4, 20
#: Points at which the driver tells what rows of a strength add.
POINTS = 4097

_BYTE_SETS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".", b",", b"!?", b"|", b"*&%$#", b"@/\\:=_-+", b"\"'()[]{}<>;~^`", bytes(range(128, 256))]
_MEMBER = np.array([[b in s for s in _BYTE_SETS] for b in range(256)], np.float64)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float


def features(text: bytes | None) -> list[float]:
    """Shares of kinds of bytes, lengths, and repetition of words, word pairs and lines."""
    text = text or b""
    n = len(text)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _MEMBER / max(1, n)
    words, lines = text.split(), text.split(b"\n")
    w, distinct = len(words), len(set(words))
    most = Counter(words).most_common(1)[0][1] if words else 0
    follow = sum(a == b for a, b in zip(words, words[1:], strict=False))
    marks = sum(x[-1:] not in b"abcdefghijklmnopqrstuvwxyz.," for x in words)
    longest = max(map(len, words), default=0)
    root = kinds**0.5
    return [
        *kinds, *root, np.log1p(n), np.log1p(w), n / max(1, w), distinct / max(1, w), most / max(1, w), follow / max(1, w - 1),
        marks / max(1, w), np.log1p(longest), len(set(lines)) / len(lines), w / len(lines) / 100, float(n == 0), float(w < 5),
    ]


WIDTH = len(features(b""))


def describe(docs: DataFrame, name: str = "features", text_column: str = "text") -> DataFrame:
    """Adds column `name`, the features of the whole text (null: empty); a column of that name is replaced."""

    @F.arrow_udf("array<double>")
    def described(values: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()) for t in values], pa.list_(pa.float64()))

    return docs.select(*columns_without(docs, name), described(quoted(text_column).cast("string").cast("binary")).alias(name))


def _matrix(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature over all rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.array([0] * WIDTH, object), np.array([0] * WIDTH, object)
        for batch in batches:
            v = np.rint(_matrix(batch["x"]) * 2.0**RAW_BITS).astype(np.int64).astype(object)
            n, one, two = n + len(v), one + v.sum(0), two + (v * v).sum(0)
        whole = pa.decimal128(38, 0)
        yield pa.record_batch({"i": pa.array(range(WIDTH), pa.int32()), "n": pa.array([n] * WIDTH, pa.int64()), "one": pa.array(map(Decimal, one), whole), "two": pa.array(map(Decimal, two), whole)})

    sums = rows.select("x").mapInArrow(summed, "i int, n long, one decimal(38,0), two decimal(38,0)").groupBy("i").agg(*[F.sum(c).alias(c) for c in ("n", "one", "two")])
    mean, scale = np.zeros(WIDTH), np.full(WIDTH, 1e-6)
    for i, n, one, two in sums.collect():
        if n:
            one, two, unit = int(one), int(two), 1 << RAW_BITS
            mean[i], scale[i] = one / (n * unit), (n * two - one * one) ** 0.5 / (n * unit) + 1e-6
    return mean, scale


@dataclass(frozen=True)
class _Bins:
    """Of one label: rows, mean and variance of the strength, and mean standardised features of each bin that has rows."""

    n: np.ndarray
    strength: np.ndarray
    variance: np.ndarray
    x: np.ndarray


@dataclass(frozen=True)
class _Labelled:
    """Labelled rows (`good`, features `x`) and how their features are standardised."""

    rows: DataFrame
    mean: np.ndarray
    scale: np.ndarray

    def gridded(self, weight: np.ndarray) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Labels, standardised features and strengths of a batch, the latter two as whole numbers."""
        mean, scale, w = self.mean, self.scale, weight * 2.0**W_BITS

        def of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            x = np.rint(_standard(_matrix(batch["x"]), mean, scale) * 2.0**X_BITS)
            return batch["good"].to_numpy(zero_copy_only=False), x, np.clip((x @ w).astype(np.int64), -LIMIT, LIMIT - 1)

        return of

    def bins(self, weight: np.ndarray) -> tuple[_Bins, _Bins]:
        """Of bad and of good rows."""
        gridded = self.gridded(weight)
        names = ["n", "off", "squares", *[f"x{i}" for i in range(WIDTH)]]

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                good, x, s = gridded(batch)
                if not len(s):
                    continue
                key, off = 2 * (s >> BIN_BITS) + good, (s & ((1 << BIN_BITS) - 1)) >> OFF_BITS
                order = np.argsort(key, kind="stable")
                own = np.column_stack([np.ones(len(s), np.int64), off, off * off, x.astype(np.int64)])[order]
                keys, first = np.unique(key[order], return_index=True)
                for k, sums in zip(keys.tolist(), np.add.reduceat(own, first, axis=0), strict=True):
                    held[k] = held[k] + sums if k in held else sums
            keys = np.array(list(held), np.int64)
            sums = np.array(list(held.values()), np.int64).reshape(-1, len(names))
            yield pa.record_batch({"good": pa.array(keys & 1), "at": pa.array(keys >> 1)} | {c: pa.array(sums[:, k]) for k, c in enumerate(names)})

        sums = self.rows.mapInArrow(summed, "good long, at long, " + ", ".join(f"{c} long" for c in names)).groupBy("good", "at").agg(*[F.sum(c).alias(c) for c in names])
        found = np.array(sorted(map(tuple, sums.collect())), np.int64).reshape(-1, len(names) + 2)

        def of(label: int) -> _Bins:
            v = found[found[:, 0] == label].astype(float)
            n, unit = v[:, 2], 2.0 ** (X_BITS + W_BITS - OFF_BITS)
            off = v[:, 3] / n
            return _Bins(n, v[:, 1] / 16 + off / unit, np.maximum(v[:, 4] / n - off * off, 0) / unit**2, v[:, 5:] / n[:, None] / 2.0**X_BITS)

        return of(0), of(1)

    def slopes(self, weight: np.ndarray, points: np.ndarray, pull: np.ndarray, bend: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all rows of features times `pull`, and of products of each two features times `bend`; both are given by label at strengths `points`."""
        gridded = self.gridded(weight)
        names = [f"x{i}" for i in range(WIDTH)]

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((WIDTH + 1, WIDTH))
            for batch in batches:
                good, x, s = gridded(batch)
                x, s = x / 2.0**X_BITS, s / 2.0 ** (X_BITS + W_BITS)
                for label in (0, 1):
                    own, at = x[good == label], s[good == label]
                    total[:-1] += (own * np.interp(at, points, bend[label])[:, None]).T @ own
                    total[-1] += np.interp(at, points, pull[label]) @ own
            yield pa.record_batch({"i": pa.array(range(WIDTH + 1), pa.int32())} | {c: pa.array(total[:, k]) for k, c in enumerate(names)})

        sums = self.rows.mapInArrow(summed, "i int, " + ", ".join(f"{c} double" for c in names)).groupBy("i").agg(*[F.sum(c).alias(c) for c in names])
        total = np.array([r[1:] for r in sorted(map(tuple, sums.collect()))])
        return total[-1], total[:-1]

    def cut(self, weight: np.ndarray, below: int) -> float:
        """Halfway between the `below`-th smallest strength and the next larger one, to 2**-20 at equal ones."""
        gridded = self.gridded(weight)

        def strengths_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.record_batch({"s": pa.array(gridded(batch)[2])})

        s, edge = self.rows.mapInArrow(strengths_of, "s long"), None
        for bits in (BIN_BITS, 16):
            within = s if edge is None else s.where((F.col("s") >= edge << BIN_BITS) & (F.col("s") < (edge + 1) << BIN_BITS))
            for part, n in sorted(map(tuple, within.groupBy(F.shiftright("s", bits).alias("part")).count().collect())):
                edge = part
                if below <= n:
                    break
                below -= n
        top = (edge + 1) << 16
        low, high = s.agg(F.max(F.when(F.col("s") < top, F.col("s"))), F.min(F.when(F.col("s") >= top, F.col("s")))).first()
        return (low + (top if high is None else high)) / 2 / 2.0 ** (X_BITS + W_BITS)


def _blocks(bad: _Bins, good: _Bins) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Of 256 bins of good rows at a time, with all bins of bad ones: gaps of strength, shares of all pairs, and the loss's second derivative."""
    for k in range(0, len(good.n), 256):
        some = slice(k, k + 256)
        gap = good.strength[some, None] - bad.strength
        lost = 1 / (1 + np.exp(np.clip(gap, -700, 700)))
        yield some, gap, good.n[some, None] * bad.n / (good.n.sum() * bad.n.sum()), lost * (1 - lost)


def _loss(bad: _Bins, good: _Bins) -> float:
    """Mean loss over all pairs, by its value and second derivative at the means of each two bins."""
    return sum(float((share * (np.logaddexp(0, -gap) + bend * (good.variance[some, None] + bad.variance) / 2)).sum()) for some, gap, share, bend in _blocks(bad, good))


def _mixed(bad: _Bins, good: _Bins) -> np.ndarray:
    """The second derivative's products of a good and a bad row's features, by means of bins; it shapes steps, not where they end."""
    one = sum(good.x[some].T @ (share * bend) @ bad.x for some, _, share, bend in _blocks(bad, good))
    return one + one.T


def _against(points: np.ndarray, other: _Bins, sign: int, n: float) -> tuple[np.ndarray, np.ndarray]:
    """What a row at each of `points` adds to the first and second derivative of the mean loss with all rows of the other label; sign: 1 for good rows."""
    pull, bend = np.zeros(len(points)), np.zeros(len(points))
    for k in range(0, len(points), 256):
        some = slice(k, k + 256)
        lost = 1 / (1 + np.exp(np.clip(sign * (points[some, None] - other.strength), -700, 700)))
        turn = lost * (1 - lost)
        pull[some] = -sign * (lost + turn * (1 - 2 * lost) * other.variance / 2) @ other.n / other.n.sum() / n
        bend[some] = turn @ other.n / other.n.sum() / n
    return pull, bend


def fit_weights(rows: _Labelled, decay: float = DECAY) -> np.ndarray:
    """Weights of least mean loss over all pairs plus decay / 2 times their squares, by Newton steps; one that does not lower that is halved."""

    def at(w: np.ndarray) -> tuple[np.ndarray, _Bins, _Bins, float]:
        w = np.clip(np.rint(w * 2.0**W_BITS) / 2.0**W_BITS, -127, 127)
        bad, good = rows.bins(w)
        return w, bad, good, _loss(bad, good) + decay / 2 * float(w @ w)

    weight, bad, good, loss = at(np.zeros(WIDTH))
    for _ in range(STEPS):
        every = np.concatenate([bad.strength, good.strength])
        points = np.linspace(every.min() - 0.1, every.max() + 0.1, POINTS)
        (pull_bad, bend_bad), (pull_good, bend_good) = _against(points, good, -1, bad.n.sum()), _against(points, bad, 1, good.n.sum())
        slope, bend = rows.slopes(weight, points, np.array([pull_bad, pull_good]), np.array([bend_bad, bend_good]))
        step = np.linalg.solve(bend - _mixed(bad, good) + decay * np.eye(WIDTH), slope + decay * weight)
        found = at(weight - step)
        while found[-1] >= loss and np.abs(step).max() > LAST_STEP:
            step = step / 2
            found = at(weight - step)
        if found[-1] < loss:
            weight, bad, good, loss = found
        if np.abs(step).max() <= LAST_STEP:
            break
    return weight


def fit_described(described: DataFrame, labels: DataFrame, rows: int | None = None, id_column: str = "doc_id", label_column: str = "quality", features_column: str = "features") -> QualityModel:
    """`fit_quality_model` of documents whose features are at hand, as `describe` adds them."""
    known = labels.where(quoted(label_column).isin(0, 1) & quoted(id_column).isNotNull()).select(quoted(id_column).alias("i"), quoted(label_column).cast("long").alias("good")).distinct()
    if rows is not None:
        draw = F.pmod(F.xxhash64(F.col("i").cast("string"), F.lit("quality")), F.lit(1 << 30)) / (1 << 30)
        known = known.where(draw < rows / max(1, known.count()))
    docs = described.select(quoted(id_column).alias("j"), quoted(features_column).alias("x"))
    met = cut_lineage(docs.join(known, F.col("i") == F.col("j")).select("good", "x"))
    counts = dict(map(tuple, met.groupBy("good").count().collect()))
    mean, scale = _moments(met)
    if len(counts) < 2:
        return QualityModel(mean, scale, np.zeros(WIDTH), 0.0)
    labelled = _Labelled(met, mean, scale)
    weight = fit_weights(labelled)
    return QualityModel(mean, scale, weight, labelled.cut(weight, counts[0]))


def fit_quality_model(docs: DataFrame, labels: DataFrame, rows: int | None = None, id_column: str = "doc_id", label_column: str = "quality", text_column: str = "text") -> QualityModel:
    """Trains on all labelled documents; null labels are left out. Without both labels the weights are 0.

    `rows`, for trials, draws about so many labels by a hash of the id. Repeated documents count as often as they are there, those
    with both labels in both. Only features are shuffled, not texts. Other columns, whatever their names, are ignored.
    """
    texts = docs.select(quoted(id_column).alias("j"), quoted(text_column).alias("t"))
    return fit_described(describe(texts, "x", "t"), labels.select(quoted(id_column).alias("j"), quoted(label_column).alias("y")), rows, "j", "y", "x")


def _scores(x: np.ndarray, model: QualityModel, cut_score: float) -> pa.Array:
    z = (_standard(x, model.mean, model.scale) * model.weight).sum(1)  # not a matrix product, whose last bits depend on the batch
    z += float(np.log(cut_score / (1 - cut_score))) - model.cut
    return pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))), pa.float64())


def score_described(described: DataFrame, model: QualityModel, features_column: str = "features", cut_score: float = CUT_SCORE) -> DataFrame:
    """`score_quality` of documents whose features are at hand, as `describe` adds them."""

    @F.arrow_udf("double")
    def scored(values: pa.Array) -> pa.Array:
        return _scores(_matrix(values), model, cut_score)

    return described.select(*columns_without(described, "score"), scored(quoted(features_column)).alias("score"))


def score_quality(docs: DataFrame, model: QualityModel, text_column: str = "text", cut_score: float = CUT_SCORE) -> DataFrame:
    """Adds score (0 to 1, higher is better), from the whole text alone.

    Null texts score as empty ones. Empty tables, repeated rows and other columns pass through; a column `score` is replaced.
    """

    @F.arrow_udf("double")
    def scored(values: pa.Array) -> pa.Array:
        return _scores(np.array([features(t.as_py()) for t in values]).reshape(-1, WIDTH), model, cut_score)

    return docs.select(*columns_without(docs, "score"), scored(quoted(text_column).cast("string").cast("binary")).alias("score"))
