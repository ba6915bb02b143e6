"""Texts as WAV media, with spectral-peak pair fingerprints.

A text's bytes, padded by zeros to a multiple of 64, are the samples of a mono 8-bit WAV file, written and read back by
the wave module. A short-time Fourier transform of the samples gives, for each frame and frequency band, a strongest bin;
those that no neighbouring frame exceeds are peaks. Payloads that fit one frame are cut into shorter ones, of at most a
quarter of their length. Each peak is paired with the peaks that follow it. If a text has no such pair, peaks of different bands are paired within their frames, and if there are none either, each
peak with itself; so every text with a peak has a fingerprint. The fingerprint is two arrays: the time (frame) of each pair,
and its code from both bins and the distance in time.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import columns_without, quoted, spare_names

UNIT, RATE = 64, 8000
FRAME, HOP, BANDS = 256, 128, 4
#: A peak is paired with so many of the next peaks, at most so many frames later.
FAN, REACH = 2, 31
_BAND = FRAME // 2 // BANDS


def to_wav(text: bytes | None) -> bytes:
    payload = text or b""
    payload += bytes(-len(payload) % UNIT if payload else UNIT)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def frame_length(samples: int) -> int:
    """FRAME; for samples that fit one such frame, the largest power of two up to a quarter of them, 16 at least."""
    return FRAME if samples > FRAME else max(16, 1 << max(1, samples // 4).bit_length() - 1)


_HANN = {n: np.hanning(n + 1)[:n] for n in (16, 32, 64, FRAME)}


#: Frames whose spectra are held at once.
FRAMES_HELD = 2048


def strongest(x: np.ndarray, frame: int, hop: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, height) of the strongest bin of each frame (rows) and band (columns), by pieces of FRAMES_HELD frames."""
    frames = 1 + -(-max(0, len(x) - frame) // hop)
    best, height = np.empty((frames, BANDS), np.int64), np.empty((frames, BANDS))
    for at in range(0, frames, FRAMES_HELD):
        n = min(FRAMES_HELD, frames - at)
        part = x[at * hop : (at + n - 1) * hop + frame].astype(np.float32) - 128
        part = np.pad(part, (0, frame + hop * (n - 1) - len(part)))
        windows = np.lib.stride_tricks.sliding_window_view(part, frame)[::hop]
        power = np.abs(np.fft.rfft(windows * _HANN[frame], axis=1)[:, 1:]).reshape(n, BANDS, width)
        best[at : at + n] = power.argmax(2)
        # rounded, so that the order of equal peaks does not hang on the last bits
        height[at : at + n] = np.round(np.take_along_axis(power, best[at : at + n, :, None], 2)[:, :, 0], 2)
    return best, height


def peak_pairs(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(times, codes) of 8-bit samples; code = (first bin * 128 + second bin) * 32 + frames between, 0 within a frame."""
    x = np.frombuffer(samples, np.uint8)
    shorter = FRAME // frame_length(len(x))
    best, height = strongest(x, FRAME // shorter, HOP // shorter, _BAND // shorter)
    edge = np.zeros((1, BANDS))
    peak = (height > 0) & (height > np.vstack([edge, height[:-1]])) & (height >= np.vstack([height[1:], edge]))
    time, band = np.nonzero(peak)
    code = band * _BAND + (best[time, band] + 1) * shorter - 1  # of the same frequency in frames of FRAME
    first, second, gap = [], [], []
    for k in range(1, FAN + BANDS):
        d = time[k:] - time[:-k]
        here = np.flatnonzero((d > 0) & (d <= REACH))
        first.append(here)
        second.append(here + k)
        gap.append(d[here])
    first, second, gap = (np.concatenate(v) for v in (first, second, gap))
    order = np.lexsort((second, first))
    first, second, gap = first[order], second[order], gap[order]
    begins = np.searchsorted(first, first)
    keep = np.arange(len(first)) - begins < FAN
    first, second, gap = first[keep], second[keep], gap[keep]
    if not len(first) and len(time):
        here = [np.flatnonzero(time[k:] == time[:-k]) for k in range(1, BANDS)]
        first, second = np.concatenate(here), np.concatenate([h + k for k, h in enumerate(here, 1)])
        if not len(first):
            first = second = np.arange(len(time))
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        gap = np.zeros(len(first), np.int64)
    return time[first], (code[first] * (FRAME // 2) + code[second]) * (REACH + 1) + gap


def with_media(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds n_bytes (of the text's UTF-8; null texts count as empty) and media, a WAV file.

    Empty tables, repeated rows and other columns, whatever their names, pass through; columns with an added column's name
    are replaced. A text costs its size a few times in memory, however long it is.
    """

    @F.arrow_udf("binary")
    def written(texts: pa.Array) -> pa.Array:
        return pa.array([to_wav(t.as_py()) for t in texts], pa.binary())

    text = F.coalesce(quoted(text_column).cast("string"), F.lit("")).cast("binary")
    return docs.select(*columns_without(docs, "n_bytes", "media"), F.length(text).cast("long").alias("n_bytes"), written(text).alias("media"))


def with_media_features(media: DataFrame, media_column: str = "media") -> DataFrame:
    """Adds what is read back from WAV files: payload_bytes, payload_sha256, tail_crc32 (of the last 64), and the
    fingerprint's arrays peak_times and peak_codes. A null file gives nulls.
    """
    schema = pa.struct([("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("peak_times", pa.list_(pa.int32())), ("peak_codes", pa.list_(pa.int32()))])
    names = [f.name for f in schema]

    @F.arrow_udf("payload_bytes long, payload_sha256 string, tail_crc32 long, peak_times array<int>, peak_codes array<int>")
    def read(files: pa.Array) -> pa.Array:
        rows = []
        for file in files:
            if (stored := file.as_py()) is None:
                rows.append(None)
                continue
            payload = from_wav(stored)
            times, codes = peak_pairs(payload)
            rows.append(dict(zip(names, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), times, codes), strict=True)))
        return pa.array(rows, schema)

    (held,) = spare_names(media.columns, "_read")
    rows = media.select(*columns_without(media, *names), read(quoted(media_column)).alias(held))
    return rows.select(*columns_without(rows, held), f"{held}.*")


def feature_text(times: str = "peak_times", codes: str = "peak_codes") -> Column:
    """time:code of each pair, joined by commas."""
    return F.concat_ws(",", F.zip_with(times, codes, lambda t, c: F.concat(t.cast("string"), F.lit(":"), c.cast("string"))))
