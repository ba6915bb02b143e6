"""Packing token sequences into windows by order-preserving dynamic programming.

Documents are tokenized in input order into one stream. Windows are cut at document ends, sentence ends
and, inside overlong sentences, at a coarse grid. For cut positions c the cheapest cost is

    f(j) = penalty(j) + window_cost + min( min f(i) + capacity - (c(j) - c(i)),   0 < c(j) - c(i) <= capacity
                                           min f(i),                              c(j) - c(i) a power of two )

The first minimum is over a sliding window and is kept by a monotone queue on f(i) + c(i); the second has one
candidate for each power of two, which needs no padding. No shuffle: each input partition is one ordered stream.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from unicodedata import is_normalized

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyweave.llm.common import quoted, worker_cache

CAPACITY = 2048
#: Costs in padding tokens: of any window, of a cut inside a document, of a cut inside a sentence.
WINDOW_COST, SPLIT_COST, BREAK_COST = 16, 2, 24
#: Every sentence end is a cut; longer sentences also get cuts at this distance.
LONG_GRID = 32
#: Windows below the capacity whose length is a power of two need no padding; this is the least such length.
LEAST_POWER = 1
#: Tokens that are planned together; the last windows of a plan are planned again with what follows.
BLOCK = 1 << 18
#: Words in each of a worker's two cache generations.
CACHED_WORDS = 200_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, row_key long"
# What a tokenizer that WordTokens knows does to texts before its vocabulary, as its file says it.
KNOWN_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
KNOWN_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
KNOWN_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
# End of fixed values.


def _byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if visible, else 256 onwards."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokens(dict):
    """White-space-separated word (bytes) -> its ids, as little-endian unsigned 32-bit integers.

    The tokenizer lower-cases, composes and drops white space, so a text's ids are those of its words in order.
    Plain words (letters, then punctuation) go to the BPE model directly; all others through the whole tokenizer.
    A full cache becomes the old generation, from which words still in use come back.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.characters = _byte_characters()
        self.old: dict[bytes, bytes] = {}
        #: ids of letters alone and of marks alone
        self.stems: dict[bytes | str, bytes] = {}
        self.marks: dict[bytes | str, bytes] = {}
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def parts(self, text: bytes) -> list[bytes]:
        """The ids of a text's sentences, in order."""
        get = self.__getitem__
        return [b"".join(map(get, sentence.split())) for sentence in sentences(simplified(text))]

    def _model_ids(self, part: str) -> bytes:
        mapped = part if part.isascii() else "".join(map(self.characters.__getitem__, part.encode()))
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(mapped)])

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha():  # ASCII letters alone
                packed = self.packed
                ids = b"".join([packed[t.id] for t in self.tokenize(word.lower().decode())])
            else:
                low = word.lower()
                stem = low.rstrip(b".,!?*&$%#|;:)")
                ids = self._plain(stem, low[len(stem) :]) if stem.isalpha() else self._ids(word)
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _plain(self, stem: bytes | str, mark: bytes | str) -> bytes:
        """Ids of letters followed by marks, both lower-case."""
        ids = self.stems.get(stem)
        if ids is None:
            if len(self.stems) >= CACHED_WORDS:
                self.stems.clear()
                self.marks.clear()
            self.stems[stem] = ids = self._model_ids(stem if isinstance(stem, str) else stem.decode())
        if not mark:
            return ids
        end = self.marks.get(mark)
        if end is None:
            self.marks[mark] = end = self._model_ids(mark if isinstance(mark, str) else mark.decode())
        return ids + end

    def _ids(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        low = text.lower()
        stem = low.rstrip(".,!?*&$%#|;:)")
        if stem.isalpha() and "σ" not in low and "ς" not in low and is_normalized("NFC", text):
            return self._plain(stem, low[len(stem) :])
        return b"".join([self.packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])


class WholeTokens:
    """The ids of whole texts, by any tokenizer; sentences end at the tokens that end with their marks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def parts(self, text: bytes) -> list[bytes]:
        whole = text.decode("utf-8", "replace")
        found = self.tokenizer.encode(whole, add_special_tokens=False)
        out, at = [], 0
        for k, (_, end) in enumerate(found.offsets, 1):
            if k == len(found.ids) or (whole[end - 1 : end] in ".!?\n" and whole[end : end + 1].isspace()) or whole[end - 1 : end] == "\n":
                out.append(b"".join(i.to_bytes(4, "little") for i in found.ids[at:k]))
                at = k
        return out


def known(path: str) -> bool:
    """Whether a tokenizer's file is of the kind whose texts WordTokens may take apart."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    model, marks = said["model"], {a["content"] for a in said.get("added_tokens") or ()}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback")) and all(m.startswith("<|") for m in marks)
    return said.get("normalizer") == KNOWN_NORMALIZER and said.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": [KNOWN_SPLIT, KNOWN_BYTES]} and model["type"] == "BPE" and plain


def tokens(path: str) -> WordTokens | WholeTokens:
    return WordTokens(path) if known(path) else WholeTokens(path)


_SIMPLE = b"abcdefghijklmnopqrstuvwxyz0123456789 \n.,"
_ASCII = bytes(range(128))


def simplified(text: bytes) -> bytes:
    """A text with the same ids and fewer different words: in ASCII lower case, and with its commas and stops set apart.

    Case goes unless a special token could come of it. Marks are set apart only in texts of letters, digits, white space and
    single commas and stops, as runs of marks have ids of their own.
    """
    if b"<|" in text:
        return text
    text = text.lower()
    other = text.translate(None, _SIMPLE)
    if other and (len(other) != len(other.translate(None, _ASCII)) or not other.decode("utf-8", "replace").isalpha()):
        return text
    if b".." in text or b".," in text or b",," in text or b",." in text:
        return text
    return text.replace(b",", b" ,").replace(b".", b" .")


def sentences(text: bytes) -> list[bytes]:
    """A text's parts up to line ends and to `.`, `!` or `?` before a space."""
    return text.replace(b". ", b".\n").replace(b"! ", b"!\n").replace(b"? ", b"?\n").split(b"\n")


def plan_windows(cuts: list[int], costs: list[int], capacity: int = CAPACITY) -> list[int]:
    """The cuts (ascending, from 0, at most `capacity` apart) that end the cheapest windows.

    costs[j] is the penalty of a cut at cuts[j]. Returns indexes into cuts, without 0.
    """
    where = {c: j for j, c in enumerate(cuts)}
    powers = [p for p in (1 << k for k in range(capacity.bit_length())) if LEAST_POWER <= p < capacity]
    best, back = [0] * len(cuts), [0] * len(cuts)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])
    look = where.get
    for j in range(1, len(cuts)):
        here = cuts[j]
        low = here - capacity
        while queue[0][1] < low:
            queue.popleft()
        key, _, came = queue[0]
        least = key - low
        for p in powers:
            i = look(here - p)
            if i is not None and best[i] < least:
                least, came = best[i], i
        best[j] = total = least + costs[j] + WINDOW_COST
        back[j] = came
        key = total + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, j))
    path, j = [], len(cuts) - 1
    while j:
        path.append(j)
        j = back[j]
    return path[::-1]


class Stream:
    """The planned and unplanned tokens of one ordered stream of documents."""

    def __init__(self, words: WordTokens | WholeTokens, eos: int, capacity: int, first_sequence: int):
        self.words, self.eos, self.capacity, self.sequence = words, eos.to_bytes(4, "little"), capacity, first_sequence
        self.buffer: list[bytes] = []
        self.size = 0
        self.cuts, self.costs = [0], [0]
        #: doc_id, position of the first id here (negative if cut before), ids in all, key
        self.docs: list[tuple[int | None, int, int, int]] = []
        self.key = first_sequence

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        began, at = self.size, self.size
        cuts, costs = self.cuts, self.costs
        for ids in self.words.parts(text or b""):
            if not ids:
                continue
            self.buffer.append(ids)
            n = len(ids) >> 2
            if n > LONG_GRID:
                for p in range(at + LONG_GRID, at + n, LONG_GRID):
                    cuts.append(p)
                    costs.append(BREAK_COST)
            at += n
            cuts.append(at)
            costs.append(SPLIT_COST)
        if cuts[-1] == at and at > began:  # the end id stays with what it ends
            cuts.pop()
            costs.pop()
        self.buffer.append(self.eos)
        self.size = at + 1
        cuts.append(self.size)
        costs.append(0)
        self.docs.append((doc_id, began, self.size - began, self.key))
        self.key += 1

    def planned(self, final: bool) -> Iterator[tuple]:
        """The pieces of all windows, or of all but the last few."""
        if self.size == 0:
            return
        path = plan_windows(self.cuts, self.costs, self.capacity)
        if not final:
            path = path[:-4] or path[:1]
        ids, done, k = b"".join(self.buffer), 0, 0
        for j in path:
            end = self.cuts[j]
            while k < len(self.docs) and self.docs[k][1] < end:
                doc_id, began, n, key = self.docs[k]
                a, b = max(began, done), min(began + n, end)
                yield doc_id, a - began, b - a, zlib.crc32(ids[4 * a : 4 * b]), n, self.sequence, a - done, key
                if began + n > end:
                    break
                k += 1
            done = end
            self.sequence += 1
        j = path[-1]
        self.buffer, self.size = [ids[4 * done :]], self.size - done
        self.cuts, self.costs = [c - done for c in self.cuts[j:]], [0, *self.costs[j + 1 :]]
        self.docs = [(d, s - done, n, key) for d, s, n, key in self.docs[k:]]


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = 1
) -> DataFrame:
    """One row for each piece of a document: where it starts in the document's ids, and its sequence and offset there.

    A document's ids are those of its whole text and then `end_id`. Each id lies in exactly one piece; a sequence
    holds at most `capacity` ids, its offsets are gapless from 0, and its number is unique. row_key is a number of the input
    row, so that pieces of rows with the same doc_id can be told apart.
    Null and empty texts are `end_id` alone. Repeated rows are packed each. A null id stays null. An empty table gives
    no rows. Other columns are ignored. Within a partition the input order is kept. The tokenizer may be of any kind; texts
    are taken apart into cached words only where its file shows that this gives the same ids (`known`).
    """
    schema = pa.schema([(x.split()[0], pa.int64()) for x in PIECES.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(worker_cache(tokenizer_path, lambda: tokens(tokenizer_path)), end_id, capacity, TaskContext.get().partitionId() << 33)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                stream.add(doc_id, text.as_py())
                if stream.size >= BLOCK:
                    rows += stream.planned(final=False)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
        if rows := list(stream.planned(final=True)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    kept = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text_column).cast("string").cast("binary").alias("text"))
    return kept.mapInArrow(pack, PIECES)
