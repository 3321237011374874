"""Packing of token ids into windows by sum-of-squares online packing."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices

WINDOW, END = 4096, 2
#: Windows that a task keeps partially filled; when there are more, all are closed.
MOST_OPEN = 512
#: Words whose ids a Python worker remembers.
MOST_WORDS = 600_000
# How the tokenizer file splits lowered words, and the letters that its
# model has for bytes.  Printable bytes of Latin-1 stand for themselves, the others for
# letters from 256 on, in order.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_LETTERS = {
    byte: 256 + n for n, byte in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))
}
#: Latin letters end here; their lower case and classes are old and the same everywhere.
LATIN_END = "\u0250"
#: Stands between the ids of two words.
GAP = b"\xff" * 4
PIECE = "row_number bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class WordTokens:
    """Ids of texts, found once for each distinct word between white space.

    The tokenizer file splits at white space and drops it, so a text has the ids of its
    words one after the other.  Words in composed Latin letters are lowered, split by the
    pattern of the file and their parts go to its model; for any other word the tokenizer
    itself is asked.  Words are remembered in two generations, so that frequent ones stay
    when there are too many.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.pattern = regex.compile(f" |{PATTERN}")
        self.words: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {" ": GAP}

    def texts(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text, END last; null is empty."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self.of_words(distinct), pa.binary()).take(coded.indices)
        edges = np.concatenate(([0], np.cumsum(words.value_lengths().to_numpy())))
        places = np.frombuffer(ids.buffers()[1], np.int32)[edges] if len(ids) else edges
        data, end = memoryview(ids.buffers()[2] or b"" if len(ids) else b""), END.to_bytes(4, "little")
        return [bytes(data[x:y]) + end for x, y in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]

    def of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        found = list(map(self.words.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if self.older:
            for k in missing:
                found[k] = self.older.get(words[k])
        new = [k for k in missing if found[k] is None]
        for k, ids in zip(new, self.of_new([words[k] for k in new]), strict=True):
            found[k] = ids
        if len(self.words) + len(missing) > MOST_WORDS // 2:
            self.older, self.words = self.words, {b"": b""}
        self.words.update((words[k], found[k]) for k in missing)
        return found

    def of_new(self, words: list[bytes]) -> list[bytes]:
        found: list[bytes | None] = [None] * len(words)
        if len(self.parts) > MOST_WORDS:
            self.parts = {" ": GAP}
        # ASCII letters: the whole of the word is one part
        letters = [k for k, w in enumerate(words) if w.isalpha()]
        if letters:
            lowered = b" ".join([words[k] for k in letters]).lower().decode().split(" ")
            self._find(set(lowered).difference(self.parts))
            for k, part in zip(letters, lowered, strict=True):
                found[k] = self.parts[part]
        others = [k for k, ids in enumerate(found) if ids is None]
        texts = [words[k].decode("utf-8", "replace") for k in others]
        plain = [_is_plain(t) for t in texts]
        parts = self.pattern.findall(" ".join([t for t, is_plain in zip(texts, plain, strict=True) if is_plain]).lower())
        self._find(set(parts).difference(self.parts))
        # no id has four bytes of ones, so these split the words and nothing else
        ids = iter(b"".join(map(self.parts.__getitem__, parts)).split(GAP))
        for k, t, is_plain in zip(others, texts, plain, strict=True):
            found[k] = next(ids) if is_plain else self.of_odd(t)
        return found

    def _find(self, parts: set[str]) -> None:
        """Ask the model for the ids of parts."""
        tokenize, ids, ends = self.model.tokenize, [], [0]
        for part in parts:
            spelt = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids += [token.id for token in tokenize(spelt)]
            ends.append(4 * len(ids))
        data = np.array(ids, "<u4").tobytes()
        self.parts.update((part, data[x:y]) for part, x, y in zip(parts, ends, ends[1:]))

    def of_odd(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _is_plain(text: str) -> bool:
    """Whether a word is printable, of composed Latin letters, and holds no special token."""
    if not text.isascii() and not (max(text) < LATIN_END and unicodedata.is_normalized("NFC", text)):
        return False
    return text.isprintable() and "<|" not in text


_TOKENS: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    """One instance a worker process, so that its words are remembered between tasks."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


class Packer:
    """Windows of one task.

    ``counts[h]`` is how many windows are filled up to h.  A piece of n ids goes where
    the sum of the squared counts grows least: into a new window, which adds one at
    level n, or from some level h to h + n.  What is left at the end is laid end to end
    and cut into full windows, and the last rest into powers of two, which need no
    padding.
    """

    def __init__(self, first: int) -> None:
        self.next = first
        self.counts = np.zeros(WINDOW + 1, np.int64)
        self.levels = np.zeros(0, np.int64)  # those with a window, in order
        self.open: dict[int, list[list[tuple]]] = {}
        self.n_open = 0

    def level_for(self, n: int) -> int:
        """The level to put ``n`` ids on; 0 for a new window."""
        counts = self.counts
        have = self.levels[: np.searchsorted(self.levels, WINDOW - n, "right")]
        if not len(have):
            return 0
        # a window that becomes full leaves the levels, and so adds nothing
        onto = np.where(have + n < WINDOW, 2 * counts[have + n] + 1, 0)
        growth = onto - 2 * counts[have] + 1
        at = int(np.argmin(growth))
        return int(have[at]) if growth[at] <= 2 * counts[n] + 1 else 0

    def count(self, level: int, more: int) -> None:
        """One window more or less at a level."""
        had = self.counts[level]
        self.counts[level] += more
        self.n_open += more
        if not had or not had + more:
            at = np.searchsorted(self.levels, level)
            self.levels = np.insert(self.levels, at, level) if not had else np.delete(self.levels, at)

    def closed(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for row, start, ids, total in pieces:
            length = len(ids) // 4
            yield row, start, length, ids, total, self.next, offset
            offset += length
        self.next += 1

    def add(self, row: int, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        full = total // WINDOW * WINDOW
        for start in range(0, full, WINDOW):
            yield from self.closed([(row, start, ids[4 * start : 4 * (start + WINDOW)], total)])
        n = total - full
        if not n:
            return
        level = self.level_for(n)
        pieces = self.open[level].pop() if level else []
        pieces.append((row, full, ids[4 * full :], total))
        if level:
            self.count(level, -1)
        if level + n == WINDOW:
            yield from self.closed(pieces)
            return
        self.count(level + n, 1)
        self.open.setdefault(level + n, []).append(pieces)
        if self.n_open > MOST_OPEN:
            yield from self.rest()

    def rest(self) -> Iterator[tuple]:
        """Close all windows, their pieces cut anew."""
        queue = [piece for level in sorted(self.open, reverse=True) for pieces in self.open[level] for piece in pieces]
        left = sum(len(ids) // 4 for _, _, ids, _ in queue)
        window, room = [], 0
        for row, start, ids, total in queue:
            done, n = 0, len(ids) // 4
            while done < n:
                if not room:
                    room = WINDOW if left >= WINDOW else 1 << (left.bit_length() - 1)
                take = min(room, n - done)
                window.append((row, start + done, ids[4 * done : 4 * (done + take)], total))
                done, room, left = done + take, room - take, left - take
                if not room:
                    yield from self.closed(window)
                    window = []
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        self.levels = self.levels[:0]


def _packed(path: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = tokens_of(path), Packer(TaskContext.get().partitionId() << 40)
        names = [part.split()[0] for part in PIECE.split(", ")]
        kinds = [pa.binary() if part.endswith("binary") else pa.int64() for part in PIECE.split(", ")]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        rows: list[tuple] = []
        for batch in slices(batches, "text", 1 << 23):
            for doc, ids in zip(batch.column("row_number").to_pylist(), tokens.texts(batch.column("text")), strict=True):
                rows += packer.add(doc, ids)
                if len(rows) >= 2000:
                    yield table(rows)
                    rows = []
        rows += packer.rest()
        if rows:
            yield table(rows)

    return emit


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of the token ids of ``docs`` in sequences of WINDOW ids at most.

    A piece: doc_id, start, length, ids (little-endian unsigned 32 bits), doc_tokens,
    sequence_id, offset.  The ids of a document are those of its text, then END; null
    and empty text have END alone.  A sequence is full or a power of two long, so none
    is padded.  Rows of one id are documents of their own; columns but doc_id and text
    are ignored, and an empty table gives an empty result.

    Each task packs the rows it reads, with at most MOST_OPEN partially filled windows
    in memory, so no row moves to another task; the task's number is part of the
    sequence_id.  ``tokenizer`` is the path of the tokenizer file on the executors.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("row_number"), "text")
    pieces = rows.mapInArrow(_packed(tokenizer), PIECE)
    return pieces.withColumnRenamed("row_number", "doc_id")
