"""Token counts by unigram segmentation, shared between words with a common prefix."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices, text_bytes

#: Mark of the beginning of a word, as in the vocabulary file.
LEAD = "▁"
#: Loss of a byte for which no piece stands, beside that of the rarest piece.
BYTE_LOSS = 10.0
#: Distinct words whose counts a Python worker remembers.
MOST_WORDS = 500_000


class Pieces:
    """Scores of the pieces of a vocabulary file.

    A piece scores its log probability.  The file's order stands for it: its pieces
    are sorted from common to rare, and the r-th has a share of 1 / r, made to sum to one.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        whole = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
        self.score = {piece: -math.log(r) - whole for r, piece in enumerate(plain, 1)}
        self.longest = max(map(len, plain), default=1)
        self.byte = min(self.score.values(), default=0.0) - BYTE_LOSS


class Trie:
    """Distinct words as a trie walked in order, with the forward scores of one branch.

    Sorted words visit the nodes depth first.  A node's best score and its number of
    pieces depend on the characters up to it alone, so they are computed when the node
    is first reached and serve all words below; ``counts`` keeps those of the terminals.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.counts: dict[bytes, int] = {}

    def insert(self, words: set[bytes]) -> None:
        score, longest, byte = self.pieces.score, self.pieces.longest, self.pieces.byte
        best, count, before = [0.0], [0], ""
        for text, word in sorted((LEAD + w.decode("utf-8", "replace"), w) for w in words):
            shared = 0
            for a, b in zip(text, before, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                size = len(text[end - 1].encode("utf-8", "surrogatepass"))
                top, n = best[end - 1] + size * byte, count[end - 1] + size
                for start in range(max(0, end - longest), end):
                    found = score.get(text[start:end])
                    if found is not None:
                        here = best[start] + found
                        if here > top or (here == top and count[start] + 1 < n):
                            top, n = here, count[start] + 1
                best.append(top)
                count.append(n)
            before = text
            self.counts[word] = count[-1]

    def count(self, texts: list[list[bytes]]) -> list[int]:
        """Tokens of each list of words."""
        new = set(chain.from_iterable(texts)) - self.counts.keys()
        if len(self.counts) + len(new) > MOST_WORDS:
            self.counts.clear()
            new = set(chain.from_iterable(texts))
        self.insert(new)
        return [sum(map(self.counts.__getitem__, words)) for words in texts]


_TRIES: dict[str, Trie] = {}


def _counted(path: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TRIES:
            _TRIES[path] = Trie(Pieces(path))
        for batch in slices(batches, "text", 1 << 22):
            words = [text.split() for text in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array(_TRIES[path].count(words), pa.int64()),
                ],
                names=["doc_id", "n_words", "n_tokens"],
            )

    return emit


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words and n_tokens of each row of ``docs``.

    Words are what stands between white space, each with a mark of its beginning; a
    word's tokens are those of its most likely segmentation into pieces, of equally
    likely ones the shortest, and a character without a piece has a token a byte.
    Null and empty texts have none.  Rows are independent: rows of one id give a row
    each, null ids stay null, columns but doc_id and text are ignored, and an empty
    table gives an empty result.  Nothing is shuffled; a task inserts the distinct words
    of some megabytes of text at a time, and a worker forgets them beyond MOST_WORDS.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_counted(vocabulary), "doc_id bigint, n_words bigint, n_tokens bigint")
