"""Fill-in-the-middle documents, cut and put together by columns of Arrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of text whose units are laid out at once: about 60 times as many bytes of memory.
AT_ONCE = 1 << 19
KIND = "doc_id bigint, n bigint, form string, prefix_units bigint, middle_units bigint, output string"


def _unit_starts(data: np.ndarray, unit: str) -> np.ndarray:
    """Where the units of UTF-8 bytes start: code points, words with what follows them, or lines.

    The first byte of a text starts a unit whatever it is; the caller sees to that.
    """
    if unit == "char":
        return (data & 0xC0) != 0x80
    before = np.concatenate(([np.uint8(10)], data[:-1]))
    if unit == "line":
        return before == 10
    space = (data == 32) | ((data >= 9) & (data <= 13))
    return ~space & ((before == 32) | ((before >= 9) & (before <= 13)))


def _roles(data: np.ndarray, starts: np.ndarray, owner: np.ndarray, first: np.ndarray, cuts: list[np.ndarray]) -> list[pa.Array]:
    """The prefix, the middle and the suffix of each part of a text.

    ``starts`` are the places of the units in ``data`` and ``owner`` the parts they
    belong to, in order; ``first`` is the ordinal of the first unit of a part within its
    text, ``cuts`` where prefix and middle end.
    """
    parts = len(first)
    offsets = np.searchsorted(owner, np.arange(parts + 1)).astype(np.int32)
    ends = np.append(starts, len(data)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
    lists = pa.ListArray.from_arrays(pa.array(offsets), units)

    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    base = pa.array(first - offsets[:-1])
    ordinal = pc.add(pa.array(np.arange(len(starts))), pc.take(base, parent))
    after = [pc.greater_equal(ordinal, pc.take(pa.array(cut), parent)) for cut in cuts]
    chosen = [pc.invert(after[0]), pc.and_not(after[0], after[1]), after[1]]
    found = []
    for mask in chosen:
        count = np.bincount(pc.filter(parent, mask).to_numpy(), minlength=parts)
        edges = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
        found.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), pc.filter(flat, mask)), ""))
    return found


def _pieces(texts: pa.Array, n: np.ndarray, data: np.ndarray, edges: np.ndarray, starts: np.ndarray, cuts: list[np.ndarray]) -> list[pa.Array]:
    """The three pieces of each text; a text longer than AT_ONCE is laid out part by part."""
    made: list[list[pa.Array]] = [[], [], []]
    of: list[int] = []
    # parts end at units, after about AT_ONCE bytes of a text
    begin = np.searchsorted(starts, edges)
    rows, lows, highs = [], [], []
    for row in range(len(texts)):
        low, high = int(begin[row]), int(begin[row + 1])
        while low < high:
            far = int(np.searchsorted(starts, starts[low] + AT_ONCE))
            upto = min(high, max(far, low + 1))
            rows.append(row)
            lows.append(low)
            highs.append(upto)
            low = upto
    lows, highs = np.array(lows, np.int64), np.array(highs, np.int64)
    places = np.append(starts, len(data))
    start = 0
    while start < len(rows):
        room = places[lows[start]] + 2 * AT_ONCE
        stop = max(start + 1, int(np.searchsorted(places[highs], room, "right")))
        low, high = lows[start], highs[stop - 1]
        mine = np.array(rows[start:stop])
        owner = np.repeat(np.arange(stop - start), highs[start:stop] - lows[start:stop])
        part = data[places[low] : places[high]]
        found = _roles(part, starts[low:high] - places[low], owner, lows[start:stop] - begin[mine], [cut[mine] for cut in cuts])
        for side, piece in zip(made, found, strict=True):
            side.append(piece)
        of += mine.tolist()
        start = stop
    each = np.searchsorted(np.array(of, np.int64), np.arange(len(texts) + 1)).astype(np.int32)
    nothing = pa.array([], pa.string())
    return [pc.binary_join(pa.ListArray.from_arrays(pa.array(each), pa.concat_arrays(side or [nothing])), "") for side in made]


def _transformed(unit: str, plain_from: int, spm_below: int):
    marks = "|".join((PREFIX, SUFFIX, MIDDLE))

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        values = texts.buffers()[2] or b""
        data = np.frombuffer(values, np.uint8)[edges[0] : edges[-1]]
        edges -= edges[0]
        begins = _unit_starts(data, unit)
        begins[edges[:-1][np.diff(edges) > 0]] = True
        starts = np.flatnonzero(begins)
        n = np.diff(np.searchsorted(starts, edges))
        h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
        low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))

        marked = pc.match_substring_regex(texts, marks).to_numpy(zero_copy_only=False)
        plain = (n == 0) | marked | (h3 % 100 >= plain_from)
        form = np.where(plain, PLAIN, np.where(h4 % 100 < spm_below, SPM, PSM))
        prefix, middle, suffix = _pieces(texts, n, data, edges, starts, [low, high])
        ahead = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
        behind = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
        output = pc.case_when(pc.make_struct(pa.array(plain), pa.array(form == SPM)), texts, behind, ahead)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n),
                pa.array(form.tolist(), pa.string()),
                pa.array(low, mask=plain),
                pa.array(high - low, mask=plain),
                output,
            ],
            names=[part.split()[0] for part in KIND.split(", ")],
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 * AT_ONCE):
            yield of_batch(batch)

    return emit


def _draws(doc_id: Column, seed: str) -> list[Column]:
    """The first four groups of eight hex digits of the sha256 of seed, colon and id, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")).cast("string")), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def fill_middle(docs: DataFrame, seed: str = "1", unit: str = "char", rate: int = 90, spm_share: int = 20) -> DataFrame:
    """doc_id, n, form, prefix_units, middle_units and output of each row.

    A text is n units (``char``: code points, ``word``: words with the white space after
    them, ``line``); white space before the first word is a unit.  Two draws from the id
    cut it into prefix, middle and suffix, each of them empty at times.
    ``rate`` of 100 texts are transformed, ``spm_share`` of 100 of those with the suffix
    first; the other texts stay as they are (form ``plain``, prefix_units and
    middle_units null), and so does a text that is empty or holds a marker, since it
    could not be told from an output.

    Null text is empty; a null id draws as an empty one.  Draws depend on the id alone,
    so rows of one id are cut at the same share and reruns agree.  Columns but doc_id
    and text are ignored; an empty table gives an empty result.  Nothing is shuffled;
    texts of any length are laid out AT_ONCE bytes at a time.
    """
    if unit not in ("char", "word", "line"):
        raise ValueError(f"no such unit: {unit}")
    id_ = F.col("doc_id").cast("bigint")
    rows = docs.select(id_.alias("doc_id"), "text", *_draws(id_, seed))
    return rows.mapInArrow(_transformed(unit, rate, spm_share), KIND)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from; null where its form is none of the three."""
    # an output that is not plain holds each marker once, so the pieces follow from them alone
    pieces = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    one, two, last = (F.get(pieces, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == PLAIN, output).when(form == PSM, F.concat(one, last, two)).when(form == SPM, F.concat(two, last, one))
