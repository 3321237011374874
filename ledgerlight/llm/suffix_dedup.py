"""Removal of byte strings that an earlier document has, by prefix doubling over chosen positions.

Prefix doubling ranks all positions by their first 1, 2, 4, ... bytes: the rank of a
longer prefix is that of the pair of ranks at an offset.  Here each task does so within
its own texts, with fingerprints for ranks, up to GRAM bytes.  Sorting the pairs of all
positions across the cluster would move many times the input, so only chosen positions
go on: of the positions in each string of LENGTH bytes, the one whose GRAM-byte rank is
the least.  The choice depends on those bytes alone, so equal strings choose alike, and
every string of LENGTH bytes holds a chosen position.  The chosen positions of all
documents are then sorted by rank; a rank that is unique drops out, and for the others
the offset grows to the bytes around, which decide each string of LENGTH bytes exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import stored
from ledgerlight.llm.hashing import U64, mix

LENGTH, GRAM = 50, 24
AROUND = LENGTH - GRAM
CONTEXT = LENGTH + AROUND
#: Text in a chunk, the unit that is ranked at once, and in one bucket of ranks.
CHUNK_BYTES, BUCKET_BYTES, MOST_BUCKETS = 1 << 21, 1 << 21, 1 << 16
#: Up to so many copied ids are broadcast to drop whole copies; beyond, a join does.
BROADCAST_IDS = 1_000_000
ENTRY = np.dtype([("rank", "u8"), ("doc", "i8"), ("at", "i4"), ("left", "u1"), ("right", "u1"), ("around", "u1", (CONTEXT,))])
#: Of an entry, what is sent; the rank is that of its middle bytes.
SENT = ("doc", "at", "left", "right", "around")
SPAN = np.dtype([("start", "i4"), ("end", "i4")])
LAST_ID = 2**63 - 1

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = _RNG.integers(0, 2**63, 32, dtype=np.uint64) * U64(2) + U64(1)
_PLACE = _RNG.integers(0, 2**63, CONTEXT, dtype=np.uint64) * U64(2) + U64(1)


def ranks(data: np.ndarray, length: int) -> np.ndarray:
    """A fingerprint for the ``length`` bytes at each position of the last axis, by doubling."""
    made = {1: _BYTE[data]}
    width, level = 1, 0
    while 2 * width <= length:
        one = made[width]
        made[2 * width] = one[..., :-width] * _STEP[level] + one[..., width:]
        width, level = 2 * width, level + 1
    have, rank = width, made[width]
    for part in sorted(made, reverse=True):
        if have + part <= length:
            tail = made[part][..., have:]
            rank = rank[..., : tail.shape[-1]] * _STEP[16 + level] + tail
            have, level = have + part, level + 1
    return mix(rank)


def sent(entry: np.ndarray) -> bytes:
    """Entries column by column, compressed, after their number."""
    columns = b"".join(np.ascontiguousarray(entry[c]).tobytes() for c in SENT)
    return len(entry).to_bytes(4, "little") + pa.compress(columns, codec="zstd", asbytes=True)


def received(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    size = n * sum(ENTRY[c].itemsize for c in SENT)
    columns = pa.decompress(blob[4:], decompressed_size=size, codec="zstd", asbytes=True)
    entry, start = np.empty(n, ENTRY), 0
    for c in SENT:
        kind, end = ENTRY[c], start + n * ENTRY[c].itemsize
        entry[c] = np.frombuffer(columns[start:end], kind.base).reshape(n, *kind.shape)
        start = end
    entry["rank"] = ranks(entry["around"][:, AROUND : AROUND + GRAM], GRAM)[:, 0]
    return entry


def sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """Least or largest of each ``width`` neighbours, by doubling."""
    made, have = values, 1
    while 2 * have <= width:
        made, have = least(made[:-have], made[have:]), 2 * have
    rest = width - have
    return least(made[: len(made) - rest], made[rest:]) if rest else made


def chosen(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chosen positions of texts laid end to end, and their ranks."""
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    rank = ranks(data, GRAM)
    order = (rank >> U64(32)).astype(np.uint32) | np.uint32(1)
    least = sliding(order, AROUND + 1, np.minimum)
    step = np.zeros(len(data) + 1, np.int32)
    starts = np.concatenate(([0], ends[:-1]))
    long = ends - starts >= LENGTH
    np.add.at(step, starts[long], 1)
    np.add.at(step, ends[long] - LENGTH + 1, -1)
    least[np.cumsum(step)[: len(least)] == 0] = 0
    edge = np.zeros(AROUND, np.uint32)
    at = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), AROUND + 1, np.maximum) == order)
    return at, rank[at]


def _chunks(most_bytes: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, size, parts = TaskContext.get().partitionId(), 0, 0, []

        def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(parts).combine_chunks()
            texts = [t or b"" for t in whole.column("text").combine_chunks().cast(pa.binary()).to_pylist()]
            data = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
            rows = whole.column("row").combine_chunks()
            rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | made], pa.int64()),
                    pa.array([pa.compress(data, codec="zstd", asbytes=True)], pa.binary()),
                    pa.array([ends.tobytes()], pa.binary()),
                    pa.array([np.array(whole.column("order").to_pylist(), np.int64).tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                ],
                names=["chunk", "data", "ends", "ids", "rows"],
            )

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            start = 0
            for at, length in enumerate(lengths.tolist()):
                size += length + 32
                if size >= most_bytes:
                    yield packed([*parts, batch.slice(start, at + 1 - start)])
                    made, size, parts, start = made + 1, 0, [], at + 1
            if start < batch.num_rows:
                parts.append(batch.slice(start))
        if parts:
            yield packed(parts)

    return emit


def _opened(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, end offsets and ids of the texts of a chunk."""
    ends = np.frombuffer(batch.column("ends")[row].as_buffer(), np.int64)
    ids = np.frombuffer(batch.column("ids")[row].as_buffer(), np.int64)
    size = int(ends[-1]) if len(ends) else 0
    data = pa.decompress(batch.column("data")[row].as_py(), decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return np.frombuffer(data, np.uint8), ends, ids


def _keys(rank: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and the low half of the rank in one number."""
    return (rank >> U64(40)) % U64(buckets) << U64(32) | rank & U64(0xFFFFFFFF)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def _ranked(buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, ends, _ = _opened(batch, row)
                keys = np.unique(_keys(chosen(data, ends)[1], buckets))
                if not len(keys):
                    continue
                bucket = (keys >> U64(32)).astype(np.int32)
                first = np.flatnonzero(_runs(bucket))
                parts = np.split(keys.astype(np.uint32), first[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[first]),
                        pa.array([batch.column("chunk")[row].as_py()] * len(first), pa.int64()),
                        pa.array([p.tobytes() for p in parts], pa.binary()),
                    ],
                    names=["bucket", "chunk", "low"],
                )

    return emit


def _repeated(group: pa.Table) -> pa.Table:
    """Of each chunk, the ranks in the bucket that another chunk has too."""
    parts = [np.frombuffer(x, np.uint32) for x in group.column("low").to_pylist()]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    low = np.concatenate(parts)
    order = np.argsort(low, kind="stable")
    new = _runs(low[order])
    many = ~new
    many[:-1] |= ~new[1:]
    low, owner = low[order][many], owner[order][many]
    order = np.argsort(owner, kind="stable")
    low, owner = low[order], owner[order]
    first = np.flatnonzero(_runs(owner)) if len(owner) else np.empty(0, np.int64)
    cut = np.split(low, first[1:]) if len(first) else []
    chunks, bucket = group.column("chunk").to_pylist(), group.column("bucket")[0].as_py()
    return pa.table(
        {
            "chunk": pa.array([chunks[o] for o in owner[first].tolist()], pa.int64()),
            "bucket": pa.array([bucket] * len(first), pa.int32()),
            "low": pa.array([c.tobytes() for c in cut], pa.binary()),
        }
    )


def _around(data: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bytes within AROUND of each GRAM, zero outside its text, and how many there are on either side."""
    left, right = np.minimum(AROUND, at - starts), np.minimum(AROUND, ends - at - GRAM)
    column = np.arange(CONTEXT)
    bytes_ = data[np.clip(at[:, None] + (column - AROUND), 0, len(data) - 1)]
    inside = (column >= AROUND - left[:, None]) & (column < AROUND + GRAM + right[:, None])
    return np.where(inside, bytes_, 0).astype(np.uint8), left.astype(np.uint8), right.astype(np.uint8)


def _entries(buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from of_chunk(batch, row)

    def of_chunk(batch: pa.RecordBatch, row: int) -> Iterator[pa.RecordBatch]:
        data, ends, ids = _opened(batch, row)
        at, rank = chosen(data, ends)
        if not len(at):
            return
        keys = _keys(rank, buckets)
        elsewhere = [
            np.frombuffer(x["low"], np.uint32).astype(np.uint64) | U64(x["bucket"]) << U64(32)
            for x in batch.column("found")[row].as_py() or ()
        ]
        text = np.searchsorted(ends, at, side="right")
        order = np.argsort(rank, kind="stable")
        run = np.cumsum(_runs(rank[order])) - 1
        first, last = np.full(run[-1] + 1, 2**62), np.full(run[-1] + 1, -1)
        np.minimum.at(first, run, text[order])
        np.maximum.at(last, run, text[order])
        keep = np.zeros(len(at), bool)
        keep[order] = (first != last)[run]
        if elsewhere:
            keep |= np.isin(keys, np.concatenate(elsewhere))
        at, rank, keys, text = at[keep], rank[keep], keys[keep], text[keep]
        if not len(at):
            return
        starts = np.concatenate(([0], ends[:-1]))
        entry = np.empty(len(at), ENTRY)
        entry["rank"], entry["doc"], entry["at"] = rank, ids[text], at
        entry["around"], entry["left"], entry["right"] = _around(data, at, starts[text], ends[text])
        # what a smaller id of the same chunk has with the same bytes around is settled here
        same = mix(entry["around"] @ _PLACE + entry["left"].astype(np.uint64) * U64(131) + entry["right"])
        order = np.lexsort((entry["doc"], same))
        entry, keys, same = entry[order], keys[order], same[order]
        new = _runs(same)
        later = entry["doc"] > entry["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
        settled = entry[later & (entry["left"].astype(int) + entry["right"] >= AROUND)]
        spans = np.empty(len(settled), SPAN)
        spans["start"] = settled["at"] - settled["left"]
        spans["end"] = settled["at"] + GRAM + settled["right"]
        entry, keys = entry[~later], keys[~later]
        bucket = (keys >> U64(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        entry, bucket = entry[order], bucket[order]
        first = np.flatnonzero(_runs(bucket))
        parts = np.split(entry, first[1:])
        chunk = batch.column("chunk")[row].as_py()
        for k in range(0, len(first), 256):
            some = parts[k : k + 256]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[first[k : k + 256]]),
                    pa.array([chunk] * len(some), pa.int64()),
                    pa.array([sent(p) for p in some], pa.binary()),
                    pa.array([spans.tobytes() if k + i == 0 else b"" for i in range(len(some))], pa.binary()),
                ],
                names=["bucket", "chunk", "entries", "spans"],
            )

    return emit


def covered(entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries, and their spans, hold strings to remove: entries with a string of LENGTH bytes that an entry of a smaller id has.

    All entries of a rank must be there.  The strings of LENGTH bytes around a gram
    start at most AROUND apart, so those found make one span.
    """
    sums = np.zeros((len(entry), CONTEXT + 1), np.uint64)
    powers = np.ones(CONTEXT, np.uint64)
    powers[1:] = U64(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(powers)
    np.cumsum(_BYTE[entry["around"]] * powers, axis=1, out=sums[:, 1:])
    left, right = entry["left"].astype(int), entry["right"].astype(int)
    low, high = np.full(len(entry), CONTEXT), np.full(len(entry), -1)
    for j in range(AROUND + 1):
        whole = np.flatnonzero((left >= AROUND - j) & (right >= j))
        if len(whole) < 2:
            continue
        string = mix(sums[whole, j + LENGTH] - sums[whole, j])
        order = np.lexsort((entry["doc"][whole], string))
        new = _runs(string[order])
        doc = entry["doc"][whole][order]
        later = whole[order[doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]]]
        low[later] = np.minimum(low[later], j)
        high[later] = np.maximum(high[later], j)
    found = np.flatnonzero(high >= 0)
    spans = np.empty(len(found), SPAN)
    spans["start"] = entry["at"][found] - AROUND + low[found]
    spans["end"] = entry["at"][found] - AROUND + high[found] + LENGTH
    return found, spans


def _compared(group: pa.Table) -> pa.Table:
    """Spans by chunk from all entries of a bucket of ranks."""
    parts = [received(x) for x in group.column("entries").to_pylist()]
    chunks = group.column("chunk").to_pylist()
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    entry = np.concatenate(parts)
    order = np.argsort(entry["rank"], kind="stable")
    new = _runs(entry["rank"][order])
    many = ~new
    many[:-1] |= ~new[1:]
    order = order[many]
    ranked = entry["rank"][order]
    cuts = [0]
    for edge in np.flatnonzero(_runs(ranked)).tolist() if len(ranked) else ():
        if edge - cuts[-1] >= 1 << 15:  # whole ranks at a time, for the memory
            cuts.append(edge)
    rows = [(chunks[k], x) for k, x in enumerate(group.column("spans").to_pylist()) if x]
    for start, stop in zip(cuts, [*cuts[1:], len(order)], strict=True):
        some = order[start:stop]
        found, spans = covered(entry[some])
        of = owner[some][found]
        rows += [(chunks[o], spans[of == o].tobytes()) for o in np.unique(of).tolist()]
    return pa.table(
        {"chunk": pa.array([c for c, _ in rows], pa.int64()), "spans": pa.array([x for _, x in rows], pa.binary())}
    )


def whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` with the rest of each UTF-8 character that it takes a byte of."""
    if not gone.any() or not len(data):
        return gone
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    starts = starts if len(starts) and not starts[0] else np.insert(starts, 0, 0)
    hit = np.logical_or.reduceat(gone, starts)
    return np.repeat(hit, np.diff(np.append(starts, len(data))))


def _cleaned(characters: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield of_chunk(batch, k)

    def of_chunk(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
        data, ends, _ = _opened(batch, k)
        step = np.zeros(len(data) + 1, np.int64)
        for blob in batch.column("found")[k].as_py() or ():
            spans = np.frombuffer(blob, SPAN)
            np.add.at(step, spans["start"], 1)
            np.add.at(step, spans["end"], -1)
        gone = np.cumsum(step)[: len(data)] > 0
        kept, removed, start = [], [], 0
        for end in ends.tolist():
            mine = gone[start:end]
            if characters:
                mine = whole_characters(data[start:end], mine)
            kept.append(data[start:end][~mine].tobytes())
            edge = np.flatnonzero(np.diff(np.concatenate(([False], mine, [False])))).tolist()
            removed.append([{"start": a, "end": b} for a, b in zip(edge[0::2], edge[1::2], strict=True)])
            start = end
        sizes = np.diff(np.concatenate(([0], ends)))
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([batch.column("rows")[k].values]),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            names=["row", "n_bytes", "spans", "kept"],
        )

    return emit


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, characters: bool = False) -> DataFrame:
    """The rows of ``docs`` without their text, as the struct ``row``, and what is left of the text.

    Further columns: n_bytes of the text, ``spans`` (start, end) of the bytes removed,
    in order, and ``kept``, the other bytes as binary.  A byte goes when a string of
    LENGTH bytes that covers it also starts in a document with a smaller doc_id; the
    input decides, not what is left.  With ``characters`` a character that loses a byte
    goes whole, so that what is left is text.  A null text is empty, a null id counts as the
    largest, and rows of one id do not remove from each other.  Extra columns stay in
    ``row``, whatever their names; an empty table gives an empty result.

    Whole copies of a text are told by a hash first and settled without a search.
    Texts are packed into chunks, stored once.  Between chunks go four bytes of each
    distinct chosen rank, and then, only for ranks that two documents have, the bytes
    around.  A chunk sends equal bytes of several documents once, so a passage that a
    third of all documents have is sent once a chunk.
    """
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    plain = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("order"),
        F.coalesce("text", F.lit("")).alias("text"),
        row.alias("row"),
    )
    hashed = plain.withColumn("hash", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    narrow = stored(hashed.select("order", "hash", F.octet_length("text").alias("size")))
    least = narrow.groupBy("hash").agg(F.min("order").alias("first"), F.max("order").alias("last")).where("first < last")
    copies = stored(narrow.join(least, "hash").where("order > first").select("order", "hash").distinct())
    sizes = narrow.agg(F.sum("size")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(1, math.ceil(sizes / BUCKET_BYTES)))
    small = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
    is_copy = ["order", "hash"]

    kind = plain.schema["row"].dataType.simpleString()
    chunks = stored(
        hashed.join(small, is_copy, "left_anti")
        .select("order", "text", "row")
        .mapInArrow(_chunks(chunk_bytes), f"chunk bigint, data binary, ends binary, ids binary, rows array<{kind}>")
    )
    bare = chunks.select("chunk", "data", "ends", "ids")
    ranked = bare.mapInArrow(_ranked(buckets), "bucket int, chunk bigint, low binary")
    repeated = ranked.groupBy("bucket").applyInArrow(_repeated, "chunk bigint, bucket int, low binary")
    replies = repeated.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "low")).alias("found"))
    entries = bare.join(replies, "chunk", "left").mapInArrow(
        _entries(buckets), "bucket int, chunk bigint, entries binary, spans binary"
    )
    found = entries.groupBy("bucket").applyInArrow(_compared, "chunk bigint, spans binary")
    spans = found.groupBy("chunk").agg(F.collect_list("spans").alias("found"))
    made = f"row {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    cleaned = chunks.join(spans, "chunk", "left").select("rows", "data", "ends", "ids", "found").mapInArrow(
        _cleaned(characters), made
    )

    size = F.octet_length("text").cast("bigint")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), size.alias("end")))
    long = size >= LENGTH
    copied = hashed.join(small, is_copy, "left_semi").select(
        "row",
        size.alias("n_bytes"),
        F.when(long, whole).otherwise(F.slice(whole, 1, 0)).alias("spans"),
        F.when(long, F.lit(b"")).otherwise(F.col("text").cast("binary")).alias("kept"),
    )
    return cleaned.unionByName(copied)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats cut out of their texts; characters cut in two go whole."""
    rest = remove_repeats(docs, characters=True)
    columns = [
        F.col("kept").cast("string").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
    ]
    return rest.select(*columns)
