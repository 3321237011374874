"""Scores of documents under a Brown class-based bigram model learnt from the corpus."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices, stored, text_bytes
from ledgerlight.llm.hashing import U64, word_hashes

#: The most frequent words, which change classes one by one on the driver.
CORE = 4096
#: The most frequent words that have an index: their classes reach every task.
KNOWN = 50_000
#: How often the known words beyond CORE choose again.
ROUNDS = 2
#: Words that training has not seen have a class by their last letters.
SPELLINGS, CLASSES = 256, 48
ADDED, ADDED_STEP = 0.1, 0.5
#: Words whose counts a task holds before it hands them on.
MOST_WORDS = 1_000_000
#: Bytes of text that a task turns into numbers at once; they are one slice, and one row, from then on.
AT_ONCE = 1 << 21
#: Parquet groups of slices are small, since a row has a megabyte.
SLICES = {"compression": "zstd", "parquet.block.size": str(1 << 24)}
#: Ranges of fingerprints in which the rare words of slices meet their counts, at least.
BUCKETS = 256
#: In a path, the class of a word that is not known is a guess by its spelling, and marked.
GUESS = 128
#: Words are told by 64-bit fingerprints; this stands for the end of a text.
END = 0
CODED = "key bigint, doc_id array<bigint>, units binary, rare binary, spelling binary"
KINDS = {"units": np.uint16, "rare": np.int64, "spelling": np.uint8}


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _summed(keys: Iterator[np.ndarray], name: str, kind: type, most: int) -> Iterator[pa.RecordBatch]:
    """(key, n) of what a task has, summed over every ``most`` keys or more."""
    held, total = [], 0

    def table() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.astype(kind)), pa.array(n)], names=[name, "n"])

    for part in keys:
        held.append(part)
        total += len(part)
        if total > most:
            yield table()
            held, total = [], 0
    if held:
        yield table()


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of each text, never END, and where each text ends."""
    hashes, ends = word_hashes(texts)
    return np.maximum(hashes, U64(1)).view(np.int64), ends


def _training_words(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in slices(batches, "text", AT_ONCE):
        ids = batch.column("doc_id").to_pylist()
        texts = [t for i, t in zip(ids, text_bytes(batch.column("text")), strict=True) if not held_out(i)]
        if texts:
            yield np.append(_hashed(texts)[0], np.full(len(texts), END))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _summed(_training_words(batches), "word", np.int64, 4 * MOST_WORDS)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the training documents; a word is its fingerprint."""
    rows = docs.mapInArrow(_counts, "word bigint, n bigint")
    return stored(rows.groupBy("word").agg(F.sum("n").alias("n")))


def _spellings(texts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space))))
    starts, ends = edge[0::2], edge[1::2]
    key = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        at = ends - back
        key = key * U64(257) + np.where(at >= starts, data[np.maximum(at, 0)], 32)
    return ((key * U64(0x9E3779B97F4A7C15) >> U64(40)) % U64(SPELLINGS)).astype(np.uint8)


def _coded(known):
    """The texts of a slice as units: 0 for an end, k + 1 for the k-th known word, the last unit for any other.

    Beside them stand the fingerprints and spellings of the others, in order.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, row = known.value, TaskContext.get().partitionId() << 40
        order = np.argsort(keys)
        ordered = keys[order]
        for batch in slices(batches, "text", AT_ONCE):
            texts = text_bytes(batch.column("text"))
            hashes, ends = _hashed(texts)
            units = np.full(len(hashes), len(keys) + 1, np.uint16)  # KNOWN fits
            if len(keys):
                at = np.minimum(np.searchsorted(ordered, hashes), len(keys) - 1)
                units = np.where(ordered[at] == hashes, order[at] + 1, units).astype(np.uint16)
            is_rare = units == len(keys) + 1
            parts = np.insert(units, ends, 0), hashes[is_rare], _spellings(texts)[is_rare]
            ids = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), batch.column("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row]), ids, *(_cut(values, [len(values)]) for values in parts)],
                names=[part.split()[0] for part in CODED.split(", ")],
            )
            row += 1

    return emit


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of an array, cut after each of ``ends``."""
    edges = (np.append(0, ends) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(edges), pa.py_buffer(values.tobytes())])


def _joined(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of a column one after the other, and where each ends."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), np.cumsum(sizes)


def _slices(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list]:
    """The columns ``names`` of each slice: ids and keys as they are, all others as arrays."""
    for batch in batches:
        columns = [batch.column(name) for name in names]
        for row in range(batch.num_rows):
            yield [np.frombuffer(c[row].as_buffer(), KINDS[x]) if x in KINDS else c[row].as_py() for x, c in zip(names, columns, strict=True)]
    pa.default_memory_pool().release_unused()


def _ends(units: np.ndarray) -> np.ndarray:
    return np.flatnonzero(units == 0) + 1


def _trained(ids: list, units: np.ndarray) -> np.ndarray:
    """Which units are those of training documents."""
    return np.repeat(np.array([not held_out(i) for i in ids]), np.diff(_ends(units), prepend=0))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for ids, units in _slices(batches, "doc_id", "units"):
        kept = _trained(ids, units)
        if kept.any():
            yield units[kept].astype(np.int32)


def _before(units: np.ndarray) -> np.ndarray:
    """What comes before each: the end of a text before the first."""
    return np.concatenate((np.zeros(1, units.dtype), units[:-1]))


def _pairs(core: int):
    """Neighbours that are both among the first ``core`` units."""

    def cells(units: np.ndarray) -> np.ndarray:
        before = _before(units)
        both = (before < core) & (units < core)
        return before[both] * core + units[both]

    return lambda batches: _summed(map(cells, _units(batches)), "cell", np.int32, 2_000_000)


def _contexts(core: int, shared):
    """Classes before and after each known unit from ``core`` on, where they are known."""

    def cells(units: np.ndarray) -> np.ndarray:
        of = shared.value
        word = (units >= core) & (units < len(of) - 1)
        found = of[units]
        made = []
        for side, near in enumerate((np.append(found[1:], 0), _before(found))):
            at = word & (near >= 0)
            made.append(((units[at] - core) * 2 + side) * CLASSES + near[at])
        return np.concatenate(made)

    return lambda batches: _summed(map(cells, _units(batches)), "cell", np.int32, 2_000_000)


def _rest(classes):
    """(word, near) of each training token that is not known: the classes after and before it."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = classes.value
        for ids, units, rare, spelt in _slices(batches, "doc_id", *KINDS):
            is_rare, kept = units == len(of) - 1, _trained(ids, units)
            rare, spelt = rare[kept[is_rare]], spelt[kept[is_rare]]
            found = of[units]
            at = np.flatnonzero(is_rare & kept)
            # CLASSES stands for a class that is not known; no text ends with a rare unit
            after, before = (np.where(x < 0, CLASSES, x) for x in (found[np.minimum(at + 1, len(units) - 1)], _before(found)[at]))
            near = (after.astype(np.int32) * (CLASSES + 1) + before) * SPELLINGS + spelt
            yield pa.RecordBatch.from_arrays([pa.array(rare), pa.array(near.astype(np.int32))], names=["word", "near"])

    return emit


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches as tables that hold each key whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or (held and held[-1].column(key)[-1].as_py() != keys[-1]):
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _chosen(table):
    """(word, n, class, spelling) from the neighbours of each word; rows come sorted by word."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "word"):
            words, near = group.column("word").to_numpy(), group.column("near").to_numpy()
            edges = np.append(np.flatnonzero(np.diff(words, prepend=words[0] - 1)), len(words))
            for start in range(0, len(edges) - 1, 4096):
                upto = min(start + 4096, len(edges) - 1)
                n = np.diff(edges[start : upto + 1])
                part = near[edges[start] : edges[upto]].astype(np.int64)
                row = np.repeat(np.arange(len(n)), n)
                wide = CLASSES + 1
                after, before = (
                    np.bincount(row * wide + x, minlength=len(n) * wide).reshape(-1, wide)[:, :CLASSES]
                    for x in (part // SPELLINGS // wide, part // SPELLINGS % wide)
                )
                of = best_classes(table.value, after, before)
                firsts = edges[start:upto]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[firsts]), pa.array(n), pa.array(of.astype(np.int32)), pa.array(near[firsts] % SPELLINGS)],
                    names=["word", "n", "class", "spelling"],
                )

    return emit


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(steps: np.ndarray, classes: int = CLASSES, rounds: int = 12) -> np.ndarray:
    """Class of each unit from the counts of neighbouring units.

    Each unit in turn goes to the class that raises the likelihood of the class bigrams
    most, until a round moves none.  Unit 0, the end of a text, is class 0 by itself.
    """
    size = len(steps)
    weight, into_of = steps.sum(axis=1), np.ascontiguousarray(steps.T)
    of = np.zeros(size, np.int64)
    order = np.argsort(-weight[1:], kind="stable") + 1
    of[order] = 1 + np.arange(size - 1) % (classes - 1)
    table = class_steps(steps, of, classes)
    for _ in range(rounds):
        moved = 0
        for w in order.tolist():
            if not weight[w]:
                continue
            self_count, old = steps[w, w], of[w]
            after, before = np.bincount(of, steps[w], classes), np.bincount(of, into_of[w], classes)
            after[old] -= self_count
            before[old] -= self_count
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= self_count
            left, right = table.sum(axis=1), table.sum(axis=0)
            rows, cols = table + after, table.T + before
            gain = (_xlogx(rows) - _xlogx(table)).sum(axis=1) + (_xlogx(cols) - _xlogx(table.T)).sum(axis=1)
            own = np.diag(table)
            gain += _xlogx(own + after + before + self_count) - _xlogx(own + after) - _xlogx(own + before) + _xlogx(own)
            out, into = after.sum() + self_count, before.sum() + self_count
            gain -= _xlogx(left + out) - _xlogx(left) + _xlogx(right + into) - _xlogx(right)
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            moved += new != old
            of[w] = new
            table[new] += after
            table[:, new] += before
            table[new, new] += self_count
        if not moved:
            break
    return of


def class_steps(steps: np.ndarray, of: np.ndarray, classes: int) -> np.ndarray:
    rows = np.zeros((classes, len(steps)))
    np.add.at(rows, of, steps)
    table = np.zeros((classes, classes))
    np.add.at(table, of, rows.T)
    return table.T.copy()


def best_classes(table: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The class that each word, not in ``table`` yet, raises the likelihood most in.

    ``after`` and ``before`` have the classes next to each word; it is the choice of
    ``exchange`` for many words at once.
    """
    gain = np.zeros(after.shape)
    for near, steps in ((after, table), (before, table.T)):
        word, k = np.nonzero(near)
        for start in range(0, len(word), 1 << 14):
            at, c = word[start : start + (1 << 14)], k[start : start + (1 << 14)]
            was = steps[:, c].T
            edges = np.flatnonzero(np.diff(at, prepend=-1))
            gain[at[edges]] += np.add.reduceat(_xlogx(was + near[at, c][:, None]) - _xlogx(was), edges, axis=0)
        size, total = near.sum(axis=1, keepdims=True), steps.sum(axis=1)
        gain -= _xlogx(total + size) - _xlogx(total)
    word, k = np.nonzero((after > 0) & (before > 0))
    own, a, b = np.diag(table)[k], after[word, k], before[word, k]
    gain[word, k] += _xlogx(own + a + b) - _xlogx(own + a) - _xlogx(own + b) + _xlogx(own)
    gain[:, 0] = -np.inf
    return np.argmax(gain, axis=1)


def _bucketed(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted words fall into, and where the words of each end."""
    of = (words >> U64(32)) * U64(buckets) >> U64(32)
    ends = np.append(np.flatnonzero(np.diff(of)) + 1, len(of))
    return of[ends - 1].astype(np.int32), ends


def _asked(buckets: int):
    """(bucket, key, words) of each slice: its distinct words that are not known, in order."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rare in _slices(batches, "key", "rare"):
            if len(rare):
                words = np.unique(rare.view(U64))
                bucket, ends = _bucketed(words, buckets)
                none = pa.nulls(len(ends), pa.binary())
                columns = [pa.array(bucket), pa.array(np.full(len(ends), key)), _cut(words, ends), none, none]
                yield pa.RecordBatch.from_arrays(columns, names=ASKED_NAMES)

    return emit


def _listed(buckets: int):
    """(bucket, -1, words, n, class) of the words that training has seen, MOST_WORDS or so at once."""

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        words = table.column("word").to_numpy().view(U64)
        order = np.argsort(words)
        bucket, ends = _bucketed(words[order], buckets)
        n, of = (table.column(name).to_numpy()[order].astype(kind) for name, kind in ANSWERS.items())
        columns = [pa.array(bucket), pa.array(np.full(len(ends), -1)), _cut(words[order], ends), _cut(n, ends), _cut(of, ends)]
        return pa.RecordBatch.from_arrays(columns, names=ASKED_NAMES)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch] if batch.num_rows else []
            if sum(x.num_rows for x in held) > MOST_WORDS:
                yield rows(held)
                held = []
        if held:
            yield rows(held)

    return emit


ASKED = "bucket int, key bigint, words binary, n binary, class binary"
ASKED_NAMES = [part.split()[0] for part in ASKED.split(", ")]
#: A word beyond the KNOWN first is less than one token in KNOWN, so its count fits.
ANSWERS = {"n": np.uint32, "class": np.uint8}
ANSWERED = "key bigint, bucket int, n binary, class binary"


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and class of each word that a slice asks for, 0 where training has not seen it; rows come sorted by bucket."""
    for group in _groups(batches, "bucket"):
        listed = pc.less(group.column("key"), 0)
        known, asked = group.filter(listed), group.filter(pc.invert(listed))
        if not asked.num_rows:
            continue
        seen = _joined(known.column("words"), U64)[0]
        order = np.argsort(seen)
        words, ends = _joined(asked.column("words"), U64)
        at = np.searchsorted(seen, words, sorter=order)
        met = at < len(seen)
        met[met] = seen[order[at[met]]] == words[met]
        at = order[at[met]]
        columns = []
        for name, kind in ANSWERS.items():
            values = np.zeros(len(words), kind)
            values[met] = _joined(known.column(name), kind)[0][at]
            columns.append(_cut(values, ends))
        yield pa.RecordBatch.from_arrays(
            [asked.column("key").combine_chunks(), asked.column("bucket").combine_chunks(), *columns],
            names=[part.split()[0] for part in ANSWERED.split(", ")],
        )


def _heads(model):
    """(key, -1, ..) of each slice: what is known without its rare words, and which of its distinct ones each of these is."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, logs, seen, unseen = model.value
        for key, ids, units, rare, spelt in _slices(batches, "key", "doc_id", *KINDS):
            starts = np.append(0, _ends(units)[:-1])
            path = of[units]
            path[units == len(of) - 1] = GUESS + unseen[spelt]
            words, place = np.unique(rare.view(U64), return_inverse=True)
            parts = (
                path.astype(np.uint8),
                np.add.reduceat(logs[units], starts),
                np.add.reduceat(seen[units], starts),
                place.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32),
            )
            none = pa.nulls(1, pa.binary())
            columns = [pa.array([key]), pa.array([-1], pa.int32()), none, none, pa.array([ids], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *(_cut(x, [len(x)]) for x in parts)], names=HEAD_NAMES)

    return emit


HEAD = ANSWERED + ", doc_id array<bigint>, path binary, log binary, seen binary, place binary"
HEAD_NAMES = [part.split()[0] for part in HEAD.split(", ")]
FOUND = "doc_id bigint, n_tokens bigint, n_known bigint, log double, path binary"


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of each document with the classes that its rare words have met; rows come sorted by slice and bucket."""
    for group in _groups(batches, "key"):
        heads = np.flatnonzero(group.column("bucket").to_numpy() < 0)
        for start, end in zip(heads, np.append(heads[1:], group.num_rows), strict=True):
            head = {name: group.column(name)[start] for name in HEAD_NAMES[4:]}
            path, log, seen = (np.frombuffer(head[x].as_buffer(), kind) for x, kind in (("path", np.uint8), ("log", float), ("seen", np.int64)))
            ends, marked = _ends(path), np.flatnonzero(path >= GUESS)
            size = head["place"].as_buffer().size
            place = np.frombuffer(head["place"].as_buffer(), np.uint16 if size == 2 * len(marked) else np.uint32)
            # the answers of all buckets, in order, are those of the distinct words of the slice
            n, of = (_joined(group.column(x).slice(start + 1, end - start - 1), kind)[0][place] for x, kind in ANSWERS.items())
            met, row = n > 0, np.searchsorted(ends, marked, side="right")
            path = path.copy()
            path[marked] = np.where(met, of, path[marked] - GUESS)
            log = log + np.bincount(row, np.log10(n + ADDED), len(ends))
            known = seen + np.bincount(row[met], minlength=len(ends))
            yield pa.RecordBatch.from_arrays(
                [head["doc_id"].values, pa.array(np.diff(ends, prepend=0)), pa.array(known), pa.array(log), _cut(path, ends)],
                names=[part.split()[0] for part in FOUND.split(", ")],
            )


def _class_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in slices(batches, "path", AT_ONCE):
        kept = pa.array([not held_out(i) for i in batch.column("doc_id").to_pylist()])
        # a path ends with class 0, so what comes before the next one's first word is right
        found = _joined(batch.column("path").filter(kept), np.uint8)[0].astype(np.int64)
        steps += np.bincount(_before(found) * CLASSES + found, minlength=len(steps))
    cells = np.flatnonzero(steps)
    yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(steps[cells])], names=["cell", "n"])


def _path_logs(step_log):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "path", AT_ONCE):
            found, ends = _joined(batch.column("path"), np.uint8)
            logs = np.add.reduceat(step_log.value[_before(found), found], np.append(0, ends[:-1]))
            names = ["doc_id", "n_tokens", "n_known", "log"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(logs)], names=[*names, "path"])

    return emit


def _gathered(frame: DataFrame, size: int) -> np.ndarray:
    """Sums of n over (cell, n), as an array of cells."""
    cells = frame.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    made = np.zeros(size)
    made[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return made


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` most frequent words; of those with the least count, as many as fit, by a hash."""
    counts = counts.where(F.col("word") != END)
    room, tied, share = most, 0, 0
    for n, words in sorted(map(tuple, counts.groupBy("n").count().collect()), reverse=True):
        if words > room:
            tied, share = n, (room << 20) // words
            break
        room -= words
    near = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share
    return counts.where((F.col("n") > tied) | (F.col("n") == tied) & near)


def word_classes(coded: DataFrame, known: int) -> tuple[np.ndarray, DataFrame]:
    """The classes of all units and (word, n, class, spelling) of all words without one."""
    share = coded.sparkSession.sparkContext.broadcast
    core = 1 + min(CORE, known)

    units = coded.select("doc_id", "units")
    steps = _gathered(units.mapInArrow(_pairs(core), "cell int, n bigint"), core * core).reshape(core, core)
    of = np.full(known + 2, -1)
    of[:core] = exchange(steps)
    table = class_steps(steps, of[:core], CLASSES)  # none of the words that choose below is in it
    more = known + 1 - core
    for _ in range(ROUNDS if more else 0):
        near = _gathered(units.mapInArrow(_contexts(core, share(of.astype(np.int16))), "cell int, n bigint"), more * 2 * CLASSES)
        after, before = near.reshape(more, 2, CLASSES).transpose(1, 0, 2)
        of[core:-1] = best_classes(table, after, before)
    rest = coded.mapInArrow(_rest(share(of)), "word bigint, near int")
    rest = rest.repartition("word").sortWithinPartitions("word")
    return of, stored(rest.mapInArrow(_chosen(share(table)), "word bigint, n bigint, class int, spelling int"))


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row.

    Training documents are those whose crc32 of the id as text is not 0 modulo 10 (a
    null id has empty text and is held out).  Tokens are the words, A-Z lowered, and
    one end a text; null text has the end alone.  base_score is the log10 probability
    under word counts with ADDED, score that under class bigrams: a step from class to
    class times a word of its class, with ADDED for words and ADDED_STEP for steps.
    Rows of one id are scored one by one; columns but doc_id and text are ignored; an
    empty table gives an empty result.

    Every word of the training documents has its class by the words next to it.  The
    CORE most frequent change classes until no move helps, 12 rounds at most, by their pairs;
    the other KNOWN words then choose by the classes next to them, ROUNDS times; all
    others choose once, in Spark, by the classes of known words next to them.  A word
    that training has not seen has the class of most of these others with its last
    letters.  Steps from class to class are counted over all training tokens.

    Words are told by 64-bit fingerprints: two words among a hundred million share one
    with a chance of 3 in 10,000.  Texts are read twice, once to count words and once to
    be stored as numbers, in slices of AT_ONCE, which all later steps read.  What reaches
    the driver is bounded: KNOWN words, CORE squared pairs, the classes next to KNOWN
    words.  Of the rarer words, each slice sends the distinct ones once, in one row for
    each range of fingerprints, to where their counts and classes are, and gets these back
    in the same order; frequent words never enter it, so no range is larger than others.
    """
    share = docs.sparkSession.sparkContext.broadcast
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counts = word_counts(docs)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    texts = counts.where(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = most_frequent(counts, KNOWN).toArrow()
    words, n = top.column("word").to_numpy(), top.column("n").to_numpy()
    order = np.lexsort((words, -n))
    words, n = words[order], n[order]
    coded = stored(docs.mapInArrow(_coded(share(words)), CODED), **SLICES)
    of, rest = word_classes(coded, len(words))

    tokens = np.bincount(of[:-1], [texts, *n], CLASSES)
    sizes = np.bincount(of[:-1], [texts > 0, *[1] * len(words)], CLASSES)
    by_spelling = np.zeros((SPELLINGS, CLASSES))
    for spelling, k, some, more in rest.groupBy("spelling", "class").agg(F.count("*"), F.sum("n")).collect():
        by_spelling[spelling, k] += some
        sizes[k] += some
        tokens[k] += more
    everywhere = by_spelling.sum(axis=0) if by_spelling.any() else sizes * (np.arange(CLASSES) > 0)
    by_spelling[~by_spelling.any(axis=1)] = everywhere
    unseen = np.argmax(by_spelling, axis=1)

    logs = np.append(np.log10(np.array([texts, *n]) + ADDED), 0.0)
    seen = np.append(np.array([texts > 0, *[True] * len(words)], np.int64), 0)
    heads = coded.mapInArrow(_heads(share((of, logs, seen, unseen))), HEAD)
    rare = coded.agg(F.coalesce(F.sum(F.octet_length("spelling")), F.lit(0))).first()[0]
    buckets = max(BUCKETS, rare // (2 * MOST_WORDS))
    asked = coded.select("key", "rare").mapInArrow(_asked(buckets), ASKED).unionByName(rest.mapInArrow(_listed(buckets), ASKED))
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_answered, ANSWERED)
    found = heads.unionByName(answers, allowMissingColumns=True).repartition("key").sortWithinPartitions("key", "bucket")
    found = stored(found.mapInArrow(_filled, FOUND), compression="zstd")

    table = _gathered(found.mapInArrow(_class_pairs, "cell int, n bigint"), CLASSES * CLASSES).reshape(CLASSES, CLASSES)
    step_log = np.log10((table + ADDED_STEP) / (table.sum(axis=1, keepdims=True) + ADDED_STEP * CLASSES))
    step_log -= np.log10(tokens + ADDED * (sizes + 1))
    found = found.mapInArrow(_path_logs(share(step_log)), FOUND.replace("path binary", "path double"))
    base = F.col("log") - F.col("n_tokens") * math.log10(total + ADDED * (distinct + 1))
    return found.select(
        "doc_id",
        (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("log") + F.col("path")).alias("score"),
    )
