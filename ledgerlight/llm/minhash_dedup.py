"""MinHash near-duplicates: banded minima, verified links, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices, stored, text_bytes
from ledgerlight.llm.components import components
from ledgerlight.llm.hashing import mix, shingles

WIDTH, BANDS, ROWS = 5, 28, 4
HASHES = BANDS * ROWS
#: Least equal minima of a candidate that is confirmed on full sets: at a similarity of
#: 0.75 the expected 84 lie six standard deviations above.
LEAST_EQUAL = 56
#: Up to so many ids of texts with a bucket-mate are broadcast; beyond, a join finds them.
BROADCAST_IDS = 2_000_000
#: Texts and shingles of a part of a bucket.
PART_ROWS, PART_SHINGLES = 512, 250_000
_FACTORS = np.random.default_rng(7).integers(0, 2**31, (HASHES, 2), dtype=np.uint32)
SKETCH = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, minima binary, bands array<bigint>"


def minima_of(sets: list[np.ndarray]) -> np.ndarray:
    """For each non-empty set the least value under every universal hash function."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    made = np.empty((len(sets), HASHES), np.uint32)
    for k, (factor, shift) in enumerate(_FACTORS):
        made[:, k] = np.minimum.reduceat(values * np.uint32(factor | 1) + shift, starts)
    return made


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key for the minima of each band; the band number is part of it."""
    wide = minima.astype(np.uint64).reshape(len(minima), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), wide.shape[:2])
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + wide[:, :, k])
    return keys


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        sets = shingles(text_bytes(batch.column("text")), WIDTH)
        full = [s for s in sets if len(s)]
        minima = minima_of(full) if full else np.empty((0, HASHES), np.uint32)
        keys, low = band_keys(minima).view(np.int64), minima.astype(np.uint8)
        at = iter(range(len(full)))
        rows = []
        for s in sets:
            k = next(at) if len(s) else None
            with np.errstate(over="ignore"):
                sums = [int(mix(s + np.uint64(seed)).sum(dtype=np.uint64).view(np.int64)) for seed in (1, 2)]
            rows.append((len(s), *sums, None if k is None else low[k].tobytes(), None if k is None else keys[k].tolist()))
        n, a, b, low, keys = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array(x, pa.int64()) for x in (n, a, b)),
                pa.array(low, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "set_a", "set_b", "minima", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        packed = [s.tobytes() for s in shingles(text_bytes(batch.column("text")), WIDTH)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union."""
    small, large = (one, two) if len(one) <= len(two) else (two, one)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(one) + len(two) - both)


def _similar(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("set_x", "set_y")]
            keep = [similar(x, y, percent) for x, y in zip(*sets, strict=True)]
            pair = pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], names=["x", "y"])
            yield pair.filter(pa.array(keep, pa.bool_()))

    return confirm


def _equal_minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("low_x", "low_y")
        )
        keep = pa.array((one == two).sum(axis=1) >= LEAST_EQUAL)
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], names=["x", "y"]).filter(keep)


def _hub_links(pairs: DataFrame, heads: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) whose sizes, minima and then full sets say that they are similar."""
    near = pairs
    for c in "xy":
        columns = [F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("minima").alias(f"low_{c}")]
        near = near.join(heads.select(*columns), c)
    near = near.where(F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent)
    near = stored(near.select("x", "y", "low_x", "low_y").mapInArrow(_equal_minima, "x bigint, y bigint"))
    for c in "xy":
        near = near.join(sets.select(F.col("doc_id").alias(c), F.col("packed").alias(f"set_{c}")), c)
    return stored(near.select("x", "y", "set_x", "set_y").mapInArrow(_similar(percent), "x bigint, y bigint"))


def _missed_links(percent: int):
    """Links that join components within a pair of parts of a bucket."""

    def of_parts(group: pa.Table) -> pa.Table:
        bucket, i, j = (group.column(c)[0].as_py() for c in ("bucket", "i", "j"))
        part = np.array(group.column("part").to_pylist())
        ids, component, size = (np.array(group.column(c).to_pylist(), np.int64) for c in ("rep", "component", "n_shingles"))
        minima = np.frombuffer(b"".join(group.column("minima").to_pylist()), np.uint8).reshape(-1, HASHES)
        bands = np.array(group.column("bands").to_pylist(), np.int64)
        packed = group.column("packed").to_pylist()
        root = {c: c for c in component.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        right = np.flatnonzero(part == j)
        links = []
        for at in np.flatnonzero(part == i).tolist():
            fits = np.minimum(size[right], size[at]) * 100 >= np.maximum(size[right], size[at]) * percent
            fits &= component[right] != component[at]
            if i == j:
                fits &= ids[right] > ids[at]
            others = right[fits]
            equal = (minima[others] == minima[at]).sum(axis=1)
            others = others[equal >= LEAST_EQUAL]
            # two texts are compared in the first of their common buckets alone
            common = bands[others] == bands[at]
            others = others[bands[at][np.argmax(common, axis=1)] == bucket] if len(others) else others
            mine = np.frombuffer(packed[at], np.uint64)
            for other in others.tolist():
                a, b = find(int(component[at])), find(int(component[other]))
                if a != b and similar(mine, np.frombuffer(packed[other], np.uint64), percent):
                    root[max(a, b)] = min(a, b)
                    links.append((ids[at], ids[other]))
        x, y = zip(*links, strict=True) if links else ((), ())
        return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})

    return of_parts


def _shared_ids(rows: DataFrame, heads: DataFrame, key: list[str]) -> DataFrame:
    """(x, y): ids whose rows have different sets, and the smallest id of each of these sets."""
    of_id = rows.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("a"), F.max(F.struct(*key)).alias("b")).where("a < b")
    several = rows.select("doc_id", *key).join(of_id.select("doc_id"), "doc_id")
    return several.join(heads.select(*key, "rep"), key).select(F.col("doc_id").alias("x"), F.col("rep").alias("y"))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document.

    Documents link when their sets of five-word shingles share at least ``percent`` of
    their union; fewer words make one shingle, no words an empty set that links with
    nothing.  Rows of one id are one node; a null id has no component and is kept.
    Columns but doc_id and text are ignored, and an empty table gives an empty result.

    Equal sets are one class, found by an aggregate, and only its smallest id goes on.
    The members of a band bucket are first compared with its smallest id alone, a
    comparison a member.  Where the components found so differ within a bucket, the
    members of different components are compared too, part by part of the bucket, by
    their minima and then by their sets.  Only links that join components leave such a
    comparison, so no bucket yields its pairs, and none between components is missed.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketches = stored(docs.mapInArrow(_sketches, SKETCH))
    key = ["n_shingles", "set_a", "set_b"]
    some = sketches.where("n_shingles > 0 and doc_id is not null")
    heads = some.groupBy(*key).agg(F.min(F.struct("doc_id", "minima", "bands")).alias("head"))
    heads = stored(heads.select(*key, F.col("head.doc_id").alias("rep"), "head.minima", "head.bands"))

    spread = heads.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    hubs = spread.groupBy("bucket").agg(
        F.min("rep").alias("hub"), F.count("*").alias("size"), F.sum("n_shingles").alias("shingles")
    )
    shared = stored(spread.join(hubs.where("size > 1"), "bucket"))
    ids = stored(shared.select(F.col("rep").alias("doc_id")).distinct())
    listed = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = stored(docs.join(listed, "doc_id", "left_semi").mapInArrow(_sets, "doc_id bigint, packed binary"))
    first = shared.where("rep <> hub").select(F.col("rep").alias("x"), F.col("hub").alias("y")).distinct()
    links = _hub_links(first, heads, sets, percent)

    known = components(links, "x", "y").select(F.col("node").alias("rep"), "component_id")
    placed = shared.join(known, "rep", "left").withColumn("component", F.coalesce("component_id", "rep"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    parts = F.ceil(F.greatest(F.col("size") / PART_ROWS, F.col("shingles") / PART_SHINGLES)).cast("int")
    placed = placed.join(mixed.where("low < high").select("bucket"), "bucket").select(
        "bucket", "rep", "component", parts.alias("parts"), F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part")
    )
    # each row goes to the pairs of parts that its part is in
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "bucket", "rep", "component", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")
    )
    placed = placed.join(heads.select("rep", "n_shingles", "minima", "bands"), "rep")
    placed = placed.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    missed = placed.groupBy("bucket", "i", "j").applyInArrow(_missed_links(percent), "x bigint, y bigint")
    links = links.union(stored(missed)).union(_shared_ids(some, heads, key))

    known = components(links, "x", "y").select(F.col("node").alias("rep"), "component_id")
    roots = heads.select(*key, "rep").join(known, "rep", "left")
    roots = roots.select(*[F.col(c).alias(f"_{c}") for c in key], F.coalesce("component_id", "rep").alias("root"))
    rows = sketches.select("doc_id", *key).join(
        roots, [F.col(c) == F.col(f"_{c}") for c in key] + [F.col("doc_id").isNotNull()], "left"
    )
    rows = rows.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the smallest id.

    Of several rows with one id all stay or go.
    """
    gone = near_duplicates(docs, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
