"""Embedding near-duplicates by a cover tree and a dual traversal of its nodes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import dropped, stored, without_shuffles
from ledgerlight.llm.components import components

#: Vectors of the sample that the tree is built on, and rows of a block.
SAMPLE, BLOCK_ROWS = 1024, 2048
#: Pairs of nodes whose distances the traversal takes at once.
PAIRS_AT_ONCE = 50_000
#: Rows of a block that are compared at once.
STRIP = 256
#: Bytes of blocks that a task compares with as many, and parts that the blocks are dealt to at least.
PART_BYTES, PARTS = 8_000_000, 8
LAST_ID = 2**63 - 1
#: A node with so few vectors of the sample is not divided further.
LEAF_SAMPLE = 4


class Tree:
    """Nested levels of centres over unit vectors, the radius halved from level to level.

    A node's centre is the centre of one of its children too.  ``parent``, ``centre``
    and ``depth`` are by node; ``leaves`` lists the nodes without children.
    """

    def __init__(self, points: np.ndarray, least_radius: float) -> None:
        self.points = points
        self.centre, self.parent, self.children = [0], [-1], [[]]
        todo = [(0, np.arange(len(points)), 2.0)]
        while todo:
            node, members, radius = todo.pop()
            if len(members) <= LEAF_SAMPLE or radius / 2 < least_radius:
                continue
            radius /= 2
            centres = [self.centre[node]]
            nearest = np.linalg.norm(points[members] - points[centres[0]], axis=1)
            owner = np.zeros(len(members), np.int64)
            while True:
                far = int(np.argmax(nearest))
                if nearest[far] <= radius:
                    break
                centres.append(int(members[far]))
                gap = np.linalg.norm(points[members] - points[centres[-1]], axis=1)
                owner[gap < nearest] = len(centres) - 1
                nearest = np.minimum(nearest, gap)
            for k, centre in enumerate(centres):
                child = len(self.centre)
                self.centre.append(centre)
                self.parent.append(node)
                self.children.append([])
                self.children[node].append(child)
                todo.append((child, members[owner == k], radius))
        self.leaves = self._in_order()

    def _in_order(self) -> list[int]:
        order, todo = [], [0]
        while todo:
            node = todo.pop()
            if self.children[node]:
                todo += reversed(self.children[node])
            else:
                order.append(node)
        return order

    def leaf_centres(self) -> np.ndarray:
        return self.points[[self.centre[leaf] for leaf in self.leaves]]

    def near_leaves(self, radii: dict[int, float], reach: float) -> np.ndarray:
        """Pairs of leaf positions that may hold vectors within ``reach``, by dual traversal.

        ``radii`` has the covering radius of the rows of each leaf position.  A pair of
        nodes is dropped when its centres are farther apart than both covering radii
        and ``reach``; otherwise the node of the larger radius is opened.
        """
        size = len(self.centre)
        radius = np.full(size, -1.0)
        for at, r in radii.items():
            radius[self.leaves[at]] = r
        spot = self.points[self.centre]
        for node in range(size - 1, 0, -1):  # children come after their parents
            up = self.parent[node]
            if radius[node] >= 0:
                radius[up] = max(radius[up], radius[node] + float(np.linalg.norm(spot[node] - spot[up])))
        fan = np.array([len(c) for c in self.children])
        first = np.cumsum(fan) - fan
        below = np.array([c for children in self.children for c in children], np.int64)

        def opened(pairs: np.ndarray, side: int) -> np.ndarray:
            """Each pair once for every child of the node on one side."""
            node = pairs[:, side]
            wide = np.repeat(pairs, fan[node], axis=0)
            nth = np.arange(len(wide)) - np.repeat(np.cumsum(fan[node]) - fan[node], fan[node])
            wide[:, side] = below[np.repeat(first[node], fan[node]) + nth]
            return wide

        pairs, done = np.zeros((1, 2), np.int64), []
        while len(pairs):
            kept = []
            for part in np.array_split(pairs, len(pairs) // PAIRS_AT_ONCE + 1):
                one, two = part.T
                gap = np.linalg.norm(spot[one] - spot[two], axis=1)
                there = (radius[one] >= 0) & (radius[two] >= 0)
                kept.append(part[there & (gap <= radius[one] + radius[two] + reach + 1e-9)])
            pairs = np.concatenate(kept)
            one, two = pairs.T
            ended = (fan[one] == 0) & (fan[two] == 0)
            done.append(pairs[ended])
            same = (one == two) & ~ended
            second = ~same & (fan[two] > 0) & ((fan[one] == 0) | (radius[two] > radius[one]))
            twins = []
            for node in one[same].tolist():
                i, j = np.triu_indices(fan[node])
                own = below[first[node] : first[node] + fan[node]]
                twins.append(np.stack((own[i], own[j]), axis=1))
            pairs = np.concatenate([opened(pairs[second], 1), opened(pairs[~ended & ~same & ~second], 0), *twins])
        at = np.full(size, -1)
        at[self.leaves] = np.arange(len(self.leaves))
        return np.sort(at[np.concatenate(done)], axis=1) if done else np.empty((0, 2), int)


def _stored(df: DataFrame) -> DataFrame:
    """``df`` stored, and its shuffles removed, so that the disk holds those of one step at a time."""
    with without_shuffles(df.sparkSession):
        return stored(df)


def _flat(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False)


def _unit(flat: np.ndarray, width: int) -> np.ndarray:
    vectors = flat.astype(np.float64).reshape(-1, width)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _placed(centres) -> object:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = centres.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                unit = _unit(_flat(part.column("vector")), points.shape[1])
                leaf = np.argmax(unit @ points.T, axis=1)
                gap = np.linalg.norm(unit - points[leaf], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(leaf.astype(np.int32)), pa.array(gap)], names=[*part.schema.names, "leaf", "gap"]
                )

    return emit


def _blocked(width: int, kept: type):
    def pack(group: pa.Table) -> pa.Table:
        flat = _flat(group.column("vector")).astype(kept).reshape(-1, width)
        ids = np.array(group.column("rep").to_pylist(), np.int64)
        copies = np.array(group.column("copies").to_pylist(), np.int64)
        leaf = group.column("leaf").to_numpy()
        order = np.argsort(leaf, kind="stable")  # rows of a leaf lie together
        own = [group.column(name)[0].as_py() for name in ("block", "part")]
        packed = [*own, *(x[order].tobytes() for x in (ids, copies, leaf, flat))]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        names = ["block", "part", "ids", "copies", "leaves", "vectors"]
        return pa.table({n: pa.array([v], k) for n, v, k in zip(names, packed, kinds, strict=True)})

    return pack


def _linked(width: int, kept: type, least: float, close):
    # a product in single precision is off by less, so what it leaves out is no link
    rough = np.float32(least - (width + 4) * 2.0**-23)

    def marked(x: np.ndarray, y: np.ndarray, leaves: list[np.ndarray]) -> np.ndarray | None:
        """The links, looking only at pairs of rows whose leaves the traversal has left; None for none."""
        near = None  # a byte a pair, whatever the number of links
        fast, others = x.astype(np.float32), y.astype(np.float32)
        edges = np.append(np.flatnonzero(np.diff(leaves[0], prepend=-1)), len(x))
        other = close.value[np.ix_(leaves[0][edges[:-1]], leaves[1])]
        if other.all():
            edges, other = np.array([0, len(x)]), other[:1]
        for start, end, of_run in zip(edges, edges[1:], other, strict=False):
            if not of_run.any():
                continue
            at = np.arange(len(y)) if of_run.all() else np.flatnonzero(of_run)
            some = others if len(at) == len(y) else others[at]
            for strip in range(start, end, STRIP):
                part = slice(strip, min(strip + STRIP, end))
                may = fast[part] @ some.T >= rough
                if may.any():
                    near = np.zeros((len(x), len(y)), bool) if near is None else near
                    rows, columns = strip + np.flatnonzero(may.any(axis=1)), at[may.any(axis=0)]
                    near[np.ix_(rows, columns)] = x[rows] @ y[columns].T >= least
        return near

    def of_pair(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, y = (_unit(np.frombuffer(row[f"vectors_{s}"], kept), width) for s in "xy")
        same = row["block_x"] == row["block_y"]
        near = marked(x, y, [np.frombuffer(row[f"leaves_{s}"], np.int32) for s in "xy"])
        if near is not None and same:
            np.fill_diagonal(near, False)
        if near is None or not near.any():
            return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        rows, columns = near.any(axis=1), near.any(axis=0)
        if same:
            rows = columns = rows | columns
        near = near[np.ix_(rows, columns)]
        ids = [np.frombuffer(row[f"ids_{s}"], np.int64)[of] for s, of in zip("xy", (rows, columns), strict=True)]
        copies = [np.frombuffer(row[f"copies_{s}"], np.int64)[of] for s, of in zip("xy", (rows, columns), strict=True)]
        parts = [slice(start, start + STRIP) for start in range(0, len(near), STRIP)]
        counts = [np.zeros(len(ids[0])), np.zeros(len(ids[1]))]
        for part in parts:
            counts[0][part] = near[part] @ copies[1].astype(float)
            counts[1] += copies[0][part].astype(float) @ near[part]
        low = [ids[0].copy(), ids[1].copy()]
        while True:  # the least id that links reach within the pair of blocks
            before = low[0].copy(), low[1].copy()
            for part in parts:
                reached = np.where(near[part], low[0][part, None], LAST_ID).min(axis=0)
                low[1] = np.minimum(low[1], reached)
            if same:
                low[0] = np.minimum(low[0], low[1])
            for part in parts:
                reached = np.where(near[part], low[1][None, :], LAST_ID).min(axis=1)
                low[0][part] = np.minimum(low[0][part], reached)
            if same:
                low[1] = low[0].copy()
            if all(np.array_equal(a, b) for a, b in zip(before, low, strict=True)):
                break
        sides = [0] if same else [0, 1]
        keep = [counts[s] > 0 for s in sides]
        return tuple(
            np.concatenate([v[s][k] for s, k in zip(sides, keep, strict=True)]) for v in (ids, counts, low)
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, counts, low = of_pair(batch.slice(k, 1).to_pylist()[0])
                if len(ids):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids), pa.array(counts.astype(np.int64)), pa.array(low)], names=["rep", "links", "low"]
                    )

    return emit


def _links_of_width(heads: DataFrame, width: int, least: float) -> DataFrame:
    """(rep, links, low) of every pair of blocks that may hold links; heads have ``width`` components."""
    spark = heads.sparkSession
    heads = heads.where(F.size("vector") == width)
    sample = heads.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").toArrow()
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    tree = Tree(_unit(_flat(sample.column("vector")), width), reach / 4)
    centres = spark.sparkContext.broadcast(tree.leaf_centres())
    element = heads.schema["vector"].dataType.elementType.simpleString()
    kept = np.float32 if element == "float" else np.float64
    kind = f"rep bigint, copies bigint, vector array<{element}>, leaf int, gap double"
    placed = _stored(heads.select("rep", "copies", "vector").mapInArrow(_placed(centres), kind))

    leaves = {r.leaf: r for r in placed.groupBy("leaf").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()}
    near = tree.near_leaves({k: r.radius for k, r in leaves.items()}, reach)
    # neighbouring leaves share a block while they fit; a large leaf has blocks of its own
    group, cuts, filled = {}, [], BLOCK_ROWS
    for leaf in sorted(leaves):
        n = leaves[leaf].n
        if filled + n > BLOCK_ROWS:
            cuts.append(0)
            filled = 0
        group[leaf] = len(cuts) - 1
        filled += n
        cuts[-1] = math.ceil(filled / BLOCK_ROWS)
    of_leaf = np.full(len(tree.leaves), -1)
    of_leaf[list(group)] = list(group.values())
    first = np.cumsum(cuts) - cuts
    by_leaf = [(k, g, cuts[g], int(first[g])) for k, g in group.items()]
    by_leaf = spark.createDataFrame(by_leaf, "leaf int, part int, cuts int, first bigint")
    rows = placed.join(F.broadcast(by_leaf), "leaf").withColumn(
        "block", F.col("first") + F.pmod(F.xxhash64("rep"), F.col("cuts"))
    )
    blocks = rows.drop("gap", "cuts", "first").groupBy("block").applyInArrow(
        _blocked(width, kept), "block bigint, part int, ids binary, copies binary, leaves binary, vectors binary"
    )
    blocks = _stored(blocks)
    dropped(placed)
    met = [[] for _ in cuts]  # the groups of leaves that each may link with: at most as many as the sample has leaves
    for a, b in np.unique(np.concatenate((of_leaf[near], of_leaf[near][:, ::-1])), axis=0).tolist():
        met[a].append(b)
    met = spark.createDataFrame(list(enumerate(met)), "part int, met array<int>")
    size = sum(leaf.n for leaf in leaves.values()) * (width * np.dtype(kept).itemsize + 20)
    parts = min(sum(cuts), max(PARTS, math.ceil(size / PART_BYTES)))
    x, y = (blocks.repartition(parts).select(*[F.col(c).alias(f"{c}_{s}") for c in blocks.columns]) for s in "xy")
    x = x.join(F.broadcast(met.withColumnRenamed("part", "part_x")), "part_x")
    # each pair of blocks once, in either order alike; blocks are read where they lie and never sent once a pair
    ordered = (F.col("block_x") < F.col("block_y")) == ((F.col("block_x") + F.col("block_y")) % 2 == 0)
    meet = F.array_contains("met", F.col("part_y")) & ((F.col("block_x") == F.col("block_y")) | ordered)
    pairs = x.join(y.hint("shuffle_replicate_nl"), meet).select(
        *[f"{c}_{s}" for s in "xy" for c in ("block", "ids", "copies", "leaves", "vectors")]
    )
    between = np.zeros((len(tree.leaves), len(tree.leaves)), bool)  # a byte for each pair of leaves of the sample
    between[near[:, 0], near[:, 1]] = between[near[:, 1], near[:, 0]] = True
    close = spark.sparkContext.broadcast(between)
    found = _stored(pairs.mapInArrow(_linked(width, kept, least, close), "rep bigint, links bigint, low bigint"))
    dropped(blocks)
    return found


def near_vectors(rows: DataFrame, least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector.

    Vectors link at a cosine of ``least`` or more, in double precision.  A vector that
    is null, zero or has null or non-finite components links with nothing, nor do
    vectors of different lengths link.  A row without vec_id links with nothing, has no
    component and is kept; rows of one id are vectors of their own, with links of their
    own, that share a component.  Columns but vec_id and embedding are ignored; an empty table gives an
    empty result.

    Equal vectors are one class.  The tree is built on a sample of SAMPLE classes (a
    bound on what the driver gets); every class is then put at its nearest leaf, so the
    covering radii are those of all rows.  Blocks of at most about BLOCK_ROWS vectors
    meet where the traversal leaves leaves of theirs as a pair, and only the vectors of
    such leaves are compared; a pair of blocks yields a count and a least id for each
    vector, never its links.  A task reads the blocks of two parts where they lie: what
    the disk holds grows with the vectors, not with the pairs of blocks.
    """
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    heads = rows.where(usable).groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    # one id may stand for several vectors, so a class has a number of its own
    heads = _stored(heads.withColumn("rep", F.monotonically_increasing_id()))
    widths = [r[0] for r in heads.select(F.size("vector").alias("n")).distinct().collect()]
    found = heads.sparkSession.createDataFrame([], "rep bigint, links bigint, low bigint")
    for width in sorted(widths):
        found = found.union(_links_of_width(heads.drop("id"), width, least))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))

    classes = heads.select(F.col("vector").alias("_vector"), "rep")
    members = rows.join(classes, usable & (F.col("vector") == F.col("_vector")), "left").select("vec_id", "rep")
    members = _stored(members)
    several = members.groupBy("vec_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    shared = members.join(several.select("vec_id", "low"), "vec_id").select("rep", "low")
    known = components(found.where("rep <> low").select("rep", "low").union(shared), "rep", "low")
    known = known.withColumnRenamed("node", "rep")
    placed = heads.select("rep", "id", "copies").join(known, "rep", "left").join(links, "rep", "left")
    placed = placed.withColumn("component_id", F.coalesce("component_id", "rep"))
    roots = placed.groupBy("component_id").agg(F.min("id").alias("_root"))
    found = placed.join(roots, "component_id").select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"), "_root"
    )
    made = members.join(found, "rep", "left").select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("_root", "vec_id").alias("component_id")
    )
    return made.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
