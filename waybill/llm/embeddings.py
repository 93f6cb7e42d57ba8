"""Embedding near-dedup: an epsilon grid order join of vectors in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import keyed, ordered, plus, small
from waybill.llm.components import components
from waybill.sources.scratch import Scratch

THRESHOLD = 0.93
#: Leading principal dimensions that are gridded; vectors of a block; vectors compared at once.
DIMS, BLOCK, LEAF = 6, 1024, 128
#: The covariance is square in the longest vector, which may not be longer.
MAX_LENGTH = 2048


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, only finite components, not all zero."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """Vectors of up to that length as rows of length one, filled with zeros."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), length))
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        out[i, : b - a] = values[a:b]
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def principal(classes: DataFrame, length: int, dims: int) -> np.ndarray:
    """The leading principal directions of the unit vectors, as columns. All vectors count."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, total, n = np.zeros((length, length)), np.zeros(length), 0
        for batch in batches:
            unit = _matrix(batch.column(0), length)
            square += unit.T @ unit
            total += unit.sum(0)
            n += len(unit)
        if n:
            rows = np.vstack([square, total, np.full(length, float(n))])
            i, j = np.divmod(np.arange(rows.size), length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(rows.ravel())],
                names=["i", "j", "x"],
            )

    parts = classes.select("vec").mapInArrow(sums, "i int, j int, x double")
    cells = parts.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    rows = np.zeros((length + 2, length))
    rows[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["x"].to_numpy()
    if not rows[-1, 0]:
        return np.eye(length)[:, :dims]
    mean = rows[-2] / rows[-1, 0]
    _, vectors = np.linalg.eigh(rows[:length] / rows[-1, 0] - np.outer(mean, mean))
    return vectors[:, ::-1][:, :dims]


def _in_grid_order(
    classes: DataFrame, space: Scratch, length: int, dims: int, eps: float, block: int
) -> DataFrame:
    """Vectors with their block: a stretch of the order by (label, length, grid cell), at most block long."""
    axes = principal(classes, length, dims)
    dims = axes.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _matrix(batch.column("vec"), length)
            at = unit @ axes
            rest = np.sqrt(np.maximum(0.0, 1.0 - (at * at).sum(1, keepdims=True)))
            at = np.hstack([at, rest])
            cells = np.floor(at / eps).astype(np.int32)
            ends = np.arange(len(at) + 1, dtype=np.int32) * (dims + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.ListArray.from_arrays(ends, cells.ravel()),
                    pa.ListArray.from_arrays(ends, at.ravel()),
                ],
                names=[*batch.schema.names, "cells", "at"],
            )

    schema = plus(classes, cells="array<int>", at="array<double>")
    order = ["label", "len", "cells", "cls"]
    dealt = classes.mapInArrow(project, schema).repartitionByRange(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, last, used = TaskContext.get().partitionId() << 32, None, 0
        seq = 0
        for batch in batches:
            blocks = []
            for group in zip(batch.column("label").to_pylist(), batch.column("len").to_pylist()):
                if group != last or used == block:
                    seq, last, used = seq + 1, group, 0
                used += 1
                blocks.append(base + seq)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blocks, pa.int64())], names=[*batch.schema.names, "block"]
            )

    numbered = dealt.sortWithinPartitions(*order).mapInArrow(number, plus(dealt, block="long"))
    return space.write(numbered.drop("cells"), "grid")


def _close_blocks(rows: DataFrame, space: Scratch, dims: int, eps: float) -> DataFrame:
    """(task, a, b): pairs of blocks, each also with itself, whose boxes are not further apart than eps."""
    low = [F.min(F.col("at")[k]).alias(f"lo{k}") for k in range(dims)]
    high = [F.max(F.col("at")[k]).alias(f"hi{k}") for k in range(dims)]
    boxes = space.write(rows.groupBy("block", "label", "len").agg(*low, *high), "boxes")
    names = [f"{side}{k}" for side in ("lo", "hi") for k in range(dims)]
    first = boxes.select(F.col("block").alias("a"), "label", "len", *[F.col(n).alias(f"a_{n}") for n in names])
    second = boxes.select(F.col("block").alias("b"), "label", "len", *[F.col(n).alias(f"b_{n}") for n in names])
    strip = lambda x: F.floor(x / eps)
    first = first.withColumn(
        "strip", F.explode(F.sequence(strip(F.col("a_lo0")) - 1, strip(F.col("a_hi0")) + 1))
    )
    second = second.withColumn(
        "strip", F.explode(F.sequence(strip(F.col("b_lo0")), strip(F.col("b_hi0"))))
    )
    gap = F.lit(0.0)
    for k in range(dims):
        apart = F.greatest(
            F.lit(0.0), F.col(f"a_lo{k}") - F.col(f"b_hi{k}"), F.col(f"b_lo{k}") - F.col(f"a_hi{k}")
        )
        gap = gap + apart * apart
    pairs = first.join(second, ["label", "len", "strip"]).where((F.col("a") <= F.col("b")) & (gap <= eps * eps))
    pairs = pairs.select("a", "b").distinct()
    return space.write(pairs.withColumn("task", F.monotonically_increasing_id()), "pairs")


class _Join:
    """The join of two blocks in grid order: intervals are halved, and skipped where boxes are apart."""

    def __init__(self, ids, weights, unit, at, cut: int, eps: float, threshold: float) -> None:
        self.weights, self.unit, self.at, self.ids = weights, unit, at, ids
        self.eps2, self.threshold = eps * eps, threshold
        self.links = np.zeros(len(ids), np.int64)
        self.label = np.arange(len(ids))
        if cut == len(ids):
            self.within(0, cut)
        else:
            self.between(0, cut, cut, len(ids))

    def within(self, start: int, end: int) -> None:
        if end - start <= LEAF:
            near = np.triu(self.near(start, end, start, end), 1)
            self.take(near, start, start)
            return
        mid = (start + end) // 2
        self.within(start, mid)
        self.within(mid, end)
        self.between(start, mid, mid, end)

    def between(self, a0: int, a1: int, b0: int, b1: int) -> None:
        a, b = self.at[a0:a1], self.at[b0:b1]
        gap = np.maximum(0.0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
        if gap @ gap > self.eps2:
            return
        if max(a1 - a0, b1 - b0) <= LEAF:
            self.take(self.near(a0, a1, b0, b1), a0, b0)
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            self.between(a0, mid, b0, b1)
            self.between(mid, a1, b0, b1)
        else:
            mid = (b0 + b1) // 2
            self.between(a0, a1, b0, mid)
            self.between(a0, a1, mid, b1)

    def near(self, a0: int, a1: int, b0: int, b1: int) -> np.ndarray:
        return self.unit[a0:a1] @ self.unit[b0:b1].T >= self.threshold

    def take(self, near: np.ndarray, a0: int, b0: int) -> None:
        """Count the links, and join the labels of what is linked."""
        if not near.any():
            return
        a, b = slice(a0, a0 + near.shape[0]), slice(b0, b0 + near.shape[1])
        self.links[a] += near @ self.weights[b]
        self.links[b] += self.weights[a] @ near
        label = self.label
        i, j = np.nonzero(near & (label[a][:, None] != label[b][None, :]))
        if not len(i):
            return
        for x, y in np.unique(np.stack([label[a][i], label[b][j]], 1), axis=0).tolist():
            while label[x] != x:
                x = int(label[x])
            while label[y] != y:
                y = int(label[y])
            label[max(x, y)] = min(x, y)
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _joined(batches: Iterator[pa.RecordBatch], length: int, eps: float, threshold: float):
    """Of each task's vectors, (a, links, null) for counts and (a, null, b) for edges."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        ids = rows["cls"].to_numpy()
        sides = rows["side"].to_numpy()
        vectors = rows["vec"].combine_chunks()
        at = np.array(rows["at"].to_pylist())
        cut = int(np.searchsorted(sides, 1))
        found = _Join(ids, rows["n"].to_numpy(), _matrix(vectors, length), at, cut, eps, threshold)
        some = np.flatnonzero(found.links)
        edges = np.flatnonzero(found.label != np.arange(len(ids)))
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[some], ids[edges]])),
                pa.concat_arrays([pa.array(found.links[some]), none(len(edges))]),
                pa.concat_arrays([none(len(some)), pa.array(ids[found.label[edges]])]),
            ],
            names=["a", "links", "b"],
        )

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        tasks = rows["task"].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(np.diff(tasks)) + 1])
        for a, b in zip(starts[:-1], starts[1:]):
            yield solve(rows.slice(a, b - a))
        held = rows.slice(starts[-1])
    if held is not None and held.num_rows:
        yield solve(held)


def classify(
    vectors: DataFrame,
    space: Scratch,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    dims: int = DIMS,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame, str]:
    """Near copies among vectors of one label: (one row per vector, the vectors with a row key, its name).

    The rows have id, row, n_links (other vectors with a cosine of at least the threshold), component_id (the
    smallest id that links can reach, nulls last) and kept (that id's row; one row if the id repeats). Vectors
    that are null, zero, or hold null or non-finite components, or whose label is null, have no links and are
    kept. Vectors of different lengths are not compared. Repeats are vectors of their own and link with each
    other; they are compared once. An empty table gives no rows.

    Distances in the leading principal directions and of what they leave over never exceed the whole
    distance, so what is skipped cannot link. Only the threshold decides: the cosine is computed in
    double precision from the whole vectors. Links are counted and reduced to a forest where they are
    found, so a group in which all link sends no more than its members. Threshold: above 0, below 1.
    """
    vectors, key = keyed(vectors, id_col, space)
    eps = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9) + 1e-9
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(key).alias("row"),
        F.col(f"`{label_col}`").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
    )
    good = F.coalesce(usable(F.col("vec")) & F.col("label").isNotNull(), F.lit(False))
    order = ordered(F.col("id"), F.col("row"))
    classes = rows.where(good).groupBy("label", "vec")
    classes = classes.agg(F.count("*").alias("n"), F.min(order).alias("first"))
    classes = space.write(
        classes.select(F.monotonically_increasing_id().alias("cls"), F.size("vec").alias("len"), "*"),
        "classes",
    )
    length = classes.agg(F.max("len")).first()[0] or 1
    if length > MAX_LENGTH:
        raise ValueError(f"vectors longer than {MAX_LENGTH}")
    plain = classes.select("cls", "len", "label", "n", "vec")
    grid = _in_grid_order(plain, space, length, min(dims, length), eps, block)
    pairs = _close_blocks(grid, space, min(dims, length) + 1, eps)
    sides = pairs.select("task", F.lit(0).alias("side"), F.col("a").alias("block"))
    sides = sides.union(
        pairs.where("a <> b").select("task", F.lit(1).alias("side"), F.col("b").alias("block"))
    )
    tasks = grid.join(small(space.write(sides, "sides")), "block")
    tasks = tasks.select("task", "side", "cls", "n", "vec", "at").repartition("task")
    tasks = tasks.sortWithinPartitions("task", "side")
    found = tasks.mapInArrow(
        lambda it: _joined(it, length, eps, threshold), "a long, links long, b long"
    )
    found = space.write(found, "links")
    links = found.where("links is not null").groupBy(F.col("a").alias("cls"))
    links = links.agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"), space)
    linked = classes.select("cls", "label", "vec", "n", "first").join(
        roots.withColumnRenamed("node", "cls"), "cls", "left"
    )
    linked = linked.withColumn("root", F.coalesce("root", "cls")).join(links, "cls", "left")
    linked = space.write(linked, "rooted")
    # Stored, so that the vectors of a large component can be split in the join.
    least = space.write(linked.groupBy("root").agg(F.min("first").alias("least")), "least")
    linked = space.write(linked.drop("first").join(least, "root"), "linked")
    inside = rows.where(good).join(linked, ["label", "vec"]).select(
        "id",
        "row",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.col("least.id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("kept"),
    )
    outside = rows.where(~good).select(
        "id", "row", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
    )
    return inside.union(outside), vectors, key
