"""Centroid clustering with ns-bounds (Newling and Fleuret, 2016), exact in integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import keyed
from waybill.sources.scratch import Scratch

CENTROIDS, ROUNDS, LENGTH, SCALE, SEED = 40, 5, 64, 256, 2
#: Up to the first bound sums of squares are exact in doubles, up to the second in 64 bits.
EXACT, LARGEST = 1 << 22, 1 << 27
#: What rounding may do to a distance, in proportion; bounds must differ by more to decide.
SLACK = 1e-9
#: Vectors compared at once.
ROWS = 4096

_STATE = "cluster int, upper double, upper_at int, lower double, lower_at int"
_SUMS = "moved int, sums array<long>, n long"


def kept_vectors(
    vectors: DataFrame, key: str, id_col: str, vector_col: str, length: int, scale: int, seed: int
) -> DataFrame:
    """(id, row, draw, vec) of the vectors that have the length and only finite components, scaled and floored."""
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    # floor of a double gives a long; what does not fit is refused below by its size.
    floors = F.transform(vec, lambda x: F.floor(x * scale))
    largest = F.lit(float(LARGEST) / scale)
    fits = F.forall(vec, lambda x: F.abs(x) < largest)
    refuse = F.raise_error(F.lit("components too large for exact distances")).cast("array<bigint>")
    return vectors.where((F.size(vec) == length) & finite).select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(key).alias("row"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_col}`").cast("string")), 256).alias("draw"),
        F.when(fits, floors).otherwise(refuse).alias("vec"),
    )


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, length)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of y (both of integers), exact, as integers."""
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) < EXACT:
        x, y = x.astype(float), y.astype(float)
        out = (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)
        return np.rint(out).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in y], 1)


def _own_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the centre in the same place."""
    return ((x - centres) ** 2).sum(1)


class Bounds:
    """Assignment by bounds that remember the round they were taken in.

    history[t] are the centroids of round t. A bound taken in round s is loosened by the norm of what a
    centroid moved in all from s to now, which is never more than the sum of its moves.
    """

    def __init__(self, history: np.ndarray) -> None:
        self.history, self.now = history, len(history) - 1
        moved = np.sqrt(((history - history[-1]) ** 2).sum(2).astype(float)) * (1 + SLACK)
        self.moved = moved  # by round and centroid
        k = moved.shape[1]
        first = np.argmax(moved, 1)
        rounds = np.arange(len(moved))
        second = moved.copy()
        second[rounds, first] = 0.0
        self.most = np.repeat(moved.max(1)[:, None], k, 1)  # of the other centroids
        self.most[rounds, first] = second.max(1)

    def rescan(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest centroid, distance, distance to the second nearest): all of them are compared."""
        d = distances(x, self.history[-1])
        nearest = np.argmin(d, 1)  # the smallest number among ties
        place = np.arange(len(x))
        own = np.sqrt(d[place, nearest].astype(float))
        d = d.astype(float)
        d[place, nearest] = np.inf
        return nearest, own, np.sqrt(d.min(1))

    def assign(self, x: np.ndarray, state: tuple[np.ndarray, ...]) -> tuple[tuple[np.ndarray, ...], int]:
        """The state of the vectors in this round, and how many were compared with all centroids.

        A vector whose loosened upper bound stays below its loosened lower one keeps its centroid. Of
        the others the distance to their own is taken anew, and who still fails is scanned exactly.
        """
        cluster, upper, upper_at, lower, lower_at = (s.copy() for s in state)
        low = lower - self.most[lower_at, cluster]
        open_ = np.flatnonzero(~((upper + self.moved[upper_at, cluster]) * (1 + SLACK) < low * (1 - SLACK)))
        if len(open_):
            own = np.sqrt(_own_distances(x[open_], self.history[-1][cluster[open_]]).astype(float))
            upper[open_], upper_at[open_] = own, self.now
            open_ = open_[~(own * (1 + SLACK) < low[open_] * (1 - SLACK))]
        if len(open_):
            cluster[open_], upper[open_], lower[open_] = self.rescan(x[open_])
            upper_at[open_] = lower_at[open_] = self.now
        return (cluster, upper, upper_at, lower, lower_at), len(open_)


def assigned(rows: DataFrame, history: np.ndarray, length: int) -> DataFrame:
    """The rows with their state in this round, and rows of what the sums of the clusters gain or lose.

    Sums rows have moved (the cluster), sums and n, one for each cluster and batch; only vectors that changed
    their cluster count in them. Rows without a state (round 0) are scanned.
    """
    shared = rows.sparkSession.sparkContext.broadcast(history)
    first = "cluster" not in rows.columns
    schema = f"id {rows.schema['id'].dataType.simpleString()}, row {rows.schema['row'].dataType.simpleString()}, "
    schema += f"vec array<bigint>, {_STATE}, {_SUMS}"
    kinds = [pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bounds(shared.value)
        k = own.history.shape[1]
        for whole in batches:
            gained, n = np.zeros((k, length), np.int64), np.zeros(k, np.int64)
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = _matrix(batch.column(2), length)
                if first:
                    cluster, upper, lower = own.rescan(x)
                    zero = np.zeros(len(x), np.int64)
                    state = cluster, upper, zero, lower, zero
                    changed = np.arange(len(x))
                else:
                    old = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns[3:8])
                    state, _ = own.assign(x, old)
                    changed = np.flatnonzero(state[0] != old[0])
                    np.subtract.at(gained, old[0][changed], x[changed])
                    np.subtract.at(n, old[0][changed], 1)
                np.add.at(gained, state[0][changed], x[changed])
                np.add.at(n, state[0][changed], 1)
                columns = [pa.array(s, kind) for s, kind in zip(state, kinds)]
                nulls = [pa.nulls(len(x), kind) for kind in (pa.int32(), pa.list_(pa.int64()), pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns, *nulls], names=names)
            some = np.flatnonzero(gained.any(1) | (n != 0))
            nulls = [pa.nulls(len(some), kind) for kind in (*(c.type for c in whole.columns[:3]), *kinds)]
            sums = pa.array(gained[some].tolist(), pa.list_(pa.int64()))
            more = [pa.array(some, pa.int32()), sums, pa.array(n[some])]
            yield pa.RecordBatch.from_arrays([*nulls, *more], names=names)

    names = ["id", "row", "vec", "cluster", "upper", "upper_at", "lower", "lower_at", "moved", "sums", "n"]
    return rows.mapInArrow(run, schema)


def _totals(stored: DataFrame, sums: np.ndarray, n: np.ndarray) -> None:
    """Add what a round's sums rows say; one row per centroid and component reaches the driver."""
    parts = stored.where("moved is not null").select("moved", "n", F.posexplode("sums").alias("at", "x"))
    for r in parts.groupBy("moved", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect():
        sums[r.moved][r["at"]] += r.x
        if r["at"] == 0:
            n[r.moved] += r.n


def cluster(
    vectors: DataFrame,
    space: Scratch,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray, DataFrame, str]:
    """Lloyd's rounds from drawn vectors: (one row per kept vector, last centroids, vectors with a key, its name).

    The rows have id, row, vec (integers: floor of scale times a component), cluster and distance (squared, exact). Kept are
    vectors of the length without null or non-finite components. The first centroids are the kept vectors with the smallest
    SHA-256 of "seed:id" (null ids last, ties by vector), in that order; fewer vectors give fewer
    centroids. Each round assigns all vectors to the nearest centroid, ties to the smaller number, and moves each
    centroid that has vectors to the floor of their mean; then all are assigned once more. Repeats are vectors of
    their own. An empty table gives no rows; other columns are not read. Components from LARGEST / scale on are an error, as
    their distances do not fit 64 bits.

    Sums are kept from round to round and changed by the vectors that changed their cluster. Each
    round reads and writes the kept vectors with six numbers of state once, and no row is shuffled; the table of the round
    before is dropped.
    """
    vectors, key = keyed(vectors, id_col, space)
    kept = kept_vectors(vectors, key, id_col, vector_col, length, scale, seed)
    rows = space.write(kept, "vectors")
    first = rows.orderBy(F.col("draw").asc_nulls_last(), "vec").limit(centroids).collect()
    centres = [list(r.vec) for r in first]
    history = np.array([centres], np.int64).reshape(1, -1, length)
    sums, n = [[0] * length for _ in centres], [0] * len(centres)
    rows = rows.select("id", "row", "vec")
    if not centres:
        empty = rows.select("*", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, history[-1], vectors, key
    for number in range(rounds + 1):
        stored = space.write(assigned(rows, history, length), f"round-{number}")
        if number:
            space.remove(f"round-{number - 1}")
        rows = stored.where("cluster is not null").drop("moved", "sums", "n")
        if number == rounds:
            break
        _totals(stored, sums, n)
        # Python's integers: no sum overflows, and // is the floor.
        moved = [[x // m for x in s] if m else list(c) for s, m, c in zip(sums, n, history[-1].tolist())]
        history = np.concatenate([history, np.array([moved], np.int64)])
    last = history[-1]
    centres = rows.sparkSession.createDataFrame(
        list(enumerate(last.tolist())), "cluster int, centre array<bigint>"
    )
    gaps = F.zip_with("vec", "centre", lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b)
    rows = rows.join(F.broadcast(centres), "cluster")  # a row per centroid
    return rows.select("id", "row", "vec", "cluster", distance.alias("distance")), last, vectors, key
