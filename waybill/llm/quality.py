"""Quality classifier: Naive Bayes support vectors over n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import fresh, plus, small, text_of
from waybill.sources.scratch import Scratch

#: Indicators: n-grams of both kinds are hashed into so many slots.
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
#: Orders of n-grams over character classes (runs shortened), and over lower-cased bytes.
CLASS_ORDERS = (1, 2, 3, 4, 5, 6)
BYTE_ORDERS = (3,)
#: Labelled rows that the hinge-loss model is fitted on at most, on average; the log-count ratios use all.
FIT_ROWS = 24_000
#: Parts of them that are fitted apart and averaged, and the share kept for the calibration.
PARTS = 8
CALIBRATE_EVERY = 5
COST = 1.0
PASSES = 12
#: Score from which a document is of quality.
THRESHOLD = 0.7
#: Bytes of a text handled at a time, and those up to the next white space.
BLOCK = 1 << 20

_DITTO = ord("=")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _classes() -> np.ndarray:
    """Lower case and letters beyond ASCII as x, upper case as X, digits as 9, white space as blank."""
    table = np.arange(256, dtype=np.uint8)
    table[128:] = ord("x")
    table[ord("a") : ord("z") + 1] = ord("x")
    table[ord("A") : ord("Z") + 1] = ord("X")
    table[ord("0") : ord("9") + 1] = ord("9")
    table[[9, 10, 11, 12, 13, 32]] = 32
    return table


_CLASS = _classes()
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def _mark(present: np.ndarray, values: np.ndarray, orders: tuple[int, ...], kind: int) -> None:
    """Set the slots of all n-grams of the given orders."""
    values = values.astype(np.uint64)
    code = np.zeros(len(values), np.uint64)
    for k in range(1, min(max(orders), len(values)) + 1):
        code = (code[: len(values) - k + 1] << np.uint64(8)) | values[k - 1 :]
        if k in orders:
            slot = (code + np.uint64((kind * 16 + k) << 56)) * _MULTIPLIER
            present[(slot >> np.uint64(64 - SLOT_BITS)).view(np.int64)] = True


def _found(present: np.ndarray) -> np.ndarray:
    """The places set in a mask; eight are looked at together, as few are."""
    eights = np.flatnonzero(present.view(np.uint64) != 0)
    which, place = np.nonzero(present.reshape(-1, 8)[eights])
    return eights[which] * 8 + place


def _ditto(data: np.ndarray, shown: np.ndarray) -> np.ndarray:
    """The classes, with ditto marks for each word that repeats the one before it."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], shown == 32, [True]])))
    starts, ends = edges[::2], edges[1::2]
    lens = ends - starts
    alike = (lens[1:] == lens[:-1]) & (data[starts[1:]] == data[starts[:-1]])
    alike &= data[ends[1:] - 1] == data[ends[:-1] - 1]
    again = np.flatnonzero(alike) + 1
    if not len(again):
        return shown
    out, whole = shown.copy(), data.tobytes()
    before = zip(starts[again - 1].tolist(), ends[again - 1].tolist())
    for (a, b), s, e in zip(before, starts[again].tolist(), ends[again].tolist()):
        if whole[a:b] == whole[s:e]:
            out[s:e] = _DITTO
    return out


def _blank_from(data: np.ndarray, at: int) -> int:
    """The first place of white space from there on, or the end."""
    while at < len(data):
        found = np.flatnonzero(_CLASS[data[at : at + 4096]] == 32)
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)


def indicators(text: str, present: np.ndarray) -> np.ndarray:
    """Slots of the n-grams that occur in a text. present is a blank mask of SLOTS that comes back blank."""
    data = np.frombuffer(text.encode(), np.uint8)
    runs, word = data[:0], data[:0]
    start = 0
    while start < len(data):
        end = _blank_from(data, start + BLOCK)
        # The word before tells whether the first one repeats it, five runs start the n-grams across the border.
        part = np.concatenate([word, data[start:end]])
        classes = _CLASS[part]
        shown = _ditto(part, classes)[len(word) :]
        first = np.concatenate([runs[-1:] != shown[:1] if len(runs) else [True], shown[1:] != shown[:-1]])
        runs = np.concatenate([runs, shown[first]])
        _mark(present, runs, CLASS_ORDERS, 1)
        _mark(present, _LOWER[data[max(0, start - 2) : end]], BYTE_ORDERS, 2)
        runs = runs[-(max(CLASS_ORDERS) - 1) :]
        letters = np.flatnonzero(classes != 32)
        if len(letters):
            stop = letters[-1] + 1
            blanks = np.flatnonzero(classes[:stop] == 32)
            word = part[blanks[-1] + 1 if len(blanks) else 0 : stop]
        start = end
    found = _found(present)
    present[found] = False
    return found


def log_count_ratio(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Log of the ratio of an indicator's share in the classes, counts smoothed by one."""
    p, q = positive + 1.0, negative + 1.0
    return np.log((p / p.sum()) / (q / q.sum())).astype(np.float32)


def _unit(found: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Values of the indicators, scaled by the ratios, in a vector of length one."""
    values = ratio[found].astype(np.float64)
    norm = np.sqrt(values @ values)
    return values / norm if norm else values


def dual_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: np.ndarray, passes: int = PASSES
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the hinge loss, by dual coordinate descent (Hsieh et al., 2008).

    The bias is one more value of 1 in each row. Rows are visited in a seeded order.
    """
    weights, bias = np.zeros(SLOTS), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for _, v in rows])
    draw = np.random.default_rng(11)
    for _ in range(passes):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            at, values = rows[i]
            gradient = signs[i] * (weights[at] @ values + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if step := (new - alpha[i]) * signs[i]:
                weights[at] += step * values
                bias += step
                moved = max(moved, abs(step))
            alpha[i] = new
        if moved < 1e-4:
            break
    return weights, bias


def calibrate(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins (Platt), by damped Newton steps."""
    n_good = float(good.sum())
    high, low = (n_good + 1) / (n_good + 2), 1 / (len(good) - n_good + 2)
    target = np.where(good, high, low)
    x = np.stack([margins, np.ones_like(margins)])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        slope = x @ (p - target) + 1e-3 * theta
        curve = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])


@dataclass(frozen=True)
class Model:
    """Weight of each slot's raw indicator, the ratios for the length, bias and calibration."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        values = _unit(found, self.ratio)
        return float(self.weights[found] @ values + self.bias)

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.offset, -30, 30))))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as the slots of their indicators."""
    present = np.zeros(SLOTS, bool)
    for batch in batches:
        slots = [indicators(t.as_py(), present).astype(np.int32) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.list_(pa.int32())), *batch.columns[1:]],
            names=["slots", "good", "draw"],
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have an indicator, summed over the task."""
    present, counts = np.zeros(SLOTS, bool), np.zeros((2, SLOTS), np.int64)
    for batch in batches:
        for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[int(good), indicators(text.as_py(), present)] += 1
    for good in (False, True):
        slots = np.flatnonzero(counts[int(good)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(slots), good)),
                pa.array(slots.astype(np.int32)),
                pa.array(counts[int(good), slots]),
            ],
            names=["good", "slot", "n"],
        )


def fit(
    labelled: DataFrame, space: Scratch, fit_rows: int = FIT_ROWS, cost: float = COST
) -> Model | None:
    """A model from rows (text, good, draw), draw a number that spreads rows evenly; None without both classes.

    Counts of the log-count ratios are summed over all rows on the cluster (one row per slot and class reaches
    the driver, SLOTS at most). Of the rows a share that makes about fit_rows is dealt into PARTS; each
    part is solved in a task of its own and the weights are averaged. Every fifth row is kept
    for the calibration. Both classes have the same weight in the loss.
    """
    numbers = {r.good: r.n for r in labelled.groupBy("good").agg(F.count("*").alias("n")).collect()}
    numbers = {bool(k): n for k, n in numbers.items() if k is not None}
    if len(numbers) < 2:
        return None
    total = sum(numbers.values())

    rows = labelled.where("good is not null").select("text", "good", "draw")
    counts = np.zeros((2, SLOTS))
    seen = rows.select("text", "good").mapInArrow(_counted, "good boolean, slot int, n long")
    seen = seen.groupBy("good", "slot").agg(F.sum("n").alias("n")).toArrow()
    at = seen["good"].to_numpy().astype(int), seen["slot"].to_numpy()
    counts[at] = seen["n"].to_numpy()
    ratio = log_count_ratio(counts[1], counts[0])
    bound = int((1 << 32) * min(1.0, fit_rows / total))
    sample = rows.where(F.pmod("draw", F.lit(1 << 32)) < bound)
    sample = sample.mapInArrow(_extracted, "slots array<int>, good boolean, draw long")
    part = F.pmod(F.xxhash64("draw"), F.lit(PARTS * CALIBRATE_EVERY))
    sample = space.write(sample.withColumn("part", part), "sample")
    balance = {good: total / (2 * n) for good, n in numbers.items()}

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, good = [], []
        for batch in batches:
            for slots, label in zip(batch.column("slots"), batch.column("good").to_pylist()):
                found = slots.values.to_numpy()
                vectors.append((found, _unit(found, ratio)))
                good.append(label)
        if len(set(good)) < 2:
            return
        flags = np.array(good)
        weight = np.where(flags, balance[True], balance[False])
        weights, bias = dual_descent(vectors, np.where(flags, 1.0, -1.0), cost * weight)
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([weights[used]], pa.list_(pa.float64())),
                pa.array([bias]),
            ],
            names=["used", "weights", "bias"],
        )

    fitted = sample.where(F.col("part") >= PARTS).withColumn("part", F.col("part") % PARTS)
    fields = "used array<int>, weights array<double>, bias double"
    parts = [fitted.where(F.col("part") == k).repartition(1) for k in range(PARTS)]
    solved = reduce(DataFrame.union, [p.mapInArrow(solve, fields) for p in parts]).collect()
    if not solved:  # too few rows to deal out
        solved = sample.repartition(1).mapInArrow(solve, fields).collect()
    if not solved:
        return None
    weights, bias = np.zeros(SLOTS), 0.0
    for r in solved:
        weights[np.array(r.used, np.int64)] += np.array(r.weights) / len(solved)
        bias += r.bias / len(solved)
    model = Model(ratio, weights, bias, 1.0, 0.0)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.margin(s.values.to_numpy()) for s in batch.column("slots")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), batch.column("good")], names=["margin", "good"]
            )

    held = sample.where(F.col("part") < PARTS).select("slots", "good")
    held = held.mapInArrow(margins, "margin double, good boolean").collect()
    if len({r.good for r in held}) < 2:
        return Model(ratio, weights, bias, 4.0, 0.0)
    slope, offset = calibrate(
        np.array([r.margin for r in held]), np.array([r.good for r in held])
    )
    return Model(ratio, weights, bias, max(slope, 0.1), offset)


def score(
    docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None
) -> tuple[DataFrame, str]:
    """The documents' columns (or those to keep) with a score from 0 to 1 of the whole text, and its name.

    Null texts count as empty; an empty text scores by the bias alone. Without a model every score is 0.5.
    """
    keep = docs.columns if keep is None else keep
    name = fresh(docs.columns, "score")
    rows = docs.select(*[f"`{c}`" for c in keep])
    if model is None:
        return rows.withColumn(name, F.lit(0.5)), name
    schema, carried = plus(rows, **{name: "double"}), len(keep)
    place = keep.index(text_col) if text_col in keep else carried
    if place == carried:
        rows = docs.select(*[f"`{c}`" for c in keep], text_of(text_col).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = np.zeros(SLOTS, bool)
        model = shared.value
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(place))
            scores = [model.score(indicators(t, present)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:carried], pa.array(scores, pa.float64())], names=[*keep, name]
            )

    return rows.mapInArrow(run, schema), name


def labelled_rows(
    docs: DataFrame,
    labels: DataFrame,
    space: Scratch,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """(text, good, draw) of documents with a label. Of several labels of a document the highest counts; null
    labels and ids give no row. learn is a condition on `id`."""
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("mark"))
    if learn is not None:
        marks = marks.where(learn)
    marks = marks.where("mark is not null and id is not null")
    marks = space.write(marks.groupBy("id").agg((F.max("mark") > 0).alias("good")), "marks")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    if learn is not None:
        texts = texts.where(learn)
    draw = F.xxhash64(F.lit("fit"), F.col("id").cast("string"))
    return texts.join(small(marks), "id").select("text", "good", draw.alias("draw"))
