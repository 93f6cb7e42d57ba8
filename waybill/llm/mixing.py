"""Mixing sources to target weights by capped water-filling and seeded repetition."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.common import WHITESPACE, fresh, keyed, text_of
from waybill.sources.scratch import Scratch

MAX_EPOCHS = 3
#: Slices of each source's seeded order; only the slice in which the room ends is sorted.
SLICES = 4096
#: A source is near enough once the words it lacks are at most this part of its target.
NEAR = 1000
#: Sources are settings, not data: their totals go to the driver, which refuses more than these.
MAX_SOURCES = 100_000
#: The weights that repeat over the sources in order.
CYCLE = (5, 2, 1)
#: Where a row stands in the order of its source.
PLACE = "struct<draw:string,size:bigint,row:bigint>"
#: Rows after `low` and before `high` are taken once if they have at most `room` words.
SPANS = f"array<struct<low:{PLACE},high:{PLACE},room:bigint>>"
START, END = ("", -1, -1), ("~", -1, -1)


def water_fill(
    sizes: Mapping[Hashable, int], weights: Mapping[Hashable, float], epochs: int = MAX_EPOCHS
) -> dict[Hashable, float]:
    """Targets in proportion to the weights that sum to all sizes and stop at epochs times a size.

    Sources over their cap are clamped to it, and what is left is shared by weight among the
    others, until none is over. Weights of zero get nothing. If every weighted source is clamped,
    the sum stays below all sizes.
    """
    total = sum(sizes.values())
    caps = {s: epochs * n for s, n in sizes.items()}
    clamped: set[Hashable] = {s for s in sizes if not weights.get(s, 0)}
    targets = {s: 0.0 for s in clamped}
    while open_ := [s for s in sizes if s not in clamped]:
        left = total - sum(caps[s] for s in clamped if weights.get(s, 0))
        level = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if weights[s] * level > caps[s]]
        if not over:
            return targets | {s: weights[s] * level for s in open_}
        targets |= {s: float(caps[s]) for s in over}
        clamped |= set(over)
    return targets


def cycled(sources: list) -> dict[Hashable, int]:
    """The weights of CYCLE over the sources by code point, null last."""
    ranked = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: CYCLE[i % len(CYCLE)] for i, s in enumerate(ranked)}


def word_count(text_col: str):
    """Number of words; null and empty texts have none."""
    parts = F.split(text_of(text_col), WHITESPACE)
    return F.size(F.filter(parts, lambda w: w != "")).cast("long")


def mix(
    docs: DataFrame,
    space: Scratch,
    weights: Callable[[list], Mapping[Hashable, float]] = cycled,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    epochs: int = MAX_EPOCHS,
    seed: int = 7,
    slices: int = SLICES,
) -> tuple[DataFrame, DataFrame, str]:
    """How often the mix takes each document: (one row per document, documents with a key, its name).

    The rows have id, row, source, size (words), source_size, target, copies. A source is taken
    whole as often as its target allows. The rest is filled in a seeded order (MD5 of seed and id, ties by
    size): a document that does not fit is passed over and the following go on, until the words that lack are a
    thousandth of the target or no document fits. Last, the smallest document left out comes in
    if that brings the words nearer. A source thus misses its target by a thousandth, or by
    half of its smallest document left out, and no document is taken more
    than epochs times. A null source is a source. Rows without words are taken as often as the whole repetitions
    of their source say. Rows that repeat an id are rows of their own. An empty table gives no rows.

    A source may hold most rows: its order is cut into slices by the hash, slices are summed, and
    only rows of one slice are ranked. Each round of passing over leaves less room than the document it stopped
    at, and a source that is large beside its documents needs one round.
    """
    docs, key = keyed(docs, id_col, space)
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(f"`{id_col}`").cast("string")))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(key).alias("row"),
        F.col(f"`{source_col}`").alias("source"),
        word_count(text_col).alias("size"),
        draw.alias("draw"),
    )
    cut = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    rows = space.write(
        rows.withColumn("slice", F.floor(cut * slices / F.lit(1 << 32)).cast("int")), "sizes"
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1)
    sizes = {r.source: r.n for r in totals.collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    targets = water_fill(sizes, weights(list(sizes)), epochs)
    whole = {s: min(epochs, int(targets[s] / n)) if n else 0 for s, n in sizes.items()}
    rooms = {s: int(targets[s] - whole[s] * n) for s, n in sizes.items()}
    spans, rooms = _fill(rows, rooms, targets)
    nearest = _nearest(rows, rooms, spans)
    fields = f"of string, source_size long, target double, whole int, spans {SPANS}, extra {PLACE}"
    plan = docs.sparkSession.createDataFrame(
        [(s, n, targets[s], whole[s], spans[s], nearest.get(s)) for s, n in sizes.items()], fields
    )
    rows = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of")))
    once = _in_spans() | F.coalesce(_place() == F.col("extra"), F.lit(False))
    taken = rows.select(
        "id", "row", "source", "size", "source_size", "target",
        (F.col("whole") + once.cast("int")).alias("copies"),
    )
    return taken, docs, key


def _place() -> Column:
    return F.struct("draw", "size", "row")


def _in_spans() -> Column:
    def holds(span: Column) -> Column:
        between = (_place() > span["low"]) & (_place() < span["high"])
        return between & F.col("size").between(F.lit(1), span["room"])

    return F.exists("spans", holds)


def _fill(
    rows: DataFrame, rooms: Mapping[Hashable, int], targets: Mapping[Hashable, float]
) -> tuple[dict[Hashable, list], dict[Hashable, int]]:
    """Take what fits in the order of each source: the spans taken and the room left, by source.

    A round goes on from the row at which the last one stopped, among the rows that fit the room left then,
    and stops at the first one that no longer does. The driver gets one row per source and round.
    """
    rooms, spans = dict(rooms), {s: [] for s in rooms}
    begin = {s: START for s in rooms}
    while begin := {s: low for s, low in begin.items() if rooms[s] * NEAR > targets[s]}:
        state = rows.sparkSession.createDataFrame(
            [(s, rooms[s], low) for s, low in begin.items()], f"of string, room long, low {PLACE}"
        )
        open_ = rows.join(F.broadcast(state), F.col("source").eqNullSafe(F.col("of")))
        open_ = open_.where(F.col("size").between(F.lit(1), F.col("room")) & (_place() > F.col("low")))
        before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        ahead = (
            open_.groupBy("source", "slice", "room").agg(F.sum("size").alias("words"))
            .withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0)))
        )
        # One row per source: the slice in which the room ends, or the last one.
        reached = ahead.where(F.col("ahead") <= F.col("room")).groupBy(F.col("source").alias("of_end"))
        reached = reached.agg(F.max_by(F.struct("slice", "ahead"), "slice").alias("end"))
        order = Window.partitionBy("source").orderBy("draw", "size", "row")
        ranked = open_.join(
            F.broadcast(reached), F.col("source").eqNullSafe(F.col("of_end")) & (F.col("slice") == F.col("end.slice"))
        ).withColumn("upto", F.col("end.ahead") + F.sum("size").over(order))
        stops = F.col("upto") > F.col("room")
        found = ranked.groupBy("source").agg(
            F.min(F.when(stops, _place())).alias("high"),
            F.coalesce(F.min(F.when(stops, F.col("upto") - F.col("size"))), F.max("upto")).alias("used"),
        )
        stopped = {}
        for r in found.collect():
            high = tuple(r.high) if r.high else END
            spans[r.source].append((begin[r.source], high, rooms[r.source]))
            rooms[r.source] -= r.used
            if r.high:
                stopped[r.source] = high
        begin = stopped
    return spans, rooms


def _nearest(rows: DataFrame, rooms: Mapping[Hashable, int], spans: Mapping[Hashable, list]) -> dict:
    """The smallest row left out of each source whose room it fills better than nothing does."""
    state = [(s, room, spans[s]) for s, room in rooms.items() if room]
    plan = rows.sparkSession.createDataFrame(state, f"of string, room long, spans {SPANS}")
    out = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of")))
    out = out.where(~_in_spans() & (F.col("size") > 0) & (F.col("size") < 2 * F.col("room")))
    least = out.groupBy("source").agg(F.min_by(_place(), F.struct("size", "draw", "row")).alias("place"))
    return {r.source: tuple(r.place) for r in least.collect()}


def repeated(docs: DataFrame, space: Scratch, **named) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as they came."""
    taken, keyed_docs, key = mix(docs, space, **named)
    copies = taken.where("copies > 0").select(F.col("row").alias(key), "copies")
    copies = space.write(copies, "copies")
    columns = [keyed_docs[f"`{c}`"] for c in docs.columns]
    joined = keyed_docs.join(copies if copies.count() > 500_000 else F.broadcast(copies), key)
    each = F.explode(F.sequence(F.lit(1), copies["copies"])).alias(fresh(docs.columns, "copy"))
    return joined.select(*columns, each).select(
        *[f"`{c}`" for c in docs.columns]
    )
