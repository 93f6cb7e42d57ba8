"""Ordered work within groups of any size.

A window over a key sorts all rows of the key in one task, which no key with a large part of the
table survives. Here the rows are range-partitioned by key and order and written out with the number
of their slice, and windows run per key and slice. As slices are ranges, only the key at a border can go on in
another slice: one row per slice carries what the next one has to know, however many keys there
are. Nothing depends on how large a key is, and the slices never decide what the result is.
Ranks are cheaper where keys are small: only the rows of large keys are sliced for them, once per order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.sources.scratch import Scratch, staged

#: Rows above which a key is cut into slices to be ranked; up to there one task sorts it.
LARGE = 100_000

_KEY, _SLICE = "__key", "__slice"
_FIRST, _LAST, _OFFSET, _EDGE, _NEAR = "__first", "__last", "__offset", "__edge", "__near"


def _sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], space: Scratch | None
) -> DataFrame:
    """Rows with the number of their slice, which rises with the order within a key.

    Written out, so that every later step sees the same slices whatever happens to executors. The
    keys are packed in a struct, which joins and groups null keys like any other.
    """
    ranged = df.repartitionByRange(*keys, *order)
    return staged(
        ranged.withColumns({_KEY: F.struct(*keys), _SLICE: F.spark_partition_id()}), "slices", space
    )


def _ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, space: Scratch | None
) -> DataFrame:
    sliced = _sliced(df, keys, order, space)
    ends = sliced.groupBy(_SLICE).agg(F.min(_KEY).alias(_FIRST), F.max(_KEY).alias(_LAST))
    ends = staged(ends, "ends", space)
    lasts = sliced.join(F.broadcast(ends), _SLICE).where(F.col(_KEY).eqNullSafe(F.col(_LAST)))
    ends = ends.join(lasts.groupBy(_SLICE).agg(F.count("*").alias("__rows")), _SLICE)
    # Rows of the last key up to here; a key's slices follow each other.
    so_far = F.sum("__rows").over(Window.partitionBy(_LAST).orderBy(_SLICE))
    ends = ends.withColumn("__so_far", so_far)
    along = Window.orderBy(_SLICE)  # a row per slice, whatever the number of rows
    goes_on = F.lag(_LAST).over(along).eqNullSafe(F.col(_FIRST))
    offset = F.when(goes_on, F.lag("__so_far").over(along)).otherwise(0)
    offsets = staged(ends.select(_SLICE, _FIRST, offset.alias(_OFFSET)), "offsets", space)
    within = Window.partitionBy(_KEY, _SLICE).orderBy(*order)
    before = F.when(F.col(_KEY).eqNullSafe(F.col(_FIRST)), F.col(_OFFSET)).otherwise(0)
    return (
        sliced.withColumn(name, F.row_number().over(within))
        .join(F.broadcast(offsets), _SLICE)
        .withColumn(name, F.col(name) + before)
        .drop(_KEY, _SLICE, _FIRST, _OFFSET)
    )


def with_ranks(
    df: DataFrame,
    keys: Sequence[str],
    orders: dict[str, Sequence[str]],
    space: Scratch | None = None,
) -> DataFrame:
    """Row numbers per key for each named order, ascending; an order must tell all rows apart.

    The rows are read once to count them per key and once to rank them: those of keys up to LARGE meet by key, in
    one shuffle for all orders. The others are sliced, once per order.
    """
    columns = df.columns
    sizes = df.groupBy(F.struct(*keys).alias(_KEY)).agg(F.count("*").alias("__rows"))
    large = staged(sizes.where(F.col("__rows") > LARGE).select(_KEY), "large", space)
    rows = df.withColumn(_KEY, F.struct(*keys))
    # At most one row in LARGE of the input.
    small = rows.join(F.broadcast(large), _KEY, "left_anti")
    sliced = rows.join(F.broadcast(large), _KEY, "left_semi").drop(_KEY)
    for name, order in orders.items():
        rank = F.row_number().over(Window.partitionBy(_KEY).orderBy(*order))
        small = small.withColumn(name, rank.cast("long"))
        sliced = _ranked(sliced, keys, order, name, space)
    return small.select(*columns, *orders).unionByName(sliced.select(*columns, *orders))


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Sequence[str],
    which: str,
    thin: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    space: Scratch | None = None,
) -> DataFrame:
    """Add columns of the previous or next row of the same key, and whether there is one.

    `which` is 'prev' or 'next'; `order` is ascending and must tell all rows apart. `thin` brings
    that about where the input has copies: it folds rows that agree in keys and order.
    """
    step = F.lead if which == "next" else F.lag
    picked = F.struct(*take)
    thinned = thin(df)
    columns = thinned.columns
    sliced = _sliced(thinned, keys, order, space)
    # The row of a slice that the adjacent slice has to see: its first one when looking forward,
    # its last one when looking back. It counts only for the same key.
    outermost = F.min_by if which == "next" else F.max_by
    row = F.struct(F.col(_KEY).alias("key"), picked.alias("row"))
    edges = sliced.groupBy(_SLICE).agg(outermost(row, F.struct(_KEY, *order)).alias(_EDGE))
    along = Window.orderBy(_SLICE)  # a row per slice, whatever the number of rows
    across = staged(edges.select(_SLICE, step(_EDGE).over(along).alias(_EDGE)), "edges", space)
    within = Window.partitionBy(_KEY, _SLICE).orderBy(*order)
    joined = sliced.withColumn(_NEAR, step(picked).over(within)).join(F.broadcast(across), _SLICE)
    over = F.when(F.col(f"{_EDGE}.key").eqNullSafe(F.col(_KEY)), F.col(f"{_EDGE}.row"))
    near: Column = F.coalesce(_NEAR, over)
    named = [near[c].alias(f"{which}_{c}") for c in take]
    return joined.select(*columns, *named, near.isNotNull().alias(f"has_{which}"))
