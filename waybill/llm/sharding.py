"""Sharding by fixed virtual slots and a versioned map of slots to shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.common import keyed, small, text_of
from waybill.sources.scratch import Scratch

#: Slots never change in number; a heavy one is taken apart into grains, by another hash of the text.
SLOTS, GRAINS = 4096, 64
#: Parts, per share of a shard, of a text that is too heavy to stay whole.
PARTS = 16
#: Shards may differ by so much of the mean before groups are split further, down to this part of a share.
SPREAD, FINEST = 0.01, 64
#: Rows that one task ranks.
RANKED = 200_000

MAP = "version int, slot int, grain int, shard int, bytes long"

Unit = tuple[int, int]  # slot and grain; grain -1 is the whole slot, one from GRAINS on a part of heavy texts


def hashed(docs: DataFrame, space: Scratch, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, str]:
    """(one row per document, documents with a key, its name). Slot and grain come from the text."""
    docs, key = keyed(docs, id_col, space)
    text = text_of(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(key).alias("row"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("cell_text"),
        F.pmod(F.xxhash64(F.lit("grain"), text), F.lit(GRAINS)).cast("int").alias("cell_grain"),
    )
    slot = F.pmod("cell_text", F.lit(SLOTS)).cast("int")
    return space.write(rows.withColumn("cell_slot", slot), "rows"), docs, key


def _sums(rows: DataFrame, space: Scratch) -> DataFrame:
    sums = rows.groupBy("cell_slot", "cell_grain").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    return space.write(sums, "cells")


def units(
    rows: DataFrame, sums: DataFrame, space: Scratch, bound: float
) -> tuple[dict[Unit, int], DataFrame, DataFrame]:
    """(bytes of what a map assigns, rows and sums in these cells): slots, grains of slots above the bound, parts of texts above it.

    Equal texts stay in one unit unless they exceed the bound by themselves. At most SLOTS rows, GRAINS for
    each of the few heavy slots and the few heavy texts reach the driver.
    """
    by_slot = {r.cell_slot: r.b for r in sums.groupBy("cell_slot").agg(F.sum("bytes").alias("b")).collect()}
    heavy = [s for s, b in by_slot.items() if b > bound]
    if heavy:
        grains = sums.where(F.col("cell_slot").isin(heavy) & (F.col("bytes") > bound)).collect()
        inside = F.struct("cell_slot", "cell_grain").isin(
            [F.struct(F.lit(r.cell_slot), F.lit(r.cell_grain)) for r in grains]
        )
        texts = rows.where(inside if grains else F.lit(False)).groupBy("cell_text").agg(F.sum("size").alias("b"))
        hot = {r.cell_text: -int(-PARTS * r.b // bound) for r in texts.where(F.col("b") > bound).collect()}
        if hot:
            parts = F.lit(0)
            for text, n in hot.items():
                parts = F.when(F.col("cell_text") == text, n).otherwise(parts)
            part = GRAINS + F.pmod(F.xxhash64(F.lit("part"), F.col("row")), parts)
            cell = F.when(F.col("cell_text").isin(list(hot)), part.cast("int")).otherwise(F.col("cell_grain"))
            rows = rows.withColumn("cell_grain", cell)
            sums = _sums(rows, space)
    out: dict[Unit, int] = {(s, -1): b for s, b in by_slot.items() if b <= bound}
    for r in sums.where(F.col("cell_slot").isin(heavy)).collect() if heavy else []:
        out[r.cell_slot, r.cell_grain] = r.bytes
    return out, rows, sums


def assign(sizes: dict[Unit, int], shards: int) -> dict[Unit, int]:
    """A first map: units by falling size, each to the shard that has least so far."""
    loads = [0] * shards
    out = {}
    for unit, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        out[unit] = min(range(shards), key=lambda s: (loads[s], s))
        loads[out[unit]] += size
    return out


def rebalance(old: dict[Unit, int], sizes: dict[Unit, int], shards: int) -> dict[Unit, int]:
    """The map edited for new sizes or more shards; units move only from shards above the mean.

    With more shards than before only the new ones take units. A unit that the old map has not seen stays
    where its slot was, or else goes to the shard with least.
    """
    before = max(old.values(), default=-1) + 1
    loads = [0] * shards
    out: dict[Unit, int] = {}
    falling = sorted(sizes.items(), key=lambda x: (-x[1], x[0]))
    for unit, size in falling:
        least = min(range(shards), key=lambda s: (loads[s], s))
        out[unit] = old.get(unit, old.get((unit[0], -1), least))
        loads[out[unit]] += size
    mean = sum(loads) / shards
    takers = range(before, shards) if before < shards else range(shards)
    for unit, size in falling:
        giver, taker = out[unit], min(takers, key=lambda s: (loads[s], s))
        if giver == taker or (before < shards and giver >= before):
            continue
        away = abs(loads[giver] - mean) + abs(loads[taker] - mean)
        if abs(loads[giver] - size - mean) + abs(loads[taker] + size - mean) < away:
            out[unit] = taker
            loads[giver] -= size
            loads[taker] += size
    return out


def store_map(spark: SparkSession, path: str, assigned: dict[Unit, int], sizes: dict[Unit, int]) -> int:
    """Append a version of the map; the number it gets."""
    spark.createDataFrame([], MAP).write.mode("ignore").parquet(path)
    last = spark.read.schema(MAP).parquet(path).agg(F.max("version")).first()[0]
    version = 1 if last is None else last + 1
    rows = [(version, slot, grain, shard, sizes[slot, grain]) for (slot, grain), shard in assigned.items()]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)
    return version


def read_map(spark: SparkSession, path: str, version: int | None = None) -> dict[Unit, int]:
    """A version of the map, the last one unless told otherwise."""
    stored = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return {(r.slot, r.grain): r.shard for r in stored.where(F.col("version") == version).collect()}


def shard(
    docs: DataFrame,
    space: Scratch,
    map_path: str,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame, str]:
    """Each document's shard: (one row per document, the documents with a row key, its name).

    The rows have id, row, size (UTF-8 bytes and one; null counts as empty), text_crc32, shard, position
    (from 0 without gaps within the shard), cell_slot, map_version. The bytes of the slots are
    summed and the slots packed so that shards have nearly equal bytes; a map that is stored at the
    path is edited, and each call that changes it adds a version. Equal texts stay in one shard as long as they fit: a
    slot above a shard's share is taken apart by another hash of the text, and only a text that
    exceeds the share by itself by row. Where shards still differ by more than SPREAD of the mean and a row, texts above
    half a share are split too, and so on. Rows that repeat an id are rows of their own. An empty table gives no rows
    and an empty version.

    Positions come from counts of cells, each of at most about RANKED rows, and a rank within each, so
    no task ranks a whole shard or a hot text.
    """
    spark = docs.sparkSession
    plain, docs, key = hashed(docs, space, id_col, text_col)
    counted = _sums(plain, space)
    largest, total = plain.agg(F.max("size"), F.sum("size")).first()
    spark.createDataFrame([], MAP).write.mode("ignore").parquet(map_path)
    old = read_map(spark, map_path)
    cut = 1
    while True:
        sizes, rows, sums = units(plain, counted, space, (total or 0) / (shards * cut))
        assigned = rebalance(old, sizes, shards) if old else assign(sizes, shards)
        loads = [0] * shards
        for unit, to in assigned.items():
            loads[to] += sizes[unit]
        # A map that is edited moves little, so its shards differ more; it is not split for that.
        if old or cut == FINEST or max(loads) - min(loads) <= max(SPREAD * sum(loads) / shards, largest or 0):
            break
        cut *= 2
    version = store_map(spark, map_path, assigned, sizes)
    table = spark.read.schema(MAP).parquet(map_path).where(F.col("version") == version)
    table = F.broadcast(table.select(F.col("slot").alias("cell_slot"), "grain", "shard"))
    tasks = F.ceil(F.col("n") / RANKED).cast("int").alias("tasks")
    in_map = sums.join(table, "cell_slot").where("grain in (-1, cell_grain)")
    in_map = small(space.write(in_map.select("cell_slot", "cell_grain", "shard", tasks), "map"))
    rows = rows.drop("cell_text").join(in_map, ["cell_slot", "cell_grain"])
    rows = rows.withColumn("cell_task", F.pmod(F.xxhash64(F.lit("task"), F.col("row")), F.col("tasks")))
    cell = ["cell_slot", "cell_grain", "cell_task"]
    before = Window.partitionBy("shard").orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", *cell).agg(F.count("*").alias("n"))
    starts = starts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    starts = small(space.write(starts.select(*cell, "start"), "starts"))
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("row"))
    placed = rows.withColumn("rank", rank).join(starts, cell)
    placed = placed.select(
        "id", "row", "size", "text_crc32", "shard",
        (F.col("start") + F.col("rank") - 1).alias("position"),
        "cell_slot", F.lit(version).alias("map_version"),
    )
    return placed, docs, key


def write_shards(placed: DataFrame, docs: DataFrame, key: str, path: str) -> None:
    """The documents as Parquet, a folder per shard; placed, docs and key are what shard gives."""
    where = placed.select(F.col("row").alias(key), "shard", "position")
    docs.join(where, key).drop(key).write.partitionBy("shard").parquet(path)
