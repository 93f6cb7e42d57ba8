"""Exact dedup by composable polynomial fingerprints, confirmed by comparing chunks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import WHITESPACE, bytes_of, keyed, ordered, plus, small, text_of, without
from waybill.sources.scratch import Scratch

#: A Mersenne prime: a byte times a residue stays below 2^40, so a chunk's sum fits 64 bits.
PRIME = (1 << 31) - 1
#: One independent residue for each.
BASES = (1_103_515_245, 692_360_451, 1_566_083_941, 1_812_433_253)
#: Bytes hashed and compared at a time.
CHUNK = 1 << 16
#: Bytes that are in a task's hands at a time, besides the batch itself.
SLICE = 1 << 20

FINGERPRINT = ["fp_a", "fp_b", "n_bytes"]


def normalised(text_col: str) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(text_of(text_col), WHITESPACE, " ")


@cache
def _powers(base: int, size: int) -> np.ndarray:
    """base^0 ... base^(size-1) modulo PRIME, by doubling."""
    powers = np.ones(1, np.uint64)
    while len(powers) < size:
        step = np.uint64(pow(base, len(powers), PRIME))
        powers = np.concatenate([powers, powers * step % np.uint64(PRIME)])
    return powers[:size]


def combine(left: list[int], right: list[int], right_bytes: int) -> list[int]:
    """Residues of two adjoining parts as those of the whole: the left is shifted by a length."""
    return [
        (a * pow(base, right_bytes, PRIME) + b) % PRIME
        for a, b, base in zip(left, right, BASES, strict=True)
    ]


def hash_chunks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int) -> np.ndarray:
    """Residues (one row per base) of parts that adjoin each other, none longer than a chunk."""
    out = np.zeros((len(BASES), len(starts)), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SLICE)))
        lens = ends[first:last] - starts[first:last]
        full = np.flatnonzero(lens)
        if len(full):
            values = data[starts[first] : ends[last - 1]].astype(np.uint64) + np.uint64(1)
            rest = np.repeat(ends[first:last], lens) - np.arange(starts[first], ends[last - 1]) - 1
            at = (starts[first:last] - starts[first])[full]
            for k, base in enumerate(BASES):
                sums = np.add.reduceat(values * _powers(base, chunk)[rest], at)
                out[k, first + full] = sums % np.uint64(PRIME)
        first = last
    return out


def _fingerprint(batch: pa.RecordBatch, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Residues and length of each text in the batch's last column."""
    offsets, data = bytes_of(batch.column(batch.num_columns - 1))
    lens = np.diff(offsets)
    count = np.maximum(1, -(-lens // chunk))
    first = np.cumsum(count) - count
    number = np.arange(count.sum()) - np.repeat(first, count)
    starts = np.repeat(offsets[:-1], count) + number * chunk
    ends = np.minimum(starts + chunk, np.repeat(offsets[1:], count))
    parts = hash_chunks(data, starts, ends, chunk)
    whole = parts[:, first]
    for i in np.flatnonzero(count > 1):
        total = [int(x) for x in whole[:, i]]
        for j in range(first[i] + 1, first[i] + count[i]):
            total = combine(total, [int(x) for x in parts[:, j]], int(ends[j] - starts[j]))
        whole[:, i] = total
    return whole, lens


def fingerprints(rows: DataFrame, chunk: int = CHUNK, bits: int = 124) -> DataFrame:
    """All columns but the last, which holds texts, and fp_a, fp_b, n_bytes of each text.

    Chunks of a text are hashed apart and joined by their lengths, so memory does not follow the
    longest text. bits below 124 keeps fewer bits, to make collisions in tests.
    """
    kept = rows.columns[:-1]
    keep_a = (1 << min(62, bits)) - 1
    keep_b = (1 << max(0, bits - 62)) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, lens = _fingerprint(batch, chunk)
            shift = np.uint64(31)
            pairs = [(whole[i] << shift) | whole[i + 1] for i in (0, 2)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array((pairs[0] & np.uint64(keep_a)).astype(np.int64)),
                    pa.array((pairs[1] & np.uint64(keep_b)).astype(np.int64)),
                    pa.array(lens.astype(np.int64)),
                ],
                names=[*kept, *FINGERPRINT],
            )

    schema = plus(rows.drop(rows.columns[-1]), **dict.fromkeys(FINGERPRINT, "long"))
    return rows.mapInArrow(run, schema)


def _chunk_rows(text: Column, chunk: int) -> Column:
    """(number, bytes) of each chunk of the text; one empty chunk for an empty text."""
    data = text.cast("binary")
    last = F.greatest(F.lit(0), F.floor((F.octet_length(data) - 1) / chunk).cast("int"))
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("chunk_no"), F.substring(data, i * chunk + 1, F.lit(chunk)).alias("piece")
        ),
    )


def classify(
    docs: DataFrame,
    space: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    extra: dict[str, Column] | None = None,
    chunk: int = CHUNK,
    bits: int = 124,
) -> tuple[DataFrame, DataFrame, str]:
    """Classes of equal texts: (one row per document, the documents with a row key, its name).

    The rows have id, row, the extra columns, n_bytes, keep_id, group_size, kept. Texts are equal
    when identical after white space is normalised; null counts as empty, and all empty texts
    are one class. The smallest id of a class stays (nulls last); of rows that repeat that id one
    stays. An empty table gives no rows. Columns of other names in docs are not read.

    Only rows whose fingerprint occurs twice are compared. Their chunks meet by (fingerprint, number,
    bytes), equal ones already on the map side, so a class with a third of all rows sends
    one copy per task. Where a chunk differs the class is split by whole texts.
    """
    docs, key = keyed(docs, id_col, space)
    text = normalised(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(key).alias("row"),
        *[c.alias(name) for name, c in (extra or {}).items()],
        text.alias("norm"),
    )
    prints = space.write(fingerprints(rows, chunk, bits), "fingerprints")
    order = ordered(F.col("id"), F.col("row"))
    groups = space.write(
        prints.groupBy(*FINGERPRINT).agg(
            F.count("*").alias("group_size"), F.min(order).alias("keep")
        ),
        "groups",
    )
    copies = prints.join(groups.where("group_size > 1").select(*FINGERPRINT), FINGERPRINT)
    copies = space.write(copies.select("row", *FINGERPRINT), "copies")
    texts = docs.select(F.col(key).alias("row"), text.alias("norm")).join(small(copies), "row")
    differing = space.write(
        texts.select(*FINGERPRINT, F.inline(_chunk_rows(F.col("norm"), chunk)))
        .groupBy(*FINGERPRINT, "chunk_no", "piece")
        .agg(F.count("*").alias("n"))
        .groupBy(*FINGERPRINT, "chunk_no")
        .agg(F.count("*").alias("variants"))
        .where("variants > 1")
        .select(*FINGERPRINT)
        .distinct(),
        "differing",
    )
    found = prints.join(groups, FINGERPRINT)
    if not differing.isEmpty():
        split = (
            texts.join(small(differing), FINGERPRINT)
            .join(prints.select("row", "id"), "row")
            .select(*FINGERPRINT, "norm", "id", "row")
        )
        whole = split.groupBy(*FINGERPRINT, "norm").agg(
            F.count("*").alias("group_size"), F.min(order).alias("keep")
        )
        again = split.join(whole, [*FINGERPRINT, "norm"]).select("row", "group_size", "keep")
        again = space.write(again, "split")
        found = (
            found.drop("group_size", "keep").join(again, "row").unionByName(
                found.join(small(differing), FINGERPRINT, "left_anti"), allowMissingColumns=False
            )
        )
    classes = found.select(
        "id",
        "row",
        *(extra or {}),
        "n_bytes",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
    )
    return classes, docs, key


def distinct_texts(
    docs: DataFrame, space: Scratch, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without copies, columns as they came; see classify for which copy stays."""
    classes, rows, key = classify(docs, space, id_col, text_col)
    dropped = space.write(classes.where("not kept").select("row"), "dropped")
    return without(rows, key, dropped).select(*[f"`{c}`" for c in docs.columns])
