"""SimHash near-dedup: bit planes, carry-save counters, components of linked fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import keyed, ordered, plus, small, text_of, without
from waybill.llm.components import components
from waybill.sources.scratch import Scratch

SEED = 42
SHINGLE = 3
RADIUS = 3
#: Fingerprints of a bucket that one task compares with as many others.
BUCKET = 2048
#: Bytes of text and lanes of fingerprints handled at a time.
BLOCK = 1 << 20
LANES = 1 << 16

_ONE = np.uint64(1)


def word_blocks(text: bytes, shingle: int = SHINGLE) -> Iterator[list[bytes]]:
    """The words of a text in blocks; each block but the first repeats the last ones before it."""
    carried: list[bytes] = []
    start = 0
    while start < len(text):
        end = min(len(text), start + BLOCK)
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        words = carried + text[start:end].split()
        yield words
        carried = words[-(shingle - 1) :]
        start = end


def fingerprint(text: str) -> int:
    """Bits set in over half the hashes of the text's shingles; zero for a text without words."""
    ones, count = np.zeros(64, np.int64), 0
    words: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(text.encode().lower()):
        if len(words) < SHINGLE:
            continue
        lens = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lens + 1) - 1
        starts = (ends - lens)[: len(words) - SHINGLE + 1].tolist()
        joined = b" ".join(words)
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        count += len(hashes)
    if not count:
        return digest(b" ".join(words), SEED) if words else 0
    over = np.flatnonzero(2 * ones > count)
    return sum(1 << int(b) for b in over)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """(id, row, fp) of each document; the fingerprint as a signed long."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(key).alias("row"), text_of(text_col).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column(2)]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(fps)], names=["id", "row", "fp"]
            )

    return rows.mapInArrow(run, plus(rows.drop("text"), fp="long"))


def _planes(fps: np.ndarray) -> np.ndarray:
    """Bit i of word w in plane b is bit b of fingerprint 64 w + i; two empty words at the end."""
    lanes = -(-len(fps) // 64) * 64
    bits = np.zeros((lanes + 128, 64), np.uint8)
    bits[: len(fps)] = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def _near(planes: np.ndarray, words: np.ndarray, alive: np.ndarray, d: int, radius: int) -> np.ndarray:
    """Of the lanes alive, those within the radius of the fingerprint d places on.

    A lane's counter starts so high that it overflows at radius + 1. Words whose lanes have all
    overflowed are left out, and the rest of the planes once none is left.
    """
    q, r = divmod(d, 64)
    size = (radius + 1).bit_length() if radius & (radius + 1) else radius.bit_length()
    begin = (1 << size) - (radius + 1)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(len(words), full if begin >> k & 1 else 0, np.uint64) for k in range(size)]
    left, out = np.arange(len(words)), np.zeros(len(words), np.uint64)
    for b in range(64):
        plane = planes[b]
        if r:
            other = (plane[words + q] >> np.uint64(r)) | (plane[words + q + 1] << np.uint64(64 - r))
        else:
            other = plane[words + q]
        carry = plane[words] ^ other
        for k in range(size):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        alive = alive & ~carry
        if b % 8 == 7:
            some = np.flatnonzero(alive)
            if not len(some):
                return out
            if 2 * len(some) < len(alive):
                words, alive, left = words[some], alive[some], left[some]
                counters = [c[some] for c in counters]
    out[left] = alive
    return out


def forest(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each place, the first place of its group that links within the radius lead to.

    Places of a group adjoin. All of them are compared with the ones d places on, for
    d = 1, 2, ...; pairs that are joined already are left out.
    """
    n = len(fps)
    planes = _planes(fps)
    change = np.flatnonzero(np.diff(group)) + 1
    ends = np.concatenate([change, [n]])
    end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    label, at = np.arange(n), np.arange(n)
    for d in range(1, n):
        at = at[at + d < end[at]]
        if not len(at):
            break
        open_ = at[label[at] != label[at + d]]
        if not len(open_):
            continue
        words, where = np.unique(open_ >> 6, return_inverse=True)
        alive = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(alive, where, _ONE << (open_ & 63).astype(np.uint64))
        found = _near(planes, words, alive, d, radius)
        lanes = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        w, bit = np.nonzero(lanes)
        if not len(w):
            continue
        for i in (words[w] * 64 + bit).tolist():
            a, b = int(label[i]), int(label[i + d])
            while label[a] != a:
                a = int(label[a])
            while label[b] != b:
                b = int(label[b])
            label[max(a, b)] = min(a, b)
        while not np.array_equal(up := label[label], label):
            label = up
    return label


def _bucketed(fps: DataFrame, radius: int, bucket: int, space: Scratch) -> DataFrame:
    """(table, part, half_a, half_b, fp): fingerprints within the radius share a bucket.

    64 bits in radius + 2 blocks: two fingerprints that differ in at most radius bits agree in two whole
    blocks, so each pair of blocks is a table of buckets. A bucket over the size is dealt into parts by
    a hash, and every two parts meet; nothing is left out.
    """
    edge = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    block = [((1 << edge[i + 1]) - (1 << edge[i])) for i in range(radius + 2)]
    masks = [a | b for a, b in combinations(block, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    spread = F.array(
        *[
            F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
            for t, m in enumerate(signed)
        ]
    )
    rows = fps.select("fp", F.inline(spread))
    large = space.write(
        rows.groupBy("table", "part").agg(F.count("*").alias("n")).where(F.col("n") > bucket),
        "large",
    )
    rows = rows.join(small(large), ["table", "part"], "left")
    parts = F.coalesce(F.ceil(F.col("n") / bucket), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    rows = rows.select("table", "part", "fp", own.alias("own"), parts.alias("parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.select("table", "part", "fp", "own", other.alias("other"))
    return rows.select(
        "table", "part", F.least("own", "other").alias("half_a"), F.greatest("own", "other").alias("half_b"), "fp"
    )


def links(fps: DataFrame, space: Scratch, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (fp) that links within the radius connect."""
    key = ["table", "part", "half_a", "half_b"]
    rows = _bucketed(fps, radius, bucket, space).select(F.xxhash64(*key).alias("bucket"), *key, "fp")
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", *key, "fp")
    return dealt.select("bucket", "fp").mapInArrow(lambda it: _edges(it, radius), "a long, b long")


def _edges(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Buckets in blocks of about LANES rows, never cut."""

    def flush(group: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        label = forest(group, fps.view(np.uint64), radius)
        joined = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[joined]), pa.array(fps[label[joined]])], names=["a", "b"]
        )

    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        rows += batch.num_rows
        if rows >= LANES:
            group, fps = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield flush(group[:cut], fps[:cut])
            held, rows = [(group[cut:], fps[cut:])], len(group) - cut
    if rows:
        yield flush(*(np.concatenate(x) for x in zip(*held)))


def classify(
    docs: DataFrame,
    space: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> tuple[DataFrame, DataFrame, str]:
    """Near-copies: (one row per document, the documents with a row key, its name).

    The rows have id, row, fp, component_id (the smallest id that links can reach, nulls last) and
    kept (that id's row; one row if the id repeats). Links are between fingerprints that differ in at most
    radius bits. Equal fingerprints are one node, so copies cost nothing. Null texts count as empty and
    have fingerprint zero. An empty table gives no rows; other columns of docs are not read.
    """
    docs, key = keyed(docs, id_col, space)
    prints = space.write(fingerprints(docs, id_col, text_col, key), "fingerprints")
    order = ordered(F.col("id"), F.col("row"))
    nodes = space.write(prints.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    edges = space.write(links(nodes.select("fp"), space, radius, bucket), "links")
    roots = components(edges, space)
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    nodes = space.write(nodes.withColumn("root", F.coalesce("root", "fp")), "roots")
    # Stored, so that the nodes of a large component can be split in the join.
    least = space.write(nodes.groupBy("root").agg(F.min("first").alias("first")), "least")
    nodes = space.write(nodes.drop("first").join(least, "root").select("fp", "first"), "classes")
    rows = prints.join(nodes, "fp").select(
        "id",
        "row",
        "fp",
        F.col("first.id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("kept"),
    )
    return rows, docs, key


def one_of_each(
    docs: DataFrame, space: Scratch, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component, columns as they came; see classify for which."""
    rows, keyed_docs, key = classify(docs, space, id_col, text_col)
    dropped = space.write(rows.where("not kept").select("row"), "dropped")
    return without(keyed_docs, key, dropped).select(*[f"`{c}`" for c in docs.columns])
