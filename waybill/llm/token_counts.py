"""Token counts through a cache of content digests; only distinct misses are encoded."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import small, text_of
from waybill.sources.scratch import Scratch

#: Tokenizer files are broadcast; larger ones are refused.
MAX_MODEL_BYTES = 64 << 20
#: Characters from which a text is encoded in parts, to bound the memory of the encoder.
LONG = 1 << 20

CACHE = "content_digest string, n_tokens long, tokenizer_digest string"
_CUT = re.compile("[A-Za-z0-9] (?=[A-Za-z0-9])")


@cache
def processor(model: bytes) -> tuple[sentencepiece.SentencePieceProcessor, bool]:
    """The encoder, and whether a text may be cut at a space between ASCII letters or digits.

    It may if the encoder puts a space before each text and no piece has a space behind another letter.
    """
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    space = "▁"
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    apart = not any(space in p.lstrip(space) for p in pieces)
    alike = sp.encode("a b") == sp.encode("a") + sp.encode("b")
    return sp, apart and alike


def text_parts(text: str, size: int) -> Iterator[str]:
    """The text cut at single spaces, which are left out, into parts of about that size."""
    start = 0
    while len(text) - start > size and (m := _CUT.search(text, start + size)):
        yield text[start : m.end() - 1]
        start = m.end()
    yield text[start:]


def count_tokens(model: bytes, text: str, long: int = LONG) -> int:
    """Number of tokens as the library gives them, without begin or end tokens."""
    sp, may_cut = processor(model)
    if may_cut and len(text) > long:
        return sum(len(sp.encode(part)) for part in text_parts(text, long))
    return len(sp.encode(text))


def digest_of(text_col: str) -> Column:
    """Digest of the content: the text as it is, null as empty. Nothing that could change a count is undone."""
    return F.sha2(text_of(text_col), 256)


def tokenizer_digest(model: bytes) -> str:
    """The version of a tokenizer: a digest of its file."""
    return hashlib.sha256(model).hexdigest()


def read_model(path: str) -> bytes:
    """A tokenizer file on the driver, which sends it to the executors."""
    data = Path(path).read_bytes()
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
    return data


def cached_counts(spark, cache_path: str, version: str) -> DataFrame:
    """(content_digest, n_tokens) that the cache holds for a tokenizer, one row per digest."""
    empty = spark.createDataFrame([], CACHE)
    empty.write.mode("ignore").partitionBy("tokenizer_digest").parquet(cache_path)
    stored = spark.read.schema(CACHE).parquet(cache_path)
    stored = stored.where(F.col("tokenizer_digest") == version)
    # Two writers at a time may both have stored a digest.
    return stored.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def count(
    docs: DataFrame,
    model: bytes,
    cache_path: str,
    space: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, content_digest, n_bytes, n_tokens) of each row; missing counts are appended to the cache.

    Null texts count as empty and have no tokens. Equal texts are encoded once, however many rows have them:
    they meet by digest, on the map side first. An empty table changes nothing. A run that broke off can
    be repeated: what it stored is not encoded again. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(model)
    shared = spark.sparkContext.broadcast(model)
    digest, text = digest_of(text_col), text_of(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        digest.alias("content_digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    rows = space.write(rows, "digests")
    stored = cached_counts(spark, cache_path, version)
    texts = docs.select(digest.alias("content_digest"), text.alias("text"))
    if not stored.isEmpty():
        missing = rows.select("content_digest").distinct().join(stored, "content_digest", "left_anti")
        missing = space.write(missing, "missing")
        texts = texts.join(small(missing), "content_digest", "left_semi")
    misses = texts.groupBy("content_digest").agg(F.any_value("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [count_tokens(shared.value, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["content_digest", "n_tokens"]
            )

    found = misses.mapInArrow(encode, "content_digest string, n_tokens long")
    found = found.withColumn("tokenizer_digest", F.lit(version))
    found.write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path)
    # One stored row per digest, so that the rows of a frequent text can be split in the last join.
    counts = rows.select("content_digest").distinct()
    counts = counts.join(cached_counts(spark, cache_path, version), "content_digest")
    counts = space.write(counts, "counts")
    return rows.join(counts, "content_digest").select("id", "content_digest", "n_bytes", "n_tokens")
