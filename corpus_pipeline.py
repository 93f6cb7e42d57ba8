"""From raw documents to token ids: filter, dedup, near-dedup, mix, encode.

Each stage works on all that the one before kept. Between stages the documents are written to the
shared folder and read again, so a lost executor costs a read and no recomputation.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import byte_bpe, exact_dedup, mixing, quality, simhash, token_counts
from waybill.llm.common import fresh, importable, session_space
from waybill.llm.queries import quality_model
from waybill.session import configure

#: SQL cannot fit a classifier or encode bytes by merges.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least quality.THRESHOLD; all of them where no labels teach a model.

    A null text scores as an empty one; repeated rows score alike and stay or go together. Whole texts
    are scored, however long. Other columns, whatever their names, come through.
    """
    importable(configure(spark))
    model = quality_model(spark, docs, sf_dir)
    if model is None:
        return docs
    scored, score = quality.score(docs, model)
    return scored.where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts, the one with the smallest id (nulls last).

    Null and empty texts are one class. Of rows that repeat id and text one stays. Long texts are compared by chunks.
    """
    return exact_dedup.distinct_texts(docs, session_space(configure(spark)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within simhash.RADIUS bits, the one with the smallest id.

    Fingerprints are of simhash.SHINGLE words over the whole text. Texts without words, null ones too, have fingerprint
    zero and so are one component. Of rows that repeat the smallest id one stays.
    """
    return simhash.one_of_each(docs, session_space(configure(spark)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; rows of one document are equal.

    A null source is a source. Rows without words come as often as whole repetitions of their source. Rows that
    repeat an id are documents of their own.
    """
    return mixing.repeated(docs, session_space(configure(spark)))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and their number; an error if ids do not decode to their text.

    A null or empty text has no ids. The two columns are named ids and n_tokens unless docs has these names. An
    empty table has both columns and no rows.
    """
    importable(configure(spark))
    ranks = token_counts.read_model(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded, ids = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    encoded = byte_bpe.confirmed(encoded, ranks, public_tokenizers.PATTERN, ids_col=ids)
    n_tokens = fresh(encoded.columns, "n_tokens")
    return encoded.withColumn(n_tokens, F.size(ids).cast("long"))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("byte_bpe", encode_bytes),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a folder through all stages."""
    space = session_space(configure(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = space.write(stage(spark, docs, sf_dir), name)
    return docs
