"""The operators as registered queries over whole tables, with the columns of their contracts."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import (
    alignment,
    byte_bpe,
    centroids,
    chat,
    embeddings,
    exact_dedup,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    token_counts,
    url_rules,
)
from waybill.llm.common import importable, session_space
from waybill.session import configure

#: Documents whose checksum has this remainder are not learnt from.
FOLDS, HELD_OUT = 4, 2
TOKEN_LIMIT = 4096
SHARDS = 8
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: A conversation made of control strings, besides those of the table.
CONTROL_CONVERSATION = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(configure(spark))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    digest = {"text_sha256": F.sha2(exact_dedup.normalised("text"), 256)}
    rows, _, _ = exact_dedup.classify(docs, session_space(spark), extra=digest)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows, _, _ = simhash.classify(_table(spark, folder, "documents"), session_space(spark))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows, _, _ = mixing.mix(_table(spark, folder, "documents"), session_space(spark))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


def quality_model(spark: SparkSession, docs: DataFrame, folder: str) -> quality.Model | None:
    """A model from the labels of the documents that are not held out."""
    space = session_space(spark)
    learn = F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS != HELD_OUT
    labels = _table(spark, folder, "labels")
    return quality.fit(quality.labelled_rows(docs, labels, space, learn), space)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality_model(spark, docs, folder)
    rows, score = quality.score(docs, model, keep=["doc_id"])
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT
    return rows.select(
        "doc_id",
        held_out.alias("held_out"),
        score,
        (F.col(score) >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    space = session_space(spark)
    model = token_counts.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = _table(spark, folder, "documents")
    rows = token_counts.count(docs, model, f"{space.path}/token-cache", space)
    over = (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", over)


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows, _, _ = embeddings.classify(_table(spark, folder, "embeddings"), session_space(spark))
    return rows.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    rules = url_rules.rule_table(spark, URL_RULES)
    judged = url_rules.judge(pages, rules, session_space(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = token_counts.read_model(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = _table(spark, folder, "documents")
    encoded, ids = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    decoded, data = byte_bpe.decode(encoded, ranks, public_tokenizers.PATTERN, ids)
    return byte_bpe.digests(decoded, ids, data)


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    space = session_space(spark)
    docs = _table(spark, folder, "documents")
    rows, _, _ = sharding.shard(docs, space, f"{space.path}/slot-map", SHARDS)
    return rows.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("cell_slot").alias("virtual_slot"),
    )


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    out = chat.render(turns.unionByName(extra))
    read = out.withColumn("turns", chat.read_back(F.col("formatted")))
    read = read.withColumn("learned", chat.learned_text(F.col("formatted"), F.col("loss_spans")))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    ranks = alignment.ranks_of(token_counts.read_model(public_tokenizers.path("byte_bpe_50k.json")))
    pieces = token_counts.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = _table(spark, folder, "documents")
    groups = F.col("groups")
    digest = {"groups_sha256": F.when(groups == "", "").otherwise(F.sha2(groups, 256))}
    rows, _, _, _ = alignment.align(
        docs, ranks, public_tokenizers.PATTERN, pieces, session_space(spark), give=digest
    )
    return rows.withColumnRenamed("id", "doc_id").drop("row")


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    model = token_counts.read_model(public_tokenizers.path("word_bpe_49k.json"))
    pieces, _, _ = packing.pack(_table(spark, folder, "documents"), model, session_space(spark))
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    rows, last, _, _ = centroids.cluster(_table(spark, folder, "embeddings"), session_space(spark))
    sums = {r.cluster: r.d for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    plan = [
        (k, d, sum(sums.values()), hashlib.sha256(",".join(map(str, last[k].tolist())).encode()).hexdigest())
        for k, d in sums.items()
    ]
    fields = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    plan = F.broadcast(spark.createDataFrame(plan, fields))  # a row per centroid
    rows = rows.select(F.col("id").alias("vec_id"), "cluster", "distance")
    return rows.join(plan, "cluster").select("vec_id", "cluster", "distance", *plan.columns[1:])


QUERIES = {
    q.__name__: q
    for q in (
        op1_exact_dedup,
        op2_simhash,
        op3_mixing,
        op4_quality,
        op5_token_counts,
        op6_embedding_dedup,
        op7_url_rules,
        op8_byte_bpe,
        op9_sharding,
        op10_chat_format,
        op11_alignment,
        op12_packing,
        op13_centroids,
    )
}
