from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from waybill.llm import byte_bpe, common
from waybill.llm.queries import op8_byte_bpe
from waybill.llm.token_counts import read_model

from .conftest import ODD, SF

RANKS = read_model(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.Codec(RANKS, PATTERN)


ALPHABET = "aAzZ éñßçü漢字 09 ,.;!\n\t\r\x0b\x0c\x1c\x1f\x85\xa0  ​　'sdm<|endoftext|>👍🏽́\x00"


def test_ids_as_the_library(bpe, library, documents):
    rng = random.Random(8)
    texts = ["", "a", "<|endoftext|>", "I'll we've 123 x", "   lead", "trail   ", "a \n b", "é" * 300]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["ab" * 500, "zq" * 70 + " " * 40 + "x"]
    texts += [r.text for r in documents.limit(40).collect()]
    for text in texts:
        ids = bpe.encode(text).tolist()
        assert ids == library.encode_ordinary(text), text
        assert bpe.decode(ids) == text.encode()


def test_every_rank_is_spelt_back(bpe):
    assert all(bpe.spelling[rank] == token for token, rank in bpe.ranks.items())


def test_blocks_cut_nothing(bpe, library, monkeypatch, documents):
    monkeypatch.setattr(byte_bpe, "blocks", lambda text: common.blocks(text, 7))
    rng = random.Random(9)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(200)) for _ in range(100)]
    for text in texts + [r.text for r in documents.limit(10).collect()]:
        assert "".join(common.blocks(text, 7)) == text
        assert bpe.encode(text).tolist() == library.encode_ordinary(text)


def test_memory_of_pre_tokens_is_bounded(bpe, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    text = " ".join(f"w{i}x{i * i}" for i in range(50)) + " " + "q" * 100
    for _ in range(2):
        assert bpe.encode(text).tolist() == library.encode_ordinary(text)
    assert "q" * 100 not in bpe.known and " " + "q" * 100 not in bpe.known


def test_a_rank_file_without_a_byte_is_refused():
    with pytest.raises(ValueError, match="without a rank"):
        byte_bpe.read_ranks(b"YQ== 0\n")


def test_round_trip_of_odd_rows(odd, clashing, none, space):
    encoded, ids = byte_bpe.encode(odd, RANKS, PATTERN)
    decoded, data = byte_bpe.decode(encoded, RANKS, PATTERN, ids)
    rows = decoded.collect()
    assert len(rows) == len(ODD)
    assert all(bytes(r[data]).decode() == (r.text or "") for r in rows)
    assert all(r[ids] == [] for r in rows if not r.text)
    encoded, ids = byte_bpe.encode(clashing, RANKS, PATTERN)
    assert ids != "ids" and encoded.columns == [*clashing.columns, ids] and encoded.count() == 12
    assert byte_bpe.encode(none, RANKS, PATTERN)[0].collect() == []


def test_query_on_the_table(spark, documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for r in op8_byte_bpe(spark, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha(" ".join(map(str, ids)).encode())
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())


def test_ids_that_give_another_text_are_an_error(spark, odd, monkeypatch):
    encoded, ids = byte_bpe.encode(odd, RANKS, PATTERN)
    again = byte_bpe.confirmed(encoded, RANKS, PATTERN, ids_col=ids).collect()
    assert sorted(map(str, again)) == sorted(map(str, encoded.collect()))
    wrong = encoded.withColumn(ids, F.when(F.col("doc_id") == 4, F.array(F.lit(5))).otherwise(F.col(ids)))
    with pytest.raises(Exception, match="do not decode"):
        byte_bpe.confirmed(wrong, RANKS, PATTERN, ids_col=ids).select("doc_id").collect()
    monkeypatch.setattr(byte_bpe, "encode", lambda *a: (wrong, ids))
    with pytest.raises(Exception, match="do not decode"):
        corpus_pipeline.encode_bytes(spark, odd, SF).collect()
