from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from waybill.llm import token_counts
from waybill.llm.queries import op5_token_counts

from .conftest import ODD, SF

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return lambda text: len(sp.encode(text or ""))


def test_counts_as_the_library(odd, space, library):
    model = token_counts.read_model(PATH)
    got = token_counts.count(odd, model, f"{space.path}/cache", space).collect()
    want = sorted(((r[0], len((r[1] or "").encode()), library(r[1])) for r in ODD), key=str)
    assert sorted(((r.id, r.n_bytes, r.n_tokens) for r in got), key=str) == want


def test_cache_is_read_and_appended(spark, odd, none, clashing, space, library):
    model, path = token_counts.read_model(PATH), f"{space.path}/cache"
    stored = lambda: spark.read.schema(token_counts.CACHE).parquet(path)
    assert token_counts.count(none, model, path, space).collect() == []
    token_counts.count(odd, model, path, space).collect()
    first = stored().count()
    assert first == len({r[1] or "" for r in ODD})
    # A stored count is used as it stands, so a mark in the cache shows that nothing was encoded again.
    version = token_counts.tokenizer_digest(model)
    digest = stored().first().content_digest
    marked = spark.createDataFrame([(digest, 999_999, version)], token_counts.CACHE)
    marked.write.mode("append").partitionBy("tokenizer_digest").parquet(path)
    got = token_counts.count(odd.union(odd), model, path, space).collect()
    assert any(r.n_tokens == 999_999 for r in got) and len(got) == 2 * len(ODD)
    assert stored().count() == first + 1
    token_counts.count(clashing, model, path, space).collect()
    assert stored().count() == first + 1 + 3
    other = token_counts.cached_counts(spark, path, "another tokenizer")
    assert other.collect() == []


def test_long_texts_in_parts(library, documents):
    model, rng = token_counts.read_model(PATH), random.Random(4)
    texts = [r.text for r in documents.limit(30).collect()]
    texts += ["a  b   c d" * 50, "<s> a </s> b <unk> c", "é ñ x y z ", " lead and trail  ", "\n\n a b\tc d\n"]
    texts += ["".join(rng.choice("ab é.▁\n  ") for _ in range(400)) for _ in range(30)]
    for text in texts:
        assert token_counts.count_tokens(model, text) == library(text)
        assert token_counts.count_tokens(model, text, long=50) == library(text)


def test_query_on_the_table(spark, documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in op5_token_counts(spark, SF).collect():
        n = library(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_large_files_are_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_MODEL_BYTES", 3)
    (tmp_path / "model").write_bytes(b"1234")
    with pytest.raises(ValueError, match="bytes"):
        token_counts.read_model(str(tmp_path / "model"))
