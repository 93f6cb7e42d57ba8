from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waybill.llm import exact_dedup
from waybill.llm.queries import op1_exact_dedup

from .conftest import ODD, SF


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    """(id, keep_id, group_size) of each row, and how many rows stay."""
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return (
        sorted(((r[0], keep[norm(r[1])], len(groups[norm(r[1])])) for r in rows), key=str),
        len(groups),
    )


@pytest.mark.parametrize(("chunk", "bits"), [(1 << 16, 124), (16, 124), (16, 1), (1 << 16, 0)])
def test_classes_with_chunks_and_collisions(odd, space, chunk, bits):
    rows, _, _ = exact_dedup.classify(odd, space, chunk=chunk, bits=bits)
    got = rows.collect()
    want, kept = expected(ODD)
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == want
    assert sum(r.kept for r in got) == kept
    assert all(r.id == r.keep_id for r in got if r.kept)


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_fingerprints_compose(left, right):
    def residues(data):
        whole = np.frombuffer(data, np.uint8)
        return exact_dedup.hash_chunks(whole, np.array([0]), np.array([len(data)]), 1024)[:, 0]

    joined = exact_dedup.combine(
        [int(x) for x in residues(left)], [int(x) for x in residues(right)], len(right)
    )
    assert joined == residues(left + right).tolist()


def test_residues_are_polynomials():
    data = b"polynomial"
    got = exact_dedup.hash_chunks(np.frombuffer(data, np.uint8), np.array([0]), np.array([10]), 16)
    for base, value in zip(exact_dedup.BASES, got[:, 0], strict=True):
        terms = ((b + 1) * base ** (9 - i) for i, b in enumerate(data))
        assert sum(terms) % exact_dedup.PRIME == value


def test_kept_documents_keep_their_columns(odd, clashing, none, space):
    out = exact_dedup.distinct_texts(odd, space)
    assert out.columns == odd.columns
    assert sorted(norm(r.text) for r in out.collect()) == sorted({norm(r[1]) for r in ODD})
    out = exact_dedup.distinct_texts(clashing, space)
    assert out.columns == clashing.columns and sorted(r.doc_id for r in out.collect()) == [0, 1, 2]
    assert exact_dedup.distinct_texts(none, space).collect() == []


def test_very_long_text_among_copies(spark, space):
    long = "".join(f"word{i} " for i in range(400_000))
    rows = [(1, long), (2, long), (3, long + "x"), (4, long.replace("word7 ", "word8 "))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, _, _ = exact_dedup.classify(docs, space)
    assert sorted((r.id, r.keep_id) for r in got.collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_query_on_the_table(spark, documents):
    texts = {r.doc_id: norm(r.text) for r in documents.select("doc_id", "text").collect()}
    for r in op1_exact_dedup(spark, SF).collect():
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        same = [i for i, t in texts.items() if t == texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(same), len(same), min(same) == r.doc_id)


def test_comparison_meets_by_chunk_not_by_text(odd, space):
    piece = F.size(exact_dedup._chunk_rows(exact_dedup.normalised("text"), 16))
    sizes = odd.where("doc_id = 2").select(piece).first()[0]
    assert sizes == -(-603 // 16)
