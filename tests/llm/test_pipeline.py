from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from waybill.llm import mixing
from waybill.llm.byte_bpe import read_ranks
from waybill.llm.queries import op4_quality
from waybill.llm.token_counts import read_model

from .conftest import ODD, SF
from .test_exact_dedup import norm
from .test_mixing import brute as brute_mix
from .test_mixing import words
from .test_simhash import brute_components, brute_fingerprint


def after_dedup(rows):
    """Brute force of the stages two and three on rows of documents."""
    seen, kept = set(), []
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        if norm(r.text) not in seen:
            seen.add(norm(r.text))
            kept.append(r)
    prints = [brute_fingerprint(r.text) for r in kept]
    return [r for i, (r, w) in enumerate(zip(kept, brute_components(prints))) if i == w]


def test_whole_run_against_brute_force(spark, documents):
    good = {r.doc_id for r in op4_quality(spark, SF).collect() if r.predicted}
    rows = after_dedup([r for r in documents.collect() if r.doc_id in good])
    sizes = Counter()
    for r in rows:
        sizes[r.source] += words(r.text)
    targets = mixing.water_fill(sizes, mixing.cycled(list(sizes)))
    copies = brute_mix([(r.doc_id, r.source, words(r.text)) for r in rows], targets, sizes)
    want = Counter({doc: n for doc, _, _, n in copies if n})
    ranks = read_ranks(read_model(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    bpe = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    out = corpus_pipeline.run(spark, SF)
    got = out.collect()
    assert Counter(r.doc_id for r in got) == want
    assert out.columns == [*documents.columns, "ids", "n_tokens"]
    texts = {r.doc_id: r.text for r in rows}
    for r in got:
        assert (r.text, r.n_tokens) == (texts[r.doc_id], len(r.ids))
        assert r.ids == bpe.encode_ordinary(r.text)


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_and_empty_tables(spark, odd, none, clashing, k):
    name, stage = corpus_pipeline.STAGES[k]
    last = k == len(corpus_pipeline.STAGES) - 1
    for docs in (odd, none, clashing):
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert last or out.columns == docs.columns
        n, before = out.count(), docs.count()
        assert n == before if last else n <= 3 * before
    if name == "quality":
        assert {"a b c d e"} <= {r[1] for r in ODD}


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "exact_dedup", "simhash_dedup", "mix", "byte_bpe",
    ]
