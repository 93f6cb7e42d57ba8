from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from waybill.llm import alignment, byte_bpe
from waybill.llm.byte_bpe import byte_letters
from waybill.llm.queries import op11_alignment
from waybill.llm.token_counts import read_model

from .conftest import ODD, SF

JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(JSON)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
SPELT = {letter: b for b, letter in enumerate(byte_letters())}


def brute_tokens(text):
    """Ids and bytes of both sides, or None."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    a_bytes = [bytes(SPELT[x] for x in A.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in ((i, B.id_to_piece(i)) for i in b)
    ]
    data = (" " + text).encode()
    return (a, a_bytes, b, b_bytes) if b"".join(a_bytes) == data == b"".join(b_bytes) else None


def brute_groups(text):
    """Lists of A and B ids between the offsets where tokens of both sides end."""
    if (tokens := brute_tokens(text)) is None:
        return []
    a, a_bytes, b, b_bytes = tokens
    ends = []
    for parts in (a_bytes, b_bytes):
        at = np.cumsum([len(x) for x in parts]).tolist()
        ends.append(at)
    common = sorted(set(ends[0]) & set(ends[1]))
    out, low = [], 0
    for high in common:
        out.append([[i for i, e in zip(ids, at) if low < e <= high] for ids, at in zip((a, b), ends)])
        low = high
    return out


def brute(texts):
    """One row of numbers per text."""
    groups = [brute_groups(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(pair for c in links for pair in c)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for g, c in zip(groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
            sum(n for p, n in c.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in c.items()), text,
        ))
    return out


def rows_of(spark, space, docs):
    ranks = alignment.ranks_of(read_model(JSON))
    out, counts, _, _ = alignment.align(docs, ranks, public_tokenizers.PATTERN, read_model(PIECES), space)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return {r.row: (r.id, tuple(r[n] for n in names)) for r in out.collect()}, counts


def test_query_on_the_table(spark, documents):
    rows = documents.collect()
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows])))
    got = op11_alignment(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        *numbers, text = want[r.doc_id]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == numbers
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")


@pytest.mark.parametrize("chars", [1 << 20, 50])
@pytest.mark.parametrize("plain", [64, 1])
def test_odd_texts_by_brute_force(spark, space, monkeypatch, chars, plain):
    monkeypatch.setattr(alignment, "CHARS", chars)
    monkeypatch.setattr(alignment, "PLAIN", plain)
    monkeypatch.setattr(alignment, "aligner", alignment.Aligner)
    rng = random.Random(9)
    letters = [*"ab Zz\n\t\r 12.,'sßΣ́ ", "漢字", "😀👩‍👩‍👧", "<|endoftext|>", "</s>", "  ", "don't ", "▁", "<0x41>", "===", "ﬁ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(150)]
    texts += [r[1] for r in ODD] + ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa " * 30, "1234567890" * 40, "one two " * 60, None, ""]
    texts += texts[:20]
    with_key = list(enumerate(texts))
    rng.shuffle(with_key)
    want = brute([t for _, t in with_key])
    ranks = alignment.ranks_of(read_model(JSON))
    own = alignment.Aligner(ranks, public_tokenizers.PATTERN, read_model(PIECES))
    assert sum(bool(w[0]) for w in want) > 100 and sum(t == "" or t is None or "▁" in t for t in texts) > 5
    for (_, text), w in zip(with_key, want):
        parts = own.align(list(own.parts(text))) if text else []
        x = own.whole(parts)
        assert (x.n_a, x.n_b, x.n_groups, x.n_links, x.groups) == (*w[:4], w[6]), text
    docs = spark.createDataFrame(with_key, "doc_id long, text string")
    got, _ = rows_of(spark, space, docs)
    assert [got[k][1] for k, _ in with_key] == want


def test_pointers_reach_the_last_token_of_a_chain():
    # A: 0-3 3-6 6-9 9-12; B: 0-2 2-5 5-8 8-12 | A: 12-14, B: 12-14
    a_end, b_end = np.array([3, 6, 9, 12, 14]), np.array([2, 5, 8, 12, 14])
    assert alignment.jumps(a_end, b_end).tolist() == [8, 8, 8, 8, 9, 8, 8, 8, 8, 9]
    long = np.arange(3, 3_000_000, 3)
    last = alignment.jumps(np.append(long, 3_000_001), np.append(long + 1, 3_000_001))
    assert len(np.unique(last)) == 1


def test_matches_that_texts_share_are_looked_up_once():
    """And a worker remembers more of them than the codec of other operators does."""
    own = alignment.Aligner(alignment.ranks_of(read_model(JSON)), public_tokenizers.PATTERN, read_model(PIECES))
    assert own.a.remembered > byte_bpe.REMEMBERED
    learned, learn = [], own.a._learn
    own.a._learn = lambda tokens: learned.append(len(tokens)) or learn(tokens)
    texts = [f"some words é {'x' * (70 + k % 3)} of text {k % 7}\n" for k in range(100)]
    found = own.align(texts)
    assert len(learned) == 1
    assert [x.groups for x in found] == [own.align([t])[0].groups for t in texts]
    assert not any(len(t) > byte_bpe.REMEMBERED_LETTERS for t in own.a.known)


def test_texts_whose_bytes_differ_are_found_among_others():
    own = alignment.Aligner(alignment.ranks_of(read_model(JSON)), public_tokenizers.PATTERN, read_model(PIECES))
    texts = ["plain text", "ﬁ ligature", "two  spaces", "more", "a▁b", "x\u3000y", "漢字"]
    found = own.align(texts)
    assert [x is not None for x in found] == [brute_tokens(t) is not None for t in texts]
    assert None in found and [x.groups for x in found if x] == [b[6] for b in brute(texts) if b[0]]


def test_large_groups_need_no_spelt_out_links():
    a, b = np.zeros(30_000, np.int64), np.arange(20_000) % 3
    of, pairs, uses = alignment.linked_pairs(
        np.zeros(30_000, np.int64), np.zeros(20_000, np.int64), a, b, np.array([0]), 10
    )
    assert pairs.tolist() == [0, 1, 2] and uses.sum() == 30_000 * 20_000 and of.tolist() == [0, 0, 0]


def test_odd_rows(spark, space, odd, clashing, none):
    got, counts = rows_of(spark, space, odd)
    assert len(got) == len(ODD)
    want = sorted(zip([r[0] for r in ODD], brute([r[1] for r in ODD])), key=str)
    assert sorted(got.values(), key=str) == want
    assert counts.where("best").count() >= 1
    got, _ = rows_of(spark, space, clashing)
    texts = [r.text for r in clashing.orderBy("doc_id").collect()]
    assert [got[k][1] for k in sorted(got)] == brute(texts)
    more = clashing.selectExpr("*", "1 as n", "2 as one", "'x' as digest", "3 as pairs", "4 as groups", "5 as uses")
    assert len(rows_of(spark, space, more)[0]) == 12
    assert rows_of(spark, space, none)[0] == {}
