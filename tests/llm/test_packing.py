from __future__ import annotations

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from waybill.llm import packing
from waybill.llm.queries import op12_packing
from waybill.llm.token_counts import read_model

from .conftest import ODD, SF

MODEL = public_tokenizers.path("word_bpe_49k.json")


def laws(pieces, window):
    """pieces: (document, start, length, doc_tokens, sequence, offset). Documents and sequences are whole."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, n, sequence, offset in pieces:
        docs[doc, n].append((start, length))
        sequences[sequence].append((offset, length))
    for (_, n), parts in docs.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == n
    short = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
        short += [at] if at < window else []
    assert len(short) == len(set(short))
    assert sorted(sequences) == list(range(len(sequences)))


def test_query_on_the_table(spark, documents):
    library = Tokenizer.from_file(MODEL)
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [2] for r in documents.collect()}
    rows = op12_packing(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(want)
    laws([(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in rows], 4096)
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids)
        data = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(data)


@pytest.mark.parametrize("window", [16, 64, 1024])
def test_plan_places_every_piece_once(window):
    rng = random.Random(window)
    for n in (0, 1, 7, 300, 5000):
        counts = np.zeros(window + 1, np.int64)
        for _ in range(n):
            counts[min(window, int(rng.expovariate(4 / window)) + 1)] += 1
        own = packing.plan(counts, window)
        pieces = []
        for length in np.flatnonzero(counts).tolist():
            for rank in range(counts[length]):
                start = 0
                for sequence, offset, size in own.place(length, rank):
                    pieces.append(((length, rank), start, size, length, sequence, offset))
                    start += size
        laws(pieces, window)
        if n == 5000:
            cut = len(pieces) - counts.sum()
            assert cut < 0.05 * n


def test_least_squares_finds_an_exact_packing():
    """A histogram made of combinations is met by the repeat counts."""
    window, rng = 256, random.Random(2)
    counts = np.zeros(window + 1, np.int64)
    for _ in range(400):
        a = rng.randrange(100, 200)
        counts[[a, window - a]] += 50
    columns = packing.combinations(counts, window)
    assert (columns.sum(1) == window).all() and len({tuple(c) for c in columns.tolist()}) == len(columns)
    x = packing.repeats(columns, counts, 400)
    met = np.zeros(window + 1)
    np.add.at(met, columns.ravel(), np.repeat(x, 3))
    assert (x >= 0).all()
    assert np.abs(met - counts)[1:].sum() < 0.02 * counts.sum()


def test_combinations_by_definition():
    counts = np.array([0, 3, 0, 1, 1, 0, 2, 0, 1])
    want = {(8, 0, 0), (4, 4, 0), (4, 3, 1), (6, 1, 1)}
    assert {tuple(c) for c in packing.combinations(counts, 8).tolist()} == want


def test_words_are_encoded_as_the_whole_text():
    own, library = packing.Encoder(read_model(MODEL)), Tokenizer.from_file(MODEL)
    assert own.apart
    rng = random.Random(3)
    letters = [*"ab Z\n\t\r\f\v 12.,'sßΣς́  \x1c\x85　", "漢", "😀", "<|endoftext|>", "  ", "it's", "İ"]
    for k in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        got = np.frombuffer(own.encode(text), np.int32).tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, text
    other = packing.Encoder(read_model(public_tokenizers.path("byte_bpe_50k.json")))
    assert not other.apart and np.frombuffer(other.encode("a b"), np.int32).tolist() == [64, 275]


ODD_LETTERS = [*"abZ Z\n\t\r\f\v 12.,'sßΣς́  \x00\x7f\x1c\x85　éÉ—“жİ", "漢", "😀", "<|endoftext|>", "  ", "it's", "x" * 70]


def changed(**more):
    return json.dumps(json.loads(read_model(MODEL)) | more).encode()


@pytest.mark.parametrize("chars", [1 << 20, 100])
@pytest.mark.parametrize(
    "more",
    [
        {},
        {"normalizer": None},
        {"normalizer": {"type": "Sequence", "normalizers": [{"type": "NFKC"}, {"type": "Lowercase"}]}},
        {"normalizer": {"type": "Sequence", "normalizers": [{"type": "NFD"}, {"type": "StripAccents"}]}},
        {"normalizer": {"type": "Replace", "pattern": {"String": "a"}, "content": "Z"}},
        {"pre_tokenizer": {"type": "WhitespaceSplit"}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}},
    ],
)
def test_texts_together_are_encoded_as_each_by_the_library(monkeypatch, chars, more):
    monkeypatch.setattr(packing, "CHARS", chars)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    model = changed(**more)
    own, library = packing.Encoder(model), Tokenizer.from_buffer(model)
    rng = random.Random(5)
    texts = ["".join(rng.choice(ODD_LETTERS) for _ in range(rng.randrange(30))) for _ in range(600)]
    texts += ["word é " * 60, "", "\n", "x" * 300]
    for _ in range(2):
        got = [np.frombuffer(x, np.int32).tolist() for x in own.encode_all(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(own.encode_all([])) == []


def test_words_that_texts_share_are_parted_once():
    own = packing.Encoder(read_model(MODEL))
    parted, pattern = [], own.pattern
    own.pattern = lambda text: parted.extend(text.split(" ")) or pattern(text)
    words = [f"word{chr(97 + k)}" for k in range(20)] + ["née", "Füße", "one,"]
    texts = [" ".join(words[k % 23 :] + words[: k % 23]) for k in range(200)]
    list(own.encode_all(texts))
    assert sorted(parted) == sorted(w.lower() for w in words)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "CHARS", 1 << 16)
    own, library = packing.Encoder(read_model(MODEL)), Tokenizer.from_file(MODEL)
    texts = ["a b", "one two, three " * 90_000, "", "c"]
    got = [np.frombuffer(x, np.int32).tolist() for x in own.encode_all(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_rows(spark, space, odd, clashing, none):
    model, library = read_model(MODEL), Tokenizer.from_file(MODEL)
    long = spark.createDataFrame([(99, "word " * 30_000 + "x" * 5000, "en", "s", 0)], odd.schema)
    docs = odd.union(long)
    out, _, _ = packing.pack(docs, model, space, window=64)
    rows = out.collect()
    laws([(r.row, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in rows], 64)
    back = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        assert len(r.ids) == 4 * r.length
        back[r.id, r.row].extend(np.frombuffer(r.ids, np.int32).tolist())
    texts = [(r[0], r[1]) for r in ODD] + [(99, "word " * 30_000 + "x" * 5000)]
    want = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in texts]
    assert sorted(((i, ids) for (i, _), ids in back.items()), key=str) == sorted(want, key=str)
    assert packing.pack(none, model, space)[0].collect() == []
    laws([(r.row, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset)
          for r in packing.pack(clashing, model, space)[0].collect()], 4096)


def test_a_frequent_length_spans_tasks(spark, space):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 < 2, 'one two three', repeat('w ', int(id % 61))) as text")
    out, _, _ = packing.pack(docs.repartition(7), read_model(MODEL), space, window=64)
    laws([(r.row, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in out.collect()], 64)
