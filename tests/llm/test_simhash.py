from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from waybill.llm import simhash
from waybill.llm.queries import op2_simhash

from .conftest import ODD, SF


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Place -> first place reachable by links of at most three bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near(rng, n, centres):
    out = []
    for _ in range(n):
        value = rng.choice(centres)
        for _ in range(rng.randrange(4)):
            value ^= 1 << rng.randrange(64)
        out.append(value)
    return out


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_fingerprint_by_definition(monkeypatch, block, documents):
    monkeypatch.setattr(simhash, "BLOCK", block)
    texts = [r[1] for r in ODD] + ["One", "one Two", "É é É à", " a\x0bb\x0cc d ", "\x1ca b c"]
    texts += [r.text for r in documents.limit(20).collect()]
    for text in texts:
        assert simhash.fingerprint(text or "") == brute_fingerprint(text)


def test_forest_joins_what_links_join():
    rng = random.Random(5)
    fps = near(rng, 400, [rng.getrandbits(64) for _ in range(60)])
    group = np.sort(np.array([rng.randrange(7) for _ in fps]))
    label = simhash.forest(group, np.array(fps, np.uint64))
    for g in set(group.tolist()):
        at = np.flatnonzero(group == g)
        want = brute_components([fps[i] for i in at])
        assert [int(label[i]) for i in at] == [int(at[w]) for w in want]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_counters_stop_at_any_radius(radius):
    rng = random.Random(radius)
    base = rng.getrandbits(64)
    fps = [base]
    for bits in range(1, 9):
        value = base
        for b in rng.sample(range(64), bits):
            value ^= 1 << b
        fps.append(value)
    for value, bits in zip(fps[1:], range(1, 9)):
        label = simhash.forest(np.zeros(2, int), np.array([base, value], np.uint64), radius)
        assert (label[1] == 0) == (bits <= radius)


@pytest.mark.parametrize("bucket", [2048, 3])
def test_links_lose_none(spark, space, bucket):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(50)]
    fps = sorted({*near(rng, 500, centres), *near(rng, 200, centres[:1]), 0, (1 << 64) - 1, 7, 1 << 63})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), space, bucket=bucket)
    root = {s: s for s in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() >= 0
        root[find(a)] = find(b)
    want = brute_components(fps)
    got = [find(s) for s in signed]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_classes_with_odd_rows(odd, clashing, none, space):
    rows, _, _ = simhash.classify(odd, space)
    got = rows.collect()
    prints = [brute_fingerprint(r[1]) for r in ODD]
    want = brute_components(prints)
    least = {}
    for r, w in zip(ODD, want, strict=True):
        least[w] = min((x for x in (least.get(w), r[0]) if x is not None), default=None)
    pairs = sorted(((r[0], least[w]) for r, w in zip(ODD, want, strict=True)), key=str)
    assert sorted(((r.id, r.component_id) for r in got), key=str) == pairs
    assert sum(r.kept for r in got) == len(set(want))
    assert simhash.one_of_each(odd, space).count() == len(set(want))
    assert simhash.one_of_each(clashing, space).columns == clashing.columns
    assert simhash.one_of_each(none, space).collect() == []


def test_query_on_the_table(spark, documents):
    docs = documents.orderBy("doc_id").collect()
    prints = [brute_fingerprint(r.text) for r in docs]
    want = {
        docs[i].doc_id: (f"{prints[i]:016x}", docs[w].doc_id)
        for i, w in enumerate(brute_components(prints))
    }
    got = op2_simhash(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
