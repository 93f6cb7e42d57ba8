from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from waybill.llm import embeddings
from waybill.llm.queries import op6_embedding_dedup

from .conftest import SF


def brute(rows, threshold=0.93):
    """(id, n_links, component_id) of rows (id, vector, label)."""

    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = defaultdict(int)
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if la is None or la != lb or not good(a) or not good(b) or len(a) != len(b):
                continue
            a64, b64 = np.array(a, float), np.array(b, float)
            if a64 @ b64 / math.sqrt((a64 @ a64) * (b64 @ b64)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), vec_id) if x is not None]
        least[find(i)] = min(known, default=None)
    return [(r[0], links[i], least[find(i)]) for i, r in enumerate(rows)]


def clustered(rng, n, dims, first=0):
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = np.array(rows[rng.integers(len(rows))][1])
            vector = base + rng.normal(size=dims) * rng.choice([0.0, 0.02, 0.05, 0.08])
        else:
            vector = rng.normal(size=dims)
        rows.append((first + i, [float(x) for x in vector * rng.choice([0.1, 1, 30])], int(rng.integers(3))))
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("block", [1024, 16])
def test_links_and_components(spark, space, block, monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF", 8)
    rng = np.random.default_rng(block)
    nan, inf = float("nan"), float("inf")
    rows = clustered(rng, 260, 12)
    rows += [(900, None, 1), (901, [0.0] * 12, 1), (902, [nan] + [1.0] * 11, 1), (903, [inf] * 12, 1)]
    rows += [(904, [None] + [1.0] * 11, 1), (905, rows[3][1], None), (906, [], 1), (907, [1.0], 1)]
    rows += [(908, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2]), (None, rows[5][1], rows[5][2])]
    rows += [(910, [1e-200] * 12, 2), (911, [1e-190] * 12, 2), (912, [1e200] * 12, 2), (913, [2.0], 1)]
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(40)]
    scaled = [(a, [x / max(map(abs, v)) for x in v] if a in (910, 911, 912) else v, c) for a, v, c in rows]
    got, _, _ = embeddings.classify(spark.createDataFrame(rows, SCHEMA), space, block=block, dims=4)
    got = got.collect()
    assert sorted(((r.id, r.n_links, r.component_id) for r in got), key=str) == sorted(brute(scaled), key=str)


def test_one_row_of_each_component_is_kept(spark, space):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [0.0, 1.0], 1)]
    got, _, _ = embeddings.classify(spark.createDataFrame(rows, SCHEMA), space)
    assert sorted((r.id, r.kept) for r in got.collect()) == [(1, False), (1, True), (2, False), (3, True)]


def test_empty_and_extra_columns(spark, space):
    none = spark.createDataFrame([], SCHEMA)
    assert embeddings.classify(none, space)[0].collect() == []
    more = spark.createDataFrame([(1, [1.0], 2, 3, "x")], f"{SCHEMA}, row_key int, component_id string")
    assert [r.n_links for r in embeddings.classify(more, space)[0].collect()] == [0]


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = op6_embedding_dedup(spark, SF).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(brute(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
