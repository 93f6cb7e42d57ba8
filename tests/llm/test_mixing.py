from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from waybill.llm import mixing
from waybill.llm.queries import op3_mixing

from .conftest import ODD, SF


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, targets, sizes):
    """Copies of each (id, size) by the seeded order of a source."""
    out = []
    by_source = defaultdict(list)
    for doc, source, size in rows:
        seed = "7" if doc is None else f"7:{doc}"
        by_source[source].append((hashlib.md5(seed.encode()).hexdigest(), size, doc))
    for source, docs in by_source.items():
        docs.sort(key=lambda x: x[:2])
        whole = min(3, int(targets[source] / sizes[source])) if sizes[source] else 0
        room, start, once = int(targets[source] - whole * sizes[source]), 0, set()
        while start is not None and room * 1000 > targets[source]:
            limit, begin, start = room, start, None
            for at in range(begin, len(docs)):
                size = docs[at][1]
                if 0 < size <= limit:
                    if size > room:
                        start = at + 1
                        break
                    once.add(at)
                    room -= size
        left = [(size, at) for at, (_, size, _) in enumerate(docs) if at not in once and 0 < size < 2 * room]
        once |= {at for _, at in sorted(left)[:1]}
        out += [(doc, source, size, whole + (at in once)) for at, (_, size, doc) in enumerate(docs)]
    return sorted(out, key=str)


def test_weights_repeat_in_code_point_order():
    got = mixing.cycled([None, "b", "Z", "é", "a", ""])
    assert got == {"": 5, "Z": 2, "a": 1, "b": 5, "é": 2, None: 1}


@given(st.dictionaries(st.integers(0, 9), st.tuples(st.integers(0, 1000), st.integers(0, 5)), max_size=8))
def test_water_fill_is_feasible_and_by_weight(sources):
    sizes = {s: n for s, (n, _) in sources.items()}
    weights = {s: w for s, (_, w) in sources.items()}
    targets = mixing.water_fill(sizes, weights)
    assert targets.keys() == sizes.keys()
    assert all(0 <= t <= 3 * sizes[s] + 1e-6 for s, t in targets.items())
    reachable = min(sum(sizes.values()), sum(3 * n for s, n in sizes.items() if weights[s]))
    assert sum(targets.values()) == pytest.approx(reachable)
    free = [t / weights[s] for s, t in targets.items() if weights[s] and t < 3 * sizes[s] - 1e-6]
    assert not free or max(free) == pytest.approx(min(free))


@pytest.mark.parametrize("slices", [4096, 1, 3])
def test_copies_by_seeded_order(odd, space, slices):
    rows = [(r[0], r[3], words(r[1])) for r in ODD]
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    targets = mixing.water_fill(sizes, mixing.cycled(list(sizes)))
    got, _, _ = mixing.mix(odd, space, slices=slices)
    got = got.collect()
    assert sorted(((r.id, r.source, r.size, r.copies) for r in got), key=str) == brute(rows, targets, sizes)
    for r in got:
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(targets[r.source]))


def test_taken_is_near_the_target(spark):
    rows = op3_mixing(spark, SF).collect()
    taken, target = sum(r.taken for r in rows), sum({(r.source_size, r.target) for r in rows}, ())
    assert all(r.taken <= 3 * r.size for r in rows)
    assert taken == pytest.approx(sum(r.size for r in rows), rel=0.1) and target
    by = defaultdict(list)
    for r in rows:
        by[r.target, r.source_size].append(r)
    for (goal, _), docs in by.items():
        whole = int(goal / docs[0].source_size) if docs[0].source_size else 0
        least = min((r.size for r in docs if r.size and r.taken == whole * r.size), default=0)
        assert abs(sum(r.taken for r in docs) - goal) <= max(goal / 1000, least / 2) + 1


def test_a_long_document_that_does_not_fit_is_passed_over(spark, space):
    """One holds nine tenths of its source, wherever it stands in the order."""
    sizes = {0: 9000} | {i: 10 for i in range(1, 101)}
    rows = [(i, "w " * n, "a") for i, n in sizes.items()] + [(1000 + i, "w " * 100, "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in range(4):
        taken, _, _ = mixing.mix(docs, space, weights=lambda found: {"a": 1, "b": 2}, seed=seed)
        taken = taken.where("source = 'a'").collect()
        assert {r.target for r in taken} == {10000.0} and sum(r.size * r.copies for r in taken) == 10000
        taken, _, _ = mixing.mix(docs, space, weights=lambda found: {"a": 1, "b": 3}, seed=seed)
        taken = taken.where("source = 'a'").collect()
        assert {r.target for r in taken} == {7500.0} and sum(r.size * r.copies for r in taken) == 10000


def test_mix_repeats_rows(odd, clashing, none, space):
    out = mixing.repeated(odd, space)
    assert out.columns == odd.columns
    taken, _, _ = mixing.mix(odd, space)
    assert out.count() == sum(r.copies for r in taken.collect())
    assert mixing.repeated(clashing, space).columns == clashing.columns
    assert mixing.repeated(none, space).collect() == []
    again = sorted(str(r) for r in mixing.repeated(odd, space).collect())
    assert again == sorted(str(r) for r in out.collect())


def test_a_column_named_as_spark_names_an_exploded_one(space, clashing):
    docs = clashing.withColumnRenamed("score", "col").withColumnRenamed("keep_id", "copy")
    assert mixing.repeated(docs, space).columns == docs.columns
