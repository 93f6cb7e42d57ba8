from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from waybill.llm import sharding
from waybill.llm.queries import op9_sharding

from .conftest import ODD, SF


def test_query_on_the_table(spark, documents):
    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    rows = op9_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    loads, places = Counter(), defaultdict(list)
    for r in rows:
        data = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        loads[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert sorted(places) == list(range(8))
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    assert max(loads.values()) - min(loads.values()) <= max(r.size for r in rows)
    shard_of = defaultdict(set)
    for r in rows:
        shard_of[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    again = {r.doc_id: (r.shard, r.slot) for r in op9_sharding(spark, SF).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_a_third_of_all_rows_in_one_slot_is_dealt_out(spark, space):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i} " * (i % 9)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed, _, _ = sharding.shard(docs, space, f"{space.path}/map")
    loads = Counter()
    for r in placed.collect():
        loads[r.shard] += r.size
    assert len(loads) == 8 and max(loads.values()) < 1.02 * min(loads.values())


def shards_of(spark, space, rows, **named):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    placed, _, _ = sharding.shard(docs, space, f"{space.path}/map-{len(rows)}", **named)
    loads, of, places = Counter(), defaultdict(set), defaultdict(list)
    for r in placed.collect():
        loads[r.shard] += r.size
        of[rows[r.id]].add(r.shard)
        places[r.shard].append(r.position)
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    return loads, of


def test_equal_texts_that_fit_a_shard_stay_together(spark, space, monkeypatch):
    """Between a sixteenth and an eighth of all bytes, beside others."""
    monkeypatch.setattr(sharding, "RANKED", 40)
    others = [f"text {i} " + "x" * (i % 200) for i in range(3000)]
    total = sum(len(t) + 1 for t in others)
    group = ["g" * 2000] * int(total / 0.88 * 0.11 / 2001)
    loads, of = shards_of(spark, space, others + group)
    assert len(of[group[0]]) == 1
    assert max(loads.values()) < 1.02 * min(loads.values())


def test_groups_are_split_where_the_sizes_need_it(spark, space):
    """Nine groups of a ninth cannot stay whole in eight equal shards."""
    rows = [f"group {i % 9} " + "y" * 100 for i in range(9 * 300)]
    loads, of = shards_of(spark, space, rows)
    assert max(loads.values()) < 1.05 * min(loads.values())


def test_map_is_edited_when_shards_are_added(spark, space, documents):
    path = f"{space.path}/map"
    first = {r.id: r.shard for r in sharding.shard(documents, space, path)[0].collect()}
    same = {r.id: r.shard for r in sharding.shard(documents, space, path)[0].collect()}
    grown = sharding.shard(documents, space, path, shards=9)[0].collect()
    assert same == first
    moved = [r for r in grown if r.shard != first[r.id]]
    assert moved and all(r.shard == 8 for r in moved)
    total = sum(r.size for r in grown)
    share = sum(r.size for r in grown if r.shard == 8) / total
    assert 0.08 < share < 0.14
    assert len(sharding.read_map(spark, path, 1)) == len(sharding.read_map(spark, path))
    assert {r.map_version for r in grown} == {3}


def test_rebalance_moves_little_and_evens_out():
    rng = random.Random(6)
    sizes = {(s, -1): rng.randrange(50, 150) for s in range(800)}
    old = sharding.assign(sizes, 6)
    changed = {u: n * (3 if old[u] == 0 and u[0] % 2 else 1) for u, n in sizes.items()}
    new = sharding.rebalance(old, changed, 6)
    loads = Counter()
    for unit, shard in new.items():
        loads[shard] += changed[unit]
    assert max(loads.values()) - min(loads.values()) < 300
    assert sum(new[u] != old[u] for u in sizes) < 200
    assert sharding.rebalance(old, sizes, 6) == old
    split = {(3, g): 10 for g in range(64)} | {u: n for u, n in sizes.items() if u != (3, -1)}
    assert set(sharding.rebalance(old, split, 6)) == set(split)


def test_odd_rows(spark, odd, clashing, none, space):
    placed, docs, key = sharding.shard(odd, space, f"{space.path}/odd", shards=3)
    rows = placed.collect()
    assert len(rows) == len(ODD)
    want = sorted(((r[0], len((r[1] or "").encode()) + 1) for r in ODD), key=str)
    assert sorted(((r.id, r.size) for r in rows), key=str) == want
    sharding.write_shards(placed, docs, key, f"{space.path}/shards")
    back = spark.read.parquet(f"{space.path}/shards")
    assert back.count() == len(ODD) and set(odd.columns) <= set(back.columns)
    assert sharding.shard(clashing, space, f"{space.path}/clash")[0].count() == 12
    assert sharding.shard(none, space, f"{space.path}/none")[0].collect() == []
