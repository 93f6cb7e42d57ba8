from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from waybill.llm import common

from .conftest import DOCS, ODD


def test_keys_tell_repeated_rows_apart(spark, odd, clashing, none, space):
    rows, key = common.keyed(odd, "doc_id", space)
    assert rows.count() == len(ODD) == rows.select(key).distinct().count()
    assert rows.where(f"{key} is null").isEmpty()
    # The numbers are stored: reading again gives the same ones.
    assert sorted(rows.collect(), key=str) == sorted(rows.collect(), key=str)
    rows, key = common.keyed(clashing, "doc_id", space)
    assert key != "row_key" and rows.where(f"{key} <> doc_id").isEmpty()
    assert common.keyed(none, "doc_id", space)[0].collect() == []
    text = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    rows, key = common.keyed(text, "doc_id", space)
    assert sorted(r[key] for r in rows.collect()) == ["a", "b"]


def test_small_tables_are_broadcast_and_large_ones_are_not(spark, space):
    rows = space.write(spark.range(10).toDF("k"), "k")
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "ResolvedHint (strategy=broadcast)" in plan(common.small(rows))
    assert "strategy=broadcast" not in plan(common.small(rows, rows=9))


@pytest.mark.parametrize("limit", [500_000, 0])
def test_dropped_keys_go(spark, space, monkeypatch, limit):
    monkeypatch.setattr(common.small, "__defaults__", (limit,))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, text string")
    dropped = space.write(spark.createDataFrame([(2,)], "row long"), "dropped")
    assert sorted(r.text for r in common.without(docs, "k", dropped).collect()) == ["a", "c"]


def test_fresh_names():
    assert common.fresh(["a", "B"], "c") == "c"
    assert common.fresh(["ids", "IDS_"], "Ids") == "Ids__"


def test_schema_is_not_changed_in_place(spark):
    df = spark.createDataFrame([], DOCS)
    more = common.plus(df, **{"odd name": "array<int>"})
    assert more.names == [*df.columns, "odd name"] and len(df.schema) == 5


@given(st.text(alphabet="ab \n ", max_size=60), st.integers(1, 9))
def test_blocks_are_the_text_cut_before_spaces(text, size):
    parts = list(common.blocks(text, size))
    assert "".join(parts) == text
    for before, part in zip(parts, parts[1:]):
        assert part[0] == " " and not before[-1].isspace()


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string(), pa.binary()])
def test_bytes_of_slices(kind):
    column = pa.array(["ab", "", "cde"]).cast(kind).slice(1)
    offsets, data = common.bytes_of(column)
    assert [bytes(data[a:b]) for a, b in zip(offsets, offsets[1:])] == [b"", b"cde"]
