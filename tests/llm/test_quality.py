from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import quality
from waybill.llm.queries import op4_quality, quality_model

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op4_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good = [r.score for r in rows if r.quality]
    bad = [r.score for r in rows if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/flipped-labels"
    flipped.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    first, second = quality_model(spark, docs, SF), quality_model(spark, docs, folder)
    assert np.array_equal(first.ratio, second.ratio) and np.allclose(first.weights, second.weights)


def test_indicators_of_blocks_and_of_the_whole(monkeypatch):
    present = np.zeros(quality.SLOTS, bool)
    text = "Some words words here, SOME! 12 | é " * 60
    whole = quality.indicators(text, present)
    assert not present.any()
    monkeypatch.setattr(quality, "BLOCK", 500)
    assert set(whole) <= set(quality.indicators(text, present))
    assert len(quality.indicators("", present)) == 0


@pytest.mark.parametrize("block", [1, 7, 50, 333])
def test_blocks_lose_no_indicator_of_text_that_does_not_repeat(monkeypatch, block):
    present, rng = np.zeros(quality.SLOTS, bool), np.random.default_rng(block)
    for _ in range(30):
        letters = list("aaaaZ9.,-é") + ["   ", " \n", "xy xy ", "longer "]
        text = "".join(rng.choice(letters, 700))
        monkeypatch.setattr(quality, "BLOCK", 1 << 20)
        whole = quality.indicators(text, present)
        monkeypatch.setattr(quality, "BLOCK", block)
        assert np.array_equal(whole, quality.indicators(text, present))


def test_repeated_words_are_marked():
    data = np.frombuffer(b"ab ab cd cd. x", np.uint8)
    shown = quality._ditto(data, quality._CLASS[data])
    assert bytes(shown) == b"xx == xx xx. x"


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    at = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(80)]
    rows = [(a, rng.normal(size=6)) for a in at]
    truth = rng.normal(size=30)
    signs = np.sign([truth[a] @ v + 0.3 * rng.normal() for a, v in rows])
    weights, bias = quality.dual_descent(rows, signs, np.full(80, 0.5), passes=400)

    def loss(w, b):
        margin = np.array([w[a] @ v + b for a, v in rows])
        return 0.5 * (w @ w + b * b) + 0.5 * np.maximum(0, 1 - signs * margin).sum()

    best = loss(weights, bias)
    for _ in range(200):
        step = np.zeros_like(weights)
        step[:30] = rng.normal(size=30) * 0.05
        assert loss(weights + step, bias + 0.05 * rng.normal()) >= best - 1e-3


def test_log_count_ratio():
    got = quality.log_count_ratio(np.array([3.0, 0.0]), np.array([0.0, 1.0]))
    assert got == pytest.approx(np.log([(4 / 5) / (1 / 3), (1 / 5) / (2 / 3)]))


def test_odd_rows_are_scored(spark, odd, clashing, none, space):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_model(spark, docs, SF)
    scored, name = quality.score(odd, model)
    rows = scored.collect()
    assert len(rows) == odd.count() and all(0 <= r[name] <= 1 for r in rows)
    assert len({r[name] for r in rows if not r.text}) == 1
    scored, name = quality.score(clashing, model)
    assert name != "score" and scored.columns == [*clashing.columns, name] and scored.count() == 12
    assert quality.score(none, model)[0].collect() == []


def test_without_both_classes_there_is_no_model(spark, odd, none, space):
    labels = spark.createDataFrame([(5, 1), (3, None), (None, 0)], "doc_id long, quality int")
    rows = quality.labelled_rows(odd, labels, space)
    assert quality.fit(rows, space) is None
    assert quality.fit(quality.labelled_rows(none, labels, space), space) is None
    scored, name = quality.score(odd, None)
    assert {r[name] for r in scored.collect()} == {0.5}
