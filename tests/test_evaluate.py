"""Evaluation operators: numeric cases, report conventions, history replay."""

import math

import pytest
from pyspark.sql import functions as F

from lectern.labels import TOPIC_CLASSES
from lectern.operators import evaluate as ev
from lectern.operators import history as hist
from lectern.operators.quantiles import box_stats, exact_quantiles


def scored(spark, pairs, probs=None):
    rows = []
    for i, (y, p) in enumerate(pairs):
        pr = probs[i] if probs else [0.2] * 5
        rows.append((i, y, p, pr))
    return spark.createDataFrame(rows, "doc_id long, y long, pred long, probs array<double>")


@pytest.mark.parametrize("pairs,acc", [([(i, i) for i in range(5)], 1.0),
                                       ([(i, (i + 1) % 5) for i in range(5)], 0.0),
                                       ([(i % 5, i % 5 if i < 5 else (i + 1) % 5) for i in range(10)], 0.5)])
def test_accuracy_cases(spark, pairs, acc):
    df = scored(spark, pairs).withColumn("correct", F.col("y") == F.col("pred"))
    assert ev.accuracy(df).first().accuracy == acc


def test_report_lists_absent_class_with_zeros(spark):
    df = scored(spark, [(0, 0), (1, 1), (1, 0)])
    rep = {r.label: r for r in ev.classification_report(df, TOPIC_CLASSES).collect()}
    assert set(rep) == set(TOPIC_CLASSES)
    assert (rep["tech"].precision, rep["tech"].recall, rep["tech"].f1_score, rep["tech"].support) == (0.0, 0.0, 0.0, 0)


def test_weighted_recall_equals_accuracy(spark):
    import random

    rnd = random.Random(42)
    pairs = [(rnd.randrange(5), rnd.randrange(5)) for _ in range(50)]
    df = scored(spark, pairs)
    per = ev.classification_report(df, TOPIC_CLASSES)
    avg = {r.label: r for r in ev.report_averages(per).collect()}
    acc = sum(1 for y, p in pairs if y == p) / 50
    assert math.isclose(avg["weighted avg"].recall, acc, abs_tol=1e-6)
    assert math.isclose(avg["accuracy"].f1_score, acc, abs_tol=1e-6)


def test_confusion_missing_true_class_is_zero_row(spark):
    df = scored(spark, [(0, 1), (1, 1)])
    cm = ev.confusion_counts(df, TOPIC_CLASSES)
    assert cm.count() == 25
    assert cm.where("y = 4").agg(F.sum("n")).first()[0] == 0
    assert cm.agg(F.sum("n")).first()[0] == 2
    norm = ev.confusion_normalised(df, TOPIC_CLASSES).where("true_label = 'tech'")
    assert {r.share for r in norm.collect()} == {0.0}


def test_batched_loss_is_mean_of_batch_means(spark):
    probs = [[0.5, 0.5, 0.0, 0.0, 0.0], [0.25, 0.75, 0.0, 0.0, 0.0], [0.1, 0.9, 0.0, 0.0, 0.0]]
    df = scored(spark, [(0, 0), (0, 0), (0, 0)], probs)
    r = ev.log_loss_batched(df, batch_size=2).first()
    b1 = (-math.log(0.5) - math.log(0.25)) / 2
    b2 = -math.log(0.1)
    assert math.isclose(r.loss_batched, round((b1 + b2) / 2, 6), abs_tol=1e-6)
    assert math.isclose(r.loss_rows, round((-math.log(0.5) - math.log(0.25) - math.log(0.1)) / 3, 6), abs_tol=1e-6)


def test_histogram_all_equal_one_bin(spark):
    df = spark.createDataFrame([(0.7,)] * 4, "c double")
    h = ev.histogram(df, "c", 20).where("n > 0").collect()
    assert len(h) == 1 and h[0].n == 4


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in range(21)], "c double")
    h = {r.bin: r.n for r in ev.histogram(df, "c", 20).collect()}
    assert h[19] == 2 and sum(h.values()) == 21


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    vals = [float(v) for v in np.random.default_rng(42).normal(size=101)]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 1.0)], "g string, v double")
    q = {r.g: r for r in exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["q1", "q2", "q3"]).collect()}
    for name, p in [("q1", 25), ("q2", 50), ("q3", 75)]:
        assert math.isclose(q["a"][name], float(np.percentile(vals, p)), abs_tol=1e-12)
    assert q["b"].q2 == 1.0


def test_box_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v double")
    b = box_stats(df, ["g"], "v").first()
    assert (b.q1, b.median, b.q3) == (2.0, 3.0, 4.0)
    assert b.whisker_high == 4.0 and b.n_outliers == 1


def history(spark, values, run="r"):
    return spark.createDataFrame([(run, i + 1, "val_acc", v) for i, v in enumerate(values)],
                                 "run string, step long, key string, value double")


def test_early_stop_fixture(spark):
    r = hist.early_stop(history(spark, [.70, .80, .80, .79, .78, .95]), 3).first()
    assert (r.stop_step, r.best_step, r.best_value) == (5, 2, .80)


def test_early_stop_patience_one(spark):
    assert hist.early_stop(history(spark, [.8, .6]), 1).first().stop_step == 2
    assert hist.best_epoch(history(spark, [.5, .7]), 1).first().best_value == .7


def test_best_epoch_null_when_never_above_zero(spark):
    r = hist.best_epoch(history(spark, [0.0, 0.0, 0.0]), 3).first()
    assert r.best_step is None and r.best_value is None


def test_events_history_stops(spark, sf_small):
    from lectern.sources.adapters import metric_history

    stops = {r.run: r.stop_step for r in hist.early_stop(metric_history(spark, "/root/testdata/sf0.01"), 3).collect()}
    assert stops == {"click": 4, "error": 5, "view": 4, "signup": 4, "purchase": 8}


def test_empty_history_raises(spark):
    empty = spark.createDataFrame([], "run string, step long, key string, value double")
    with pytest.raises(ValueError):
        hist.require_history(empty)


def test_config_rows_fall_back(spark):
    h = history(spark, [.5, .6])
    rows = hist.report_config_rows(h, hist.run_params(h)).orderBy("position").collect()
    assert len(rows) == 9
    assert {r.parameter: r.value for r in rows}["Epochs"] == "2"
    assert {r.parameter: r.value for r in rows}["Batch size"] == "8"


def test_loss_keeps_confident_errors(spark):
    from lectern.operators import evaluate as ev

    rows = [(0, [800.0, 0.0], [1.0, 0.0], 1), (1, [0.0, 0.0], [0.5, 0.5], 0), (2, [0.0, 0.0], [0.5, 0.5], 1)]
    df = spark.createDataFrame(rows, "doc_id long, z array<double>, probs array<double>, y long")
    r = ev.log_loss_batched(df, 2).first()
    assert r.n_rows == 3 and abs(r.loss_rows - (800 + 2 * 0.693147) / 3) < 1e-5
    r = ev.log_loss_batched(df.drop("z"), 2).first()
    assert r.loss_rows > 200
