"""Training over epochs against a numpy version; the keyed permutation against itself run row by row."""

import os
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.labels import LANG2ID, LANG_CLASSES
from lectern.operators import epoch_order as eo
from lectern.operators import epoch_trainer as et
from lectern.operators import history as hist
from lectern.operators.splits import filter_split, stratified_split
from lectern.plans import jobs
from lectern.plans.oracle_check import compare, duckdb_con
from lectern.plans.registry import load_all
from lectern.session import ensure_checkpoint_dir
from lectern.sources.articles import docs_articles, scan_articles

CONFIG = et.TrainConfig(epochs=3, batch_size=40, num_features=512, lr=0.1, warmup_steps=2)


def walked(n, seed, epoch):
    keys = eo.round_keys(seed, epoch)
    at = eo.permute_once(np.arange(n, dtype=np.int64), n, keys)
    while (at >= n).any():
        out = at >= n
        at[out] = eo.permute_once(at[out], n, keys)
    return at


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 17, 99, 100, 1000, 4097, 10007])
def test_places_are_a_permutation(spark, n):
    orders = [walked(n, 42, e) for e in (1, 2, 3)]
    for order in orders:
        assert sorted(order.tolist()) == list(range(n))
    if n > 16:
        assert len({tuple(o) for o in orders}) == 3
    got = eo.epoch_places(spark.range(n).withColumnRenamed("id", "row"), n, 2, 8).orderBy("row").collect()
    assert [r.place for r in got] == orders[1].tolist() and all(r.batch == r.place // 8 for r in got)


def test_places_need_no_exchange(spark):
    plan = eo.epoch_places(spark.range(100).withColumnRenamed("id", "row"), 100, 1, 8)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_walks_of_huge_tables_are_few():
    for n in (10**9 + 7, 10**12):
        assert eo.walks(n, eo.round_keys(42, 1)) <= 4


def test_places_equal_sql(spark, sf_small):
    load_all()
    assert compare(spark, "epoch_places", sf_small, duckdb_con(sf_small))["status"] == "match"


@pytest.fixture(scope="module")
def parts(spark, sf_small):
    s = stratified_split(scan_articles(docs_articles(spark, sf_small), LANG2ID)).select("doc_id", "category", "text", "split").cache()
    return filter_split(s, "train"), filter_split(s, "val")


def dense(spark, rows, size):
    """(X, y) in order of doc_id: unit-length hashed counts and a column of ones, by plain Python."""
    rows = rows.orderBy("doc_id").collect()
    words = [[w for w in re.split(r"[\W\d_]+", r.text.lower()) if w] for r in rows]
    known = sorted({w for ws in words for w in ws})
    slot = {r.w: r.s for r in spark.createDataFrame([(w,) for w in known], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(size)).alias("s")).collect()}
    x = np.zeros((len(rows), size + 1))
    for i, ws in enumerate(words):
        for w, c in Counter(ws).items():
            x[i, slot[w]] += c
        norm = np.sqrt((x[i] ** 2).sum())
        x[i] /= norm or 1.0
        x[i, size] = 1.0
    return x, np.array([LANG_CLASSES.index(r.category) for r in rows])


def numpy_training(x, y, xv, yv, config):
    n, k = len(x), 4
    steps = -(-n // config.batch_size)
    w, m, v, t, log = np.zeros((x.shape[1], k)), 0.0, 0.0, 0, []

    def scores(w, x, y):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return p, -np.log(p[np.arange(len(y)), y]), z.argmax(axis=1) == y

    for epoch in range(1, config.epochs + 1):
        place, losses, right = walked(n, config.seed, epoch), [], 0
        for b in range(steps):
            at = np.flatnonzero(place // config.batch_size == b)
            p, loss, ok = scores(w, x[at], y[at])
            losses.append(loss.mean())
            right += ok.sum()
            p[np.arange(len(at)), y[at]] -= 1
            g = x[at].T @ p / len(at)
            g = g * min(1.0, config.clip_norm / np.sqrt((g * g).sum()))
            total = steps * config.epochs
            warm = config.warmup_steps
            rate = config.lr * (t / warm if t < warm else (total - t) / max(1, total - warm))
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w * (1 - rate * config.weight_decay) - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        _, loss, ok = scores(w, xv, yv)
        batches = [loss[i:i + config.batch_size].mean() for i in range(0, len(loss), config.batch_size)]
        log.append((np.mean(losses), right / n, np.mean(batches), ok.mean()))
    return w, log


def table(history):
    got = {(r.step, r.key): r.value for r in history.collect()}
    return [tuple(got[e, k] for k in ("train_loss", "train_acc", "val_loss", "val_acc")) for e in sorted({e for e, _ in got})]


def test_training_equals_numpy_and_any_partitioning(spark, parts, tmp_path):
    runs = []
    for p in (1, 4, 32):
        model, history = et.train_epochs(*(x.repartition(p) for x in parts), LANG_CLASSES, str(tmp_path / f"run{p}"), CONFIG)
        runs.append((model.weights.tobytes(), table(history)))
    assert runs[0] == runs[1] == runs[2]
    tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    assert not [t for t in os.listdir(tables) if t.startswith("epoch-batches")]  # an epoch's batches go with it
    x, y = dense(spark, parts[0], CONFIG.num_features)
    w, log = numpy_training(x, y, *dense(spark, parts[1], CONFIG.num_features), CONFIG)
    assert np.allclose(np.array(log), np.array(runs[0][1]), atol=1e-6)
    best = int(np.argmax([r[3] for r in log])) + 1
    if best == CONFIG.epochs:
        assert np.allclose(w, np.frombuffer(runs[0][0]).reshape(w.shape), atol=1e-5)


def test_best_epoch_restored_and_run_resumed(spark, parts, tmp_path, monkeypatch):
    accuracy = iter([0.8, 0.6])
    monkeypatch.setattr(et, "evaluate_rows", lambda *a: (1.0, next(accuracy)))
    config = et.TrainConfig(epochs=5, batch_size=80, num_features=64, patience=1)
    model, history = et.train_epochs(*parts, LANG_CLASSES, str(tmp_path / "a"), config)
    assert [r[3] for r in table(history)] == [0.8, 0.6]  # stopped after the second epoch
    first = et._read_state(spark, et.Run(spark, str(tmp_path / "a")).state(1), 3, model.weights.shape)[0]
    assert (model.weights == first).all()
    again, same = et.train_epochs(*parts, LANG_CLASSES, str(tmp_path / "a"), config)  # nothing left to train
    assert (again.weights == model.weights).all() and table(same) == table(history)
    monkeypatch.undo()

    whole, _ = et.train_epochs(*parts, LANG_CLASSES, str(tmp_path / "b"), CONFIG)
    broken = iter([True, False])
    real = et._train_epoch
    monkeypatch.setattr(et, "_train_epoch", lambda *a: real(*a) if next(broken) else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        et.train_epochs(*parts, LANG_CLASSES, str(tmp_path / "c"), CONFIG)
    monkeypatch.undo()
    resumed, history = et.train_epochs(*parts, LANG_CLASSES, str(tmp_path / "c"), CONFIG)
    assert (resumed.weights == whole.weights).all() and len(table(history)) == CONFIG.epochs


@pytest.mark.parametrize("arrow", ["true", "false"])
def test_state_written_with_and_without_arrow(spark, tmp_path, arrow):
    before = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", arrow)
    try:
        given = [np.array([[0.0, 0.0], [0.271808013285187, -1.5], [0.0, 3e-17]]), np.zeros((3, 2)), np.eye(3, 2)]
        et._write_state(spark, str(tmp_path / "s"), given)
        assert all((a == b).all() for a, b in zip(given, et._read_state(spark, str(tmp_path / "s"), 3, (3, 2))))
        et._write_state(spark, str(tmp_path / "z"), [np.zeros((3, 2))])  # nothing but zeros: no rows
        assert not et._read_state(spark, str(tmp_path / "z"), 1, (3, 2))[0].any()
        df = spark.createDataFrame([(i, "en" if i % 2 else "fr", f"word{i % 2} word") for i in range(12)], "doc_id long, category string, text string")
        model, history = et.train_epochs(df, df, LANG_CLASSES, str(tmp_path / "r"), et.TrainConfig(epochs=2, batch_size=6, num_features=16, lr=0.1))
        assert len(table(history)) == 2 and et.score_epochs(model, df).where("predicted_label is null").count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", before)


def test_odd_rows(spark, tmp_path):
    rows = [(1, "en", "a b"), (1, "en", "a b"), (None, "fr", None), (2, "de", ""), (3, "xx", "left out"), (4, None, "left out")]
    df = spark.createDataFrame(rows, "doc_id long, category string, text string")
    config = et.TrainConfig(epochs=2, batch_size=3, num_features=16)
    model, history = et.train_epochs(df, df.limit(0), LANG_CLASSES, str(tmp_path / "r"), config)
    assert len(table(history)) == 2 and model.weights.any()  # no validation rows: the last epoch's parameters
    out = et.score_epochs(model, df, keep=["category"]).collect()
    assert len(out) == 6 and all(abs(sum(r.probs) - 1) < 1e-12 for r in out)
    assert et.score_epochs(model, df.limit(0)).count() == 0


def test_job_trains_over_epochs_with_history(spark, sf_small, tmp_path):
    out = jobs.job_train(spark, docs_articles(spark, sf_small), LANG2ID, str(tmp_path / "t"), trainer="epochs", use_title=True,
                         sample_size=150, config=et.TrainConfig(epochs=4, batch_size=30, num_features=256, patience=2))
    logged = spark.read.parquet(out["history"])
    series = logged.where("step > 0")
    stop = hist.early_stop(series, patience=2).first()
    assert stop.stop_step == series.agg(F.max("step")).first()[0] and stop.best_step >= 1
    assert {r.key for r in logged.where("step = 0").collect()} >= {f"test_{c}_precision" for c in LANG_CLASSES}
    ev = out["evaluation"].first()
    assert 0 < ev.n_rows == spark.read.parquet(out["predictions"]).count() < 40 and 0.0 <= ev.accuracy <= 1.0
