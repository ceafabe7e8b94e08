"""Sinks and end-to-end jobs: counts, idempotent reruns, once-only streaming."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lectern import schemas
from lectern.labels import LANG2ID, LANG_CLASSES
from lectern.operators import naive_bayes, splits
from lectern.plans import jobs
from lectern.sources import requests, sinks
from lectern.sources.articles import docs_articles, scan_articles

NOW = dt.datetime(2024, 1, 8, 6, 30, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    return docs_articles(spark, sf_small).cache()


@pytest.fixture(scope="module")
def model(docs):
    a = scan_articles(docs, LANG2ID)
    return naive_bayes.train_nb(splits.filter_split(splits.stratified_split(a), "train"), LANG_CLASSES)


def test_daily_rerun_has_no_duplicates(spark, docs, model, tmp_path):
    path = str(tmp_path / "daily")
    n1 = jobs.job_daily_inference(spark, docs, model, path, day=3, now=NOW)
    n2 = jobs.job_daily_inference(spark, docs, model, path, day=3, now=NOW)
    n3 = jobs.job_daily_inference(spark, docs, model, path, day=4, now=NOW)
    t = spark.read.parquet(path)
    assert n1 == n2 > 0
    assert t.count() == n1 + n3
    assert t.select("doc_id").distinct().count() == n1 + n3


def test_daily_default_day_from_date(spark, docs, model, tmp_path):
    path = str(tmp_path / "daily2")
    jobs.job_daily_inference(spark, docs, model, path, now=dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc))
    assert {r.day_partition for r in spark.read.parquet(path).select("day_partition").distinct().collect()} == {0}


def test_daily_schema_fixed(spark, docs, model, tmp_path):
    out = jobs.daily_frame(docs, model, 5, NOW)
    assert [f.name for f in out.schema.fields] == [f.name for f in schemas.daily_prediction(LANG_CLASSES).fields]


def test_sample_append_counts(spark, docs, model, tmp_path):
    path = str(tmp_path / "sample")
    assert jobs.job_sample_inference(spark, docs, model, path, n=10) == 10
    assert jobs.job_sample_inference(spark, docs, model, path, n=10) == 10
    assert spark.read.parquet(path).count() == 20


def test_sample_empty_fetch_raises(spark, docs, model, tmp_path):
    with pytest.raises(ValueError):
        jobs.job_sample_inference(spark, docs.where("false"), model, str(tmp_path / "x"))


def test_append_rejects_missing_columns(spark, docs, tmp_path):
    with pytest.raises(ValueError):
        sinks.sink_append(docs.select("doc_id"), str(tmp_path / "bad"), schemas.SAMPLE_PREDICTION)


def test_split_paths_share_one_stamp(spark, docs, tmp_path):
    a = scan_articles(docs, LANG2ID)
    paths = sinks.sink_splits(splits.stratified_split(a), str(tmp_path / "proc"), NOW)
    assert {os.path.dirname(p) for k, p in paths.items() if k != "run_dir"} == {paths["run_dir"]}
    assert paths["run_dir"].endswith("2024-01-08T06-30-00")
    assert spark.read.parquet(paths["run_dir"]).count() == a.count()


def test_job_train_end_to_end(spark, docs, tmp_path):
    out = jobs.job_train(spark, docs, LANG2ID, str(tmp_path / "train"), now=NOW)
    rep = {r.label: r for r in out["report"].collect()}
    assert set(LANG_CLASSES) <= set(rep)
    assert 0.0 <= rep["accuracy"].f1_score <= 1.0
    ev = out["evaluation"].first()
    assert ev.n_rows == spark.read.parquet(out["predictions"]).count()


def test_request_round_trip_and_empty_rejected(spark, model):
    req = spark.createDataFrame([(1, 0, '{"instances":[{"text":"the cat"},{"text":"le chat"}]}'),
                                 (2, 0, '{"instances":[]}')], "conv_id long, chunk long, request string")
    rows, rejected = requests.request_json(req)
    assert [(r.conv_id, r.pos, r.text) for r in rows.orderBy("pos").collect()] == [(1, 0, "the cat"), (1, 1, "le chat")]
    assert [r.reason for r in rejected.collect()] == ["instances list is empty"]
    scored = naive_bayes.score_nb(model, rows, key_col=["conv_id", "chunk", "pos"])
    resp = requests.response_json(scored, model.class_names).first().response
    import json

    preds = json.loads(resp)["predictions"]
    assert len(preds) == 2 and set(preds[0]) == {"label", "confidence", "scores"}
    back = requests.response_rows(requests.response_json(scored, model.class_names), model.class_names).orderBy("pos").collect()
    assert [(r.conv_id, r.chunk, r.pos, r.label) for r in back] == [(1, 0, k, p["label"]) for k, p in enumerate(preds)]


def test_requests_are_taken_or_rejected_whole(spark):
    req = spark.createDataFrame([(1, 0, "not json"), (2, 0, None), (3, 0, '{"instances":[{"text":"a"},{"txt":"b"}]}'),
                                 (4, 0, '{"instances":[{"text":""}]}'), (5, 0, '{"instances":{}}')],
                                "conv_id long, chunk long, request string")
    rows, rejected = requests.request_json(req)
    assert [(r.conv_id, r.pos, r.text) for r in rows.collect()] == [(4, 0, "")]
    got = {r.conv_id: r.reason for r in rejected.collect()}
    assert got.pop(3) == "instance without text" and got.pop(5) and set(got.values()) == {"malformed request"} and len(got) == 2


def test_rows_of_several_keys_score_as_rows_of_one(spark, model, monkeypatch):
    """The broadcast and the shuffled look-up give the same scores under a key of three columns."""
    rows = spark.createDataFrame([(k % 3, 0, k, "le chat " * (k % 4) + "the cat") for k in range(40)],
                                 "conv_id long, chunk long, pos long, text string")
    one = {r.pos: r.z for r in naive_bayes.class_scores(model, rows, key_col="pos").collect()}
    for broadcast in (True, False):
        monkeypatch.setattr(naive_bayes, "terms_broadcastable", lambda m, b=broadcast: b)
        got = naive_bayes.class_scores(model, rows, key_col=["conv_id", "chunk", "pos"]).collect()
        assert len(got) == 40 and all(r.z == pytest.approx(one[r.pos]) for r in got)  # a class without rows has -inf


def test_stream_appends_each_file_once(spark, docs, model, tmp_path):
    from lectern.streaming.score_append import stream_score_append

    src = str(tmp_path / "src")
    d = docs.where("body IS NOT NULL")
    d.repartition(3, "doc_id").write.parquet(src)
    sink, ck = str(tmp_path / "sink"), str(tmp_path / "ck")
    stream_score_append(spark, src, d.schema, model, sink, ck)
    stream_score_append(spark, src, d.schema, model, sink, ck)
    out = spark.read.parquet(sink)
    assert out.count() == d.count() == out.select("doc_id").distinct().count()


def test_stream_with_another_checkpoint_adds(spark, docs, model, tmp_path):
    from lectern.streaming.score_append import stream_score_append

    d = docs.where("body IS NOT NULL")
    sink, n = str(tmp_path / "sink"), 0
    for name, part in (("a", "doc_id % 2 = 0"), ("b", "doc_id % 2 = 1")):
        src = str(tmp_path / name)
        d.where(part).write.parquet(src)
        stream_score_append(spark, src, d.schema, model, sink, str(tmp_path / f"ck-{name}"))
        n += d.where(part).count()
    out = spark.read.parquet(sink)
    assert out.count() == n == d.count() == out.select("doc_id").distinct().count()
