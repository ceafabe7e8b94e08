"""Requests arriving as files: answered once, rejects apart, restarts and replays add nothing."""

import json

import pytest
from pyspark.sql.types import StructType

from lectern.operators import naive_bayes
from lectern.sources.requests import response_rows
from lectern.streaming.request_stream import split_requests, stream_requests

IDS = StructType().add("conv_id", "long").add("chunk", "long")


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the cat sat", "en"), ("the dog ran", "en"), ("le chat dort", "fr"), ("der hund", "de"), ("el gato", "es")]
    train = spark.createDataFrame(rows * 3, "text string, category string")
    return naive_bayes.train_nb(train, {"de": 0, "en": 1, "es": 2, "fr": 3})


def line(conv, *texts, chunk=0):
    return json.dumps({"conv_id": conv, "chunk": chunk, "instances": [{"text": t} for t in texts]})


def split(spark, lines):
    df = spark.createDataFrame([(v, "f") for v in lines], "value string, file string")
    rows, rejects = split_requests(df, IDS)
    return (sorted((r.conv_id, r.chunk, r.pos, r.text) for r in rows.collect()),
            sorted(((r.conv_id, r.reason) for r in rejects.collect()), key=str))


def test_lines_are_split_into_instances_and_rejects(spark):
    rows, rejects = split(spark, [
        line(1, "a", "b"), line(1, "a", "b"),  # repeated: answered once
        line(2, "x"), line(2, "y"),            # one id, two requests
        line(3), "no json", "", "   ", None, '{"instances":[{"text":"t"}]}',
        '{"conv_id":4,"chunk":0,"instances":[{"text":null}]}', line(5, ""), line(1, "c", chunk=1)])
    assert rows == [(1, 0, 0, "a"), (1, 0, 1, "b"), (1, 1, 0, "c"), (5, 0, 0, "")]
    assert rejects == sorted([(2, "id used for different requests"), (3, "instances list is empty"),
                              (4, "instance without text"), (None, "request without id"), (None, "request without id")], key=str)


def test_no_lines(spark):
    assert split(spark, []) == ([], [])


def test_each_file_is_answered_once(spark, model, tmp_path):
    src, out, bad, mark = (str(tmp_path / d) for d in ("src", "out", "bad", "mark"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.jsonl").write_text("\n".join([line(1, "the cat", "le chat"), "broken"]))
    stream_requests(spark, src, model, out, bad, mark)
    (tmp_path / "src" / "b.jsonl").write_text(line(2, "der hund"))
    for _ in range(2):  # the second run finds nothing new
        stream_requests(spark, src, model, out, bad, mark)
    got = response_rows(spark.read.parquet(out), model.class_names).collect()
    assert sorted((r.conv_id, r.pos, r.label) for r in got) == [(1, 0, "en"), (1, 1, "fr"), (2, 0, "de")]
    rejected = spark.read.parquet(bad).collect()
    assert [(r.file, r.request, r.reason) for r in rejected] == [("a.jsonl", "broken", "request without id")]
