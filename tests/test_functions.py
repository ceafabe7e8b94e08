"""Hand-written cases (FIXTURES part 3) for the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from lectern.functions import scores, text, timefmt
from lectern.labels import ID2LABEL, LABEL2ID, TOPIC_CLASSES


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_label_dictionary_contiguous_and_invertible():
    assert len(LABEL2ID) == 5
    assert sorted(LABEL2ID.values()) == list(range(5))
    assert all(ID2LABEL[i] == c for c, i in LABEL2ID.items())
    assert TOPIC_CLASSES == sorted(TOPIC_CLASSES)


@pytest.mark.parametrize("value,expected", [("ﬁne", "fine"), ("ＡＢＣ", "ABC"), (None, None),
                                            ("ré", "ré")])
def test_nfkc(spark, value, expected):
    assert one(spark, text.nfkc(F.col("x")), value) == expected


@pytest.mark.parametrize("value,expected", [("x ", "x"), ("\t a \n b ", "a b")])
def test_trim_then_nfkc(spark, value, expected):
    assert one(spark, text.clean_title(F.col("x")), value) == expected


def test_entities_deleted_not_decoded(spark):
    out = one(spark, text.strip_entities(F.col("x")), "a&amp;b&#39;c&copy;")
    assert out == "a b c&copy;"
    assert one(spark, text.clean_text(F.col("x")), "a&amp;b&#39;c&copy;") == "a b c&copy;"


def test_bare_angle_bracket_run_removed(spark):
    assert one(spark, text.clean_text(F.col("x")), "1 < 2 > 0") == "1 0"


def test_label_encode_unknown_is_null_row_kept(spark):
    df = spark.createDataFrame([("tech",), ("weather",)], "c string")
    rows = df.select("c", scores.encode_label("c", LABEL2ID).alias("label")).collect()
    assert [(r.c, r.label) for r in rows] == [("tech", 4), ("weather", None)]


@pytest.mark.parametrize("a,b,pct", [(100, 1000, 10), (9999, 10, 100), (500, 2225, 22), (1, 1000, 0)])
def test_sample_pct(a, b, pct):
    assert timefmt.sample_pct(a, b) == pct


def test_sample_pct_requires_total():
    with pytest.raises(ValueError):
        timefmt.sample_pct(10, None)


@pytest.mark.parametrize("day,bucket", [(1, 0), (30, 29), (31, 0)])
def test_day_bucket(day, bucket):
    assert timefmt.day_bucket_of(day) == bucket


def test_day_bucket_argument_validated():
    with pytest.raises(ValueError):
        timefmt.validate_day(30)


def test_argmax_tie_gives_lowest(spark):
    assert one(spark, scores.argmax_label(F.col("x")), [0.0] * 5, "x array<double>") == 0


def test_softmax_sums_to_one(spark):
    probs = one(spark, scores.softmax(F.col("x")), [1.0, 2.0, 3.0, -1.0, 0.5], "x array<double>")
    assert math.isclose(sum(probs), 1.0, rel_tol=1e-12)
    assert all(p >= 0 for p in probs)


@pytest.mark.parametrize("value,expected", [("", 1), ("a  b", 3), (None, None)])
def test_word_count(spark, value, expected):
    assert one(spark, text.word_count(F.col("x")), value) == expected


def test_scores_wide_missing_class_is_zero(spark):
    df = spark.createDataFrame([({"tech": 0.9},)], "m map<string,double>")
    row = df.select(*scores.scores_wide(F.col("m"), TOPIC_CLASSES)).first()
    assert row["prob_tech"] == 0.9 and row["prob_business"] == 0.0


def test_safe_divide_null_on_zero(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 2)], "a double, b int")
    assert [r.r for r in df.select(scores.safe_divide("a", "b").alias("r")).collect()] == [None, 0.5]


def test_utc_stamp_format():
    import datetime as dt

    assert timefmt.utc_stamp_now(dt.datetime(2024, 3, 5, 7, 8, 9)) == "2024-03-05T07-08-09"
