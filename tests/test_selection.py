"""Selection by narrowing against numpy and plain sorting; thresholds against ranks."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import selection
from lectern.operators.quantiles import box_stats, exact_quantiles
from lectern.operators.splits import stratified_split_exact

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def odd_groups():
    rng = np.random.default_rng(3)
    return {
        "normal": rng.normal(size=301).tolist(),
        "whole": [float(x) for x in rng.integers(0, 9, 200)],
        "one": [7.5],
        "same": [2.0] * 50,
        "hot": [1.0] * 900 + rng.normal(size=100).tolist(),
        "wide": [10.0 ** k for k in range(-300, 301, 12)] + [-(10.0 ** k) for k in range(-300, 301, 25)],
        "edge": [-1.7e308, 1.7e308, 0.0, -0.0, 5e-324, -5e-324, 1.0, 1.0 + 2 ** -52],
        None: [3.0, 1.0, 2.0],
    }


@pytest.mark.parametrize("pieces", [11, 1 << 16])
def test_quantiles_equal_numpy(spark, monkeypatch, pieces):
    monkeypatch.setattr(selection, "PIECES", pieces)
    groups = odd_groups()
    if pieces == 11:
        groups = {g: groups[g] for g in ("whole", "one", "hot", None)}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("normal", None), ("empty", None), ("whole", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", PROBS, [f"p{i}" for i in range(len(PROBS))]).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        ordered = sorted(vs)
        for i, p in enumerate(PROBS):
            at = p * (len(vs) - 1)
            lo, hi = ordered[math.floor(at)], ordered[math.ceil(at)]
            want = lo if lo == hi else lo + (at - math.floor(at)) * (hi - lo)
            assert got[g][f"p{i}"] == pytest.approx(want, rel=1e-12, abs=0), (g, p)
            if g in ("normal", "hot"):
                assert math.isclose(got[g][f"p{i}"], float(np.quantile(vs, p)), abs_tol=1e-12)


def test_infinite_values_and_no_groups(spark):
    vs = [float("-inf"), 1.0, 2.0, 3.0, float("inf")]
    r = exact_quantiles(spark.createDataFrame([(v,) for v in vs], "v double"), [], "v", [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    assert tuple(r) == (1.0, 2.0, 3.0)
    assert box_stats(spark.createDataFrame([(v,) for v in vs[1:4]], "v double"), [], "v").first().median == 2.0
    assert box_stats(spark.createDataFrame([], "g string, v double"), ["g"], "v").collect() == []


def test_a_value_in_most_rows_is_one_row_of_counts(spark):
    """What the rounds read is the counted table: a value that fills the input is a single row of it."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5).cast("double").alias("v"), F.lit("g").alias("g"))
    r = box_stats(df, ["g"], "v").first()
    assert (r.q1, r.median, r.q3, r.n) == (5.0, 5.0, 5.0, 20_000)


def brute_split(rows, seed="42"):
    out = {}
    for c in {c for _, c in rows}:
        keys = sorted((k for k, x in rows if x == c), key=lambda k: (k is not None, hashlib.md5(f"{seed}{k}".encode()).hexdigest()))
        t = int(len(keys) * 0.1 + 0.5)
        v = int((len(keys) - t) * 0.111 + 0.5)
        for i, k in enumerate(keys):
            out[c, k] = "test" if i < t else "val" if i < t + v else "train"
    return out


@pytest.mark.parametrize("digits", [1, 4, 32])
def test_split_equals_ranks(spark, monkeypatch, digits):
    monkeypatch.setattr(selection, "DIGITS", digits)
    rows = [(i, "a" if i % 3 else "b") for i in range(700)] + [(1000 + i, "few") for i in range(4)] + [(2000 + i, None) for i in range(30)]
    rows += [(3000, "one"), (None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, category string").repartition(6)
    got = {(r.category, r.doc_id): r.split for r in stratified_split_exact(df).collect()}
    assert got == brute_split(rows)


def test_rows_of_one_key_share_a_split(spark):
    df = spark.createDataFrame([(i // 25, "a") for i in range(500)], "doc_id long, category string")
    got = {(r.doc_id, r.split) for r in stratified_split_exact(df).select("doc_id", "split").collect()}
    assert len(got) == 20 and {s for _, s in got} == {"train", "val", "test"}
    assert stratified_split_exact(df.limit(0)).collect() == []


def test_split_moves_no_row(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a").alias("category"))
    plan = stratified_split_exact(df)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan and "Window" not in plan
