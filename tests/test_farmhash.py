"""FarmHash fingerprints against published values and against the public Java implementation that Spark ships."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions.farmhash import farm_fingerprint, farm_fingerprints
from lectern.labels import LANG2ID
from lectern.operators import sampling, splits
from lectern.sources.articles import docs_articles, scan_articles


def own(strings):
    sizes = np.array([len(s) for s in strings])
    return farm_fingerprints(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes).tolist()


@pytest.fixture(scope="module")
def public(spark):
    hashing = spark._jvm.com.google.common.hash.Hashing.farmHashFingerprint64()
    return lambda s: hashing.hashBytes(s).asLong()


def test_published_values():
    assert own([b"1footrue", b"2applefalse", b"3true"]) == [-1541654101129638711, 2794438866806483259, -4880158226897771312]


def test_every_length(public):
    rng = random.Random(1)
    strings = [rng.randbytes(n) for n in range(0, 330)] + [rng.randbytes(n) for n in (1000, 4095, 4096, 4097, 20_000)]
    assert own(strings) == [public(s) for s in strings]


def test_column(spark, public):
    texts = [None, "", "a", "é" * 40, "日本語" * 100, "same", "same", "x" * 64, "x" * 65]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(3)
    got = {r.i: r.fp for r in df.select("i", farm_fingerprint("t").alias("fp")).collect()}
    assert got == {i: None if t is None else public(t.encode()) for i, t in enumerate(texts)}
    assert df.where("false").select(farm_fingerprint("t")).collect() == []


def test_split_and_sample_by_fingerprint(spark, sf_small, public):
    a = scan_articles(docs_articles(spark, sf_small), LANG2ID).select("doc_id", "title", "category")
    rows = a.collect()
    want = {}
    for c in {r.category for r in rows}:
        mine = sorted((r for r in rows if r.category == c), key=lambda r: (public(r.title.encode()), r.doc_id))
        for i, r in enumerate(mine, 1):
            want[r.doc_id] = "test" if i % 100 < 10 else "val" if i % 100 < 20 else "train"
    got = {r.doc_id: r.split for r in splits.stratified_split(a, digest=farm_fingerprint).collect()}
    assert got == want
    kept = {r.doc_id for r in sampling.sample_hash_row(a, 60, len(rows), digest=farm_fingerprint).collect()}
    pct = min(round(60 / len(rows) * 100), 100)
    assert kept == {r.doc_id for r in rows if abs(public(str(r.doc_id).encode())) % 100 < pct}
    kept = {r.category for r in sampling.sample_hash_label(a, 60, len(rows), digest=farm_fingerprint).collect()}
    assert kept == {r.category for r in rows if abs(public(r.category.encode())) % 100 < pct}
