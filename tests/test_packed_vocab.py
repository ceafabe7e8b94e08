"""The packed vocabulary: every word found, no stranger mistaken, no token shuffled."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import encode, packed_vocab as pv


@pytest.mark.parametrize("n", [1, 2, 3, 10, 100, 4096, 9000])
def test_group_is_minimal_and_perfect(n):
    h = np.random.default_rng(n).integers(-2**63, 2**63 - 1, n)
    seeds, place = pv.build_group(h)
    assert sorted(place.tolist()) == list(range(n)) and len(seeds) == n // 2 + 1


def test_one_hash_twice_fails():
    with pytest.raises(ValueError):
        pv.build_group(np.array([5, 7, 5]))


def test_words_found_and_a_million_strangers_not(spark, monkeypatch):
    monkeypatch.setattr(pv, "GROUP", 500)
    vocab = spark.range(20_000).select(F.concat(F.lit("w"), "id").alias("token"), (F.col("id") + 4).alias("token_id"))
    packed = pv.pack_vocab(vocab)
    assert len(packed.hashes) == 20_000
    rows = vocab.select(F.xxhash64("token").alias("h"), "token_id").toPandas()
    assert (packed.lookup(rows["h"].to_numpy(), 1) == rows["token_id"].to_numpy()).all()
    strangers = spark.range(1_000_000).select(F.xxhash64(F.concat(F.lit("s"), "id")).alias("h")).toPandas()["h"].to_numpy()
    assert (packed.lookup(strangers, 1) == 1).all()


def test_long_batches_need_little_memory():
    rng = np.random.default_rng(5)
    h = rng.integers(-2**63, 2**63 - 1, 4000)
    seeds, place = pv.build_group(h)
    hashes, ids = np.empty_like(h), np.empty(4000, np.int64)
    hashes[place], ids[place] = h, np.arange(4000)
    packed = pv.PackedVocab(pv.narrow(seeds), hashes, pv.narrow(ids), np.array([0, len(seeds)]), np.array([0, 4000]))
    assert packed.seeds.dtype == packed.ids.dtype == np.int32 and pv.narrow(np.array([1 << 40])).dtype == np.int64
    many = np.tile(h, 1000)
    tracemalloc.start()
    found = packed.lookup(many, -1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found == np.tile(np.arange(4000), 1000)).all() and peak < 1.5 * many.nbytes


def test_small_and_empty_vocabularies(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["zz"])], "doc_id long, tokens array<string>")
    for words in ([], [("a", 4)], [("a", 4), ("b", 5)]):
        vocab = spark.createDataFrame(words, "token string, token_id long")
        known = dict(words)
        out = df.select("doc_id", pv.token_ids(df, pv.pack_vocab(vocab), F.col("tokens"), 1).alias("ids")).collect()
        assert {r.doc_id: r.ids for r in out} == {1: [known.get(t, 1) for t in "aba"], 2: [], 3: [], 4: [1]}


@pytest.mark.parametrize("fn", [encode.encode_truncate_pad, encode.encode_head_tail])
def test_packed_equals_join(spark, monkeypatch, fn):
    df = spark.createDataFrame([(1, "the cat sat on the mat " * 200), (2, ""), (3, "Éa unknown words here"), (4, "cat")], "doc_id long, text string")
    toks = encode.tokenize(df)
    vocab = encode.build_vocab(df.where("doc_id <> 3"))
    packed = sorted(fn(toks, vocab).collect())
    plan = fn(toks, vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    joined = sorted(encode.join_vocab(toks, vocab).collect())
    monkeypatch.setattr(encode, "PACKED_WORDS", 0)
    assert sorted(fn(toks, vocab).collect()) == packed
    assert sorted(encode.join_vocab(toks, vocab).collect()) == joined
