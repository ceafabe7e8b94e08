"""Classifiers: NB against a brute-force computation, probability properties,
schema with / without labels, save + load, external model hook."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.labels import LANG2ID, LANG_CLASSES
from lectern.operators import encode, naive_bayes, splits
from lectern.sources.articles import docs_articles, scan_articles


@pytest.fixture(scope="module")
def split(spark, sf_small):
    a = scan_articles(docs_articles(spark, sf_small), LANG2ID).select("doc_id", "title", "category", "text")
    return splits.stratified_split(a).cache()


@pytest.fixture(scope="module")
def model(split):
    return naive_bayes.train_nb(splits.filter_split(split, "train"), LANG_CLASSES)


def test_nb_equals_brute_force(spark, split, model):
    import regex

    tok = lambda s: [t for t in regex.split(r"[^\p{L}]+", s.lower()) if t]
    train = splits.filter_split(split, "train").collect()
    test = splits.filter_split(split, "test").limit(15).collect()
    counts = {c: Counter() for c in LANG_CLASSES}
    docs = Counter()
    for r in train:
        counts[r.category].update(tok(r.text))
        docs[r.category] += 1
    vocab = set().union(*counts.values())
    totals = {c: sum(counts[c].values()) for c in LANG_CLASSES}
    got = {r.doc_id: r for r in naive_bayes.score_nb(model, spark.createDataFrame(test)).collect()}
    for r in test:
        z = []
        for c in LANG_CLASSES:
            s = math.log(docs[c] / len(train)) if docs[c] else -math.inf
            for t in tok(r.text):
                if t in vocab:
                    s += math.log((counts[c][t] + 1) / (totals[c] + len(vocab)))
            z.append(s)
        best = max(range(len(z)), key=lambda i: (z[i], -i))
        assert got[r.doc_id].pred == best
        for a, b in zip(got[r.doc_id].z, z):
            assert a == b if math.isinf(b) else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


def test_probabilities_valid(spark, split, model):
    out = naive_bayes.score_nb(model, splits.filter_split(split, "test"), keep=["category"]).collect()
    assert out
    for r in out:
        assert math.isclose(sum(r.probs), 1.0, rel_tol=1e-9)
        assert 0.0 <= r.confidence <= 1.0
        assert 0 <= r.pred < len(LANG_CLASSES)


def test_rows_and_columns_preserved(spark, split, model):
    test = splits.filter_split(split, "test")
    out = naive_bayes.score_nb(model, test, keep=["title", "category"])
    assert out.count() == test.count()
    assert {"doc_id", "title", "category", "predicted_label", "confidence"} <= set(out.columns)


def test_tokenless_document_kept(spark, model):
    df = spark.createDataFrame([(1, "123 456"), (2, "")], "doc_id long, text string")
    out = {r.doc_id: r for r in naive_bayes.score_nb(model, df).collect()}
    assert set(out) == {1, 2}
    assert out[1].pred == out[2].pred == max(range(len(model.log_prior)), key=lambda i: (model.log_prior[i], -i))


def test_schema_with_and_without_labels(split, model):
    from lectern.plans.jobs import predictions_frame

    scored = naive_bayes.score_nb(model, splits.filter_split(split, "test"), keep=["category"])
    assert {"true_label", "correct"} <= set(predictions_frame(scored, LANG_CLASSES, True).columns)
    assert not {"true_label", "correct"} & set(predictions_frame(scored, LANG_CLASSES, False).columns)


def test_model_roundtrip(spark, split, model, tmp_path):
    path = str(tmp_path / "nb")
    model.save(path)
    back = naive_bayes.NaiveBayesModel.load(spark, path)
    test = splits.filter_split(split, "test")
    a = {r.doc_id: r.pred for r in naive_bayes.score_nb(model, test).collect()}
    b = {r.doc_id: r.pred for r in naive_bayes.score_nb(back, test).collect()}
    assert a == b and back.vocab_size == model.vocab_size


def test_external_model_hook(spark, sf_small):
    from lectern.operators.external import score_external_model
    from lectern.plans.q_model import make_linear_logits
    from lectern.labels import TOPIC_CLASSES

    e = spark.read.parquet(f"{sf_small}/embeddings.parquet").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("x"))
    out = score_external_model(e, make_linear_logits, "x", 64, TOPIC_CLASSES, batch_size=7)
    assert out.count() == e.count()
    r = out.first()
    assert math.isclose(sum(r.probs), 1.0, rel_tol=1e-9)


def test_vocab_reserved_ids_and_head_tail(spark):
    df = spark.createDataFrame([(1, "b a a c")], "doc_id long, text string")
    v = {r.token: r.token_id for r in encode.build_vocab(df).collect()}
    assert v == {"a": 4, "b": 5, "c": 6}
    ids = spark.createDataFrame([(list(range(511)),), (list(range(510)),)], "ids array<long>")
    kept = [r.k for r in ids.select(encode.head_tail(F.col("ids")).alias("k")).collect()]
    assert kept[0] == list(range(340)) + list(range(341, 511))
    assert kept[1] == list(range(510))


def test_truncate_pad_mask(spark):
    df = spark.createDataFrame([(1, "b a a c")], "doc_id long, text string")
    vocab = encode.build_vocab(df)
    e = encode.encode_truncate_pad(encode.tokenize(df), vocab, max_length=5).first()
    assert e.input_ids == [2, 5, 4, 4, 3] and e.attention_mask == [1, 1, 1, 1, 1]
    e = encode.encode_truncate_pad(encode.tokenize(df), vocab, max_length=8).first()
    assert e.input_ids == [2, 5, 4, 4, 6, 3, 0, 0] and e.attention_mask == [1] * 6 + [0, 0]


def test_salted_scoring_equals_broadcast(spark, split, model, monkeypatch):
    test = splits.filter_split(split, "test")
    by_broadcast = {r.doc_id: r for r in naive_bayes.score_nb(model, test, keep=["category"]).collect()}
    monkeypatch.setattr(naive_bayes, "BROADCAST_TERMS_BYTES", 0)
    assert not naive_bayes.terms_broadcastable(model)
    by_shuffle = {r.doc_id: r for r in naive_bayes.score_nb(model, test, keep=["category"]).collect()}
    assert set(by_broadcast) == set(by_shuffle)
    for k, r in by_broadcast.items():
        s = by_shuffle[k]
        assert (r.pred, r.category) == (s.pred, s.category)
        for a, b in zip(r.z, s.z):
            assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_salted_encoding_equals_broadcast(spark, split, monkeypatch):
    docs = encode.tokenize(split.select("doc_id", "text"))
    vocab = encode.build_vocab(splits.filter_split(split, "train"))

    def run():
        e = encode.encode_head_tail(docs, vocab, max_length=32, head=20, tail=10)
        j = encode.join_vocab(docs, vocab)
        return (sorted((r.doc_id, r.n_tokens, tuple(r.input_ids)) for r in e.collect()),
                sorted(tuple(r) for r in j.collect()))

    by_broadcast = run()
    monkeypatch.setattr(encode, "PACKED_WORDS", 0)
    assert run() == by_broadcast


@pytest.mark.parametrize("max_words", [8_000_000, 4])
def test_large_vocabulary_scores_inside_the_row(spark, monkeypatch, max_words):
    rows = [(i, c, f"common word{i % 5} {c}thing " + "x y " * (i % 3)) for i, c in enumerate(LANG_CLASSES * 6)]
    train = spark.createDataFrame(rows, "doc_id long, category string, text string")
    df = spark.createDataFrame([(1, "common enthing enthing stranger"), (2, None), (3, ""), (4, "strangers alone"), (5, "x " * 5_000 + "stranger " * 65_000 + "dething"),
                                (6, "y"), (6, "x frthing"), (None, "word1")], "doc_id long, text string")

    def scores(model, **kw):
        out = naive_bayes.class_scores(model, df, **kw)
        return out, sorted([(r.doc_id, [round(x, 4) for x in r.z]) for r in out.collect()], key=str)

    sent = naive_bayes.train_nb(train, LANG_CLASSES)
    expected, kept = scores(sent)[1], scores(sent, keep=["text"])[1]
    monkeypatch.setattr(naive_bayes, "BROADCAST_VOCAB_ROWS", 0)
    monkeypatch.setattr(naive_bayes, "MAX_WORDS", max_words)
    model = naive_bayes.train_nb(train, LANG_CLASSES)
    out, got = scores(model)
    assert got == expected and scores(model, keep=["text"])[1] == kept
    assert len(model.packs) == -(-model.vocab_size // max_words)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan  # no token leaves its row
    monkeypatch.setattr(naive_bayes, "MAX_PACKS", 0)
    assert scores(naive_bayes.train_nb(train, LANG_CLASSES))[1] == expected


def test_mllib_training_reads_the_texts_once(spark):
    from pyspark.ml.feature import IDFModel

    from lectern.operators import mllib_model

    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    rows = [(f"{word} {word} and", lang) for word, lang in (("haus", "de"), ("house", "en")) for _ in range(4)] + [("x", "xx")]
    train = spark.createDataFrame(rows, "text string, category string").coalesce(1)
    model = mllib_model.train_mllib(train.withColumn("text", seen("text")), ["de", "en"], num_features=64, max_iter=5)
    assert read.value <= len(rows)
    whole = mllib_model.build_pipeline(["de", "en"], num_features=64, max_iter=5).fit(train)
    assert [type(stage) for stage in model.stages] == [type(stage) for stage in whole.stages]
    idfs = [stage.idf.toArray().tolist() for m in (model, whole) for stage in m.stages if isinstance(stage, IDFModel)]
    assert idfs[0] == idfs[1]
    assert mllib_model.objective_history(model) == pytest.approx(mllib_model.objective_history(whole))
