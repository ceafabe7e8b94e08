"""Classifier training and scoring queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lectern.functions.scores import decode_label
from lectern.labels import LANG2ID, LANG_CLASSES, TOPIC_CLASSES
from lectern.operators import epoch_trainer, external, mllib_model, naive_bayes
from lectern.operators.sizing import stable_table
from lectern.operators.splits import filter_split, stratified_split
from lectern.plans.registry import register
from lectern.plans.views import LOGITS, RANKED, TOPIC_NAME, tok_sql, with_
from lectern.session import ensure_checkpoint_dir
from lectern.sources.adapters import logits
from lectern.sources.articles import docs_articles, scan_articles
from lectern.sources.tables import read_table


def split_docs(spark, sf):
    a = scan_articles(docs_articles(spark, sf), LANG2ID).select("doc_id", "title", "category", "label", "text")
    return stratified_split(a)


def nb_model(spark, sf, splitted=None):
    s = splitted if splitted is not None else split_docs(spark, sf)
    return naive_bayes.train_nb(filter_split(s, "train"), LANG_CLASSES)


def nb_sql(test_cte: str, extra: str = "") -> str:
    """NB training on the train split and scoring of ``test`` (doc_id, category, text)."""
    return with_(RANKED) + extra + """,
train AS (SELECT * FROM splitted WHERE split = 'train'),
""" + test_cte + """,
ttok AS (SELECT category, unnest(""" + tok_sql("text") + """) AS token FROM train),
counts AS (SELECT category, token, count(*) AS n FROM ttok GROUP BY category, token),
vsize AS (SELECT count(DISTINCT token) AS v FROM counts),
cls AS (SELECT d.category, ln(d.n_docs / (SELECT count(*) FROM train)) AS log_prior,
               ln(t.n_tokens + (SELECT v FROM vsize)) AS log_denom
        FROM (SELECT category, count(*) AS n_docs FROM train GROUP BY category) d
        JOIN (SELECT category, sum(n) AS n_tokens FROM counts GROUP BY category) t ON d.category = t.category),
dt AS (SELECT doc_id, token, count(*) AS cnt FROM (SELECT doc_id, unnest(""" + tok_sql("text") + """) AS token FROM test)
       GROUP BY doc_id, token),
nv AS (SELECT doc_id, sum(cnt) AS nv FROM dt WHERE token IN (SELECT token FROM counts) GROUP BY doc_id),
s AS (SELECT dt.doc_id, c.category, sum(dt.cnt * ln(c.n + 1)) AS s FROM dt JOIN counts c ON dt.token = c.token
      GROUP BY dt.doc_id, c.category),
z AS (SELECT t.doc_id, t.category AS true_label, cl.category AS cls,
             CASE cl.category WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END AS cid,
             cl.log_prior + coalesce(s.s, 0) - coalesce(nv.nv, 0) * cl.log_denom AS z
      FROM test t CROSS JOIN cls cl
      LEFT JOIN s ON s.doc_id = t.doc_id AND s.category = cl.category
      LEFT JOIN nv ON nv.doc_id = t.doc_id),
zm AS (SELECT *, exp(z - max(z) OVER (PARTITION BY doc_id)) AS e FROM z),
p AS (SELECT *, e / sum(e) OVER (PARTITION BY doc_id) AS prob FROM zm),
p2 AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY z DESC, cid) AS r FROM p)
"""


NB_SQL = nb_sql("test AS (SELECT * FROM splitted WHERE split = 'test')")


@register("train_nb", with_(RANKED) + """,
train AS (SELECT * FROM splitted WHERE split = 'train'),
ttok AS (SELECT category, unnest(""" + tok_sql("text") + """) AS token FROM train),
counts AS (SELECT category, token, count(*) AS n FROM ttok GROUP BY category, token),
tot AS (SELECT category, sum(n) AS n_tokens FROM counts GROUP BY category),
vsize AS (SELECT count(DISTINCT token) AS v FROM counts)
SELECT c.category AS class, c.token, round(ln((c.n + 1) / (t.n_tokens + (SELECT v FROM vsize))), 6) AS log_prob
FROM counts c JOIN tot t ON c.category = t.category""")
def q_train_nb(spark, sf):
    m = nb_model(spark, sf)
    long = m.terms.select("token", F.posexplode("w").alias("class_id", "lw"))
    # observed (class, token) pairs only: ln(n + 1) > 0
    long = long.where(F.col("lw") > 0)
    denom = F.element_at(F.array(*[F.lit(ld) for ld in m.log_denom]), (F.col("class_id") + 1).cast("int"))
    return long.select(decode_label("class_id", m.class_names).alias("class"), "token",
                       F.round(F.col("lw") - denom, 6).alias("log_prob"))


@register("score_nb", NB_SQL + """
SELECT doc_id, true_label, cls AS predicted_label, round(prob, 6) AS confidence, true_label = cls AS correct
FROM p2 WHERE r = 1""")
def q_score_nb(spark, sf):
    s = split_docs(spark, sf)
    m = nb_model(spark, sf, s)
    test = filter_split(s, "test")
    out = naive_bayes.score_nb(m, test, keep=["category"])
    return out.select("doc_id", F.col("category").alias("true_label"), "predicted_label",
                      F.round("confidence", 6).alias("confidence"),
                      (F.col("category") == F.col("predicted_label")).alias("correct"))


@register("join_class_scores", NB_SQL + """
SELECT doc_id, cls AS class, round(z, 6) AS score FROM z""")
def q_join_class_scores(spark, sf):
    s = split_docs(spark, sf)
    m = nb_model(spark, sf, s)
    z = naive_bayes.class_scores(m, filter_split(s, "test"))
    e = z.select("doc_id", F.posexplode("z").alias("cid", "score"))
    return e.select("doc_id", decode_label("cid", m.class_names).alias("class"), F.round("score", 6).alias("score"))


def _scratch(spark, name):
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "models", f"{name}-{uuid.uuid4().hex}")


@register("train_mllib")
def q_train_mllib(spark, sf):
    """Objective (loss) per iteration of the logistic regression, as a history table."""
    s = split_docs(spark, sf)
    model = mllib_model.train_mllib(filter_split(s, "train"), LANG_CLASSES)
    hist = mllib_model.objective_history(model)
    # a bounded list (one value per iteration) returned as rows
    return spark.createDataFrame(list(enumerate(hist)), "iteration int, loss double")


@register("score_mllib")
def q_score_mllib(spark, sf):
    s = split_docs(spark, sf)
    model = mllib_model.train_mllib(filter_split(s, "train"), LANG_CLASSES)
    out = mllib_model.score_mllib(model, filter_split(s, "test"), LANG_CLASSES, keep=["category"])
    return out.select("doc_id", F.col("category").alias("true_label"), "predicted_label",
                      F.round("confidence", 6).alias("confidence"))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """Train, save both models under the shared folder, load, score the test split."""
    s = split_docs(spark, sf)
    train = filter_split(s, "train")
    test = filter_split(s, "test")
    path = _scratch(spark, "nb")
    naive_bayes.train_nb(train, LANG_CLASSES).save(path)
    nb = naive_bayes.NaiveBayesModel.load(spark, path)
    mpath = _scratch(spark, "mllib")
    mllib_model.save_model(mllib_model.train_mllib(train, LANG_CLASSES), mpath)
    ml = mllib_model.load_model(mpath)
    a = naive_bayes.score_nb(nb, test).select("doc_id", F.col("predicted_label").alias("nb_label"))
    b = mllib_model.score_mllib(ml, test, LANG_CLASSES).select("doc_id", F.col("predicted_label").alias("mllib_label"))
    return a.join(b, "doc_id")


def make_linear_logits():
    """A user model: class scores = 10 x the first five embedding values."""
    import numpy as np

    def predict(x):
        return 10.0 * np.asarray(x, dtype=np.float64)[:, :5]
    return predict


@register("score_external_model", with_(LOGITS) + """
SELECT doc_id, """ + TOPIC_NAME.format(x="pred") + """ AS predicted_label, round(confidence, 6) AS confidence FROM scored2""")
def q_score_external_model(spark, sf):
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    e = e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("x"))
    out = external.score_external_model(e, make_linear_logits, "x", 64, TOPIC_CLASSES, batch_size=32)
    return out.select("doc_id", "predicted_label", F.round("confidence", 6).alias("confidence"))


@register("optional_labels_schema", NB_SQL + """
SELECT doc_id, max(cls) FILTER (WHERE r = 1) AS predicted, round(max(prob) FILTER (WHERE r = 1), 6) AS confidence,
       """ + ", ".join(f"round(max(prob) FILTER (WHERE cls = '{c}'), 6) AS prob_{c}" for c in LANG_CLASSES) + """
FROM p2 GROUP BY doc_id""")
def q_optional_labels_schema(spark, sf):
    """Unlabelled input: no true_label / correct columns in the prediction frame."""
    from lectern.plans.jobs import predictions_frame

    s = stable_table(split_docs(spark, sf).select("doc_id", "category", "text", "split"), "splits")
    m = nb_model(spark, sf, s)
    test = filter_split(s, "test").drop("category")
    out = predictions_frame(naive_bayes.score_nb(m, test), LANG_CLASSES, "category" in test.columns)
    return out.select("doc_id", "predicted", *[F.round(c, 6).alias(c) for c in ("confidence", *(f"prob_{c}" for c in LANG_CLASSES))])


# Rows a mini-batch: a fixed number of steps an epoch, whatever the size of the table.
STEPS_AN_EPOCH = 6


def epoch_model(spark, sf):
    s = stable_table(split_docs(spark, sf).select("doc_id", "category", "text", "split"), "splits")
    train = filter_split(s, "train")
    config = epoch_trainer.TrainConfig(epochs=3, batch_size=max(1, -(-train.count() // STEPS_AN_EPOCH)), num_features=1 << 14, lr=0.1)
    model, history = epoch_trainer.train_epochs(train, filter_split(s, "val"), LANG_CLASSES, _scratch(spark, "epochs"), config)
    return s, model, history


@register("train_epochs")
def q_train_epochs(spark, sf):
    """Train and validation loss and accuracy of every epoch of a run with early stopping."""
    return epoch_model(spark, sf)[2]


@register("score_epochs")
def q_score_epochs(spark, sf):
    """The test split scored by the best epoch's parameters."""
    s, model, _ = epoch_model(spark, sf)
    out = epoch_trainer.score_epochs(model, filter_split(s, "test"), keep=["category"])
    return out.select("doc_id", F.col("category").alias("true_label"), "predicted_label", F.round("confidence", 6).alias("confidence"))
