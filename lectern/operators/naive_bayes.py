"""Multinomial naive Bayes as relational algebra (add-one smoothing).

Training is one map-side-combined count over (class, token), written once
to the shared checkpoint folder. One NULL sentinel token per document makes
the same count also give the documents per class. From that table:

* terms   (token, w)   w[c] = ln(n(token, c) + 1) for every class c, built by
                       a pivot over the known class ids (no class cross join)
* class parameters     log_prior_c, log_denom_c = ln(T_c + |V|)  (C numbers,
                       kept on the driver with the model)

Because ln(0 + 1) = 0, a document's class score only needs the tokens it
shares with the vocabulary:

    z_c = log_prior_c + sum_t cnt_t * w_t[c] - n_in_vocab * log_denom_c

which equals the textbook sum over all tokens. Scoring explodes the
document's tokens and joins them with ``terms`` while the vocabulary is
under a row bound for a broadcast. Beyond it the terms are packed into
perfect hashes (``packed_vocab``), each of a bounded number of words, and a
document's sums are taken inside its row, one projection per pack: no token
is shuffled. Only beyond ``MAX_PACKS`` packs, or with too many different
weight vectors, the tokens are joined by a salted shuffle after a
per-(doc, token) pre-aggregation. Sums of one key are added up at the end.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.scores import argmax_label, decode_label, pick, softmax
from lectern.operators.encode import tokens
from lectern.operators.joins import lookup_join
from lectern.operators.packed_vocab import MAX_WORDS, PackedVocab, pack_vocab, token_sums
from lectern.operators.sizing import stable_table

# The terms table is broadcast to the scoring tasks only while its estimated
# size (token plus one double per class, per row) stays under this many
# bytes and its rows under the row bound; beyond either it is packed.
BROADCAST_VOCAB_ROWS = 500_000
BROADCAST_TERMS_BYTES = 128 * 1024 * 1024
TERM_ROW_OVERHEAD_BYTES = 48
# A pack holds up to about MAX_WORDS words; every pack reads the scored rows once.
MAX_PACKS = 8
# Words of the same counts share a weight vector; each pack's tasks hold all of them.
MAX_VECTORS = 500_000


def terms_broadcastable(model: "NaiveBayesModel") -> bool:
    est = model.vocab_size * (TERM_ROW_OVERHEAD_BYTES + 8 * len(model.class_names))
    return model.vocab_size <= BROADCAST_VOCAB_ROWS and est <= BROADCAST_TERMS_BYTES


@dataclass
class NaiveBayesModel:
    terms: DataFrame
    class_names: list[str]
    log_prior: list[float]
    log_denom: list[float]
    vocab_size: int
    n_docs: list[int] = field(default_factory=list)
    n_tokens: list[int] = field(default_factory=list)
    packs: list[PackedVocab] | None = field(default=None, repr=False, compare=False)
    vectors: np.ndarray | None = field(default=None, repr=False, compare=False)

    def packed(self) -> bool:
        """Pack the terms, once for all batches that the model scores; False if they are too many."""
        parts = -(-self.vocab_size // MAX_WORDS)
        if self.packs is None and parts <= MAX_PACKS:
            distinct = stable_table(self.terms.select("w").distinct().withColumn("token_id", F.monotonically_increasing_id()), "nb-vectors")
            if distinct.count() <= MAX_VECTORS:
                found = sorted(distinct.collect(), key=lambda r: r["token_id"])
                self.vectors = np.array([[1.0, *r["w"]] for r in found])
                words = stable_table(self.terms.join(F.broadcast(distinct), "w").select("token", "token_id"), "nb-words")
                at, numbers = F.pmod(F.xxhash64("token", F.lit(parts)), F.lit(parts)), np.array([r["token_id"] for r in found])
                self.packs = [pack_vocab(words.where(at == i), 2 * MAX_WORDS) for i in range(parts)]
                for p in self.packs:
                    p.ids = np.searchsorted(numbers, p.ids).astype(np.int32)
        return self.packs is not None

    def classes_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, c, self.n_docs[i], self.n_tokens[i], self.log_prior[i], self.log_denom[i])
                for i, c in enumerate(self.class_names)]
        return spark.createDataFrame(rows, "class_id bigint, class string, n_docs bigint, n_tokens bigint, "
                                           "log_prior double, log_denom double")

    def save(self, path: str) -> None:
        self.terms.write.mode("overwrite").parquet(os.path.join(path, "terms"))
        meta = {"class_names": self.class_names, "log_prior": self.log_prior, "log_denom": self.log_denom,
                "vocab_size": self.vocab_size, "n_docs": self.n_docs, "n_tokens": self.n_tokens}
        spark = self.terms.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").json(os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "NaiveBayesModel":
        meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
        return cls(spark.read.parquet(os.path.join(path, "terms")), meta["class_names"], meta["log_prior"],
                   meta["log_denom"], meta["vocab_size"], meta["n_docs"], meta["n_tokens"])


def _class_id(class_names: Sequence[str], class_col: str):
    return (F.array_position(F.array(*[F.lit(c) for c in class_names]), F.col(class_col)) - 1).cast("bigint")


def term_counts(train: DataFrame, class_names: Sequence[str], text_col: str = "text",
                class_col: str = "category") -> DataFrame:
    """(class_id, token, n); token NULL counts the documents of the class."""
    toks = F.concat(tokens(text_col), F.array(F.lit(None).cast("string")))
    t = train.select(_class_id(class_names, class_col).alias("class_id"), F.explode(toks).alias("token"))
    return t.where(F.col("class_id") >= 0).groupBy("class_id", "token").agg(F.count(F.lit(1)).alias("n"))


def train_nb(train: DataFrame, class_names: Sequence[str], text_col: str = "text",
             class_col: str = "category") -> NaiveBayesModel:
    """One counting pass written once (token -> per-class counts, the NULL
    sentinel row holding documents per class), then one aggregate over that
    table for all class parameters."""
    names = list(class_names)
    k = len(names)
    # one aggregate keyed by token with a conditional count per class
    # (combined map-side, so a token in a third of all rows is still cheap)
    toks = F.concat(tokens(text_col), F.array(F.lit(None).cast("string")))
    t = train.select(_class_id(names, class_col).alias("class_id"), F.explode(toks).alias("token"))
    wide = t.where(F.col("class_id") >= 0).groupBy("token").agg(
        F.array(*[F.count_if(F.col("class_id") == i) for i in range(k)]).alias("n"))
    wide = stable_table(wide, "nb-counts")
    real = F.col("token").isNotNull()
    stats = wide.agg(
        F.count_if(real).alias("vocab"),
        *[F.sum(F.when(real, F.col("n")[i])).alias(f"t{i}") for i in range(k)],
        *[F.sum(F.when(~real, F.col("n")[i])).alias(f"d{i}") for i in range(k)],
    ).first()
    vocab = int(stats["vocab"])
    n_docs = [int(stats[f"d{i}"] or 0) for i in range(k)]
    n_tokens = [int(stats[f"t{i}"] or 0) for i in range(k)]
    total = sum(n_docs) or 1
    log_prior = [math.log(d / total) if d else -math.inf for d in n_docs]
    log_denom = [math.log(t + vocab) if (t + vocab) else 0.0 for t in n_tokens]
    terms = wide.where(real).select("token", F.transform("n", lambda x: F.log(x + 1.0)).alias("w"))
    return NaiveBayesModel(terms, names, log_prior, log_denom, vocab, n_docs, n_tokens)


def _joined_sums(model: NaiveBayesModel, df: DataFrame, text_col: str, keys: list[str]) -> DataFrame:
    """(keys, _nv, _s0, _s1, ...): what each token adds, by a join with the terms."""
    # One NULL sentinel token per document keeps token-less documents.
    toks = F.concat(tokens(text_col), F.array(F.lit(None).cast("string")))
    exploded = df.select(*keys, F.explode(toks).alias("token"))
    if terms_broadcastable(model):
        facts = exploded.withColumn("cnt", F.lit(1).cast("bigint"))
        j = facts.join(F.broadcast(model.terms), "token", "left")
    else:
        facts = exploded.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("cnt"))
        j = lookup_join(facts, model.terms, "token", "left", salt_source=keys)
    known = F.col("w").isNotNull()
    # a document's tokens come from one row, so the caller's partial aggregate
    # leaves one row per document and task before the shuffle
    sums = [F.when(known, F.col("cnt") * F.col("w")[i]).otherwise(0.0).alias(f"_s{i}") for i in range(len(model.class_names))]
    return j.select(*keys, F.when(known, F.col("cnt")).otherwise(0).alias("_nv"), *sums)


def class_scores(model: NaiveBayesModel, df: DataFrame, text_col: str = "text", key_col: str | Sequence[str] = "doc_id",
                 keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., z) with z the unnormalised log score of every class.

    ``key_col``, one column or several, must identify a row. Only (key, token) pairs are exploded:
    the ``keep`` columns (often the whole text) are joined back once per
    document instead of being copied into every token row.
    """
    k = len(model.class_names)
    keys = [key_col] if isinstance(key_col, str) else list(key_col)
    if terms_broadcastable(model) or not model.packed():
        parts = _joined_sums(model, df, text_col, keys)
    else:
        # a document's first element counts its known tokens; a null text has no scores, as in the join
        of = [df.where(F.col(text_col).isNotNull()).select(*keys, token_sums(df, p, model.vectors, tokens(text_col)).alias("_v")) for p in model.packs]
        parts = reduce(DataFrame.unionAll, of).select(*keys, F.col("_v")[0].cast("bigint").alias("_nv"),
                                                      *[F.col("_v")[i + 1].alias(f"_s{i}") for i in range(k)])
    agg = parts.groupBy(*keys).agg(F.sum("_nv").alias("_nv"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(k)])
    z = F.array(*[F.lit(lp) + F.col(f"_s{i}") - F.col("_nv") * F.lit(ld)
                  for i, (lp, ld) in enumerate(zip(model.log_prior, model.log_denom))])
    scores = agg.select(*keys, z.alias("z"))
    if not keep:
        return scores
    return df.select(*keys, *keep).join(scores, keys, "inner").select(*keys, *keep, "z")


def score_nb(model: NaiveBayesModel, df: DataFrame, text_col: str = "text", key_col: str | Sequence[str] = "doc_id",
             keep: Sequence[str] = ()) -> DataFrame:
    """Adds probs (softmax of z), pred (argmax, lowest id on ties), predicted_label, confidence."""
    z = class_scores(model, df, text_col, key_col, keep)
    out = z.withColumn("probs", softmax("z")).withColumn("pred", argmax_label("z"))
    return out.withColumn("predicted_label", decode_label("pred", model.class_names)) \
              .withColumn("confidence", pick("probs", "pred"))
