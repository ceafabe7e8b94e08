"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words, word pairs, shapes of words, pairs and triples of shapes): one of
target text, the documents labelled good, one of raw text, all documents. A document's importance weight is the ratio
of its likelihoods; its log is the sum of the log ratios of its n-grams. Gumbel top-k samples k documents without
replacement in proportion to the weights: Gumbel noise, drawn from a hash of the row, is added to the log weight and
the k largest are kept. k is the number of documents whose log weight reaches the cut that best separates the labelled
documents, so the share that is kept follows the corpus.

The target model is fitted on one half and the cut on the other half of all labelled rows; the raw model, the weights, k
and the k-th largest key cover all rows.

Defined cases: null text counts as empty and has log weight 0; without good labels all weights are 0 and all rows
are kept; rows that tie with the k-th key are kept too, so repeated rows share one fate; a null doc_id is never
labelled; a doc_id labelled both good and bad counts as good; an empty table gives an empty result; columns beyond
doc_id and text pass through the filter untouched and are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.arrays import WordHashes, gathered
from lectern.llm.common import staged, whole_text
from lectern.operators.sizing import bounded_broadcast

BUCKETS = 1 << 16
SENT_LABELS = 4_000_000  # so many labelled rows are sent to the executors (some 60 bytes each); more are joined by a shuffle
SEED = 20240229
PRIOR = 4.0           # added to each bucket of both models
BIN, EDGE = 0.25, 400  # the cut is looked for on a grid of this step up to this log weight

K1, K2, K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
SHIFT = np.uint64(48)

RUN_SHAPES = ((re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0"))


class ShapeHashes(WordHashes):
    """Hash of a word's shape: runs of capitals, letters and digits become one symbol each."""

    @staticmethod
    def hashed(word: bytes) -> int:
        for run, symbol in RUN_SHAPES:
            word = run.sub(symbol, word[:64])
        return WordHashes.hashed(b"shape " + word)


def ngrams(words: list[bytes], hashes: WordHashes, shapes: ShapeHashes) -> np.ndarray:
    """Buckets of a document's n-grams. A word that repeats the one before has a shape of its own."""
    if not words:
        return np.zeros(0, np.int64)
    w, s = hashes.of(words), shapes.of(words)
    s[1:][w[1:] == w[:-1]] = K3
    found = [w * K1, s * K2, w[:-1] * K1 + w[1:] * K2, s[:-1] * K2 + s[1:] * K3,
             s[:-2] * K1 + s[1:-1] * K2 + s[2:] * K3]
    return np.concatenate([x >> SHIFT for x in found]).astype(np.int64)


def labelled(labels: DataFrame, value: str) -> DataFrame:
    """(doc_id, label) of every labelled document, written once."""
    return staged(labels.where(F.col("doc_id").isNotNull() & F.col(value).isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(value).cast("int")).alias("label")), "labels")


def with_labels(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with the other columns of ``known`` by doc_id, null where it lacks the id."""
    return rows.join(bounded_broadcast(known, SENT_LABELS), "doc_id", "left")


def for_cut(key: Column) -> Column:
    """Half of the labelled rows stay out of the target model: their weights are those of unlabelled rows."""
    return F.pmod(F.xxhash64(key), F.lit(2)) == 1


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of the target and the raw model by bucket."""
    good = labels.where("label = 1").where(~for_cut(F.col("doc_id"))).select("doc_id", F.lit(True).alias("_good"))
    rows = with_labels(docs.select("doc_id", whole_text().alias("_text")), good).select(
        "_text", F.coalesce("_good", F.lit(False)).alias("_good"))

    def count(batches: Iterable[pd.DataFrame]) -> dict[str, np.ndarray]:
        hashes, shapes = WordHashes(), ShapeHashes()
        target, raw = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, is_good in zip(batch["_text"], batch["_good"]):
                found = np.bincount(ngrams(text.encode().split(), hashes, shapes), minlength=BUCKETS)
                raw += found
                if is_good:
                    target += found
        return {"target": target, "raw": raw}

    n = gathered(rows, count, {"target": (BUCKETS, "add"), "raw": (BUCKETS, "add")})
    target, raw = n["target"].astype(float), n["raw"].astype(float)
    if not target.sum():
        return np.zeros(BUCKETS)
    # Both models are put on the size of the target text and smoothed alike: a bucket that little text fills says little.
    expected = raw * (target.sum() / raw.sum())
    return np.log(target + PRIOR) - np.log(expected + PRIOR)


def log_weight(docs: DataFrame, ratios: np.ndarray, text: str = "text") -> Column:
    """Sum of the log ratios of a document's n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.pandas_udf("double")
    def weigh(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes, shapes, ratio = WordHashes(), ShapeHashes(), shared.value
        for batch in texts:
            yield pd.Series([float(ratio[ngrams(t.encode().split(), hashes, shapes)].sum()) for t in batch], dtype=float)

    return weigh(whole_text(text))


def gumbel(seed: int = SEED) -> Column:
    """Gumbel noise from a hash of the row's id and text: the same on every retry."""
    u = (F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def best_cut(weights: DataFrame) -> float:
    """Log weight that best separates good from bad labelled rows (equal weight to both), on a fixed grid."""
    at = F.floor(F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), F.col("log_weight"))) / BIN).cast("int")
    rows = weights.where("label is not null").where(for_cut(F.col("doc_id"))).groupBy(at.alias("at"), "label").count().collect()  # 2 * EDGE / BIN bins
    good = {r["at"]: r["count"] for r in rows if r["label"] == 1}
    bad = {r["at"]: r["count"] for r in rows if r["label"] == 0}
    if not good or not bad:
        return -math.inf
    n_good, n_bad = sum(good.values()), sum(bad.values())
    best, cut, below_good, below_bad = 0.0, -math.inf, 0, 0
    for at in sorted({*good, *bad}):
        below_good, below_bad = below_good + good.get(at, 0), below_bad + bad.get(at, 0)
        gain = below_bad / n_bad - below_good / n_good
        if gain > best:
            best, cut = gain, (at + 1) * BIN
    return cut


def kth_largest(keys: DataFrame, col: str, k: int, most: int = 10_000) -> float:
    """The k-th largest value: a histogram of 4096 bins is narrowed to the bin that holds it until few are left."""
    rows = keys.select(F.col(col).alias("x")).where("x is not null")
    lo, hi = rows.agg(F.min("x"), F.max("x")).first()
    above, held = 0, None
    while lo is not None and lo < hi and (held is None or held > most):
        part = rows.where(F.col("x").between(lo, hi))
        at = F.least(F.lit(4095), F.floor((F.col("x") - lo) / F.lit((hi - lo) / 4096)))
        for r in sorted(part.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("x").alias("lo"),
                                                         F.max("x").alias("hi")).collect(), key=lambda r: -r["at"]):
            if above + r["n"] >= k:
                lo, hi, held = r["lo"], r["hi"], r["n"]
                break
            above += r["n"]
    if lo is None or lo == hi:
        return -math.inf if lo is None else lo
    return sorted((r["x"] for r in rows.where(F.col("x").between(lo, hi)).collect()), reverse=True)[k - above - 1]


def resample(docs: DataFrame, labels: DataFrame, value: str = "quality") -> tuple[DataFrame, np.ndarray, float]:
    """(doc_id, log_weight, sample_key, selected) of every row, the model, and the smallest key that is kept."""
    known = labelled(labels, value)
    ratios = log_ratios(docs, known)
    weights = docs.select("doc_id", log_weight(docs, ratios).alias("log_weight"), gumbel().alias("_noise"))
    weights = staged(with_labels(weights, known).select(
        "doc_id", "log_weight", (F.col("log_weight") + F.col("_noise")).alias("sample_key"), "label"), "weights")
    k = weights.where(F.col("log_weight") >= F.lit(best_cut(weights))).count()
    least = kth_largest(weights, "sample_key", k) if k else math.inf
    return weights.select("doc_id", "log_weight", "sample_key",
                          (F.col("sample_key") >= F.lit(least)).alias("selected")), ratios, least


def keep_resampled(docs: DataFrame, labels: DataFrame, value: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the sample keeps, with all their columns."""
    _, ratios, least = resample(docs, labels, value)
    return docs.where(log_weight(docs, ratios) + gumbel() >= F.lit(least))
