"""Toxicity by class-conditional Kneser-Ney models.

One interpolated Kneser-Ney word-pair model for toxic text, one for ordinary text, both backing off to continuation
counts shared by all documents, labelled or not: an expression that neither class has seen gets the same small
probability from both. A document is cut into overlapping windows; each window's toxic and ordinary log-likelihoods
are compared after division by its length. The score is a logistic function, fitted on labelled rows kept out of the
counts, of the highest window, the number of strong windows and the document mean.

Counts live in arrays of fixed size indexed by hashes. Pair counts of a full array are corrected by the mean load of a
cell. Distinct contexts are estimated by 64-bit sketches with geometric bits, merged by "or", so they cover all
documents at any size.

Learning uses every labelled row outside the held-out fold; the shared counts use every document. The logistic function
is fitted by sums that Spark takes over its rows, so no row reaches the driver. Labels, lang, source and doc_id are no inputs of a score.

Defined cases: null and empty texts have no windows and score as such (the logistic of zero evidence); without toxic
or without ordinary training rows every document gets the smoothed share of toxic training rows; a doc_id with
conflicting labels counts as toxic; a null doc_id is neither labelled nor held out; repeated rows each get their
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.arrays import WordHashes, document_runs, gathered
from lectern.llm.common import staged, whole_text
from lectern.llm.importance import labelled, with_labels

WORDS, PAIRS = 1 << 18, 1 << 20
WORD_SHIFT, PAIR_SHIFT = np.uint64(64 - 18), np.uint64(64 - 20)
STEM = 5         # bytes of a word that count: inflected and compound forms share their counts
DISCOUNT = 6.0   # counts up to this carry no weight of their own: the toxic class is small, chance meetings are many
WINDOW = 1       # words, each judged after the one before it
STRONG = 2.0     # a window of at least this mean log ratio counts as evidence
LIMIT = 4.0      # largest log ratio of one word
THRESHOLD = 0.3

K1, K2, K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
SKETCH_BITS, SKETCH_RATE = 64, 2.0 ** (-1 / 3)

#: Letters and digits in lower case; all else separates words. Bytes from 0x80 belong to letters.
LETTERS = bytes(b if chr(b).isalnum() or b >= 0x80 else 32 for b in range(256)).lower()


def words_of(text: str) -> list[bytes]:
    return [w[:STEM] for w in text.encode().translate(LETTERS).split()]


def sketch_bit(h: np.ndarray) -> np.ndarray:
    """One of 64 bits, bit j with a probability falling by ``SKETCH_RATE`` from bit to bit."""
    u = ((h * K3) >> np.uint64(12)).astype(float) / float(1 << 52)
    j = np.floor(np.log1p(-u * (1 - SKETCH_RATE ** SKETCH_BITS)) / np.log(SKETCH_RATE))
    return np.uint64(1) << np.clip(j, 0, SKETCH_BITS - 1).astype(np.uint64)


def sketch_counts(masks: np.ndarray) -> np.ndarray:
    """Estimated number of distinct items behind each sketch, from its number of bits."""
    rates = SKETCH_RATE ** np.arange(SKETCH_BITS)
    rates /= rates.sum()
    sizes = 2.0 ** np.arange(0, 24, 0.125)
    expected = (1 - (1 - rates[None, :]) ** sizes[:, None]).sum(axis=1)
    bits = np.bitwise_count(masks.view(np.uint64)).astype(float)
    return np.where(bits == 0, 0.0, np.interp(bits, expected, sizes))


def hashed(words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, word cells, cells of each word with the one before (the first follows a start mark)."""
    h = hashes.of(words)
    before = np.concatenate([np.array([K3], np.uint64), h[:-1]])
    return h, (h >> WORD_SHIFT).astype(np.int64), ((before * K1 + h * K2) >> PAIR_SHIFT).astype(np.int64)


EVIDENCE = ["top", "strong", "mean"]
SPEC = {"seen": (WORDS, "or"), **{f"{name}{c}": spec for c in (0, 1) for name, spec in (
    ("contexts", (WORDS, "or")), ("history", (WORDS, "add")), ("pairs", (PAIRS, "add")))}}


def count_arrays(batches: Iterable[pd.DataFrame]) -> dict[str, np.ndarray]:
    """Columns _text and _class (0 ordinary, 1 toxic, -1 not for the class counts)."""
    hashes = WordHashes()
    out = {name: np.zeros(size, np.uint64 if kind == "or" else np.int64) for name, (size, kind) in SPEC.items()}
    for batch in batches:
        for text, c in zip(batch["_text"], batch["_class"]):
            words = words_of(text)
            if not words:
                continue
            h, w, pair = hashed(words, hashes)
            before = np.concatenate([np.array([K3], np.uint64), h[:-1]])
            context = sketch_bit(before)
            np.bitwise_or.at(out["seen"], w, context)
            if c >= 0:
                prev = (before >> WORD_SHIFT).astype(np.int64)
                np.bitwise_or.at(out[f"contexts{c}"], w, context)
                np.add.at(out[f"history{c}"], prev, 1)
                np.add.at(out[f"pairs{c}"], pair, 1)
    return {k: v.view(np.int64) for k, v in out.items()}


class Models:
    """Both classes' Kneser-Ney models over hashed cells, with one shared backoff.

    The mass that discounting frees is spread by the shared continuation counts. Both classes free the same share, the
    larger of the two: a word that neither knows then has the same probability in both.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        seen = sketch_counts(arrays["seen"]) + 0.5
        shared = seen / seen.sum()
        contexts = [sketch_counts(arrays[f"contexts{c}"]) for c in (0, 1)]
        own = [np.maximum(x - DISCOUNT, 0) for x in contexts]
        free = max(1 - o.sum() / max(x.sum(), 1.0) for o, x in zip(own, contexts))
        self.back = [(1 - free) * o / max(o.sum(), 1.0) + free * shared for o in own]
        self.history = [arrays[f"history{c}"].astype(float) for c in (0, 1)]
        self.pairs = [arrays[f"pairs{c}"].astype(np.float32) for c in (0, 1)]
        self.load = [float(p.sum()) / PAIRS for p in self.pairs]

    def log_p(self, c: int, prev: np.ndarray, w: np.ndarray, pair: np.ndarray) -> np.ndarray:
        n = self.history[c][prev]
        # What a pair's cell holds beyond the mean load of a cell, discounted.
        held = np.clip(self.pairs[c][pair] - self.load[c] - DISCOUNT, 0, np.maximum(n - DISCOUNT, 0))
        direct = held / np.maximum(n, 1.0)
        return np.log(direct + (1 - direct) * self.back[c][w])


def evidence(models: Models, texts: list[list[bytes]], hashes: WordHashes) -> np.ndarray:
    """Of each document, of log P(toxic model) - log P(ordinary model): the highest window mean, the log of 1 + the
    number of strong windows, the mean over all words."""
    out = np.zeros((len(texts), 3))
    counts = np.array([len(t) for t in texts])
    for run in document_runs(counts):
        held = [t for t in texts[run] if t]
        if not held:
            continue
        n = np.array([len(t) for t in held])
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        h = hashes.of([w for t in held for w in t])
        before = np.concatenate([h[:1], h[:-1]])
        before[starts] = K3
        w, prev = (h >> WORD_SHIFT).astype(np.int64), (before >> WORD_SHIFT).astype(np.int64)
        pair = ((before * K1 + h * K2) >> PAIR_SHIFT).astype(np.int64)
        ratio = np.clip(models.log_p(1, prev, w, pair) - models.log_p(0, prev, w, pair), -LIMIT, LIMIT)
        sums = np.concatenate([[0.0], np.cumsum(ratio)])
        ends, at = starts + n, np.arange(len(h))
        last = np.minimum(np.repeat(ends, n), at + WINDOW)          # windows end with the document
        first = np.maximum(np.repeat(starts, n), last - WINDOW)     # and are full where it is long enough
        windows = (sums[last] - sums[first]) / (last - first)
        index = np.arange(run.start, run.stop)[counts[run] > 0]
        out[index, 0] = np.maximum.reduceat(windows, starts)
        out[index, 1] = np.log1p(np.add.reduceat((windows >= STRONG).astype(float), starts))
        out[index, 2] = (sums[ends] - sums[starts]) / n
    return out


def fit_logistic(rows: DataFrame, features: list[str], label: str = "label", rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Weights and intercept by Newton's method; a round adds up its gradient and curvature over all rows."""
    x = [*map(F.col, features), F.lit(1.0)]
    k = len(x)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    beta = np.zeros(k)
    for _ in range(rounds):
        z = sum((F.lit(float(b)) * c for b, c in zip(beta, x)), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
        found = rows.withColumn("_p", p).withColumn("_v", F.col("_p") * (1 - F.col("_p")) + 1e-9).agg(
            *[F.sum(c * (F.col("_p") - F.col(label))) for c in x], *[F.sum(x[i] * x[j] * F.col("_v")) for i, j in pairs]).first()
        grad, hess = np.array(found[:k]) + ridge * beta, ridge * np.eye(k)
        for (i, j), v in zip(pairs, found[k:]):
            hess[i, j] += v
            hess[j, i] = hess[i, j]
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-12:
            break
    return beta


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4


def score_toxicity(docs: DataFrame, labels: DataFrame, value: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    held = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    known = labelled(labels.where(fold(F.col("doc_id")) != 2), value)
    rows = with_labels(docs.select("doc_id", whole_text().alias("_text")), known)
    in_counts = F.col("label").isNotNull() & (fold(F.col("doc_id")) != 3)
    counted = rows.select("_text", F.when(in_counts, F.col("label")).otherwise(F.lit(-1)).alias("_class"))
    models = docs.sparkSession.sparkContext.broadcast(Models(gathered(counted, count_arrays, SPEC)))

    @F.pandas_udf(", ".join(f"{x} double" for x in EVIDENCE))
    def weigh(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in texts:
            found = [evidence(models.value, [words_of(t) for t in batch.iloc[i:i + 256]], hashes)
                     for i in range(0, len(batch), 256)]
            yield pd.DataFrame(np.concatenate(found) if found else np.zeros((0, len(EVIDENCE))), columns=EVIDENCE)

    scored = staged(rows.select("doc_id", held.alias("held_out"), "label", weigh("_text").alias("e")).select(
        "doc_id", "held_out", "label", "e.*"), "toxicity")
    fitted = staged(scored.where("label is not null").where(fold(F.col("doc_id")) == 3).select("label", *EVIDENCE), "evidence")
    n, toxic = fitted.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if 0 < toxic < n:
        beta = fit_logistic(fitted, EVIDENCE)
    else:  # nothing to fit on: the smoothed share of toxic rows
        n = known.agg(F.count("*"), F.sum("label")).first()
        share = ((n[1] or 0) + 1) / (n[0] + 2)
        beta = np.array([0.0] * len(EVIDENCE) + [np.log(share / (1 - share))])
    z = F.lit(float(beta[-1]))
    for weight, x in zip(beta, EVIDENCE):
        z = z + F.lit(float(weight)) * F.col(x)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return scored.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
