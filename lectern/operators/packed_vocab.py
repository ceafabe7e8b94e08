"""A vocabulary packed into a minimal perfect hash, so that ids are found inside a row.

A token is known by its 64-bit hash. The hashes are dealt into groups of some ``GROUP`` tokens, and each group gets a minimal
perfect hash in a task of its own: buckets of about two hashes, from the fullest to the smallest, look for a seed that sends
all of theirs to free places; a bucket of one hash stores its place outright, so the last free places cost no search. What is
sent to the tasks is one array of seeds, one of hashes and one of ids, some 14 bytes a token (seeds and ids take 4 bytes
where they fit). Looking up takes ``LOOKUP`` hashes at a time, so a batch of long rows needs little beyond itself. The stored hash is the
fingerprint: a token outside the vocabulary is taken for one inside only if all 64 bits agree.

``pack_vocab`` refuses vocabularies beyond ``max_words``, for which the token join stays. Two tokens of one hash would share
an id; building fails if that happens.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.sizing import stable_table

GROUP = 4096
# 14 bytes a word: some 110 MB held by each Python worker at most.
MAX_WORDS = 8_000_000
TRIES = 64
LOOKUP = 1 << 16


def _mix(h: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """64 mixed bits of a hash and a seed."""
    x = h.astype(np.uint64) ^ (np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _bucket(h: np.ndarray, buckets: np.ndarray | int) -> np.ndarray:
    return (_mix(h, 0) % np.asarray(buckets, np.uint64)).astype(np.int64)


def build_group(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, place of each hash): a negative seed is a place itself, -1 - place."""
    n = len(hashes)
    if len(np.unique(hashes)) != n:
        raise ValueError("two tokens of the vocabulary have one hash")
    buckets = n // 2 + 1
    of = _bucket(hashes, buckets)
    order = np.argsort(of, kind="stable")
    begins = np.searchsorted(of[order], np.arange(buckets + 1))
    sizes = np.diff(begins)
    seeds, place, taken = np.zeros(buckets, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        mine = order[begins[b]:begins[b + 1]]
        if len(mine) < 2:
            break
        first = 0
        while True:
            at = (_mix(hashes[mine][None, :], np.arange(first, first + TRIES)[:, None]) % np.uint64(n)).astype(np.int64)
            apart = np.sort(at, axis=1)
            good = np.flatnonzero((apart[:, 1:] != apart[:, :-1]).all(axis=1) & ~taken[at].any(axis=1))
            if len(good):
                seeds[b], place[mine] = first + good[0], at[good[0]]
                taken[place[mine]] = True
                break
            first += TRIES
    free = iter(np.flatnonzero(~taken))
    for b in np.flatnonzero(sizes == 1):
        mine = order[begins[b]]
        place[mine] = next(free)
        seeds[b] = -1 - place[mine]
    return seeds, place


@dataclass
class PackedVocab:
    seeds: np.ndarray
    hashes: np.ndarray
    ids: np.ndarray
    seed_starts: np.ndarray
    word_starts: np.ndarray

    def lookup(self, h: np.ndarray, unknown: int) -> np.ndarray:
        out = np.full(len(h), unknown, np.int64)
        for i in range(0, len(h) if len(self.hashes) else 0, LOOKUP):
            out[i:i + LOOKUP] = self._found(h[i:i + LOOKUP], unknown)
        return out

    def _found(self, h: np.ndarray, unknown: int) -> np.ndarray:
        group = np.mod(h, len(self.word_starts) - 1)
        begin, n = self.word_starts[group], np.diff(self.word_starts)[group]
        buckets = np.diff(self.seed_starts)[group]
        seed = self.seeds[self.seed_starts[group] + _bucket(h, buckets)].astype(np.int64)
        place = np.where(seed < 0, -1 - seed, (_mix(h, np.maximum(seed, 0)) % np.maximum(n, 1).astype(np.uint64)).astype(np.int64))
        at = np.minimum(begin + place, len(self.hashes) - 1)
        return np.where((n > 0) & (self.hashes[at] == h), self.ids[at], unknown)


def narrow(x: np.ndarray) -> np.ndarray:
    """In 4 bytes a number, if all fit."""
    return x.astype(np.int32) if not len(x) or (x.min() >= -2**31 and x.max() < 2**31) else x


def pack_vocab(vocab: DataFrame, max_words: int = MAX_WORDS) -> PackedVocab | None:
    """The packed form of (token, token_id), or None beyond ``max_words``."""
    words = stable_table(vocab.select(F.xxhash64("token").alias("h"), F.col("token_id").cast("long").alias("id")), "vocab-hashes")
    n = words.count()
    if n > max_words:
        return None
    groups = max(1, n // GROUP)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        h = rows["h"].to_numpy(np.int64)
        seeds, place = build_group(h)
        hashes, ids = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
        hashes[place], ids[place] = h, rows["id"].to_numpy(np.int64)
        return pd.DataFrame({"g": [rows["g"].iloc[0]], "seeds": [seeds.tobytes()], "hashes": [hashes.tobytes()], "ids": [ids.tobytes()]})

    built = words.withColumn("g", F.pmod("h", F.lit(groups))).groupBy("g").applyInPandas(
        build, "g long, seeds binary, hashes binary, ids binary")
    found = {r["g"]: r for r in built.collect()}  # at most max_words words

    def parts(name: str) -> list[np.ndarray]:
        # a group without words still has one bucket, which holds nothing
        return [np.frombuffer(found[g][name], np.int64) if g in found else np.zeros(1 if name == "seeds" else 0, np.int64) for g in range(groups)]

    seeds, hashes, ids = (parts(c) for c in ("seeds", "hashes", "ids"))
    starts = [np.r_[0, np.cumsum([len(p) for p in x])] for x in (seeds, hashes)]
    return PackedVocab(narrow(np.concatenate(seeds)), np.concatenate(hashes), narrow(np.concatenate(ids)), *starts)


def token_ids(df: DataFrame, packed: PackedVocab, tokens: Column, unknown: int) -> Column:
    """Ids of an array of tokens, in order, found inside the row; a null array has none."""
    sent = df.sparkSession.sparkContext.broadcast(packed)

    @F.arrow_udf("array<long>")
    def ids(hashes: pa.Array) -> pa.Array:
        flat = hashes.flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(hashes.offsets.to_numpy())
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(sent.value.lookup(flat.astype(np.int64, copy=False), unknown)))

    known = F.coalesce(tokens, F.array().cast("array<string>"))
    return ids(F.transform(known, lambda t: F.xxhash64(t)))


def token_sums(df: DataFrame, packed: PackedVocab, table: np.ndarray, tokens: Column) -> Column:
    """Sum of the ``table`` rows that the words' ids name, over the tokens of an array; strangers add nothing."""
    sent = df.sparkSession.sparkContext.broadcast((packed, np.vstack([table, np.zeros((1, table.shape[1]))])))

    @F.arrow_udf("array<double>")
    def sums(hashes: pa.Array) -> pa.Array:
        words, rows = sent.value
        flat = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        of = np.repeat(np.arange(len(hashes)), np.diff(hashes.offsets.to_numpy()))
        out = np.zeros((len(hashes), rows.shape[1]))
        for i in range(0, len(flat), LOOKUP):
            found, at = rows[words.lookup(flat[i:i + LOOKUP], -1)], of[i:i + LOOKUP]
            for c in range(rows.shape[1]):
                part = np.bincount(at - at[0], weights=found[:, c])
                out[at[0]:at[0] + len(part), c] += part
        offsets = np.arange(0, out.size + 1, rows.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    known = F.coalesce(tokens, F.array().cast("array<string>"))
    return sums(F.transform(known, lambda t: F.xxhash64(t)))
