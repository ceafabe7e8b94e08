"""Order of rows within an epoch from a keyed permutation, without a sort.

Rows numbered 0..n-1 once get, for every (seed, epoch), their place in that epoch by arithmetic on their own number: a
Feistel network over Z_a x Z_b with a = ceil(sqrt n) and b = ceil(n / a) is a bijection of 0..a*b-1, and walking on from
places beyond n (fewer than a of them) until one is below n makes it a bijection of 0..n-1. How often a walk can go on is
counted on the driver over the at most sqrt(n) + 1 places beyond n, so the expression has exactly as many steps as it needs.
Places need no exchange; batches are stretches of places.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.labels import SEED

ROUNDS = 6
# Odd multipliers below 2**32; operands stay below 2**31, so products fit a signed 64-bit integer.
MIX_A, MIX_B, LOW = 2654435761, 2246822519, (1 << 31) - 1


def round_keys(seed: int, epoch: int) -> list[int]:
    return [int(hashlib.md5(f"{seed}-{epoch}-{i}".encode()).hexdigest()[:8], 16) & LOW for i in range(ROUNDS)]


def sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _mix(x, key):
    """31 mixed bits of a half and a round key; plain arithmetic, so it runs on numpy arrays and on columns alike."""
    t = x * MIX_A + key
    if isinstance(t, Column):
        t = t.bitwiseXOR(F.shiftright(t, 17)).bitwiseAND(F.lit(LOW)) * MIX_B
        return t.bitwiseXOR(F.shiftright(t, 13)).bitwiseAND(F.lit(LOW))
    t = ((t ^ (t >> 17)) & LOW) * MIX_B
    return (t ^ (t >> 13)) & LOW


def permute_once(x: np.ndarray, n: int, keys: list[int]) -> np.ndarray:
    """One pass of the network over 0..a*b-1 (numpy)."""
    a, b = sides(n)
    left, right = x // b, x % b
    for i, key in enumerate(keys):
        if i % 2 == 0:
            left = (left + _mix(right, key)) % a
        else:
            right = (right + _mix(left, key)) % b
    return left * b + right


def walks(n: int, keys: list[int]) -> int:
    """How many passes the longest walk from any row takes."""
    a, b = sides(n)
    at, passes = np.arange(n, a * b, dtype=np.int64), 1
    while len(at):
        after = permute_once(at, n, keys)
        after = after[after >= n]
        if len(after) == len(at):  # only cycles beyond n are left, which no row ever enters
            break
        at, passes = after, passes + 1
    return passes


def place_in_epoch(row: Column | str, n: int, seed: int, epoch: int) -> Column:
    """Place (0..n-1) of a row's number (0..n-1) in an epoch."""
    keys = round_keys(seed, epoch)
    a, b = sides(n)
    row = F.col(row) if isinstance(row, str) else row
    steps = F.array(*[F.struct(F.lit(key).cast("bigint").alias("key"), F.lit(i).alias("i"))
                      for _ in range(walks(n, keys)) for i, key in enumerate(keys)])

    def step(s: Column, k: Column) -> Column:
        resting = (k["i"] == 0) & (s["l"] * b + s["r"] < n) & ~s["fresh"]
        left = F.when(s["done"] | (k["i"] % 2 == 1), s["l"]).otherwise((s["l"] + _mix(s["r"], k["key"])) % a)
        right = F.when(s["done"] | (k["i"] % 2 == 0), s["r"]).otherwise((s["r"] + _mix(s["l"], k["key"])) % b)
        done = s["done"] | resting
        return F.struct(F.when(done, s["l"]).otherwise(left).alias("l"), F.when(done, s["r"]).otherwise(right).alias("r"),
                        done.alias("done"), F.lit(False).alias("fresh"))

    wide = row.cast("bigint")
    r = wide % b
    start = F.struct(F.call_function("div", wide - r, F.lit(b)).alias("l"), r.alias("r"),
                     F.lit(False).alias("done"), F.lit(True).alias("fresh"))
    return F.aggregate(steps, start, step, lambda s: s["l"] * b + s["r"])


def epoch_places(numbered: DataFrame, n: int, epoch: int, batch_size: int, seed: int = SEED,
                 row_col: str = "row") -> DataFrame:
    """Add ``place`` and ``batch`` of one epoch to rows numbered 0..n-1; a projection, no exchange."""
    placed = numbered.withColumn("place", place_in_epoch(row_col, n, seed, epoch))
    return placed.withColumn("batch", F.call_function("div", F.col("place"), F.lit(batch_size)).cast("bigint"))
