"""Stratified splits, day buckets and split checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.hashing import seeded_order_key
from lectern.labels import DAY_BUCKETS, SEED, TEST_PCT, VAL_PCT
from lectern.operators.numbering import exact_row_number, global_row_number, hashed_rank
from lectern.operators.selection import digest_thresholds, within
from lectern.operators.sizing import stable_table


SPLITS = ["train", "val", "test"]
FAULTS = ["overlap_train_val", "overlap_train_test", "overlap_val_test", "missing_rows", "extra_rows"]


def rank_in_class(df: DataFrame, class_col: str = "category", order_col: str = "title",
                  key_col: str = "doc_id", out_col: str = "rn", digest=F.md5) -> DataFrame:
    """1-based rank of each row in its class, ordered by the digest of the raw title, then key.

    Computed with the scaled numbering, so a large class is spread over
    many tasks; the result equals the plain window.
    """
    return hashed_rank(df, [class_col], digest(F.col(order_col)), [F.col(key_col).asc_nulls_first()], out_col)


def split_of(rn, test_pct: int = TEST_PCT, val_pct: int = VAL_PCT):
    """m = rn mod 100: test if m < t, val if m < t + v, else train."""
    m = F.pmod(rn, F.lit(100))
    return (F.when(m < test_pct, "test")
            .when(m < test_pct + val_pct, "val")
            .otherwise("train"))


def stratified_split(df: DataFrame, test_pct: int = TEST_PCT, val_pct: int = VAL_PCT,
                     class_col: str = "category", order_col: str = "title",
                     key_col: str = "doc_id", digest=F.md5) -> DataFrame:
    """Add ``split`` in {'train','val','test'} per the rank-in-class rule."""
    if not (0 <= test_pct and 0 <= val_pct and test_pct + val_pct <= 100):
        raise ValueError("test_pct + val_pct must be within 0..100")
    ranked = rank_in_class(df, class_col, order_col, key_col, "_rn", digest)
    return ranked.withColumn("split", split_of(F.col("_rn"), test_pct, val_pct)).drop("_rn")


def expected_split_sizes(n: int, test_pct: int = TEST_PCT, val_pct: int = VAL_PCT) -> tuple[int, int, int]:
    """(test, val, train) rows of a class of n rows under the rule above."""
    def below(bound: int) -> int:
        # rn in 1..n with rn mod 100 < bound
        full, rest = divmod(n, 100)
        return full * bound + max(0, min(rest, bound - 1) if bound > 0 else 0)
    test = below(test_pct)
    val = below(test_pct + val_pct) - test
    return test, val, n - test - val


def filter_split(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split).drop("split")


def split_counts(df: DataFrame, class_col: str = "category") -> DataFrame:
    return df.groupBy("split", class_col).agg(F.count(F.lit(1)).alias("n"))


# Pieces of the key space whose fingerprints are compared; differing ones are cut into as many again.
FINGERPRINT_PIECES = 4096


def _keyed(df: DataFrame, key_col: str, *more) -> DataFrame:
    k = F.col(key_col)
    return df.select(k.alias("_k"), F.xxhash64(k.isNull(), k).alias("_h"), *more)


def _piece(level: int):
    return F.pmod(F.shiftright("_h", 12 * level), F.lit(FINGERPRINT_PIECES)).cast("int")


def _fingerprints(rows: DataFrame, pieces: list, splits: bool) -> DataFrame:
    """Per piece of the key space: rows, and the order-free sum of their key hashes (in halves, so that no sum overflows)."""
    figures = [F.count(F.lit(1)).alias("_n"), F.sum(F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("_lo"),
               F.sum(F.shiftrightunsigned("_h", 32)).alias("_hi")]
    if splits:
        figures += [F.count_if(F.col("split") == s).alias(f"_{s}") for s in SPLITS]
    return rows.groupBy(*pieces).agg(*figures)


def _differing(given: DataFrame, placed: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces whose rows or hash sums differ between the input and the splits."""
    g = given.select(*keys, F.struct("_n", "_lo", "_hi").alias("_g"))
    p = placed.select(*keys, F.struct("_n", "_lo", "_hi").alias("_p"))
    return g.join(p, keys, "full").where(~F.col("_g").eqNullSafe(F.col("_p"))).select(*keys)


def split_integrity(df: DataFrame, source: DataFrame, key_col: str = "doc_id", unique_keys: bool = False) -> DataFrame:
    """One row of counts that compares the split frame with its input.

    Splits are disjoint when every overlap is 0 and complete when ``missing_rows`` (input rows in no split) and
    ``extra_rows`` (split rows beyond the input's) are 0. With ``unique_keys`` (the key names one input row) both sides are
    reduced to order-free sums of key hashes per piece of the key space, one scan each and no shuffle of rows; where all agree,
    the splits hold the input's rows once each. Differing pieces are cut once more, and only keys of those that still differ
    are compared one by one. Without it every key is.
    """
    given, placed = _keyed(source, key_col), _keyed(df, key_col, "split")
    if not unique_keys:
        return _key_counts(given, placed).agg(*_totals())
    top = [F.col("_a")]
    given, placed = given.withColumn("_a", _piece(0)), placed.withColumn("_a", _piece(0))
    sums = [stable_table(_fingerprints(x, top, s), "fingerprints") for x, s in ((given, False), (placed, True))]
    whole = sums[0].agg(F.lit(1).alias("_one"), F.sum("_n").alias("input_rows")).join(
        sums[1].agg(F.lit(1).alias("_one"), *[F.sum(f"_{s}").alias(f"{s}_rows") for s in SPLITS]), "_one").na.fill(0)
    bad = stable_table(_differing(*sums, ["_a"]), "differing")
    found = {c: F.lit(0).cast("bigint").alias(c) for c in FAULTS}
    if not bad.isEmpty():
        parts = [x.join(bad, "_a", "left_semi").withColumn("_b", _piece(1)) for x in (given, placed)]
        finer = [_fingerprints(x, [F.col("_a"), F.col("_b")], False) for x in parts]
        worse = stable_table(_differing(*finer, ["_a", "_b"]), "differing")
        rows = [x.join(worse, ["_a", "_b"], "left_semi") for x in parts]
        faults = _key_counts(*rows).agg(*_totals()).first()  # one row
        found = {c: F.lit(faults[c] or 0).cast("bigint").alias(c) for c in FAULTS}
    return whole.select("input_rows", *[f"{s}_rows" for s in SPLITS], *found.values())


def _key_counts(given: DataFrame, placed: DataFrame) -> DataFrame:
    """Per key: rows of the input and of each split. Two keyed aggregates (map-side combined) and one full join."""
    per_key = placed.groupBy("_k").agg(*[F.count_if(F.col("split") == s).alias(f"_{s}") for s in SPLITS])
    per_given = given.groupBy(F.col("_k").alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    return per_given.join(per_key, per_given["_g"].eqNullSafe(per_key["_k"]), "full").na.fill(0, ["_n", *[f"_{s}" for s in SPLITS]])


def _totals() -> list:
    tr, va, te = (F.col(f"_{s}") > 0 for s in SPLITS)
    there = F.col("_train") + F.col("_val") + F.col("_test")
    return [F.sum("_n").alias("input_rows"), *[F.sum(f"_{s}").alias(f"{s}_rows") for s in SPLITS],
            F.count_if(tr & va).alias("overlap_train_val"), F.count_if(tr & te).alias("overlap_train_test"),
            F.count_if(va & te).alias("overlap_val_test"),
            F.sum(F.greatest(F.col("_n") - there, F.lit(0))).alias("missing_rows"),
            F.sum(F.greatest(there - F.col("_n"), F.lit(0))).alias("extra_rows")]


def _scorable(df: DataFrame, order_col: str) -> DataFrame:
    return df.where(F.col("body").isNotNull() & F.col(order_col).isNotNull())


def day_numbers(df: DataFrame, buckets: int = DAY_BUCKETS, order_col: str = "title", key_col: str = "doc_id",
                out_col: str = "day_num") -> DataFrame:
    """(key, order, day): ``MOD(ROW_NUMBER() OVER (ORDER BY title, key), buckets)`` over scorable rows; only these columns are
    numbered, so no text is moved."""
    keys = _scorable(df, order_col).select(key_col, order_col)
    numbered = global_row_number(keys, [F.col(order_col).asc_nulls_first(), F.col(key_col).asc_nulls_first()], "_rn")
    return numbered.withColumn(out_col, F.pmod(F.col("_rn"), F.lit(buckets)).cast("bigint")).drop("_rn")


def _by_row(df: DataFrame, numbers: DataFrame, order_col: str, key_col: str, how: str) -> DataFrame:
    n = numbers.withColumnsRenamed({key_col: "_k", order_col: "_o"})
    return df.join(n, df[key_col].eqNullSafe(n["_k"]) & (df[order_col] == n["_o"]), how)


def day_partition(df: DataFrame, buckets: int = DAY_BUCKETS, order_col: str = "title",
                  key_col: str = "doc_id", out_col: str = "day_num") -> DataFrame:
    """All scorable rows with their day. (order, key) must name a row; rows that share both share a day only by chance and
    would be doubled, so they are given the least of their days."""
    numbers = day_numbers(df, buckets, order_col, key_col, out_col).groupBy(key_col, order_col).agg(F.min(out_col).alias(out_col))
    return _by_row(_scorable(df, order_col), numbers, order_col, key_col, "inner").drop("_k", "_o")


def filter_day(df: DataFrame, day: int, buckets: int = DAY_BUCKETS, order_col: str = "title", key_col: str = "doc_id") -> DataFrame:
    """The rows of one day: the day's keys are picked, then their rows (a semi-join against 1 / buckets of the keys)."""
    from lectern.functions.timefmt import validate_day

    validate_day(day, buckets)
    numbers = day_numbers(df, buckets, order_col, key_col).groupBy(key_col, order_col).agg(F.min("day_num").alias("day_num"))
    mine = stable_table(numbers.where(F.col("day_num") == day).select(key_col, order_col), "day-keys")
    return _by_row(_scorable(df, order_col), mine, order_col, key_col, "left_semi").withColumn("day_num", F.lit(day).cast("bigint"))


def stratified_split_exact(df: DataFrame, test_frac: float = 0.1, val_frac: float = 0.111,
                           seed: int = SEED, class_col: str = "category",
                           key_col: str = "doc_id") -> DataFrame:
    """Class shares kept exactly: per class, the first round(test_frac * n) rows in the order of a seeded digest of the key
    go to test, the next round(val_frac * (n - test)) to val, the rest to train.

    No row is numbered or moved: two threshold digests per class come from counts of digest prefixes, and each row is compared
    with those of its class. Rows of one key share a split.
    """
    digest = F.coalesce(seeded_order_key(seed, key_col), F.lit("0" * 32))  # null keys come first

    def ranks(n):
        t = F.round(n * test_frac)
        return [t, t + F.round((n - t) * val_frac)]

    cuts = digest_thresholds(df, class_col, digest, ranks)
    j = df.join(cuts, df[class_col].eqNullSafe(cuts["_class"]), "inner")
    split = F.when(within(digest, F.col("_t0")), "test").when(within(digest, F.col("_t1")), "val").otherwise("train")
    return j.select(*[df[c] for c in df.columns], split.alias("split"))
