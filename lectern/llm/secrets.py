"""Secret scan: fixed patterns plus sliding-window Shannon entropy, all in DataFrame functions.

Base kinds are leftmost non-overlapping matches of fixed patterns. The entropy method looks at candidate strings, runs
of one character class, and slides a window over each. The window's symbol counts are kept incrementally: one symbol
enters, one leaves, and the sum of c * log2(c) changes by two table differences. A candidate is reported if its
highest window entropy reaches the threshold of its class and no allow-list pattern fits it. What a base span covers is
not repeated, and an allow-listed word covers its surroundings of ``REACH`` symbols, up to the next '/', '_' or '-'; the
pieces of a candidate that neither covers are looked at each by itself.

Defined cases: null text counts as empty (no spans, digest of the empty string); repeated rows each get their result;
an empty table gives an empty result; offsets count code points, the end is exclusive; spans with equal start keep the
order of the kinds; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import whole_text


class Kind(NamedTuple):
    name: str
    pattern: str
    group: int      # group whose length counts
    min_length: int


class EntropyClass(NamedTuple):
    name: str
    alphabet: str   # symbols of the class
    run: str        # pattern of a candidate
    window: int
    min_bits: float


# The base patterns.
BASE_KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),  # a run is maximal from its first symbol, so shorter ones never hide a longer
)
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    EntropyClass("hex_entropy", DIGITS + "abcdefABCDEF", r"(?<![0-9a-fA-F])[0-9a-fA-F]{24,}+", 24, 2.9),
    EntropyClass("base64_entropy", DIGITS + LOWER + LOWER.upper() + "+/_-",
                 r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+", 24, 3.9),
)
ALLOW_LIST = (
    r"^[A-Za-z_/+-]+$",                       # words, paths and identifiers without a digit
    r"^[0-9+/_-]+$",                          # numbers, dates, rules of dashes
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
)
ALLOW_WORDS = r"example|test|dummy|placeholder|xxxx|0123456789|abcdefghij"  # the last two for alphabets; in any case
REACH = 24      # symbols on each side that an allowed word covers

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def find_spans(text: Column, hit: Column, pattern: str) -> tuple[Column, Column]:
    """Matches and the pieces between them, empty where ``hit`` is false."""
    return (F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
            F.when(hit, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")))


def placed(matches: str, gaps: str, kind: str, rank: int) -> Column:
    """Spans of the matches: a match starts after all pieces and matches before it."""
    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(x["match"])).alias("end"),
                        F.lit(kind).alias("kind"), x["match"].alias("value"))
        return F.struct((start + F.length(x["match"])).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))
    pairs = F.zip_with(F.col(matches), F.slice(F.col(gaps), F.lit(1), F.size(matches)),
                       lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    return F.aggregate(pairs,
                       F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), step, lambda acc: acc["out"])


def peak_entropy(value: Column, cls: EntropyClass) -> Column:
    """Highest Shannon entropy, in bits, of any window of the class's width in a candidate of its alphabet."""
    size, w = len(cls.alphabet), cls.window
    weight = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(w + 2)])
    symbol = lambda i: F.instr(F.lit(cls.alphabet), F.substring(value, i, F.lit(1)))

    def step(acc, i):
        enter, leave = symbol(i), F.when(i > w, symbol(i - w)).otherwise(F.lit(0))
        ce = F.element_at(acc["counts"], enter)
        grown = acc["sum"] + F.element_at(weight, ce + 2) - F.element_at(weight, ce + 1)
        cl = F.element_at(acc["counts"], F.greatest(leave, F.lit(1))) + (leave == enter).cast("int")
        cl = F.greatest(cl, F.lit(1))
        left = F.when(leave > 0, grown - F.element_at(weight, cl + 1) + F.element_at(weight, cl)).otherwise(grown)
        counts = F.when(enter == leave, acc["counts"]).otherwise(F.transform(
            acc["counts"], lambda c, k: c + (k + 1 == enter).cast("int") - (k + 1 == leave).cast("int")))
        best = F.when(i >= w, F.greatest(acc["best"], F.lit(math.log2(w)) - left / w)).otherwise(acc["best"])
        return F.struct(counts.alias("counts"), left.alias("sum"), best.alias("best"))

    start = F.struct(F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), start, step, lambda acc: acc["best"])


def allowed(value: Column, patterns=ALLOW_LIST) -> Column:
    fits = F.lit(False)
    for p in patterns:
        fits = fits | F.regexp_like(value, F.lit(p))
    return fits


def uncovered(span: Column, base: str, words: str, least: int) -> Column:
    """The pieces of ``span``, of ``least`` symbols or more, that neither a base span nor an allowed word covers."""
    def piece(start, end, value):
        return F.struct(start.alias("start"), span["rank"].alias("rank"), end.alias("end"), span["kind"].alias("kind"),
                        value.alias("value"))

    def cut(acc, b):
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["out"], F.array(
            F.struct(acc["at"].alias("start"), b["start"].alias("end")))).alias("out"))

    def masked(s):
        mask = rf"(?i)[^/_-]{{0,{REACH}}}(?:{words})[^/_-]{{0,{REACH}}}"

        def step(acc, x):
            end = acc["at"] + F.length(x["gap"])
            return F.struct((end + F.coalesce(F.length(x["match"]), F.lit(0))).alias("at"),
                            F.concat(acc["out"], F.array(piece(acc["at"], end, x["gap"]))).alias("out"))
        parts = F.zip_with(F.split(s["value"], mask, -1), F.regexp_extract_all(s["value"], F.lit(mask), F.lit(0)),
                           lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
        return F.when(F.regexp_like(s["value"], F.lit(f"(?i){words}")), F.aggregate(
            parts, F.struct(s["start"].alias("at"), F.array().cast(SPAN).alias("out")), step, lambda acc: acc["out"])
        ).otherwise(F.array(s))

    over = F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    free = F.aggregate(over, F.struct(span["start"].alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias(
        "out")), cut, lambda acc: F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), span["end"].alias("end")))))
    free = F.transform(F.filter(free, lambda p: p["end"] - p["start"] >= least), lambda p: piece(
        p["start"], p["end"], F.substring(span["value"], p["start"] - span["start"] + 1, p["end"] - p["start"])))
    return F.filter(F.flatten(F.transform(free, masked)), lambda p: p["end"] - p["start"] >= least)


def free_pieces(cls: EntropyClass, words: str):
    return lambda s: uncovered(s, "base", words, cls.window)


def long_enough(kind: Kind):
    return lambda s: F.length(F.regexp_extract(s["value"], kind.pattern, kind.group)) >= kind.min_length


def high_entropy(cls: EntropyClass):
    return lambda s: peak_entropy(s["value"], cls) >= cls.min_bits


def of_kind(kind: Kind):
    return lambda s: s["kind"] == kind.name


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds=BASE_KINDS, classes=CLASSES,
                 allow_list=ALLOW_LIST, allow_words=ALLOW_WORDS) -> DataFrame:
    """(key, base, found): arrays of spans (start, rank, end, kind, value); ``base`` by the patterns, ``found`` all."""
    df = docs.select(F.col(key), whole_text(text).alias("_text"))
    entries = [(k.name, k.pattern) for k in kinds] + [(c.name, c.run) for c in classes]
    df = df.select("*", *[F.col("_text").rlike(p).alias(f"_hit{i}") for i, (_, p) in enumerate(entries)])
    cols = []
    for i, (_, p) in enumerate(entries):
        m, g = find_spans(F.col("_text"), F.col(f"_hit{i}"), p)
        cols += [m.alias(f"_m{i}"), g.alias(f"_g{i}")]
    df = df.select(key, *cols)
    spans = []
    for i, (name, _) in enumerate(entries):
        col = placed(f"_m{i}", f"_g{i}", name, i)
        if i < len(kinds):
            col = F.filter(col, long_enough(kinds[i]))
        spans.append(col.alias(f"_s{i}"))
    df = df.select(key, *spans)
    base = F.concat(*[F.col(f"_s{i}") for i in range(len(kinds))])
    df = df.select(key, F.array_sort(base).alias("base"), *[f"_s{i}" for i in range(len(kinds), len(entries))])
    more = []
    for j, c in enumerate(classes):
        new = F.filter(f"_s{len(kinds) + j}", lambda s: ~allowed(s["value"], allow_list))
        new = F.flatten(F.transform(new, free_pieces(c, allow_words)))
        new = F.filter(new, lambda s: ~allowed(s["value"], allow_list))
        more.append(F.filter(new, high_entropy(c)))
    found = F.array_sort(F.concat(F.col("base"), *more)) if more else F.col("base")
    return df.select(key, "base", found.alias("found"))


def digest_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, count of each base kind, digest of the base spans, all spans."""
    found = scan_secrets(docs)
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k.name}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(digest_text(F.col("base")), 256).alias("base_sha256"),
                        digest_text(F.col("found")).alias("spans"))
