"""Line dedup by content-defined chunks, all in DataFrame functions.

Lines are hashed; a rolling hash over two neighbouring line hashes decides where a chunk ends, so boundaries follow the
content and survive a shift. A line of ``LONG`` words or more is a chunk by itself. So that no boundary hides a repeat,
every line with words is also matched together with the next such line (and the blank lines between), whatever stands
around them; a longer passage is found pair by pair, each against the first occurrence of that pair.

These units are matched by their whole sequence of line hashes, counted over all documents; each repeat is compared with
the first occurrence (least doc_id, then text hash, then line) and grown over neighbouring blank lines that agree with
those of the first occurrence, up to ``CONTEXT`` on each side (neighbours with words are in pairs of their own). Repeats
of several non-blank lines, or of a long line, are removed from all places but the first. Before that the bytes of all
lines involved are compared: a hash that stands for two different lines is left alone.

The first occurrence of every line stays: a unit that is no first occurrence holds only lines that occurred before.

Defined cases: null text stays null; a text without a removed line stays as it is, byte for byte; a text that loses
all lines becomes empty, its row stays; rows with equal doc_id and text count as one document and share one fate;
null doc_ids order first; an empty table gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import staged

LONG = 50     # words
CONTEXT = 4   # lines
CUT = 4       # a rolling hash divisible by this does not end a chunk


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def word_count(line: Column) -> Column:
    """Words of a line, by its runs of white space; 0 for a blank line."""
    return F.regexp_count(line, F.lit(r"[^\s\u0085\p{Z}]+"))


def part(array: str, start: Column, size: Column) -> Column:
    """``size`` elements from ``start`` (from 0), without touching the others as slice does."""
    return F.when(size > 0, F.transform(F.sequence(start + 1, start + F.greatest(size, F.lit(1))),
                                        lambda i: F.element_at(array, i))).otherwise(F.array())


def unit_rows(docs: DataFrame) -> DataFrame:
    """One row per unit: (_id, _key, start, lines, before, after); lines are hashes, before and after those of the blank
    lines next to the unit, nearest first."""
    df = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_id"), text_key(F.col("text")).alias("_key"), lines_of(F.col("text")).alias("l"))
    df = df.select("_id", "_key", F.transform("l", lambda x: F.xxhash64(x)).alias("h"),
                   F.transform("l", word_count).alias("n"))

    def ends(i: Column) -> Column:
        """Whether the chunk ends before line ``i`` (from 0)."""
        here, last = F.element_at("h", i + 1), F.element_at("h", i)
        before = F.when(i > 1, F.element_at("h", F.greatest(i - 1, F.lit(1)))).otherwise(F.lit(0))
        rolled = F.shiftleft(before, 1).bitwiseXOR(last)
        return (F.element_at("n", i) >= LONG) | (F.element_at("n", i + 1) >= LONG) | (
            F.pmod(rolled, F.lit(CUT)) != 0) & here.isNotNull()

    size = F.size("h")
    inner = F.when(size > 1, F.filter(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), ends)).otherwise(
        F.array().cast("array<int>"))
    df = df.select("*", F.concat(F.array(F.lit(0)), inner).alias("starts"))
    bounds = F.zip_with("starts", F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(size)),
                        lambda a, b: F.struct(a.alias("start"), b.alias("end")))

    span = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    # A chunk of two lines with words is a pair.
    chunks = F.filter(bounds, lambda c: (c["end"] - c["start"] > 2) & (F.size(F.filter(
        part("n", c["start"], c["end"] - c["start"]), lambda n: n > 0)) > 1))
    full = F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.element_at("n", i + 1) > 0)
    df = df.select("_id", "_key", "h", "n", chunks.alias("chunks"), full.alias("full"))
    ahead = F.greatest(F.size("full") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("full", F.lit(1), ahead), F.slice("full", F.lit(2), ahead), lambda a, b: span(a, b + 1))
    wide = F.transform(F.filter("full", lambda i: F.element_at("n", i + 1) >= LONG), lambda i: span(i, i + 1))

    def blank(start: Column, count: Column, turned: bool) -> Column:
        """Hashes of the blank lines among ``count`` lines from ``start``, up to the nearest line with words."""
        near = lambda array: F.reverse(part(array, start, count)) if turned else part(array, start, count)
        stop = F.array_position(F.transform(near("n"), lambda n: n > 0), F.lit(True)).cast("int")
        beside = F.element_at("n", F.least(F.greatest(start + count if turned else start + 1, F.lit(1)), size))
        return F.when((count > 0) & (beside == 0), F.slice(near("h"), F.lit(1), F.when(stop == 0, count).otherwise(
            stop - 1))).otherwise(F.array().cast("array<bigint>"))

    def unit(c: Column) -> Column:
        start, end = c["start"], c["end"]
        before, after = F.least(start, F.lit(CONTEXT)), F.least(size - end, F.lit(CONTEXT))
        return F.struct(start.alias("start"), part("h", start, end - start).alias("lines"),
                        blank(start - before, before, True).alias("before"), blank(end, after, False).alias("after"))

    # The outer form: for the inner one a filter on the size is inferred, which computes the whole chain once per line.
    df = df.select("_id", "_key", F.explode_outer(F.transform(F.concat("chunks", pairs, wide), unit)).alias("c"))
    return df.where("c is not null").select("_id", "_key", "c.*")


def agreeing(a: Column, b: Column) -> Column:
    """Length of the common beginning of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same)).otherwise(first.cast("int") - 1)


def repeats(units: DataFrame) -> DataFrame:
    """(_id, _key, low, high, lines) of the repeats to be removed: line range and hashes."""
    place = F.struct("_id", "_key", "start")
    firsts = units.groupBy("lines").agg(
        F.count("*").alias("copies"), F.min(F.struct("_id", "_key", "start", "before", "after")).alias("first")
    ).where("copies > 1").select("lines", "first")
    again = units.join(firsts, "lines").where(~place.eqNullSafe(F.struct("first._id", "first._key", "first.start")))
    again = again.select("*", agreeing(F.col("before"), F.col("first.before")).alias("b"),
                         agreeing(F.col("after"), F.col("first.after")).alias("a"))
    grown = F.concat(F.reverse(F.slice("before", F.lit(1), F.col("b"))), "lines", F.slice("after", F.lit(1), F.col("a")))
    return again.select(
        "_id", "_key", (F.col("start") - F.col("b")).alias("low"),
        (F.col("start") + F.size("lines") + F.col("a")).alias("high"), grown.alias("lines"))


def unsound_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Byte comparison: hashes (h) among the lines of repeats that stand for more than one line."""
    used = found.select(F.explode("lines").alias("h")).distinct()
    lines = docs.where(F.col("text").isNotNull()).select(F.explode(lines_of(F.col("text"))).alias("line")).select(
        F.xxhash64("line").alias("h"), "line")
    # Grouping by the bytes too is what compares them; equal lines meet before the shuffle.
    return lines.join(used, "h", "left_semi").groupBy("h", "line").agg(F.lit(1).alias("one")).groupBy("h").count().where(
        "count > 1").select("h")


def removals(docs: DataFrame) -> DataFrame:
    """(_id, _key, gone): the line numbers, from 0, that each document loses."""
    found = staged(repeats(staged(unit_rows(docs), "units")), "repeats")
    unsound = unsound_lines(docs, found)
    each = found.select("_id", "_key", F.posexplode("lines").alias("at", "h"), "low").select(
        "_id", "_key", (F.col("low") + F.col("at")).alias("at"), "h")
    return each.join(unsound, "h", "left_anti").groupBy("_id", "_key").agg(F.collect_set("at").alias("gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, plus n_removed (lines)."""
    gone = removals(docs)
    names = docs.columns
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    joined = wide.join(gone, F.col("_row.doc_id").eqNullSafe(F.col("_id"))
                       & (text_key(F.col("_row.text")) == F.col("_key")), "left")
    lines = lines_of(F.col("_row.text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    text = F.when(F.col("gone").isNull() | F.col("_row.text").isNull(), F.col("_row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n"))
    out = [text.alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in names]
    return joined.select(*out, F.when(F.col("_row.text").isNull(), F.lit(0)).otherwise(
        F.coalesce(F.size("gone"), F.lit(0))).alias("n_removed"))
