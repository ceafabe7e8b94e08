"""Benchmark decontamination by template canonicalisation, all in DataFrame functions.

Texts become words; numbers, names (words with a capital first letter) and units are replaced by typed placeholders,
other words by their lower-case form. Windows of ``WIDTH`` canonical words are hashed and joined with the windows of
the benchmark. So that letter case decides nothing, every window is also hashed without the names, all words in lower
case; where that leaves fewer than ``LITERAL`` literal words (tables, arithmetic, code) the numbers and units stand for
themselves, so that an exact copy is found whatever an item consists of. An item shorter than a window is one window of
its lower-case words.

Matches of one document and item at one offset form an alignment. Its slots are then compared: in each
typed slot the benchmark's value must always meet the same value of the document and the other way round, so a
re-parameterised copy passes and a chance meeting of templates fails. An alignment that covers ``SPAN`` words, or
``SHARE`` of a shorter item, contaminates the document.

Before the join Bloom filters of fixed size, one a form over the benchmark's window hashes and one each over the hashes of
their first four words, drop most windows inside their row: only windows whose first four words pass are hashed whole. The
filters are one row that a broadcast join puts beside the documents; the join decides, whatever the size of the benchmark.

Defined cases: null text counts as empty and is never contaminated; rows with equal doc_id and text count as one
document; a null doc_id is handled like any other; items with fewer words than a window are found by exact
copies only, items without words contaminate nothing; repeated items are found each by its item_id; empty tables give empty results; other columns are ignored, or
pass through the filter untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import staged
from lectern.llm.line_chunks import text_key

WIDTH = 8       # words of a window
LITERAL = 4     # literal words of a window whose slots may vary
SPAN = 13       # words that an alignment must cover
SHARE = 0.8     # or this part of an item
BITS = 18       # log2 of the cells of one window filter
UNITS = ("kg", "g", "mg", "km", "m", "cm", "mm", "mi", "miles", "mile", "meters", "metres", "feet", "inches", "l", "ml",
         "liters", "litres", "hours", "hour", "minutes", "minute", "seconds", "second", "days", "day", "weeks", "years",
         "dollars", "dollar", "cents", "euros", "percent", "degrees", "usd", "eur")


def words_of(text: Column) -> Column:
    """Runs of letters and digits."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+", -1), "")


def canonical(word: Column) -> Column:
    first = F.substring(word, 1, 1)
    small = F.lower(word)
    return (F.when(first.between("0", "9"), F.lit("<number>")).when(F.lower(first) != first, F.lit("<name>"))
            .when(small.isin(*UNITS), F.lit("<unit>")).otherwise(small))


SLOTS = ("<number>", "<name>", "<unit>")
FORMS = (0, 1, 2)  # windows of canonical words, of words whatever their case, and whole items shorter than a window


def hashed(df: DataFrame) -> DataFrame:
    """Column ``words`` followed by arrays of hashes, one a word: ``plain`` of the word in lower case, ``loose`` with numbers
    and units as placeholders, ``canon`` with names too, and of the four words from each place on ``loose4``, ``canon4``."""
    others = [c for c in df.columns if c != "words"]
    number, name, unit = (F.xxhash64(F.lit(slot)) for slot in SLOTS)
    units = [F.xxhash64(F.lit(u)) for u in UNITS]

    def onward(array: str, by: int) -> Column:
        """Hash of each element and the one ``by`` places on, where there is one."""
        return F.zip_with(array, F.slice(array, by + 1, F.size(array)), lambda x, y: F.xxhash64(x, y)).alias(array)

    # Lower case is taken of all words at once; words hold no line ends.
    small = F.when(F.size("words") > 0, F.split(F.lower(F.array_join("words", "\n")), "\n", -1)).otherwise(
        F.array().cast("array<string>"))
    df = df.select(*others, "words", small.alias("small"))
    df = df.select(*others, "words", "small", F.transform("small", lambda s: F.xxhash64(s)).alias("plain"))
    df = df.select(*others, "words", "plain", F.zip_with("words", "plain", lambda w, p: F.when(
        w < ":", number).when(p.isin(*units), unit).otherwise(p)).alias("loose"), F.zip_with(
        "words", "small", lambda w, s: (w != s) & (F.substring(w, 1, 1) != F.substring(s, 1, 1))).alias("named"))
    df = df.select(*others, "words", "plain", "loose", F.zip_with(
        "named", "loose", lambda named, h: F.when(named, name).otherwise(h)).alias("canon"))
    kept = [*others, "words", "plain", "loose", "canon"]
    df = df.select(*kept, onward("loose", 1).alias("loose4"), onward("canon", 1).alias("canon4"))
    return df.select(*kept, onward("loose4", 2), onward("canon4", 2))


def windows(df: DataFrame, cells: DataFrame | None = None, widths=()) -> DataFrame:
    """Explode column ``words`` into (…, at, form, h, first, raw); the filters ``cells`` drop windows before rows are made.

    ``first`` is the hash of a window's first four words, null in the third form; ``widths`` are those of that form."""
    others = [c for c in df.columns if c != "words"]
    df = hashed(df)
    if cells is not None:
        df = df.crossJoin(F.broadcast(cells))
    size = F.size("words")

    def run(array: str, i: Column, width: int) -> list[Column]:
        return [F.get(array, i + k) for k in range(width)]

    def any_case(i: Column) -> Column:
        loose, plain = run("loose", i, WIDTH), run("plain", i, WIDTH)
        literal = sum([(a == b).cast("int") for a, b in zip(loose[1:], plain[1:])], (loose[0] == plain[0]).cast("int"))
        return F.when(literal >= LITERAL, F.xxhash64(*loose)).otherwise(F.xxhash64(*plain))

    def places(form: int, width: int, value, first) -> Column:
        at = F.sequence(F.lit(0), F.greatest(size - width, F.lit(0)))
        if cells is not None and form != 2:
            at = F.filter(at, lambda i: passes(FIRST + form, first(i), 0))
        if cells is not None:
            at = F.filter(at, lambda i: passes(form, value(i), 0) & passes(form, value(i), 1))
        found = F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(form).alias("form"), F.lit(width).alias("width"),
                                                   value(i).alias("h"), first(i).alias("first")))
        return F.when(size >= width, found).otherwise(
            F.array().cast("array<struct<at:int,form:int,width:int,h:bigint,first:bigint>>"))

    found = [places(0, WIDTH, lambda i: F.xxhash64(*run("canon", i, WIDTH)), lambda i: F.get("canon4", i)),
             places(1, WIDTH, any_case, lambda i: F.get("loose4", i))]
    found += [places(2, n, lambda i, n=n: F.xxhash64(*run("plain", i, n)), lambda i: F.lit(None).cast("long")) for n in widths]
    df = df.select(*others, F.transform(F.concat(*found), lambda x: F.struct(
        x["at"].alias("at"), x["form"].alias("form"), x["h"].alias("h"), x["first"].alias("first"), F.transform(
            F.sequence(F.lit(1), x["width"]), lambda k: F.element_at("words", x["at"] + k)).alias("raw"))).alias("w"))
    # The outer form: for the inner one a filter on the size is inferred, which computes the whole chain once per word.
    return df.select(*others, F.explode_outer("w").alias("w")).where("w is not null").select(*others, "w.*")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_words, b_at, form, h, first, b_raw): canonical windows with enough literal words, all windows of any case,
    whole items shorter than a window."""
    rows = benchmark.select("item_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("item_id", "words", F.size("words").alias("n_words"))
    literal = F.size(F.filter("raw", lambda w: ~canonical(w).isin(*SLOTS)))
    found = windows(rows, widths=range(1, WIDTH)).where(
        F.when(F.col("form") == 0, literal >= LITERAL).when(F.col("form") == 2, F.size("raw") == F.col("n_words"))
        .otherwise(F.lit(True)))
    return found.select("item_id", "n_words", F.col("at").alias("b_at"), "form", "h", "first", F.col("raw").alias("b_raw"))


FIRST = len(FORMS)  # the filters of forms 0 and 1 over first words follow those over whole windows
FILTERS = FIRST + 2


def cell(h: Column, k: int) -> Column:
    """The cell of a hash, from its k-th lot of bits."""
    return F.shiftrightunsigned(h, k * BITS).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def passes(number: int, h: Column, k: int) -> Column:
    """Whether the k-th cell of ``h`` is set in this filter of column ``cells``, 64 cells a long."""
    at = cell(h, k)
    return F.getbit(F.get("cells", F.shiftright(at, 6) + (number << (BITS - 6))), at.bitwiseAND(F.lit(63))) == 1


def known_cells(bench: DataFrame) -> DataFrame:
    """One row, whatever the benchmark: ``cells``, the Bloom filters over its windows, 2^BITS bits each. They stay a column,
    as literals they would stand in every plan's text."""
    marks = bench.select(F.explode(F.array(
        *[F.struct(F.col("form").alias("number"), cell(F.col("h"), k).alias("cell")) for k in (0, 1)],
        F.struct((F.col("form") + FIRST).alias("number"), cell(F.col("first"), 0).alias("cell")))).alias("m")).select(
        "m.*").where("cell is not null").select((F.col("number").cast("long") * (1 << BITS) + F.col("cell")).alias("bit"))
    longs = marks.groupBy(F.shiftright("bit", 6).alias("id")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    every = bench.sparkSession.range(0, FILTERS << (BITS - 6), 1, 1).join(F.broadcast(longs), "id", "left")
    return every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias(
        "x")).select(F.col("x.bits").alias("cells"))


def alignments(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, _key, item_id, n_words, offset, covered, consistent, exact), one row per alignment."""
    bench = staged(benchmark_windows(benchmark), "benchmark_windows")
    widths = [r["n_words"] for r in bench.where("form = 2").select("n_words").distinct().collect()]  # below WIDTH
    found = windows(docs.select("doc_id", text_key(F.col("text")).alias("_key"), words_of(F.col("text")).alias("words")),
                    staged(known_cells(bench), "cells"), sorted(widths))
    met = found.join(bench, ["form", "h"]).select(
        "doc_id", "_key", "item_id", "n_words", (F.col("at") - F.col("b_at")).alias("offset"), "b_at", "raw", "b_raw").distinct()
    by = ["doc_id", "_key", "item_id", "n_words", "offset"]
    place = F.sequence(F.lit(0), F.size("raw") - 1)
    words = met.select(*by, F.explode(F.transform(place, lambda k: F.struct(
        (F.col("b_at") + k).alias("p"), F.element_at("raw", k + 1).alias("d"),
        F.element_at("b_raw", k + 1).alias("b")))).alias("w")).select(*by, "w.*").distinct()
    kind = canonical(F.col("b"))
    values = words.select(*by, "p", F.when(kind.isin(*SLOTS), F.concat(kind, F.lower("b"))).alias("b"),
                          F.when(kind.isin(*SLOTS), F.concat(kind, F.lower("d"))).alias("d"))
    return values.groupBy(*by).agg(
        F.count("*").alias("covered"), F.countDistinct("b").alias("nb"), F.countDistinct("d").alias("nd"),
        F.countDistinct("b", "d").alias("nbd"), F.coalesce(F.bool_and(F.col("b") == F.col("d")), F.lit(True)).alias("exact")
    ).select(*by, "covered", ((F.col("nbd") == F.col("nb")) & (F.col("nbd") == F.col("nd"))).alias("consistent"), "exact")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, _key, item_id, covered, n_words, exact) of contaminated documents and the items they hold."""
    rows = alignments(docs, benchmark).where("consistent").where(
        (F.col("covered") >= SPAN) | (F.col("covered") >= SHARE * F.col("n_words")))
    return rows.groupBy("doc_id", "_key", "item_id").agg(
        F.max("covered").alias("covered"), F.max("n_words").alias("n_words"), F.bool_or("exact").alias("exact"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("_id"), "_key").distinct()
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = wide.join(bad, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (text_key(F.col("_row.text")) == F.col("_key")),
                     "left_anti")
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
