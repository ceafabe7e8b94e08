"""Ranked lexical search over a length-stratified index.

A document's normaliser m is a whole number that depends on its length alone, so documents of one m form a stratum, within
which a term's impact depends on its frequency alone. The index holds blocks of at most ``BLOCK`` documents of one stratum;
a block's postings lie by term and, within a term, by falling frequency, in runs of one frequency, so an impact is computed
once for each frequency. A stratum too large for one block is dealt into as many pieces as its counted size asks for, by a
salt, so no stratum is gathered anywhere.

The queries are searched in blocks of ``ITEM_BLOCK`` items, whose terms are all that is sent to the tasks. From a stratum's
greatest frequency of each term follows the most that any of its documents can score. Strata are visited in the order of
these bounds: the first ones of each item, with ``SEED`` documents together, give a score that the item's ``top`` best reach;
after that a block is scored only for items whose bound in it reaches that score. Scores are sums of whole numbers, exact in
doubles below 2**53 (64-bit integers are used beyond).

Defined cases: null and empty texts have no terms, count nowhere and are never found; repeated rows and null ids are documents
of their own; rows of one item_id are one item with the terms of all; equal scores go by ascending doc_id (null first); texts of
any length; an empty table of either kind gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.common import staged, whole_text
from lectern.operators.numbering import global_row_number

TOP = 50
BLOCK, BLOCK_PAIRS = 1024, 1 << 18
ITEM_BLOCK = 256
SEED = 1000
CELLS = 1 << 21
SLICE = 250

# One byte stands for each byte of a term (letters in lower case), a space for every other.
TERM_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of anything beyond ASCII, only A-Z lowered."""
    return text.translate(TERM_BYTES).split()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows: what is taken out of Arrow at once stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)


def count_terms(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, terms, tfs): number of terms with repeats, distinct terms joined by spaces, their frequencies; no empty texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            kept, n, terms, tfs = [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                counted = Counter(found := terms_of(text))
                if found:
                    kept.append(i)
                    n.append(len(found))
                    terms.append(b" ".join(counted))
                    tfs.append(np.fromiter(counted.values(), "<i4", len(counted)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()),
                                              pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], names=[key, "n", "terms", "tfs"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, whole_text().alias("text")).mapInArrow(run, f"{key} {kind}, n long, terms binary, tfs binary")


def _block(m: int, docs: list, terms: list[bytes], tfs: list[bytes]) -> dict:
    """One block of documents of stratum m: dictionary, runs of equal frequency, and whom they hold."""
    each = [len(t) // 4 for t in tfs]
    number: dict[bytes, int] = {}
    term = np.array([number.setdefault(t, len(number)) for t in b" ".join(terms).split(b" ")], np.int64)
    tf = np.frombuffer(b"".join(tfs), "<i4").astype(np.int64)
    who = np.repeat(np.arange(len(docs)), each)
    order = np.argsort(term * (int(tf.max()) + 1) - tf, kind="stable")
    term, tf = term[order], tf[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(tf) != 0)])
    runs = np.bincount(term[starts], minlength=len(number))
    return {"m": m, "docs": docs, "dictionary": b" ".join(number), "df": np.bincount(term).astype("<i4").tobytes(),
            "top": tf[np.r_[0, np.cumsum(np.bincount(term))[:-1]]].astype("<i4").tobytes(), "runs": runs.astype("<i4").tobytes(),
            "run_tf": tf[starts].astype("<i4").tobytes(), "run_length": np.diff(np.r_[starts, len(tf)]).astype("<i4").tobytes(),
            "who": who[order].astype("<u2").tobytes()}


BLOBS = ["dictionary", "df", "top", "runs", "run_tf", "run_length", "who"]


def build_index(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(index, N, L): blocks of all documents with terms, how many such documents there are, and all their terms."""
    counted = staged(count_terms(docs, "doc_id"), "terms")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    counted = counted.select("doc_id", m.alias("m"), "terms", "tfs", F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    pieces = F.ceil(F.greatest(F.sum(F.octet_length("tfs")) / (4 * BLOCK_PAIRS), F.count(F.lit(1)) / BLOCK)).alias("pieces")
    sizes = staged(counted.groupBy("m").agg(pieces), "sizes")
    dealt = counted.join(sizes, "m").withColumn("piece", F.pmod("salt", "pieces")).repartition("m", "piece").sortWithinPartitions(
        "m", "piece", F.col("doc_id").asc_nulls_first())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, pairs, id_type = None, ([], [], []), 0, None

        def out() -> pa.RecordBatch:
            block = _block(now[0], *held)
            arrays = [pa.array([block["m"]], pa.int64()), pa.array([block["docs"]], pa.list_(id_type))]
            return pa.RecordBatch.from_arrays(arrays + [pa.array([block[b]], pa.binary()) for b in BLOBS], names=["m", "docs", *BLOBS])

        for batch in _slices(batches):
            id_type = batch.schema.field("doc_id").type
            for doc_id, m, piece, terms, tfs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "m", "piece", "terms", "tfs"))):
                if held[0] and ((m, piece) != now or len(held[0]) == BLOCK or pairs > BLOCK_PAIRS):
                    yield out()
                    held, pairs = ([], [], []), 0
                now = m, piece
                for column, value in zip(held, (doc_id, terms, tfs)):
                    column.append(value)
                pairs += len(tfs) // 4
        if held[0]:
            yield out()

    schema = f"m long, docs array<{kind}>, " + ", ".join(f"{b} binary" for b in BLOBS)
    return staged(dealt.mapInArrow(run, schema), "strata"), n_docs, n_terms


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _impact(tf: Column, m: Column) -> Column:
    return F.call_function("div", tf.cast("long") * F.lit(1_000_000_000), tf.cast("long") * F.lit(1000) + m * F.lit(20))


class Items:
    """A block of items: their terms numbered, and which item holds which term."""

    def __init__(self, ids: list, terms: list[list[bytes]]):
        self.ids, self.number = ids, {}
        pairs = [(self.number.setdefault(t, len(self.number)), i) for i, found in enumerate(terms) for t in found]
        self.term, self.item = np.array(sorted(pairs), np.int64).reshape(-1, 2).T
        self.starts = np.searchsorted(self.term, np.arange(len(self.number) + 1))
        self.weight = np.zeros(len(self.number), np.int64)

    def known(self, dictionary: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places in a block's dictionary of terms that an item holds, and their numbers here."""
        at = [(k, t) for k, w in enumerate(dictionary.split(b" ")) if (t := self.number.get(w)) is not None]
        places, numbers = np.array(at, np.int64).reshape(-1, 2).T
        return places, numbers

    def holders(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``numbers``, item) for every item that holds one of these terms."""
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        place = np.repeat(np.arange(len(numbers)), sizes)
        at = np.repeat(self.starts[numbers] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return place, self.item[at]


def _ints(blob: bytes, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(blob, kind).astype(np.int64)


def _best(block: dict, items: Items, floor: np.ndarray, wanted: np.ndarray, top: int) -> list[tuple[int, int, int]]:
    """(item, document's place, score): the best documents of a block for the wanted items, of scores from ``floor`` on."""
    places, numbers = items.known(block["dictionary"])
    if not len(places):
        return []
    m, n_docs = block["m"], len(block["docs"])
    most = items.weight[numbers] * impact(_ints(block["top"])[places], m)
    place, item = items.holders(numbers)
    bound = np.bincount(item, most[place].astype(np.float64), minlength=len(items.ids))
    alive = np.flatnonzero(wanted & (bound > 0) & (bound >= floor * (1 - 1e-12)))
    if not len(alive):
        return []
    exact = np.float64 if float(most.sum()) < 2.0 ** 53 else np.int64
    row = np.full(len(items.ids), -1)
    row[alive] = np.arange(len(alive))
    holds = np.zeros((len(alive), len(places)), exact)
    among = row[item] >= 0
    holds[row[item[among]], place[among]] = 1
    used = np.flatnonzero(holds.any(axis=0))
    holds, places, numbers = holds[:, used], places[used], numbers[used]

    runs, run_tf, run_length = (_ints(block[c]) for c in ("runs", "run_tf", "run_length"))
    kinds, which = np.unique(run_tf, return_inverse=True)
    value = np.repeat(impact(kinds, m)[which], run_length)
    who = _ints(block["who"], "<u2")
    ends = np.cumsum(np.add.reduceat(run_length, np.cumsum(runs) - runs))
    sizes = _ints(block["df"])[places]
    at = np.repeat(ends[places] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
    line = np.repeat(np.arange(len(places)), sizes)
    docs, value = who[at], value[at] * items.weight[numbers][line]
    out, width = [], max(1, CELLS // len(places))
    for begin in range(0, n_docs, width):
        inside = (docs >= begin) & (docs < begin + width)
        impacts = np.zeros((len(places), min(width, n_docs - begin)), exact)
        impacts[line[inside], docs[inside] - begin] = value[inside]
        scores = holds @ impacts
        for k in np.flatnonzero((scores >= np.maximum(floor[alive], 1)[:, None]).any(axis=1)):
            hits = np.flatnonzero(scores[k] >= max(floor[alive[k]], 1))
            for d in hits[np.argsort(-scores[k, hits], kind="stable")[:top]]:
                out.append((int(alive[k]), begin + int(d), int(scores[k, d])))
    return out


def _score(index: DataFrame, items: Items, floor: np.ndarray, top: int, item_kind: str) -> DataFrame:
    """(item, item_id, doc_id, score) from the blocks of ``index``; a column ``visitors`` names the items to score, if it is there."""
    doc_kind = index.schema["docs"].dataType.elementType.simpleString()
    named = "visitors" in index.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = {c: batch.column(c)[i].as_py() for c in ("m", "docs", *BLOBS)}
                wanted = np.full(len(items.ids), not named)
                if named:
                    wanted[batch.column("visitors")[i].as_py()] = True
                found = _best(block, items, floor, wanted, top)
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _, _ in found], pa.int64()), pa.array([items.ids[k] for k, _, _ in found], id_type),
                    pa.array([block["docs"][d] for _, d, _ in found], batch.schema.field("docs").type.value_type),
                    pa.array([s for _, _, s in found], pa.int64())], names=["item", "item_id", "doc_id", "score"])

    id_type = pa.array(items.ids).type if any(i is not None for i in items.ids) else pa.int64()
    return index.mapInArrow(run, f"item long, item_id {item_kind}, doc_id {doc_kind}, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _statistics(index: DataFrame, items: Items) -> DataFrame:
    """(m, term, df, top): in each stratum, of each term of the items, the documents that hold it and its greatest frequency."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m, dictionary, df, most in zip(*(batch.column(c).to_pylist() for c in ("m", "dictionary", "df", "top"))):
                places, numbers = items.known(dictionary)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), m)), pa.array(numbers), pa.array(_ints(df)[places]),
                                                  pa.array(_ints(most)[places])], names=["m", "term", "df", "top"])

    found = index.select("m", "dictionary", "df", "top").mapInArrow(run, "m long, term long, df long, top long")
    return staged(found.groupBy("m", "term").agg(F.sum("df").alias("df"), F.max("top").alias("top")), "statistics")


def _first_visits(index: DataFrame, stats: DataFrame, items: Items) -> DataFrame:
    """(m, visitors): for each item the strata of greatest bound that hold SEED documents together, listed by stratum."""
    spark = index.sparkSession
    holds = spark.createDataFrame(pa.table({"term": items.term, "item": items.item, "w": items.weight[items.term]}))
    bounds = stats.join(holds, "term").groupBy("item", "m").agg(F.sum(F.col("w") * _impact(F.col("top"), F.col("m"))).alias("bound"))
    sizes = index.groupBy("m").agg(F.sum(F.size("docs")).alias("docs"))
    before = Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    seen = bounds.where("bound > 0").join(sizes, "m").withColumn("seen", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    return staged(seen.where(F.col("seen") < SEED).groupBy("m").agg(F.collect_list("item").alias("visitors")), "visits")


def _items(queries: DataFrame) -> tuple[DataFrame, int]:
    """Items numbered from 1, each with the terms of all its rows, and their number."""
    counted = count_terms(queries, "item_id").groupBy("item_id").agg(F.collect_list("terms").alias("terms"))
    numbered = staged(global_row_number(counted, [F.col("item_id").asc_nulls_first()], "number"), "items")
    return numbered, numbered.count()


def search(docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """Of every item (item_id, text) the ``top`` best documents: item_id, rank, doc_id, score."""
    item_kind, doc_kind = queries.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    index, n_docs, _ = build_index(docs)
    numbered, n_items = _items(queries)
    found = []
    for first in range(1, n_items + 1, ITEM_BLOCK):
        rows = numbered.where(F.col("number").between(first, first + ITEM_BLOCK - 1)).collect()
        items = Items([r["item_id"] for r in rows], [sorted({t for part in r["terms"] for t in bytes(part).split(b" ")}) for r in rows])
        stats = _statistics(index, items)
        df = stats.groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (F.lit(2.0) * F.col("df") + F.lit(1.0))))
        for term, w in df.select("term", weight.cast("long")).collect():  # at most the terms of one block of items
            items.weight[term] = w
        seeds = _score(index.join(_first_visits(index, stats, items), "m"), items, np.zeros(len(rows)), top, item_kind)
        floor = np.zeros(len(rows))
        for item, score in _ranked(seeds, top).where(F.col("rank") == top).select("item", "score").collect():
            floor[item] = score
        best = _ranked(_score(index, items, floor, top, item_kind), top)
        found.append(staged(best.select("item_id", "rank", "doc_id", "score"), "found"))
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
