"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document is the set of hashes of its distinct word shingles. All hashes have one global order: by the count of their
cell in a sketch of fixed size over the whole table, rare first, then by value. Two sets whose Jaccard similarity
reaches the threshold share a hash among the first ``n - ceil(t * n) + 1`` of each, the prefix. Equal sets are one node;
nodes with equal prefix and size are one group.

Pairs come from shared prefix hashes only. First each group's members meet their head and the heads meet a hub of each
of their hashes, for a few rounds with other hubs; what is verified joins components. Then every remaining pair of
nodes from different components that share a prefix hash, at places where it can be the first they share, is expanded and
verified, so no link between components is lost, and no group of near copies is ever multiplied out. Verification
compares whole sets.

Defined cases: null and empty texts have an empty set, link with nothing and are their own component; fewer words than
a shingle make one shingle of the whole sequence; equal rows are one node, each row gets its result; a component's id
is its smallest doc_id (null only if all are null); an empty table gives an empty result; other columns are ignored,
or pass through the filter untouched. Hashes have 64 bits, set digests 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.arrays import WordHashes, gathered
from lectern.llm.common import staged, staged_at, whole_text
from lectern.llm.line_chunks import text_key
from lectern.operators.sizing import drop_folder

CELLS_LOG = 21
PARITIES = 512           # bits of a set's parities
ROUNDS = 3               # rounds with hubs before the rest is expanded
BROADCAST_ROWS = 2_000_000  # rows of three longs that may be broadcast; beyond that the join shuffles


def factor(i: int) -> np.uint64:
    return np.uint64(WordHashes.hashed(b"shingle factor %d" % i) | 1)


def shingles(text: str, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's words (A-Z in lower case, separated by ASCII white space)."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    h = hashes.of(words)
    if len(h) < width:
        h = np.array([np.bitwise_xor.reduce(h * np.array([factor(100 * len(h) + i) for i in range(len(h))]))])
    else:
        h = sum(h[i:len(h) - width + 1 + i] * factor(i) for i in range(width))
    h ^= h >> np.uint64(32)
    h *= factor(-1)
    h ^= h >> np.uint64(29)
    return np.unique(h.view(np.int64))


def cell(h: np.ndarray) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(64 - CELLS_LOG)).astype(np.int64)


def cell_counts(docs: DataFrame, width: int) -> np.ndarray:
    """Number of shingles of all documents in each cell."""
    def count(batches: Iterable[pd.DataFrame]) -> dict[str, np.ndarray]:
        hashes, n = WordHashes(), np.zeros(1 << CELLS_LOG, np.int64)
        for batch in batches:
            for text in batch["_text"]:
                np.add.at(n, cell(shingles(text, width, hashes)), 1)
        return {"n": n}

    return gathered(docs.select(whole_text().alias("_text")), count, {"n": (1 << CELLS_LOG, "add")})["n"]


def least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def digest(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def parities(h: np.ndarray) -> np.ndarray:
    """Of each of ``PARITIES`` classes of hashes, whether the set holds an odd number: as many bits, in words of 64. Where
    two sets' bits differ, at least one hash of the class is in one of them only."""
    odd = np.bincount(h & (PARITIES - 1), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, _tkey, n, digest, parities, prefix): set size, digest and parities of the set, its prefix in global order."""
    counts = docs.sparkSession.sparkContext.broadcast(cell_counts(docs, width).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t.as_py(), width, hashes) for t in batch.column("_text")]
            first = []
            for h in sets:
                keep = len(h) - least_overlap(len(h), percent) + 1 if len(h) else 0
                first.append(h[np.lexsort((h, counts.value[cell(h)]))[:keep]])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in first])]).astype(np.int32)
            flat = np.concatenate(first) if first else np.zeros(0, np.int64)
            words = np.concatenate([parities(h) for h in sets]) if sets else np.zeros(0, np.int64)
            bits = np.arange(len(sets) + 1, dtype=np.int32) * (PARITIES // 64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_tkey"), pa.array([len(h) for h in sets], pa.int64()),
                 pa.array([digest(h) for h in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(bits), pa.array(words)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "_tkey", "n", "digest", "parities", "prefix"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key(F.col("text")).alias("_tkey"), whole_text().alias("_text")).mapInArrow(
        run, f"doc_id {kind}, _tkey long, n long, digest binary, parities array<long>, prefix array<long>")


def whole_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, set) of the given nodes (node, digest, source), from the text of their first document; as many times as
    its row is repeated."""
    wanted = nodes.select("node", "digest", F.col("source.doc_id").alias("_id"), F.col("source._tkey").alias("_tkey"))
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").alias("_doc"), text_key(F.col("text")).alias("_tkey"), whole_text().alias("_text")).join(
        wanted, "_tkey").where(F.col("_doc").eqNullSafe(F.col("_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [(node, h) for node, d, t in zip(batch.column("node"), batch.column("digest"), batch.column("_text"))
                     if digest(h := shingles(t.as_py(), width, hashes)) == d.as_py()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n.as_py() for n, _ in found], pa.int64()), pa.array([h for _, h in found], pa.list_(pa.int64()))],
                names=["node", "set"])

    return texts.select("node", "digest", "_text").mapInArrow(run, "node long, set array<long>")


def similar_size(a: Column, b: Column, percent: int) -> Column:
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def enough(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union."""
    return overlap * (100 + percent) >= (a + b) * percent


def may_link(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of sizes n can be similar if the hash at their positions pos is the first that they share: no more
    than the rest of the smaller side can then be equal, and of equally many not all, since the sets differ. A pair that
    links passes at the first hash it shares."""
    most = F.least(x["n"] - x["pos"], y["n"] - y["pos"], F.greatest(x["n"], y["n"]) - 1)
    return similar_size(x["n"], y["n"], percent) & enough(most, x["n"], y["n"], percent)


def may_overlap(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of sizes n can be similar by their parities: each bit that differs stands for a hash that only one of
    them holds. A pair that links passes, whatever the hashes."""
    apart = sum((F.bit_count(F.get(x["parities"], F.lit(i)).bitwiseXOR(F.get(y["parities"], F.lit(i))))
                 for i in range(PARITIES // 64)), F.lit(0)).cast("long")
    total = x["n"] + y["n"]
    return (total - apart) * (100 + percent) >= total * 2 * percent


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, linked) of the pairs (a, b), by their whole sets; pairs that their parities tell apart need no sets."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.struct("n", "parities").alias(f"_{name}"))

    judged = staged(pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", may_overlap(F.col("_a"), F.col("_b"), percent).alias("may")), "judged")
    close = judged.where("may").select("a", "b")
    both = close.select(F.col("a").alias("node")).union(close.select(F.col("b").alias("node"))).distinct()
    sets, folder = staged_at(whole_sets(docs, nodes.join(both, "node", "left_semi"), width), "sets")
    left = close.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    full = left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    found = staged(full.select("a", "b", enough(F.size(F.array_intersect("sa", "sb")).cast("long"), F.size("sa").cast("long"),
                                                F.size("sb").cast("long"), percent).alias("linked")).distinct().union(
        judged.where("not may").select("a", "b", F.lit(False).alias("linked")).distinct()), "verified")
    drop_folder(docs.sparkSession, folder)
    return found


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (a, b): alternating large and small stars until nothing moves."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(),
                   "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def join_components(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, digest) and classes (digest, component): the smallest doc_id of the component of each set."""
    rows = staged(prefixes(docs, width, percent), "prefixes")
    nodes = staged(rows.where("n > 0").groupBy("digest", "n").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "_tkey")).alias("source"), F.first("prefix").alias("prefix"),
        F.first("parities").alias("parities")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    posts = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = posts.groupBy("token").count().where("count > 1").select("token")
    posts = staged(posts.join(shared, "token", "left_semi"), "posts")

    # Groups: equal prefix and size. Only heads meet the hubs.
    grouped = nodes.join(posts.select("node").distinct(), "node", "left_semi")
    heads = grouped.groupBy("n", "prefix").agg(F.min("node").alias("head"), F.count("*").alias("members"))
    members = staged(grouped.join(heads.where("members > 1"), ["n", "prefix"]).where("node != head").select("node", "head"),
                     "members")
    head_posts = posts.join(members.select("node"), "node", "left_anti")

    links = tested = None
    root = posts.select("node").distinct().withColumn("root", F.col("node")).limit(0)
    for turn in range(ROUNDS):
        at = head_posts.join(root, "node", "left").select("token", "node", "n", "pos", F.coalesce("root", "node").alias("root"))
        hubs = at.groupBy("token").agg(F.min_by(F.struct("node", "n", "pos", "root"), F.xxhash64("node", F.lit(turn))).alias("hub"),
                                       F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token", "hub")
        pairs = at.join(hubs, "token").where((F.col("root") != F.col("hub.root")) & may_link(
            F.struct("n", "pos"), F.col("hub"), percent)).select(*pair("node", "hub.node"))
        if turn == 0:
            pairs = pairs.union(members.select(*pair("node", "head")))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        found = verified(docs, nodes, pairs, width, percent)
        tested = found if tested is None else tested.union(found)
        root = staged(components(tested.where("linked").select("a", "b")), "roots")

    # All pairs that may still join two components.
    at = staged(posts.join(root, "node", "left").withColumn("root", F.coalesce("root", "node")), "posts")
    mixed = at.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                    F.min_by("root", F.xxhash64("node", F.lit(ROUNDS))).alias("major")).where("lo < hi")
    live = at.join(mixed.select("token", "major"), "token").join(nodes.select("node", "parities"), "node")
    x = live.where("root != major").select("token", F.struct("node", "n", "pos", "root", "parities").alias("x"))
    y = live.select("token", F.struct("node", "n", "pos", "root", "parities").alias("y"))
    rest = x.join(y, "token").where((F.col("x.root") != F.col("y.root")) & may_link(F.col("x"), F.col("y"), percent)
                                    & may_overlap(F.col("x"), F.col("y"), percent)).select(*pair("x.node", "y.node")).distinct()
    rest = rest.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    links = tested.union(verified(docs, nodes, rest, width, percent)).where("linked").select("a", "b")
    root = components(links)

    label = nodes.select("node", "digest", "rep").join(root, "node", "left").select(
        "digest", "rep", F.coalesce("root", "node").alias("root"))
    least = label.groupBy("root").agg(F.min("rep").alias("component"))
    return rows, label.join(least, "root").select("digest", "component")


def jaccard_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows, classes = join_components(docs, width, percent)
    found = rows.select("doc_id", "n", "digest").join(classes, "digest", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(
        F.col("component")).alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller doc_id; empty texts stay. Equal rows tie and
    stay together."""
    rows, classes = join_components(docs, width, percent)
    drop = rows.where("n > 0").select("doc_id", "_tkey", "digest").join(classes, "digest").where(
        ~F.col("doc_id").eqNullSafe(F.col("component"))).select(F.col("doc_id").alias("_id"), "_tkey").distinct()
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = wide.join(drop, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (text_key(F.col("_row.text")) == F.col("_tkey")),
                     "left_anti")
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
