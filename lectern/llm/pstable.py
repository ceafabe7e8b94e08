"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Vectors are put on a sphere (one more coordinate makes all lengths equal), where a larger inner product with a query is
a smaller Euclidean distance. Each of several tables hashes a vector by ``k`` Gaussian projections, floor((a x + b) / w).
A query visits its own bucket and then perturbed ones, one projection's cell up or down or two at once, in the order of
their estimated success: the sum of squared distances to the cell borders that must be crossed. Candidates of all
tables are ranked by their exact inner product in double precision on the original vectors.

Equal vectors are one entry with its ``top + 1`` smallest ids, which is all that any query can return. The index is cut
into blocks of about ``BLOCK`` entries, each entry in one block with its bucket of every table; blocks of queries, with the
buckets that they visit, meet each block of the index. So a vector is stored once and not once a table, a bucket of any size is
spread over blocks, and a task holds one pair of blocks. Each block gives a query its best rows only.

A vector is put on the sphere of its range of lengths, the greatest length of all halved as often as it fits, so that a few
long vectors do not draw all others into one bucket; a query lies on every such sphere at the same place. A query that gets
fewer than ``top`` rows from its buckets is ranked against all entries instead, block by block. Every vector is indexed. Recall against brute
force is measured in the tests and stated in the README.

Defined cases: vectors that are null or zero, or hold null or non-finite components, or whose length is not the most
common one (a search needs one dimension), take no part; rows with equal vec_id and vector count once each as
candidates but a query never returns its own vec_id; fewer candidates give fewer rows; null ids take no part; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import FloatType

from lectern.llm.common import staged

TABLES = 10
HASHES = 4       # projections of a table
PROBES = 44      # perturbed buckets that a query visits in each table, besides its own
BLOCK = 8192     # entries of the index, and queries, that a task holds together
CHUNK = 128      # queries of a block that are ranked at once
WIDTH = 1.0      # cell width, in standard deviations of a projection
SEED = 7


def usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0)


def projections(dim: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.standard_normal((TABLES, hashes, dim + 1)), rng.random((TABLES, hashes))


def perturbations(hashes: int) -> np.ndarray:
    """All perturbations of a bucket: rows of steps -1, 0, 1, with one to three cells changed."""
    single = [(i, by) for i in range(hashes) for by in (-1, 1)]
    sets = [c for n in (1, 2, 3) for c in itertools.combinations(single, n) if len({i for i, _ in c}) == n]
    steps = np.zeros((len(sets), hashes), np.int64)
    for row, c in zip(steps, sets):
        for i, by in c:
            row[i] = by
    return steps


def visited(place: np.ndarray, probes: int) -> np.ndarray:
    """Cells that queries visit, by (query, table, probe, projection): the own one, then others in order of estimated
    success."""
    cell = np.floor(place).astype(np.int64)
    offset, steps = place - cell, perturbations(place.shape[-1])
    cost = offset ** 2 @ (steps < 0).T.astype(float) + (1 - offset) ** 2 @ (steps > 0).T.astype(float)
    order = np.argsort(cost, axis=-1, kind="stable")[..., :probes]
    return np.concatenate([cell[:, :, None, :], cell[:, :, None, :] + steps[order]], axis=2)


def keys(cells: np.ndarray) -> np.ndarray:
    """32-bit bucket keys of rows of cell numbers; buckets that share a key only add candidates."""
    out = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, np.uint64)
    for i in range(cells.shape[-1]):
        out = (out ^ cells[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(29)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def hashed(df: DataFrame, dim: int, longest: float, hashes: int, probes: int) -> DataFrame:
    """The rows with ``buckets``: of each table the own bucket, for queries followed by ``probes`` perturbed ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = projections(dim, hashes)
        for batch in itertools.chain.from_iterable(
                (x.slice(i, 1024) for i in range(0, x.num_rows, 1024)) for x in batches):
            n = batch.num_rows
            x = np.array(batch.column("vec").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, dim)
            if probes:  # a query lies in the plane of the data, at full length
                x = np.column_stack([x / np.linalg.norm(x, axis=1)[:, None], np.zeros(n)])
            else:
                x = x / longest
                halvings = np.minimum(np.frexp(np.linalg.norm(x, axis=1))[1], 0)
                x = np.ldexp(x, -halvings[:, None])
                x = np.column_stack([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))])
            place = (x @ a.reshape(-1, dim + 1).T).reshape(n, TABLES, hashes) / WIDTH + b
            found = keys(visited(place, probes) if probes else np.floor(place).astype(np.int64)).reshape(n, -1)
            buckets = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, buckets], names=[*batch.schema.names, "buckets"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, buckets array<int>")


def nearest(vectors: DataFrame, top: int = 20, query_every: int = 20, hashes: int = HASHES, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``query_every`` its nearest rows."""
    narrow = vectors.schema["embedding"].dataType.elementType == FloatType()  # single precision stays so until it is used
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        "vec_id", (F.col("embedding") if narrow else F.col("embedding").cast("array<double>")).alias("vec"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("longest")).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    main = max(sizes, key=lambda r: (r["n"], r["dim"]))
    dim, longest = main["dim"], main["longest"]
    rows = rows.where(F.size("vec") == dim)

    # Equal vectors are one entry with its smallest ids; the limit by rank works before the shuffle.
    by_vec = Window.partitionBy("vec").orderBy("vec_id")
    ids = rows.withColumn("r", F.row_number().over(by_vec)).where(F.col("r") <= top + 1)
    entries = staged(ids.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn(
        "entry", F.monotonically_increasing_id()), "vectors")
    asked = rows.where(F.col("vec_id") % query_every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min("vec").alias("vec"))
    probing = staged(hashed(asked, dim, longest, hashes, probes), "probes")
    first = staged(ranked(entries, probing, dim, longest, top, hashes, False), "ranked")
    full = first.groupBy("query_id").count().where(F.col("count") >= top).select("query_id")
    short = probing.join(full, "query_id", "left_anti")
    if short.isEmpty():
        return first
    return first.join(full, "query_id", "left_semi").unionByName(ranked(entries, short, dim, longest, top, hashes, True))


def ranked(entries: DataFrame, probing: DataFrame, dim: int, longest: float, top: int, hashes: int, whole: bool) -> DataFrame:
    """(query_id, rank, vec_id, score) of the best candidates in the buckets of ``probing``; with ``whole``, of all entries."""
    n_index, n_queries = (max(1, -(-x.count() // BLOCK)) for x in (entries, probing))
    # Every block of queries meets every block of the index, in a task of its own.
    def dealt(df: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))))
    index = entries.select("entry", F.col("ids")[0].alias("first"), "vec")
    index = index if whole else hashed(index, dim, longest, hashes, 0)
    met = dealt(index, "entry", "i", n_index, "q", n_queries).groupBy("i", "q").cogroup(
        dealt(probing, "query_id", "q", n_queries, "i", n_index).groupBy("i", "q"))
    best = met.applyInArrow(ranker(dim, top + 1, whole), "query_id long, entry long, first long, score double")
    leading = Window.partitionBy("query_id").orderBy(F.desc("score"), "first", "entry")
    best = best.withColumn("place", F.row_number().over(leading)).where(F.col("place") <= top + 1)
    found = best.join(entries.select("entry", "ids"), "entry").select("query_id", "score", F.explode("ids").alias("vec_id"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rows = found.where("query_id != vec_id").distinct().withColumn("rank", F.row_number().over(by_score)).where(
        F.col("rank") <= top)
    return rows.select("query_id", "rank", "vec_id", "score")


def ranker(dim: int, top: int, whole: bool = False):
    """Of a block of the index and a block of queries, each query's ``top`` candidates by exact inner product, and those
    that tie with the last one; with ``whole`` every entry is a candidate."""
    def flat(table: pa.Table, name: str) -> np.ndarray:
        column = table.column(name).combine_chunks()
        return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        n, out = index.num_rows, []
        if n and queries.num_rows:
            vec, asked = flat(index, "vec").astype(np.float64), flat(queries, "vec").astype(np.float64)
            visits = flat(queries, "buckets").reshape(queries.num_rows, TABLES, -1)
            ids = [index.column(c).to_numpy() for c in ("entry", "first")]
            own = None if whole else flat(index, "buckets")
            tables = [] if whole else [np.unique(own[:, t], return_inverse=True) for t in range(TABLES)]
            for start in range(0, len(asked), CHUNK):
                part = visits[start:start + CHUNK]
                candidate = np.full((len(part), n), whole)
                for t, (buckets, member) in enumerate(tables):
                    at = np.minimum(np.searchsorted(buckets, part[:, t]), len(buckets) - 1)
                    query, probe = np.nonzero(buckets[at] == part[:, t])
                    visit = np.zeros((len(part), len(buckets)), bool)
                    visit[query, at[query, probe]] = True
                    candidate |= visit[:, member]
                score = np.where(candidate, asked[start:start + CHUNK] @ vec.T, -np.inf)
                if n > top:
                    candidate &= score >= np.partition(score, n - top, axis=1)[:, n - top][:, None]
                q, e = np.nonzero(candidate)
                out.append((q + start, e, score[q, e]))
        q, e, score = map(np.concatenate, zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": queries.column("query_id").take(pa.array(q)) if out else pa.array([], pa.int64()),
                         "entry": ids[0][e] if out else pa.array([], pa.int64()),
                         "first": ids[1][e] if out else pa.array([], pa.int64()), "score": pa.array(score, pa.float64())})

    return run
