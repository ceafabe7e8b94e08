"""Ranks, splits, day buckets, sampling, ordering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.functions.farmhash import farm_fingerprint
from lectern.labels import LANG2ID, SEED
from lectern.operators import epoch_order, sampling, splits
from lectern.operators.sizing import default_partitions, stable_table
from lectern.plans.registry import register
from lectern.plans.views import ARTICLES, DOCS, RANKED, with_
from lectern.sources.articles import docs_articles, scan_articles


def articles(spark, sf):
    return scan_articles(docs_articles(spark, sf), LANG2ID)


def split_articles(spark, sf, num_partitions=None):
    a = articles(spark, sf).select("doc_id", "title", "category", "label")
    if num_partitions is None:
        return splits.stratified_split(a)
    # the general (range-partitioned) numbering must give the same ranks
    ranked = splits.exact_row_number(
        a, ["category"], [F.md5("title").asc_nulls_first(), F.col("doc_id").asc_nulls_first()],
        "_rn", num_partitions)
    return ranked.withColumn("split", splits.split_of(F.col("_rn"))).drop("_rn")


@register("rank_in_class", with_(RANKED) + "SELECT doc_id, category, rn FROM ranked")
def q_rank_in_class(spark, sf):
    a = articles(spark, sf).select("doc_id", "title", "category")
    return splits.rank_in_class(a).select("doc_id", "category", "rn")


@register("stratified_split", with_(RANKED) + "SELECT doc_id, category, label, split FROM splitted")
def q_stratified_split(spark, sf):
    return split_articles(spark, sf).select("doc_id", "category", "label", "split")


@register("stratified_split_farm")
def q_stratified_split_farm(spark, sf):
    """The split by the 64-bit FarmHash fingerprint of the title, as the source table's own engine orders it."""
    a = articles(spark, sf).select("doc_id", "title", "category", "label")
    return splits.stratified_split(a, digest=farm_fingerprint).select("doc_id", "category", "label", "split")


@register("stratified_split_scaled", with_(RANKED) + "SELECT doc_id, category, label, split FROM splitted")
def q_stratified_split_scaled(spark, sf):
    n = 4 * default_partitions(spark.range(1))
    return split_articles(spark, sf, n).select("doc_id", "category", "label", "split")


@register("split_counts", with_(RANKED) + """
SELECT split, category, count(*) AS n FROM splitted GROUP BY split, category""")
def q_split_counts(spark, sf):
    return splits.split_counts(split_articles(spark, sf))


@register("filter_split", with_(RANKED) + """
SELECT doc_id, title, category, label FROM splitted WHERE split = 'val'""")
def q_filter_split(spark, sf):
    return splits.filter_split(split_articles(spark, sf), "val")


@register("split_integrity", with_(RANKED) + """,
given AS (SELECT doc_id AS g, count(*) AS n FROM docs_articles WHERE title IS NOT NULL AND body IS NOT NULL
          AND category IS NOT NULL GROUP BY 1),
per AS (SELECT doc_id AS k, count(*) FILTER (WHERE split = 'train') AS tr, count(*) FILTER (WHERE split = 'val') AS va,
               count(*) FILTER (WHERE split = 'test') AS te FROM splitted GROUP BY 1),
j AS (SELECT coalesce(n, 0) AS n, coalesce(tr, 0) AS tr, coalesce(va, 0) AS va, coalesce(te, 0) AS te
      FROM given FULL JOIN per ON g = k)
SELECT CAST(sum(n) AS BIGINT) AS input_rows, CAST(sum(tr) AS BIGINT) AS train_rows, CAST(sum(va) AS BIGINT) AS val_rows,
       CAST(sum(te) AS BIGINT) AS test_rows, count(*) FILTER (WHERE tr > 0 AND va > 0) AS overlap_train_val,
       count(*) FILTER (WHERE tr > 0 AND te > 0) AS overlap_train_test,
       count(*) FILTER (WHERE va > 0 AND te > 0) AS overlap_val_test,
       CAST(sum(greatest(n - tr - va - te, 0)) AS BIGINT) AS missing_rows,
       CAST(sum(greatest(tr + va + te - n, 0)) AS BIGINT) AS extra_rows
FROM j""")
def q_split_integrity(spark, sf):
    placed = stable_table(split_articles(spark, sf).select("doc_id", "split"), "placed")
    return splits.split_integrity(placed, articles(spark, sf), unique_keys=True)


DAY_SQL = with_(DOCS) + """,
numbered AS (
    SELECT doc_id, title, body, category,
           CAST(row_number() OVER (ORDER BY title, doc_id) % 30 AS BIGINT) AS day_num
    FROM docs_articles WHERE body IS NOT NULL AND title IS NOT NULL)
"""


@register("day_partition", DAY_SQL + "SELECT doc_id, day_num FROM numbered")
def q_day_partition(spark, sf):
    return splits.day_numbers(docs_articles(spark, sf)).select("doc_id", "day_num")


@register("filter_day", DAY_SQL + """
SELECT doc_id, title, body, category AS true_label FROM numbered WHERE day_num = 7""")
def q_filter_day(spark, sf):
    d = splits.filter_day(docs_articles(spark, sf), 7)
    return d.select("doc_id", "title", "body", F.col("category").alias("true_label"))


@register("one_per_class", with_(DOCS) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY category
        ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM docs_articles)
SELECT category, doc_id, title, left(body, 300) AS preview FROM r WHERE rn = 1""")
def q_one_per_class(spark, sf):
    d = docs_articles(spark, sf)
    d = d.select("doc_id", "title", "category", F.left("body", F.lit(300)).alias("preview"))
    return sampling.one_per_class(d).select("category", "doc_id", "title", "preview")


@register("stratified_split_exact", with_(ARTICLES) + """,
r AS (SELECT doc_id, category,
             row_number() OVER (PARTITION BY category ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
             count(*) OVER (PARTITION BY category) AS n
      FROM src),
s AS (SELECT *, round(n * 0.1) AS t FROM r),
s2 AS (SELECT *, round((n - t) * 0.111) AS v FROM s)
SELECT doc_id, category,
       CASE WHEN rn <= t THEN 'test' WHEN rn <= t + v THEN 'val' ELSE 'train' END AS split
FROM s2""")
def q_stratified_split_exact(spark, sf):
    a = articles(spark, sf).select("doc_id", "category")
    return splits.stratified_split_exact(a).select("doc_id", "category", "split")


def _pct_sql(n: int) -> str:
    return f"least(round_even({n} / (SELECT count(*) FROM src) * 100, 0), 100)"


@register("sample_hash_label", with_(ARTICLES) + f"""
SELECT doc_id, category FROM src
WHERE ('0x' || substr(md5(category), 1, 8))::BIGINT % 100 < {_pct_sql(300)}""")
def q_sample_hash_label(spark, sf):
    a = articles(spark, sf).select("doc_id", "category")
    return sampling.sample_hash_label(a, 300, a.count())


@register("sample_hash_row", with_(ARTICLES) + f"""
SELECT doc_id, category FROM src
WHERE ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 100 < {_pct_sql(300)}""")
def q_sample_hash_row(spark, sf):
    a = articles(spark, sf).select("doc_id", "category")
    return sampling.sample_hash_row(a, 300, a.count())


@register("random_sample_n", with_(DOCS) + """
SELECT doc_id, title, category FROM docs_articles
WHERE body IS NOT NULL AND title IS NOT NULL
ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""")
def q_random_sample_n(spark, sf):
    d = docs_articles(spark, sf).where("body IS NOT NULL AND title IS NOT NULL")
    return sampling.random_sample_n(d.select("doc_id", "title", "category"), 100)


@register("limit_n", with_(DOCS) + """
SELECT doc_id, title, category FROM docs_articles ORDER BY doc_id LIMIT 5""")
def q_limit_n(spark, sf):
    d = docs_articles(spark, sf).select("doc_id", "title", "category")
    return sampling.limit_n(d, 5, F.col("doc_id"))


@register("order_by", with_(DOCS) + """
SELECT category, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, category) AS BIGINT) AS position
FROM docs_articles GROUP BY category""")
def q_order_by(spark, sf):
    counts = docs_articles(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    # the window sees one row per class
    w = Window.orderBy(F.col("n").desc(), F.col("category"))
    return counts.withColumn("position", F.row_number().over(w).cast("bigint")).orderBy("position")


@register("epoch_shuffle", with_(DOCS) + """
SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || '-1') AS epoch_order FROM docs_articles""")
def q_epoch_shuffle(spark, sf):
    return sampling.epoch_shuffle(docs_articles(spark, sf).select("doc_id"), 1)


def places_sql(epoch: int, batch_size: int) -> str:
    """The keyed permutation as a recursive walk: one round a step, again from the first while the place is beyond n."""
    keys = ", ".join(str(k) for k in epoch_order.round_keys(SEED, epoch))
    mix = """((xor(((xor({x} * 2654435761 + [""" + keys + """][i + 1], ({x} * 2654435761 + [""" + keys + """][i + 1]) >> 17)) & 2147483647)
              * 2246822519, (((xor({x} * 2654435761 + [""" + keys + """][i + 1], ({x} * 2654435761 + [""" + keys + """][i + 1]) >> 17)) & 2147483647)
              * 2246822519) >> 13)) & 2147483647)"""
    return "WITH RECURSIVE " + DOCS + f""",
numbered AS (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS "row" FROM docs_articles),
size AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b
         FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM docs_articles)),
walk AS (
  SELECT doc_id, "row" // b AS l, "row" % b AS r, 0 AS i, n, a, b FROM numbered CROSS JOIN size
  UNION ALL
  SELECT doc_id, CASE WHEN i % 2 = 0 THEN (l + {mix.format(x="r")}) % a ELSE l END,
         CASE WHEN i % 2 = 1 THEN (r + {mix.format(x="l")}) % b ELSE r END, i + 1, n, a, b
  FROM (SELECT doc_id, l, r, i % 6 AS i, n, a, b FROM walk WHERE i < 6 OR l * b + r >= n))
SELECT doc_id, l * b + r AS place, (l * b + r) // {batch_size} AS batch FROM walk WHERE i = 6 AND l * b + r < n"""


@register("epoch_places", places_sql(1, 32))
def q_epoch_places(spark, sf):
    """Place and mini-batch of every article in one epoch, from a keyed permutation of the row numbers."""
    d = docs_articles(spark, sf).select("doc_id")
    numbered = splits.global_row_number(d, [F.col("doc_id").asc_nulls_first()], "row").withColumn("row", F.col("row") - 1)
    return epoch_order.epoch_places(numbered, d.count(), 1, 32).select("doc_id", "place", "batch")
