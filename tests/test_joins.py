"""The salted join: same rows as a plain join, and no key fills a task by itself."""

from pyspark.sql import functions as F

from lectern.operators import joins
from lectern.operators.sizing import default_partitions


def tables(spark):
    """A third of all rows hold one token, a tenth another; some tokens and keys are null or unknown."""
    key = (F.when(F.col("id") % 3 == 0, "the").when(F.col("id") % 10 == 1, "of").when(F.col("id") % 97 == 2, None)
           .otherwise(F.concat(F.lit("w"), F.col("id") % 500)))
    facts = spark.range(30_000).select(F.col("id").alias("doc"), key.alias("token"))
    dim = spark.range(450).select(F.concat(F.lit("w"), "id").alias("token"), F.col("id").alias("n"))
    return facts, dim.unionByName(spark.createDataFrame([("the", -1), ("of", -2)], "token string, n long"))


def test_equals_plain_join(spark):
    facts, dim = tables(spark)
    for how in ("left", "inner"):
        want = sorted(facts.join(dim, "token", how).select("doc", "token", "n").collect(), key=str)
        got = sorted(joins.lookup_join(facts, dim, "token", how, "doc").select("doc", "token", "n").collect(), key=str)
        assert got == want


def test_hot_keys_are_cut_by_their_count(spark):
    facts, dim = tables(spark)
    tasks = default_partitions(facts)
    hot = {r.token: r._pieces for r in joins.hot_keys(facts, "token", tasks).collect()}
    assert set(hot) == {"the", "of"} and hot["the"] > 2 * hot["of"] > 0
    f, d = joins.salted(facts, dim, "token", "doc")
    share = 30_000 / (joins.FINENESS * tasks)
    assert f.groupBy("token", "_salt").count().agg(F.max("count")).first()[0] <= 1.5 * share
    assert d.count() == dim.count() + sum(hot.values()) - len(hot)
    tasks_rows = f.repartition(tasks, "token", "_salt").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert tasks_rows.max() <= 2 * tasks_rows.median()


def test_empty_sides(spark):
    facts, dim = tables(spark)
    assert joins.lookup_join(facts.limit(0), dim, "token").count() == 0
    assert joins.lookup_join(facts, dim.limit(0), "token").where("n IS NOT NULL").count() == 0
