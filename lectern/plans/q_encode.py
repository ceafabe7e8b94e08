"""Text encoding queries and mini-batch ids (2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import encode
from lectern.operators.evaluate import mini_batch_id
from lectern.operators.splits import filter_split
from lectern.plans.q_splits import split_articles
from lectern.plans.registry import register
from lectern.plans.views import DOCS, VOCAB, tok_sql, with_
from lectern.sources.articles import docs_articles, scan_articles
from lectern.labels import LANG2ID


def ids_text(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def train_vocab(spark, sf):
    a = scan_articles(docs_articles(spark, sf), LANG2ID).select("doc_id", "title", "category", "label", "text")
    from lectern.operators.splits import stratified_split

    train = filter_split(stratified_split(a), "train")
    return encode.build_vocab(train, "text")


def docs_tokens(spark, sf):
    return encode.tokenize(docs_articles(spark, sf).select("doc_id", "body"), "body")


@register("tokenize", with_(DOCS) + f"""
SELECT doc_id, CAST(len({tok_sql('body')}) AS BIGINT) AS n_tokens, array_to_string({tok_sql('body')}, ' ') AS tokens
FROM docs_articles""")
def q_tokenize(spark, sf):
    t = docs_tokens(spark, sf)
    return t.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


@register("build_vocab", with_(VOCAB) + "SELECT token, token_id, n FROM vocab")
def q_build_vocab(spark, sf):
    return train_vocab(spark, sf)


@register("join_vocab", with_(VOCAB) + "SELECT doc_id, pos, token_id FROM dids")
def q_join_vocab(spark, sf):
    return encode.join_vocab(docs_tokens(spark, sf), train_vocab(spark, sf)).select("doc_id", "pos", "token_id")


@register("encode_truncate_pad", with_(VOCAB) + """,
fr AS (SELECT doc_id, len(ids) AS n, list_concat([2], ids[1:510], [3]) AS body FROM idl)
SELECT doc_id, CAST(n AS BIGINT) AS n_tokens, md5(array_to_string(list_resize(body, 512, 0), ',')) AS ids_md5,
       CAST(len(body) AS BIGINT) AS mask_sum FROM fr""")
def q_encode_truncate_pad(spark, sf):
    e = encode.encode_truncate_pad(docs_tokens(spark, sf), train_vocab(spark, sf), max_length=512)
    return e.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"),
                    F.md5(ids_text("input_ids")).alias("ids_md5"),
                    F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("mask_sum"))


@register("encode_head_tail", with_(VOCAB) + """,
ht AS (SELECT doc_id, len(ids) AS n,
              CASE WHEN len(ids) > 510 THEN list_concat(ids[1:340], ids[len(ids) - 169:len(ids)]) ELSE ids END AS kept
       FROM idl),
fr AS (SELECT doc_id, n, list_concat([2], kept, [3]) AS body FROM ht)
SELECT doc_id, CAST(n AS BIGINT) AS n_tokens, md5(array_to_string(list_resize(body, 512, 0), ',')) AS ids_md5,
       CAST(len(body) AS BIGINT) AS mask_sum FROM fr""")
def q_encode_head_tail(spark, sf):
    e = encode.encode_head_tail(docs_tokens(spark, sf), train_vocab(spark, sf))
    return e.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"),
                    F.md5(ids_text("input_ids")).alias("ids_md5"),
                    F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("mask_sum"))


@register("pad_to_batch_max", with_(DOCS) + f""",
t AS (SELECT doc_id, len({tok_sql('body')}) AS n,
             (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch FROM docs_articles)
SELECT doc_id, CAST(batch AS BIGINT) AS batch, CAST(least(max(n + 2) OVER (PARTITION BY batch), 512) AS BIGINT) AS padded_len
FROM t""")
def q_pad_to_batch_max(spark, sf):
    t = docs_tokens(spark, sf).select("doc_id", F.size("tokens").alias("n_tokens"))
    return encode.pad_to_batch_max(t, 8).select("doc_id", "batch", "padded_len")


@register("mini_batch_id", with_(DOCS) + """
SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 32 AS BIGINT) AS batch FROM docs_articles""")
def q_mini_batch_id(spark, sf):
    return mini_batch_id(docs_articles(spark, sf).select("doc_id"), 32, [F.col("doc_id").asc()])
