"""Article-shaped views over the given tables.

``docs_articles``  documents -> doc_id, title (first line), body, category (lang)
``pages_articles`` pages     -> doc_id, title (<title>), body (html), category (lang attribute)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.scores import encode_label
from lectern.functions.text import first_line
from lectern.sources.tables import read_table

TITLE_TAG = r"(?s)<title>(.*?)</title>"
LANG_ATTR = r"lang=\"([^\"]*)\""


def docs_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return d.select(
        "doc_id",
        first_line("text").alias("title"),
        F.col("text").alias("body"),
        F.col("lang").alias("category"),
    )


def pages_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages", ["page_id", "html"], balance_key="page_id")
    return p.select(
        F.col("page_id").alias("doc_id"),
        F.nullif(F.regexp_extract("html", TITLE_TAG, 1), F.lit("")).alias("title"),
        F.col("html").alias("body"),
        F.nullif(F.regexp_extract("html", LANG_ATTR, 1), F.lit("")).alias("category"),
    )


def scan_articles(df: DataFrame, mapping: Mapping[str, int], text_col: str = "body",
                  label_col: str = "category", title_col: str = "title",
                  key_col: str = "doc_id") -> DataFrame:
    """Extraction: chosen columns, renamed, label encoded, NULL rows dropped.

    ``title_col`` is honoured in both the filter and the projection.
    """
    return (
        df.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()
                 & F.col(title_col).isNotNull())
        .select(
            F.col(key_col).alias("doc_id"),
            F.col(title_col).alias("title"),
            F.col(label_col).alias("category"),
            F.col(text_col).alias("text"),
            encode_label(label_col, mapping).alias("label"),
        )
    )


def scan_projected(df: DataFrame, use_title: bool = False) -> DataFrame:
    """The training reader's projection: ``text,label`` (+ ``title``)."""
    cols = ["doc_id", "text", "label"] + (["title"] if use_title else [])
    return df.select(*cols)
