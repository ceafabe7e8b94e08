"""Text cleaning and measuring expressions.

All of these compile to JVM expressions inside whole-stage codegen except
``nfkc``, which has no Spark built-in and runs as an Arrow-batched pandas
UDF (standard-library normaliser, ASCII values skipped).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lectern.labels import ENTITY_PATTERN, PREVIEW_CHARS, TAG_PATTERN, WS_PATTERN

# Leading / trailing runs of any Unicode white space or separator.
EDGE_SPACE_PATTERN = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_tags(col: Column | str) -> Column:
    """Replace every ``<...>`` run by one space."""
    return F.regexp_replace(_c(col), TAG_PATTERN, " ")


def strip_entities(col: Column | str) -> Column:
    """Replace the five XML entities, ``&nbsp;`` and numeric ones by a space.

    Entities are deleted, not decoded; other named entities stay.
    """
    return F.regexp_replace(_c(col), ENTITY_PATTERN, " ")


def trim_unicode(col: Column | str) -> Column:
    """Trim all Unicode white space, not only U+0020."""
    return F.regexp_replace(_c(col), EDGE_SPACE_PATTERN, "")


def collapse_ws(col: Column | str) -> Column:
    """White-space runs to one space, then trim."""
    return trim_unicode(F.regexp_replace(_c(col), WS_PATTERN, " "))


def _nfkc_one(x):
    if x is None or (isinstance(x, float) and x != x):
        return None
    # ASCII text is already in NFKC; skip the normaliser for it.
    return x if x.isascii() else unicodedata.normalize("NFKC", x)


@F.pandas_udf(StringType())
def _nfkc_udf(s: pd.Series) -> pd.Series:
    # pyarrow's utf8_normalize does not recompose (e + U+0301 stays two code
    # points), so the standard library normaliser is used per value.
    return s.map(_nfkc_one, na_action="ignore")


def nfkc(col: Column | str) -> Column:
    """Unicode NFKC normalisation; NULL stays NULL."""
    value = _c(col)  # ASCII text is in NFKC already and stays in the JVM
    return F.coalesce(_nfkc_udf(F.when(value.rlike(r"[^\x00-\x7F]"), value)), value)


def clean_title(col: Column | str, normalize: bool = True) -> Column:
    out = collapse_ws(col)
    return nfkc(out) if normalize else out


def clean_text(col: Column | str, normalize: bool = True) -> Column:
    """Tags, entities, white space, NFKC - in this order."""
    out = collapse_ws(strip_entities(strip_tags(col)))
    return nfkc(out) if normalize else out


def char_length(col: Column | str) -> Column:
    return F.length(_c(col)).cast("bigint")


def word_count(col: Column | str) -> Column:
    """Pieces of a split on one space; empty pieces count ('' -> 1)."""
    return F.size(F.split(_c(col), " ", -1)).cast("bigint")


def preview(col: Column | str, n: int = PREVIEW_CHARS) -> Column:
    return F.left(_c(col), F.lit(n))


def text_with_title(title: Column | str, text: Column | str) -> Column:
    """``title + ' ' + text``; NULL when either side is NULL."""
    return F.concat(_c(title), F.lit(" "), _c(text))


def first_line(col: Column | str) -> Column:
    return F.substring_index(_c(col), "\n", 1)
