"""Class-score arithmetic on array columns, all JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def softmax(z: Column | str) -> Column:
    """exp(z - max z) / sum exp(z - max z), element order kept."""
    z = _c(z)
    m = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / total)


def argmax_label(scores: Column | str) -> Column:
    """0-based index of the largest score; ties give the lowest index."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("bigint")


def pick(probs: Column | str, idx: Column | str) -> Column:
    """probs[idx] for a 0-based index column; NULL index -> NULL."""
    return F.try_element_at(_c(probs), (_c(idx) + 1).cast("int"))


def confidence(probs: Column | str, predicted: Column | str) -> Column:
    return pick(probs, predicted)


def true_confidence(probs: Column | str, true_id: Column | str) -> Column:
    return pick(probs, true_id)


def scores_map(probs: Column | str, classes: Sequence[str]) -> Column:
    names = F.array(*[F.lit(c) for c in classes])
    return F.map_from_arrays(names, _c(probs))


def scores_wide(scores: Column | str, classes: Sequence[str], prefix: str = "prob_") -> list[Column]:
    """One column per class from a label -> score map; missing class -> 0.0."""
    m = _c(scores)
    return [F.coalesce(F.try_element_at(m, F.lit(c)), F.lit(0.0)).alias(f"{prefix}{c}") for c in classes]


def round4(col: Column | str) -> Column:
    return F.round(_c(col), 4)


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """NULL when the denominator is zero or NULL."""
    return F.try_divide(_c(a), _c(b))


def zero_divide(a: Column | str, b: Column | str) -> Column:
    """0.0 when the denominator is zero (report convention)."""
    return F.coalesce(F.try_divide(_c(a).cast("double"), _c(b)), F.lit(0.0))


def label_lookup(mapping: Mapping[str, int]) -> Column:
    """Literal map category -> id."""
    items = sorted(mapping.items(), key=lambda kv: kv[1])
    return F.create_map(*[x for k, v in items for x in (F.lit(k), F.lit(v).cast("bigint"))])


def encode_label(col: Column | str, mapping: Mapping[str, int]) -> Column:
    """Category -> id; unknown -> NULL (row kept)."""
    return F.try_element_at(label_lookup(mapping), _c(col))


def decode_label(col: Column | str, classes: Sequence[str]) -> Column:
    """id -> class name; out-of-range id -> NULL."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.try_element_at(names, (_c(col) + 1).cast("int"))
