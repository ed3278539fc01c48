"""Numeric and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_tf(n: Column) -> Column:
    """``1 + log10(n)`` for positive counts, else 0."""
    return F.when(n > 0, F.lit(1.0) + F.log10(n.cast("double"))).otherwise(F.lit(0.0))


def idf(n_docs: Column, df: Column) -> Column:
    """``log10(N / df)``; 0 when the term is in no document."""
    ratio = n_docs.cast("double") / F.when(df > 0, df).cast("double")
    return F.coalesce(F.log10(ratio), F.lit(0.0))


def bce_with_logits(z: Column, y: Column | float) -> Column:
    """Logistic loss that does not overflow for large logits."""
    y = y if isinstance(y, Column) else F.lit(float(y))
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def l2_norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def softmax(a: Column) -> Column:
    """Probabilities from an array of logits, shifted by its maximum."""
    top = F.array_max(a)
    e = F.transform(a, lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / total)


def log_softmax(a: Column) -> Column:
    top = F.array_max(a)
    total = F.aggregate(a, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))
    return F.transform(a, lambda v: v - top - F.log(total))


def argmax(a: Column) -> Column:
    """0-based index of the first largest entry."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def pad_to(a: Column, n: Column | int, fill: Column) -> Column:
    """Cut to ``n`` entries, or fill up to ``n``."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.concat(F.slice(a, F.lit(1), n), F.array_repeat(fill, F.greatest(n - F.size(a), F.lit(0))))


def map_get(m: Column, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(m, key), default)


def fourier_terms(t: Column, orders: int, period: float) -> list[Column]:
    """``sin_order_k`` and ``cos_order_k`` for k = 1..orders."""
    import math

    out = []
    for k in range(1, orders + 1):
        angle = F.lit(2.0 * math.pi) * (t.cast("double") / F.lit(float(period))) * F.lit(float(k))
        out.append(F.sin(angle).alias(f"sin_order_{k}"))
        out.append(F.cos(angle).alias(f"cos_order_{k}"))
    return out
