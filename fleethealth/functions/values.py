"""Numbers, bins and ordered folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def finite(c: Column) -> Column:
    """The number, or null where it is null, not a number or infinite."""
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def right_closed(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the bin (a, b] that c is in, the first and the last bin being open; null stays null."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges")
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(c <= edge, label)
    return out.otherwise(labels[-1])


def lookup(c: Column, table: dict[str, float], default: float | None) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where whole is 0."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(0.0)


def ordered_sum(order: Column, value: Column) -> Column:
    """Sum of a group's values from left to right in the given order, so that rounding is the same every time."""
    items = F.sort_array(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.aggregate(items, F.lit(0.0), lambda a, x: a + x["v"])


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))


def robust_scaled(c: Column, median: Column, iqr: Column) -> Column:
    return (c - median) / F.when(iqr == 0, 1.0).otherwise(iqr)


def one_hot(c: Column, vocabulary: Sequence[str], prefix: str, missing: str = "__missing__") -> list[Column]:
    """0 or 1 for each value but the first; null counts as ``missing``, values outside the vocabulary give zeros."""
    filled = F.coalesce(c, F.lit(missing))
    return [(filled == v).cast("double").alias(f"{prefix}_{v}") for v in list(vocabulary)[1:]]
