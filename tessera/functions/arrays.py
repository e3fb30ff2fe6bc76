"""Set measures on token lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unique(a: Column) -> Column:
    """Number of distinct non-null elements."""
    return F.size(F.array_distinct(F.array_compact(a)))


def common(a: Column, b: Column) -> Column:
    return F.size(F.array_compact(F.array_intersect(a, b)))


def overlap(a: Column, b: Column) -> Column:
    """Common elements over the smaller set; 0 if one is empty."""
    least = F.least(unique(a), unique(b))
    return F.when(least == 0, F.lit(0.0)).otherwise(common(a, b) / least).cast("float")


def jaccard(a: Column, b: Column) -> Column:
    either = unique(a) + unique(b) - common(a, b)
    return F.when(either == 0, F.lit(0.0)).otherwise(common(a, b) / either).cast("float")


def equal_sets(a: Column, b: Column) -> Column:
    """Both hold elements and the same ones."""
    return (unique(a) > 0) & (unique(b) > 0) & (common(a, b) == unique(a)) & (common(a, b) == unique(b))


def bucket(c: Column, n: int) -> Column:
    """0 to n - 1, from the first 32 bits of the MD5 of a string; the same number in other engines."""
    return (F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long") % n).cast("int")
