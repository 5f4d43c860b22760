"""Similarity kernels as Columns (K1-K4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """K1: 1 - distance / longer length; 1 for equal texts (also empty ones), 0 against an empty one."""
    ratio = 1.0 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(ratio)


def overlap(a: Column, b: Column) -> Column:
    """Number of distinct common elements."""
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """K2, K3: of the arrays' sets; 0 if either is empty."""
    return F.coalesce(F.try_divide(overlap(a, b), F.size(F.array_union(a, b))), F.lit(0.0))


def prefix_ratio(a: Column, b: Column) -> Column:
    """K4: length of the common prefix over the longer length; 0 if either is empty.

    Prefix equality only goes from true to false as the prefix grows, so equal prefixes can be counted.
    """
    shorter = F.least(F.length(a), F.length(b))
    same = F.filter(F.sequence(F.lit(1), F.greatest(shorter, F.lit(1))), lambda i: F.left(a, i) == F.left(b, i))
    return F.when(shorter == 0, 0.0).otherwise(F.size(same) / F.greatest(F.length(a), F.length(b), F.lit(1)))
