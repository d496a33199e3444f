"""Set operations (2.J)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicarium import schema as S


def union_years(frames: list[DataFrame] | dict[int, DataFrame], year_col: str = S.YEAR_COL) -> DataFrame:
    """Union of yearly tables; a dict adds its key as the year; missing
    columns become null. One Union node after CombineUnions."""
    if isinstance(frames, dict):
        frames = [df.withColumn(year_col, F.lit(y).cast("int")) for y, df in sorted(frames.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_disjoint(*frames: DataFrame) -> DataFrame:
    """Union of disjoint filters (prefer one predicate, see D9)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_difference(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``df`` absent from ``other``."""
    return df.select(*keys).distinct().join(other.select(*keys), keys, "left_anti")


def years_union(a: Column | str, b: Column | str) -> Column:
    """Union of two year arrays, distinct and sorted."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.array_sort(F.array_union(F.coalesce(ca, F.array().cast("array<int>")),
                                      F.coalesce(cb, F.array().cast("array<int>"))))


def years_new(new: Column | str, old: Column | str) -> Column:
    """Years of ``new`` not in ``old``."""
    cn = F.col(new) if isinstance(new, str) else new
    co = F.col(old) if isinstance(old, str) else old
    return F.array_except(cn, F.coalesce(co, F.array().cast("array<int>")))
