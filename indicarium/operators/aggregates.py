"""Aggregations (2.G). All are hash aggregates with map-side partial
aggregation; array results are bounded by the number of distinct years."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicarium import schema as S


def group_sum(df: DataFrame, keys: list[str], measure: str, out: str = S.VALUE_COL) -> DataFrame:
    """G1: group-sum of one measure."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(out))


def group_sum_all(df: DataFrame, keys: list[str]) -> DataFrame:
    """Group-sum of every non-key column."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])


def row_sum(cols: list[str | Column]) -> Column:
    """Row-wise sum of columns."""
    return reduce(add, [F.col(c) if isinstance(c, str) else c for c in cols])


def bucket_columns(columns: list[str], ceiling: int, number_pattern: str,
                   seed: list[str] | None = None) -> list[str]:
    """G4 column choice (driver side, over column names): walk the
    columns in order, skip those without numbers, take those whose
    numbers are all <= ceiling and stop at the first one above it."""
    chosen = list(seed or [])
    rx = re.compile(number_pattern)
    for c in columns:
        nums = [int(x) for x in rx.findall(c)]
        if not nums:
            continue
        if any(n > ceiling for n in nums):
            break
        chosen.append(c)
    return chosen


def bucket_sum(df: DataFrame, key: str | list[str], ceiling: int, number_pattern: str,
               seed: list[str] | None = None, out: str = S.VALUE_COL) -> DataFrame:
    """Sum of the label columns up to the ceiling; '-' counts as 0 (E5)."""
    from indicarium.functions.numbers import dash_zero_int
    keys = [key] if isinstance(key, str) else list(key)
    chosen = bucket_columns([c for c in df.columns if c not in keys], ceiling, number_pattern, seed)
    types = dict(df.dtypes)
    parts = [dash_zero_int(F.col(f"`{c}`")) if types[c] == "string" else F.col(f"`{c}`").cast("bigint")
             for c in chosen]
    return df.select(*[F.col(f"`{k}`") for k in keys], row_sum(parts).alias(out))


def bucket_sum_long(df: DataFrame, keys: list[str], label: str, value: str, ceiling: int,
                    number_pattern: str = r"\d+", out: str = S.VALUE_COL) -> DataFrame:
    """G4 on long data: sum values of buckets whose label numbers are all
    within the ceiling."""
    nums = F.regexp_extract_all(F.col(label), F.lit(f"({number_pattern})"), 1).try_cast("array<int>")
    ok = (F.size(nums) > 0) & (F.array_max(nums) <= ceiling)
    return df.groupBy(*keys).agg(F.sum(F.when(ok, F.col(value))).alias(out))


def null_poison_sum(df: DataFrame, keys: list[str], value: str, out: str = S.VALUE_COL) -> DataFrame:
    """Sum across results; null when any contributing value is null."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.when(F.count(v) == F.count(F.lit(1)), F.sum(v)).alias(out))


def series_years(df: DataFrame, keys: list[str], year_col: str = S.YEAR_COL,
                 out: str = "anos") -> DataFrame:
    """Sorted distinct years of each series."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(F.col(year_col))).alias(out))


def years_by_frequency(df: DataFrame, year_col: str = S.YEAR_COL) -> DataFrame:
    """Years with their row counts, most frequent first (ties by year)."""
    return df.groupBy(year_col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), year_col)


def longest_series(df: DataFrame, series_keys: list[str], city_col: str = S.CITY_CODE_COL,
                   year_col: str = S.YEAR_COL, out: str = "anos") -> DataFrame:
    """Per series, the year list of the city holding the most years
    (ties: the smaller city code). Two bounded aggregates."""
    per_city = df.groupBy(*series_keys, city_col).agg(
        F.array_sort(F.collect_set(year_col)).alias("__years"))
    rank = F.struct(F.size("__years"), -F.col(city_col))
    return per_city.groupBy(*series_keys).agg(F.max_by("__years", rank).alias(out))


def collection_type(df: DataFrame, keys: list[str], tipo: str, order: str,
                    normal: Column | None = None, out: str = S.DTYPE_COL) -> DataFrame:
    """The type of a collection is the type of its last normal value."""
    t = F.col(tipo) if normal is None else F.when(normal, F.col(tipo))
    o = F.col(order) if normal is None else F.when(normal, F.col(order))
    # the last position of each type by a hash aggregate; then one row of a few types is chosen
    last = df.groupBy(*keys, t.alias("__t")).agg(F.max(o).alias("__o"))
    return last.groupBy(*keys).agg(F.max_by("__t", "__o").alias(out))
