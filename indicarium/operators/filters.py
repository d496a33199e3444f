"""Row filters (2.D) at the DataFrame level. Plain predicates compile to
one Filter that Catalyst pushes into the scan where it can."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def in_list(df: DataFrame, col: str, values) -> DataFrame:
    """IN-list filter with a literal list."""
    return df.filter(F.col(col).isin(*values))


def in_catalogue(df: DataFrame, col: str, catalogue: DataFrame, cat_col: str) -> DataFrame:
    """D1 (catalogue-driven): keep rows whose ``col`` appears in a catalogue."""
    cat = catalogue.select(F.col(cat_col).alias("__k")).distinct()
    return df.join(cat, F.col(col) == F.col("__k"), "left_semi")


def in_lists(df: DataFrame, lists: dict[str, list]) -> DataFrame:
    """Conjunction of IN-lists (one predicate)."""
    pred = reduce(lambda a, b: a & b, [F.col(c).isin(*v) for c, v in lists.items()])
    return df.filter(pred)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``subset`` (all columns by default)."""
    return df.dropna(how="any", subset=subset)


def schema_drift_guard(df: DataFrame, min_columns: int = 4) -> bool:
    """A table with too few columns is skipped (driver-side check of
    the schema only)."""
    return len(df.columns) >= min_columns
