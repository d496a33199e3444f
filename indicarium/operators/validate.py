"""Validation (2.K). Every rule of the fact contract is evaluated in ONE
aggregate pass (one job, partial aggregation per task); ``enforce_contract``
instead checks inline with ``raise_error`` so that validation rides along
with the write and needs no extra pass over the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicarium import schema as S


class ContractError(ValueError):
    pass


def _rules(max_year: Column | None = None) -> dict[str, Column]:
    year = F.col(S.YEAR_COL)
    code = F.col(S.CITY_CODE_COL)
    top = max_year if max_year is not None else F.year(F.current_date())
    return {
        "ano_invalido": year.isNull() | (year < S.OLDEST_YEAR) | (year > top),
        "codigo_invalido": code.isNull() | (code < S.SMALLEST_CITY_CODE) | (code > S.HIGHEST_CITY_CODE),
        "dado_nulo": F.col(S.DATA_ID_COL).isNull(),
        "tipo_invalido": F.col(S.DTYPE_COL).isNull() | ~F.col(S.DTYPE_COL).isin(*S.TYPE_TAGS),
        "valor_nulo": F.col(S.VALUE_COL).isNull(),
    }


#: Columns of the fact contract whose type is fixed; a value may be of any type.
FACT_TYPES = {S.YEAR_COL: T.IntegralType, S.CITY_CODE_COL: T.IntegralType, S.DATA_ID_COL: T.StringType, S.DTYPE_COL: T.StringType}


def require_types(df: DataFrame) -> None:
    """K1: years and codes are whole numbers, names and tags are text."""
    wrong = [f"{c}: {df.schema[c].dataType.simpleString()}" for c, t in FACT_TYPES.items() if not isinstance(df.schema[c].dataType, t)]
    if wrong:
        raise ContractError(f"wrong column types: {', '.join(wrong)}")


def contract_report(df: DataFrame, group: list[str] | None = None) -> DataFrame:
    """K1/K2: violation counts of the fact contract (types, ranges, enum,
    non-null; code width checked on every row), optionally per group.
    Schema problems (missing/extra columns) are reported as counts too."""
    missing = [c for c in S.FACT_COLUMNS if c not in df.columns]
    extra = [c for c in df.columns if c not in S.FACT_COLUMNS and c not in (group or [])]
    if missing:
        raise ContractError(f"missing fact columns {missing}")
    require_types(df)
    aggs = [F.count(F.lit(1)).alias("linhas")]
    aggs += [F.sum(F.when(rule, 1).otherwise(0)).cast("bigint").alias(name)
             for name, rule in _rules().items()]
    out = df.groupBy(*(group or [])).agg(*aggs)
    return out.withColumn("colunas_extras", F.lit(len(extra)).cast("bigint"))


def assert_contract(df: DataFrame) -> None:
    """K1 strict mode: raise when any rule is broken (collects one row)."""
    row = contract_report(df).first()
    bad = {k: v for k, v in row.asDict().items() if k != "linhas" and v}
    if bad:
        raise ContractError(f"fact contract violated: {bad}")


def _in_place(test: Column) -> Column:
    """The test, tied to its place in the plan. A filter that raises must not be
    moved below a filter or join before it: it would fail on rows that those
    take out. Spark moves no expression that depends on the row's place."""
    return test & (F.monotonically_increasing_id() >= 0)


def enforce_contract(df: DataFrame) -> DataFrame:
    """K1 inline: the same rules as a lazy check; a broken row fails the
    job when the data is written, without a separate pass."""
    extra = [c for c in df.columns if c not in S.FACT_COLUMNS]
    if extra:
        raise ContractError(f"extra columns {extra}")
    require_types(df)
    bad = reduce(lambda a, b: a | b, _rules().values())
    # a filter (not a dropped column) so that column pruning cannot remove the check
    guard = F.when(_in_place(bad), F.raise_error(F.lit("fact contract violated")).cast("boolean")).otherwise(F.lit(True))
    return df.filter(guard).select(*S.FACT_COLUMNS)


def require_rows(df: DataFrame) -> None:
    """K3: fail on an empty load."""
    if df.isEmpty():
        raise ContractError("empty load")


def require_columns(df: DataFrame, columns: list[str], ordered: bool = True) -> None:
    """K3: fail on a column-count / name mismatch (``ordered``: or another order)."""
    if (list if ordered else sorted)(df.columns) != (list if ordered else sorted)(columns):
        raise ContractError(f"columns {df.columns} != {columns}")


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """K4: number of rows missing any of the required fields."""
    any_null = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields])
    return df.agg(F.sum(F.when(any_null, 1).otherwise(0)).cast("bigint").alias("campos_ausentes"))


def enforce_fields(df: DataFrame, fields: list[str], what: str = "required field missing") -> DataFrame:
    """K4 inline: fail the job on a row missing any required field (checked
    while the rows flow, no extra pass)."""
    any_null = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields])
    guard = F.when(_in_place(any_null), F.raise_error(F.lit(what)).cast("boolean")).otherwise(F.lit(True))
    return df.filter(guard)


def exactly_one(df: DataFrame, keys: list[str], expected: DataFrame) -> DataFrame:
    """K5: expected keys that resolve to no row or to several (n != 1)."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (expected.select(*keys).distinct().join(found, keys, "left")
            .withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")).filter(F.col("n") != 1))
