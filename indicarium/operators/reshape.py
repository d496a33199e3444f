"""Wide <-> long reshaping (2.H). ``unpivot`` compiles to one Expand node,
however many columns it turns into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicarium import schema as S


def _q(name: str):
    """A column by its literal name (names from public files hold dots,
    spaces and parentheses)."""
    return F.col(f"`{name}`")


def unpivot_years(df: DataFrame, ids: list[str], year_cols: list[str] | None = None,
                  value: str = S.VALUE_COL, year_col: str = S.YEAR_COL,
                  value_type: str | None = None) -> DataFrame:
    """H1: year-named columns -> (ano INT, valor)."""
    cols = year_cols or [c for c in df.columns if c not in ids]
    src = df
    if value_type:
        src = df.select(*[_q(i) for i in ids], *[_q(c).cast(value_type).alias(c) for c in cols])
    long = src.unpivot([_q(i) for i in ids], [_q(c) for c in cols], year_col, value)
    return long.withColumn(year_col, F.col(year_col).try_cast("int"))


def unpivot_indicators(df: DataFrame, ids: list[str], indicator_cols: list[str] | None = None,
                       name_col: str = S.DATA_ID_COL, value: str = S.VALUE_COL,
                       value_type: str | None = None) -> DataFrame:
    """H2: indicator columns -> (dado_identificador, valor). Mixed column
    types are first cast to ``value_type``."""
    cols = indicator_cols or [c for c in df.columns if c not in ids]
    src = df
    if value_type:
        src = df.select(*[_q(i) for i in ids], *[_q(c).cast(value_type).alias(c) for c in cols])
    return src.unpivot([_q(i) for i in ids], [_q(c) for c in cols], name_col, value)


def map_to_rows(df: DataFrame, map_col: str, key: str = S.YEAR_COL, value: str = "raw") -> DataFrame:
    """H3: a map column (year -> value) to rows."""
    rest = [c for c in df.columns if c != map_col]
    return df.select(*rest, F.explode(F.col(map_col)).alias(key, value))


def rows_to_fact(df: DataFrame, city: str, year: str, data_id: str, tipo: str, value: str) -> DataFrame:
    """H5: shape rows into the fact columns with integer casts and drop
    rows with a null anywhere."""
    out = df.select(F.col(city).cast("bigint").alias(S.CITY_CODE_COL),
                    F.col(year).cast("int").alias(S.YEAR_COL),
                    F.col(data_id).cast("string").alias(S.DATA_ID_COL),
                    F.col(tipo).alias(S.DTYPE_COL),
                    F.col(value).alias(S.VALUE_COL))
    return out.dropna(how="any")
