"""Joins (2.F): key resolution against dimensions, catalogue joins,
zero fill and request filtering.

Only frames that the driver built carry a broadcast hint (``literal_frame``); for
every other side Spark and AQE decide from sizes in bytes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indicarium import schema as S
from indicarium.functions.numbers import seven_digit
from indicarium.functions.text import name_key, text_key


#: Rows of a driver-built frame up to which it carries a broadcast hint.
LITERAL_ROWS = 20_000


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """A frame of rows that the driver holds (a catalogue, a request, years of
    partitions), hinted to be broadcast: joins with it shuffle nothing. Its
    size is known here and nowhere later, so the hint is given here, up to
    ``LITERAL_ROWS``; a larger one is an ordinary side of a join."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= LITERAL_ROWS else df


def listed(df: DataFrame) -> DataFrame:
    """A catalogue that was read from files as a ``literal_frame``, when it has ``LITERAL_ROWS`` rows at most; else as it is."""
    rows = df.take(LITERAL_ROWS + 1)
    return literal_frame(df.sparkSession, [tuple(r) for r in rows], df.schema) if len(rows) <= LITERAL_ROWS else df


def municipality_code6(municipalities: DataFrame) -> DataFrame:
    """(six-digit code, seven-digit code) pairs: the six-digit code is the
    seven-digit one without its check digit."""
    code = F.col(S.CITY_CODE_COL)
    return municipalities.select(F.floor(code / 10).cast("bigint").alias("__code6"),
                                 code.alias("__code7"))


def upgrade_city_code(df: DataFrame, code_col: str, municipalities: DataFrame) -> DataFrame:
    """codes that already have seven digits pass through; others are
    six-digit codes upgraded by a left join on the first six digits of
    the reference list (unmatched -> null). Checked per row."""
    dim = municipality_code6(municipalities)
    code = F.col(code_col).cast("bigint")
    joined = df.join(dim, code == F.col("__code6"), "left")
    return (joined.withColumn(code_col, F.when(seven_digit(code), code).otherwise(F.col("__code7")))
                  .drop("__code6", "__code7"))


def resolve_by_name_state(df: DataFrame, name_col: str, uf_col: str, municipalities: DataFrame, fold: bool = False) -> DataFrame:
    """inner equi-join on (lower/no-space name, state); unmatched rows
    drop, duplicate (name, state) pairs in the reference list fan out.
    Accents are compared as written (as the source does) unless ``fold``,
    which matches on the folded text key (E13) instead."""
    key = text_key if fold else name_key
    dim = municipalities.select(key("nome_municipio").alias("__nk"),
                                F.col("sigla_uf").alias("__uf"), S.CITY_CODE_COL)
    keyed = df.withColumn("__nk_l", key(name_col))
    out = keyed.join(dim,
                     (F.col("__nk_l") == F.col("__nk")) & (F.col(uf_col) == F.col("__uf")), "inner")
    return out.drop("__nk_l", "__nk", "__uf")


def unique_lookup(df: DataFrame, keys: dict[str, Column], lookup: DataFrame,
                  lookup_keys: dict[str, Column], value: Column, out_col: str,
                  missing=-1) -> DataFrame:
    """resolve each row to the lookup value when its key matches
    exactly one lookup row; no match or several matches give ``missing``.
    The lookup is reduced to one row per key first, so nothing fans out."""
    names = list(keys)
    per_key = (lookup.groupBy(*[c.alias(f"__k_{n}") for n, c in lookup_keys.items()])
                     .agg(F.count(F.lit(1)).alias("__n"), F.min(value).alias("__v")))
    resolved = F.when(F.col("__n") == 1, F.col("__v"))
    left = df.withColumns({f"__l_{n}": keys[n] for n in names})
    cond = reduce(lambda a, b: a & b, [F.col(f"__l_{n}") == F.col(f"__k_{n}") for n in names])
    out = left.join(per_key, cond, "left")
    return (out.withColumn(out_col, F.coalesce(resolved, F.lit(missing)))
               .drop(*[f"__l_{n}" for n in names], *[f"__k_{n}" for n in names], "__n", "__v"))


def fanout_sum(df: DataFrame, lookup: DataFrame, on: str, target: str,
               measures: list[str]) -> DataFrame:
    """F4 + G2 without materialising the fan-out: sum the measures per
    entity name first, count lookup rows per (name, target), then join the
    two small aggregates and multiply. Equal to joining row by row and
    summing by ``target`` because a sum distributes over the copies."""
    per_name = df.groupBy(on).agg(*[F.sum(m).alias(m) for m in measures])
    copies = lookup.groupBy(on, target).agg(F.count(F.lit(1)).alias("__copies"))
    joined = per_name.join(copies, on, "inner")
    return joined.groupBy(target).agg(*[F.sum(F.col(m) * F.col("__copies")).alias(m) for m in measures])


def outer_merge(frames: list[DataFrame], key: str, unique_keys: bool = False) -> DataFrame:
    """N-way full outer merge on one key.

    By default a chain of full outer joins, in which duplicate keys pair up.
    With ``unique_keys`` (each sheet has at most one row per key, as survey
    sheets keyed by city do) the merge is one union and one aggregate: a
    single shuffle for any number of sheets. The same aggregate counts the
    rows of each sheet; a key that a sheet holds twice is an error, and so are
    sheets that share another column's name."""
    if not unique_keys:
        return reduce(lambda a, b: a.join(b, key, "full_outer"), frames)
    cols = [c for f in frames for c in f.columns if c != key]
    if len(set(cols)) < len(cols):
        raise ValueError(f"sheets share column names: {sorted({c for c in cols if cols.count(c) > 1})}")
    sheets = [f.withColumn("__sheet", F.lit(i)) for i, f in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sheets)
    out = merged.groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols],
                                  F.count(F.lit(1)).alias("__rows"), F.collect_set("__sheet").alias("__sheets"))
    twice = F.raise_error(F.concat(F.lit("a sheet holds this key twice: "), F.col(key).cast("string")))
    checked = F.when(F.col("__rows") > F.size("__sheets"), twice).otherwise(F.lit(True))
    return out.where(checked.cast("boolean")).select(key, *cols)


def to_surrogate(df: DataFrame, dim: DataFrame, natural: str = S.CITY_CODE_COL,
                 surrogate: str = "municipio_id") -> DataFrame:
    """replace a natural key with the dimension's surrogate key (left
    join; unmatched -> null)."""
    d = dim.select(F.col(natural).alias("__nat"), F.col(surrogate).alias("__sur"))
    out = df.join(d, F.col(natural) == F.col("__nat"), "left")
    return out.withColumn(surrogate, F.col("__sur")).drop("__nat", "__sur", natural)


def indicator_lookup(df: DataFrame, name_col: str, indicator_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """attach (dado_id, topico, anos_serie_historica) by indicator name,
    case- and space-insensitive. Returns (matched rows, unmatched names)."""
    dim = indicator_dim.select(name_key("nome_dado").alias("__nk"), "dado_id", "topico",
                               "anos_serie_historica")
    keyed = df.withColumn("__nk_l", name_key(name_col))
    matched = keyed.join(dim, F.col("__nk_l") == F.col("__nk"), "inner").drop("__nk_l", "__nk")
    unmatched = (keyed.select(F.col(name_col), F.col("__nk_l")).distinct()
                      .join(dim, F.col("__nk_l") == F.col("__nk"), "left_anti").drop("__nk_l"))
    return matched, unmatched


def catalogue_join(df: DataFrame, catalogue: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """F8: attach catalogue attributes (topic, type) by (year, code) or
    (variable, classification). A catalogue that the driver built comes with
    its hint (``literal_frame``), through the selections made of it."""
    return df.join(catalogue, keys, how)


def zero_fill_sum(df: DataFrame, keys: list[str], keep: Column, measure: str,
                  out: str = S.VALUE_COL) -> DataFrame:
    """sum ``measure`` over rows passing ``keep``; keys whose rows all
    fail ``keep`` come back with 0. One aggregate (one shuffle) instead of
    filter + anti join + union; partial aggregation runs map-side."""
    return df.groupBy(*keys).agg(
        F.sum(F.when(keep, F.col(measure)).otherwise(F.lit(0))).alias(out))


def request_filter(df: DataFrame, col: str, request: list[str] | None,
                   all_token: str = "todos") -> tuple[DataFrame, DataFrame]:
    """keep rows whose normalised ``col`` is requested (lower case, no
    spaces); an empty request or the ``todos`` key keeps everything.
    Returns (kept rows, requested names that match nothing)."""
    spark = df.sparkSession
    req = [r for r in (request or [])]
    norm = [r.lower().replace(" ", "") for r in req]
    empty = spark.createDataFrame([], "name string")
    if not req or all_token in norm:
        return df, empty
    req_df = literal_frame(spark, list(zip(req, norm)), "name string, __rk string")
    keyed = df.withColumn("__dk", name_key(col))
    kept = keyed.join(req_df.select("__rk"), F.col("__dk") == F.col("__rk"),
                      "left_semi").drop("__dk")
    present = keyed.select("__dk").distinct()
    unknown = req_df.join(present, F.col("__rk") == F.col("__dk"), "left_anti").select("name")
    return kept, unknown
