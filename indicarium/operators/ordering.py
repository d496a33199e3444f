"""Ordering, ranking and year bookkeeping (2.I). Windows are always
partitioned by a key; single-winner choices use ``max_by`` aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.session import materialize


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per key keep the row listed last (highest ``order``)."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("__r"))
    return picked.select(*keys, "__r.*")


def ranges_by_rank(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """``df`` with ``__range``: numbered ranges of the order ``by`` of about
    ``rows`` rows each, whatever its values and gaps (Spark samples the bounds;
    equal rows stay together). Written, as bounds are sampled anew whenever a plan runs."""
    ranges = df.select(*by).count() // rows + 2
    return materialize(df.repartitionByRange(ranges, *by).withColumn("__range", F.spark_partition_id()))


def fill_missing_year(df: DataFrame, year_col: str, order: str, partition: list[str] | None = None,
                      out: str | None = None, chunk: int | None = 1 << 20) -> DataFrame:
    """A missing year is the last known year + 1; the last known year
    stays the same across consecutive gaps. A leading gap has no
    predecessor and stays null.

    A window over a whole source would put a hot source (a third of all
    rows) in one task. With chunking the fill is a parallel prefix scan:
    1. the rows are dealt out by ranges of (source, order) and written, each
       with its range: about ``chunk`` rows by rank, whatever the units and
       gaps of ``order`` are (Spark samples the bounds);
    2. per (source, range) the last known year (an aggregate, partial on
       the map side);
    3. per range the carry-in: the last known year of earlier ranges (a
       window over one small row for each range that a source reaches into);
    4. inside each (source, range) a window, falling back to the carry-in.
    ``chunk`` does not change the result, only how many rows a task holds.
    ``None`` uses one window per source. A null source is a source too. Rows
    of one source with equal ``order`` are in one range and in no order.
    """
    part = list(partition or [])
    res = out or year_col
    y, o = F.col(year_col), F.col(order)
    if not chunk:
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(res, F.coalesce(y, F.last(y, ignorenulls=True).over(w) + 1))
    keyed = ranges_by_rank(df, [*part, order], chunk)
    # one row per (source, range): its last known year (null when it has none)
    per_range = keyed.groupBy(*part, "__range").agg(
        F.max_by(y, F.when(y.isNotNull(), o)).alias("__last"))
    wc = Window.partitionBy(*part).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    names = [*part, "__range"]
    carry = per_range.select(*[F.col(p).alias(f"__s_{p}") for p in names], F.last("__last", ignorenulls=True).over(wc).alias("__in"))
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__s_{p}")) for p in names])
    wl = Window.partitionBy(*part, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("__prev", F.last(y, ignorenulls=True).over(wl))
    filled = local.join(carry, same, "left").drop(*[f"__s_{p}" for p in names])
    prev = F.coalesce(F.col("__prev"), F.col("__in"))
    return filled.withColumn(res, F.coalesce(y, prev + 1)).drop("__range", "__prev", "__in")


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keep-first de-duplication with an explicit total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def best_dataset(df: DataFrame, keys: list[str], name: str, years: str, pos: str) -> DataFrame:
    """I4: per key the file with the newest maximum year (first listed on
    ties), with its series length (1 for one year, else last - first) and
    its first/last years."""
    ys = F.col(years)
    cand = df.select(*keys, name, pos, ys.alias("__y")).filter(F.size("__y") > 0)
    cand = cand.withColumn("__max", F.array_max("__y"))
    best = cand.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(name).alias("arquivo"), F.col("__y").alias("__yy")),
                 F.struct(F.col("__max"), -F.col(pos))).alias("__b"))
    yy = F.col("__b.__yy")
    return best.select(
        *keys, F.col("__b.arquivo").alias("arquivo"),
        F.when(F.size(yy) == 1, F.lit(1)).otherwise(F.element_at(yy, -1) - F.element_at(yy, 1)).alias("anos_serie"),
        F.element_at(yy, 1).alias("primeiro_ano"), F.element_at(yy, -1).alias("ultimo_ano"))


def sort_years(c: Column | str) -> Column:
    """Sorted year array."""
    return F.array_sort(F.col(c) if isinstance(c, str) else c)


def first_n(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows per key in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def expand_year_range(df: DataFrame, first: str, last: str, out: str = S.YEAR_COL) -> DataFrame:
    """(first, last) -> one row per year."""
    return df.withColumn(out, F.explode(F.sequence(F.col(first), F.col(last))))
