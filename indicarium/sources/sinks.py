"""Sinks (2.B). A load's facts are one folder ``partitionBy`` (dado_id, ano) that a
commit makes visible (``sources.versions``); a task or job retried after an
executor loss writes the same partitions of the same folder again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from indicarium import schema as S


def write_facts(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", observe: tuple[Observation, list[Column]] | None = None) -> None:
    """B1: write facts as parquet; with ``overwrite`` only the partitions
    present in ``df`` are replaced (dynamic partition overwrite). ``observe``
    gathers figures of the rows in the job that writes them: G9 without a
    second scan. It stands behind the shuffle, in the stage that writes, so
    a task that is run again does not count twice."""
    parts = partition_by or ["dado_id", "ano"]
    # REBALANCE clusters rows by the partition columns (few files per
    # partition) and lets AQE split a hot (indicator, year) over several
    # tasks and merge small ones; a plain repartition would write a hot
    # partition from one task. Dynamic overwrite is a per-write option, so
    # the session's setting for other writes is left alone.
    out = df.hint("rebalance", *parts)
    if observe:
        out = out.observe(observe[0], *observe[1])
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def write_facts_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                     batch: int = S.JDBC_BATCH) -> None:
    """B1 (relational target): batched inserts, one transaction per task."""
    df.write.option("batchsize", str(batch)).jdbc(url, table, mode="append", properties=properties or {})


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """B2: CSV export with a header and no index."""
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)


def append_run_log(log: DataFrame, path: str) -> None:
    """Append run-log records (parquet)."""
    log.write.mode("append").parquet(path)


def run_log_text(log: DataFrame) -> DataFrame:
    """One text block per source, as the log file shows it."""
    point = F.transform("points", lambda p: F.format_string(
        "  %s: anos [%s], linhas %d", p["data_point"],
        F.array_join(F.transform(p["years"], lambda y: y.cast("string")), ", "), p["rows"]))
    return log.select("run", "source", F.concat_ws(
        "\n",
        F.format_string("fonte: %s  status: %s", F.col("source"), F.col("status")),
        F.format_string("inicio: %s  fim: %s", F.date_format("start", "yyyy-MM-dd HH:mm:ss"),
                        F.date_format("finish", "yyyy-MM-dd HH:mm:ss")),
        F.coalesce(F.col("info"), F.lit("")),
        F.array_join(point, "\n")).alias("texto"))


def update_indicator_years(indicator_dim: DataFrame, new_years: DataFrame,
                           name_col: str = "nome_dado") -> DataFrame:
    """The indicator dimension with its year arrays extended by the
    newly loaded years (matched on the normalised name). Written back by
    the caller (overwrite of a small table)."""
    from indicarium.functions.text import name_key
    from indicarium.operators.sets import years_union
    upd = new_years.select(name_key(name_col).alias("__nk"), F.col("anos").alias("__new"))
    out = indicator_dim.withColumn("__nk", name_key(name_col)).join(upd, "__nk", "left")
    return out.withColumn("anos_serie_historica", F.when(F.col("__new").isNull(), F.col("anos_serie_historica"))
                          .otherwise(years_union("anos_serie_historica", "__new"))).drop("__nk", "__new")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of a collection."""
    return df.limit(n)
