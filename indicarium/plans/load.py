"""Incremental load (L1) and run audit (L2) as Spark jobs.

The fact store is a versioned folder (``sources.versions``) whose loads are
partitioned by (dado_id, ano). A load writes its rows beside the store's, counts
them while it writes, takes out of the partitions that the store already has
what is there by key (late rows are merged, stored ones are not written twice),
and commits: one step makes all of it visible, or none. A load that is killed
leaves the store at its last version, and the next one starts over.
The indicator dimension's year arrays come from the commits, not from a scan.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions import text as X
from indicarium.operators import joins as J
from indicarium.operators import sets as U
from indicarium.operators import validate as K
from indicarium.plans import bindings as B
from indicarium.plans.queries import query
from indicarium.session import checkpoint_dir
from indicarium.sources import sinks
from indicarium.sources import versions as V

CTE = B.with_ctes


LOADED_SCHEMA = f"dado_id int, municipio_id int, {S.YEAR_COL} int, {S.DTYPE_COL} string, {S.VALUE_COL} string, load string"
#: What says that a row is in the store.
LOADED_KEY = ["dado_id", S.YEAR_COL, "municipio_id"]


def rows_to_load(facts: DataFrame, indicator_dim: DataFrame, municipality_dim: DataFrame,
                 cut_strings: bool = False) -> tuple[DataFrame, DataFrame]:
    """L1 plan: F7 -> J5/D12 -> F6 -> C12 (-> E15 when ``cut_strings``).

    Returns (rows in loaded-fact shape, indicator names with no dimension
    row). A year already in ``anos_serie_historica`` is not loaded again.
    The source cut every text to 20 lower-case characters on load (its
    VARCHAR(20) columns); that loses data, so it is off unless asked for.
    """
    matched, unknown = J.indicator_lookup(facts, S.DATA_ID_COL, indicator_dim)
    new = matched.filter(~F.coalesce(F.array_contains("anos_serie_historica", F.col(S.YEAR_COL)), F.lit(False)))
    keyed = J.to_surrogate(new, municipality_dim, S.CITY_CODE_COL, "municipio_id")
    out = keyed.select("dado_id", "municipio_id", S.YEAR_COL, S.DTYPE_COL, F.col(S.VALUE_COL).cast("string"))
    if cut_strings:
        out = out.withColumns({S.DTYPE_COL: X.lower_cut(S.DTYPE_COL), S.VALUE_COL: X.lower_cut(S.VALUE_COL)})
    return out, unknown


def read_store(spark: SparkSession, store: str, version: int | None = None) -> DataFrame | None:
    """The rows of the store's last version, or of an earlier one; None while it has none."""
    loads = [x for c in V.committed(spark, store) if version is None or c["version"] <= version for x in c["loads"]]
    columns = ["dado_id", "municipio_id", S.YEAR_COL, S.DTYPE_COL, S.VALUE_COL]
    return V.read_loads(spark, store, loads, LOADED_SCHEMA).select(*columns) if loads else None


def stored_years(commits: list[dict]) -> dict[int, list[int]]:
    """Indicator id -> years in the store, from its commits."""
    years: dict[int, set[int]] = {}
    for c in commits:
        for i, ys in c["years"]:
            years.setdefault(i, set()).update(ys)
    return {i: sorted(ys) for i, ys in years.items()}


def _years_frame(spark: SparkSession, years: dict[int, list[int]]) -> DataFrame:
    return J.literal_frame(spark, list(years.items()), "dado_id int, __stored array<int>")


def _in_pairs(years: dict[int, list[int]]) -> Column:
    """Rows of the (indicator, year) pairs: a filter on the partition columns alone."""
    return reduce(lambda a, b: a | b, [(F.col("dado_id") == i) & F.col(S.YEAR_COL).isin(ys) for i, ys in years.items()], F.lit(False))


def with_stored_years(indicator_dim: DataFrame, years: dict[int, list[int]]) -> DataFrame:
    """The indicator dimension with the store's years added to its arrays."""
    joined = indicator_dim.join(_years_frame(indicator_dim.sparkSession, years), "dado_id", "left")
    return joined.withColumn("anos_serie_historica", F.when(F.col("__stored").isNull(), F.col("anos_serie_historica")).otherwise(
        U.years_union("anos_serie_historica", "__stored"))).drop("__stored")


def _write_counted(rows: DataFrame, store: str, load: str, stored: dict[int, list[int]]) -> dict:
    """Write a load's folder; what it holds is counted by the job that writes it."""
    seen = Observation()
    one = F.lit(1)
    sinks.write_facts(rows, V.load_path(store, load), ["dado_id", S.YEAR_COL], mode="error", observe=(seen, [
        F.count(one).alias("rows"), F.count_if(_in_pairs(stored)).alias("touched"), F.count_if(F.col("municipio_id").isNull()).alias("unmatched"),
        F.count_if(F.col(S.YEAR_COL).isNull()).alias("undated"), F.collect_set(F.struct("dado_id", S.YEAR_COL)).alias("pairs")]))
    got = seen.get
    if got.get("undated"):
        raise K.ContractError(f"{got['undated']} rows without a year")
    years: dict[int, list[int]] = {}
    for i, y in sorted(tuple(p) for p in got.get("pairs") or []):
        years.setdefault(i, []).append(y)
    return {"rows": got.get("rows") or 0, "touched": got.get("touched") or 0, "unmatched": got.get("unmatched") or 0, "years": years}


def _write_late(spark: SparkSession, store: str, load: str, late: str, loads: list[str], touched: dict[int, list[int]]) -> dict:
    """Of a load's rows in partitions that the store has, write those whose key is not there, and drop the load's own copy."""
    where = _in_pairs(touched)
    fresh = V.read_loads(spark, store, [load], LOADED_SCHEMA).where(where).drop("load")
    # merge: by their bytes in parquet the store's keys pass for small long after a hash table of them is not (25 MB of files, 1.1 GB of table)
    known = V.read_loads(spark, store, loads, LOADED_SCHEMA).where(where).select(*[F.col(c).alias(f"__{c}") for c in LOADED_KEY]).hint("merge")
    # a city that was not found has a null id: null equals null here, or a rerun would add it again
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LOADED_KEY])
    out = _write_counted(fresh.join(known, same, "left_anti"), store, late, {})
    V.drop_partitions(spark, store, load, [f"dado_id={i}/{S.YEAR_COL}={y}" for i, ys in touched.items() for y in ys])
    return out


def load_incremental(facts: DataFrame, indicator_dim: DataFrame, municipality_dim: DataFrame,
                     store: str) -> dict:
    """L1: one version of ``store`` with the rows of ``facts`` that it does not hold.

    A year that the dimension lists and the store lacks was loaded elsewhere
    and is left out, as at the source. A year that the store has is merged:
    rows whose (indicator, year, city) is there are counted and left alone, the
    others are added. Rows of one load are never merged with each other. A row
    without a year fails the load, as nothing could tell whether it is there.

    Returns the inserted rows, those of them in years the store had (late), the rows that were there
    (present), the inserted rows of unknown cities (unmatched), the version, the
    indicator dimension with the store's years (for the caller to persist) and the unknown indicator names.
    Nothing inserted makes no version. When another load commits first, this
    one starts over on its version."""
    spark = facts.sparkSession
    K.require_columns(facts, S.FACT_COLUMNS, ordered=False)
    if V.holds_other_files(spark, store):
        raise ValueError(f"{store} holds files that no load wrote")
    while True:
        commits = V.committed(spark, store)
        stored, version = stored_years(commits), V.latest(commits)
        elsewhere = indicator_dim.join(_years_frame(spark, stored), "dado_id", "left").withColumn(
            "anos_serie_historica", U.years_new(F.coalesce("anos_serie_historica", F.array().cast("array<int>")), "__stored")).drop("__stored")
        # a few indicators deal the facts to as few tasks, unless their dimension is broadcast; AQE does not when few of its partitions have rows
        rows, unknown = rows_to_load(facts, J.listed(elsewhere.select("dado_id", "nome_dado", "topico", "anos_serie_historica")), municipality_dim)
        load = V.load_name(version + 1)
        wrote = _write_counted(rows, store, load, stored)
        touched = {i: t for i, ys in wrote["years"].items() if (t := [y for y in ys if y in stored.get(i, [])])}
        added, loads, late = wrote["rows"] - wrote["touched"], [load], {"rows": 0, "unmatched": 0, "years": {}}
        if touched:
            late = _write_late(spark, store, load, f"{load}-late", [x for c in commits for x in c["loads"]], touched)
            loads = ([load] if added else []) + ([f"{load}-late"] if late["rows"] else [])
        out = {"rows": added + late["rows"], "late": late["rows"], "present": wrote["touched"] - late["rows"]}
        if not out["rows"]:
            for x in {load, f"{load}-late"}:
                V.drop_load(spark, store, x)
            break
        years = {i: [y for y in ys if y not in touched.get(i, [])] + late["years"].get(i, []) for i, ys in wrote["years"].items()}
        if V.commit(spark, store, version + 1, loads, years=sorted((i, sorted(ys)) for i, ys in years.items() if ys), **out):
            commits, version = V.committed(spark, store), version + 1
            break
    return out | {"unmatched": wrote["unmatched"], "version": version, "unknown": unknown,
                  "indicator_dim": with_stored_years(indicator_dim, stored_years(commits))}


# ---------------------------------------------------------------------------
# registered L1: rows a load would insert, with years up to 1997 already loaded
# ---------------------------------------------------------------------------
L1_STORED = [1995, 1996, 1997]


def _l1_inputs(spark, t: B.Tables):
    o = B.order_facts(t)
    facts = o.groupBy("codigo_municipio", "ano", F.col("o_orderpriority").alias(S.DATA_ID_COL)).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias(S.VALUE_COL)) \
        .withColumn(S.DTYPE_COL, F.lit("float"))
    # indicator dimension: one row per indicator present in the facts
    dim = o.select(F.col("o_orderpriority").alias("nome_dado")).distinct().select(
        F.substring("nome_dado", 1, 1).cast("int").alias("dado_id"),
        F.upper(F.replace(F.col("nome_dado"), F.lit("-"), F.lit(" - "))).alias("nome_dado"),
        F.lit("Pedidos").alias("topico"),
        F.array(*[F.lit(y) for y in L1_STORED]).alias("anos_serie_historica"))
    mun = B.municipalities(t).select("municipio_id", "codigo_municipio")
    return facts, dim, mun


@query("l1_incremental_load", CTE(B.MUN_SQL, B.ORD_SQL) + f"""
, f AS (SELECT codigo_municipio, ano, o_orderpriority AS dado_identificador,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS valor FROM ord GROUP BY 1, 2, 3)
SELECT CAST(substr(f.dado_identificador, 1, 1) AS INTEGER) AS dado_id, m.municipio_id, f.ano,
       'float' AS tipo_dado, f.valor
FROM f LEFT JOIN mun m ON f.codigo_municipio = m.codigo_municipio
WHERE f.ano NOT IN ({", ".join(map(str, L1_STORED))})""")
def l1_incremental_load(spark, d):
    facts, dim, mun = _l1_inputs(spark, B.Tables(spark, d))
    rows, _unknown = rows_to_load(facts, dim, mun)
    return rows


@query("e15_load_text_cut", CTE(B.MUN_SQL, B.ORD_SQL) + """
SELECT DISTINCT o_orderpriority, substr(lower(concat(o_orderpriority, ' ', CAST(codigo_municipio AS VARCHAR), ' Valor Total')), 1, 20) AS texto FROM ord""")
def e15_load_text_cut(spark, d):
    o = B.order_facts(B.Tables(spark, d))
    text = F.concat_ws(" ", "o_orderpriority", F.col("codigo_municipio").cast("string"), F.lit("Valor Total"))
    return o.select("o_orderpriority", text.alias("texto")).withColumn("texto", X.lower_cut("texto")).distinct()


@query("l1_load_roundtrip", CTE(B.MUN_SQL, B.ORD_SQL) + f"""
, f AS (SELECT codigo_municipio, ano, o_orderpriority AS dado_identificador,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS valor FROM ord GROUP BY 1, 2, 3),
  g AS (SELECT CAST(substr(f.dado_identificador, 1, 1) AS INTEGER) AS dado_id, m.municipio_id, f.ano, f.valor
        FROM f LEFT JOIN mun m ON f.codigo_municipio = m.codigo_municipio WHERE f.ano NOT IN ({", ".join(map(str, L1_STORED))}))
SELECT dado_id, municipio_id, ano, valor,
       array_to_string(list_sort(list_distinct(list_concat([{", ".join(map(str, L1_STORED))}], list(ano) OVER (PARTITION BY dado_id)))), ',') AS anos
FROM g""")
def l1_load_roundtrip(spark, d):
    """A load and a rerun of it, then what the store and the dimension hold."""
    facts, dim, mun = _l1_inputs(spark, B.Tables(spark, d))
    store = f"{checkpoint_dir(spark)}/roundtrip-{uuid.uuid4().hex}"
    out = load_incremental(facts, dim, mun, store)
    again = load_incremental(facts, out["indicator_dim"], mun, store)
    years = again["indicator_dim"].select("dado_id", F.array_join(F.transform("anos_serie_historica", lambda y: y.cast("string")), ",").alias("anos"))
    return (read_store(spark, store).join(years, "dado_id")
            .select("dado_id", "municipio_id", S.YEAR_COL, S.VALUE_COL, "anos"))


# ---------------------------------------------------------------------------
# L2 run audit: one record per source with its data points
# ---------------------------------------------------------------------------
def run_audit(facts_by_source: DataFrame, run_id: str, start: dt.datetime, finish: dt.datetime) -> DataFrame:
    """L2: run-log records (schema RUN_LOG_SCHEMA) from per-source,
    per-data-point row counts and years; one small record per source."""
    per_point = facts_by_source.groupBy("source", "data_point").agg(
        F.array_sort(F.collect_set("year")).alias("years"), F.count(F.lit(1)).alias("rows"))
    per_source = per_point.groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct("data_point", "years", "rows"))).alias("points"))
    return per_source.select(
        F.lit(run_id).alias("run"), "source",
        F.lit(start).cast("timestamp").alias("start"), F.lit(finish).cast("timestamp").alias("finish"),
        F.when(F.size("points") > 0, F.lit("ok")).otherwise(F.lit("vazio")).alias("status"),
        F.lit(None).cast("string").alias("info"), "points")


@query("l2_run_audit", """
SELECT source, 'ok' AS status, count(*) AS linhas, count(DISTINCT lang) AS pontos,
       array_to_string(list_sort(list_distinct(list(lang))), ', ') AS idiomas
FROM documents GROUP BY source""")
def l2_run_audit(spark, d):
    docs = B.Tables(spark, d).documents
    src = docs.select("source", F.col("lang").alias("data_point"), F.lit(None).cast("int").alias("year"))
    log = run_audit(src, "auditoria", dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1))
    return log.select("source", "status",
                      F.aggregate("points", F.lit(0).cast("bigint"), lambda a, p: a + p["rows"]).alias("linhas"),
                      F.size("points").cast("bigint").alias("pontos"),
                      F.array_join(F.transform("points", lambda p: p["data_point"]), ", ").alias("idiomas"))
