"""Registered queries of the load: what a killed load leaves, ids dealt before facts, late rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.operators.joins import literal_frame
from indicarium.plans import bindings as B
from indicarium.plans import load as L
from indicarium.plans.queries import query
from indicarium.session import checkpoint_dir
from indicarium.sources import versions as V

CTE = B.with_ctes
FACTS_SQL = """f AS (SELECT codigo_municipio, ano, o_orderpriority AS nome, CAST(count(*) AS VARCHAR) AS valor FROM ord GROUP BY 1, 2, 3)"""


def _store(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/loads/{uuid.uuid4().hex}"


def _facts(t: B.Tables) -> DataFrame:
    return B.order_facts(t).groupBy("codigo_municipio", "ano", F.col("o_orderpriority").alias(S.DATA_ID_COL)).agg(
        F.count(F.lit(1)).cast("string").alias(S.VALUE_COL)).withColumn(S.DTYPE_COL, F.lit("int"))


def _dims(spark: SparkSession, t: B.Tables) -> tuple[DataFrame, DataFrame]:
    names = t.orders.select(F.col("o_orderpriority").alias("nome_dado")).distinct()
    dim = names.select(F.substring("nome_dado", 1, 1).cast("int").alias("dado_id"), "nome_dado", F.lit("t").alias("topico"), F.lit(None).cast("array<int>").alias("anos_serie_historica"))
    return dim, B.municipalities(t).select("municipio_id", "codigo_municipio")


def _counts(store: DataFrame | None, like: DataFrame, name: str) -> DataFrame:
    rows = like.limit(0).select("ano") if store is None else store.select("ano")
    return rows.groupBy("ano").agg(F.count(F.lit(1)).alias(name))


@query("l1_commit_rollback", CTE(B.ORD_SQL, FACTS_SQL) + """
SELECT ano, count(*) FILTER (codigo_municipio % 2 = 0) AS antes, count(*) FILTER (codigo_municipio % 2 = 0) AS depois_da_queda, count(*) AS depois FROM f GROUP BY 1""")
def l1_commit_rollback(spark, d):
    """Rows a year that a reader sees: after a load, after one that died with all of its files written, after that one's rerun."""
    t, store = B.Tables(spark, d), _store(spark)
    facts, (dim, mun) = _facts(t), _dims(spark, t)
    L.load_incremental(facts.where("codigo_municipio % 2 = 0"), dim, mun, store)
    before = _counts(L.read_store(spark, store), facts, "antes")
    # what a load leaves that dies before its commit: a folder of rows, years that the store has among them
    L._write_counted(L.rows_to_load(facts, dim, mun)[0], store, V.load_name(2), {})
    killed = _counts(L.read_store(spark, store), facts, "depois_da_queda")
    L.load_incremental(facts, dim, mun, store)
    out = _counts(L.read_store(spark, store), facts, "depois")
    return out.join(before, "ano", "left").join(killed, "ano", "left").select("ano", F.coalesce("antes", F.lit(0)).alias("antes"), F.coalesce("depois_da_queda", F.lit(0)).alias("depois_da_queda"), "depois")


@query("l1_late_rows", CTE(B.ORD_SQL, FACTS_SQL) + """
, a AS (SELECT DISTINCT nome, ano FROM f WHERE codigo_municipio % 2 = 0),
c AS (SELECT count(*) AS n, count(*) FILTER (codigo_municipio % 2 = 0) AS e, count(*) FILTER (codigo_municipio % 2 <> 0 AND a.ano IS NOT NULL) AS tarde FROM f LEFT JOIN a ON f.nome = a.nome AND f.ano = a.ano)
SELECT 1 AS passo, e AS inseridas, 0 AS tardias, 0 AS presentes, e AS na_loja FROM c
UNION ALL SELECT 2, n - e, tarde, e, n FROM c
UNION ALL SELECT 3, 0, 0, n, n FROM c""")
def l1_late_rows(spark, d):
    """A file of half the cities, then one of all cities in the same years, then that one again: what each load adds."""
    t, store = B.Tables(spark, d), _store(spark)
    facts, (dim, mun) = _facts(t), _dims(spark, t)
    rows = []
    for step, part in enumerate((facts.where("codigo_municipio % 2 = 0"), facts, facts), 1):
        out = L.load_incremental(part, dim, mun, store)
        stored = L.read_store(spark, store)
        rows.append((step, out["rows"], out["late"], out["present"], stored.count() if stored else 0))
    return literal_frame(spark, rows, "passo int, inseridas long, tardias long, presentes long, na_loja long")


@query("l1_stable_ids", CTE(B.MUN_SQL, B.ORD_SQL, FACTS_SQL) + """
, i AS (SELECT nome, CAST(row_number() OVER (ORDER BY nome) AS INTEGER) AS dado_id FROM (SELECT DISTINCT nome FROM f))
SELECT i.dado_id, f.nome AS nome_dado, f.ano, m.municipio_id, f.valor FROM f JOIN i ON f.nome = i.nome LEFT JOIN mun m ON f.codigo_municipio = m.codigo_municipio""")
def l1_stable_ids(spark, d):
    """Indicators of a run that died before its facts keep their ids; the next run's get others; then the first run is made up for."""
    from indicarium.plans.run import read_dimension, register_indicators

    t, store = B.Tables(spark, d), _store(spark)
    facts, (_, mun) = _facts(t), _dims(spark, t)
    path = f"{store}-indicadores"
    names = sorted(r[0] for r in facts.select(S.DATA_ID_COL).distinct().collect())  # indicators, not facts
    first = names[: len(names) // 2]
    register_indicators(spark, path, first, "primeira")
    dim = register_indicators(spark, path, names[len(first):], "segunda")
    L.load_incremental(facts.where(~F.col(S.DATA_ID_COL).isin(first)), dim, mun, store)
    dim = register_indicators(spark, path, [n.upper() for n in first], "primeira")
    L.load_incremental(facts.where(F.col(S.DATA_ID_COL).isin(first)), dim, mun, store)
    return L.read_store(spark, store).join(read_dimension(spark, path), "dado_id").select("dado_id", "nome_dado", "ano", "municipio_id", S.VALUE_COL)
