"""The ETL run: requested sources -> pipelines -> incremental load -> run log.

    python -m indicarium.plans.run --sf /root/testdata/sf0.001 --store <folder> --request capag idhm

A request names sources case- and space-insensitively; an empty request or
``todos`` runs every source, unknown names are reported. Each source's
facts are loaded with the idempotent incremental load, so a rerun inserts
nothing new. Indicators get their ids in the dimension, which is committed
before any of their facts are: a run that dies leaves names without
facts, never facts without a name. One run-log record per source holds its data points
(indicator, years, rows), status and timing; a source that failed makes the process end with 1.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions.text import name_key
from indicarium.operators import validate as K
from indicarium.operators.joins import literal_frame, request_filter
from indicarium.operators.ordering import ranges_by_rank
from indicarium.plans import bindings as B
from indicarium.plans.load import load_incremental, stored_years, with_stored_years
from indicarium.session import materialize
from indicarium.sources import versions as V

# source name -> registered pipeline query, or queries
SOURCES = {
    "datasus": ("p1", "p1_catalogue"), "empregos_formais": "p2", "capag": "p3", "ensino_superior": "p4",
    "distorcao_idade_serie": "p5", "ideb": "p6", "idhm": "p7", "rede_de_cidades": "p8", "munic": ("p9", "p9_catalogue"),
    "pib_municipal": "p10", "equipamentos_escolares": "p11", "agregados": ("p12", "p12_text", "p12_catalogue"), "homicidios": "p13",
    "banda_larga": "p14", "saneamento_e_rais": ("p15", "p15_snis_catalogue", "p15_rais_catalogue"),
}


def resolve_request(request: list[str] | None) -> tuple[list[str], list[str]]:
    """(sources to run, unknown names); names compared lower-case without
    spaces or underscores; empty or 'todos' means every source."""
    def key(s: str) -> str:
        return s.lower().replace(" ", "").replace("_", "")
    by_key = {key(s): s for s in SOURCES}
    req = request or []
    if not req or "todos" in [key(r) for r in req]:
        return list(SOURCES), []
    chosen, unknown = [], []
    for r in req:
        (chosen if key(r) in by_key else unknown).append(by_key.get(key(r), r))
    return list(dict.fromkeys(chosen)), unknown


DIM_SCHEMA = "dado_id int, nome_dado string, topico string, anos_serie_historica array<int>"


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The committed indicator dimension (the folder of its last version); empty before the first run."""
    commits = V.committed(spark, path)
    if not commits:
        return spark.createDataFrame([], DIM_SCHEMA)
    return V.read_loads(spark, path, commits[-1]["loads"], f"{DIM_SCHEMA}, load string").drop("load")


def update_dimension(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Commit what ``change`` makes of the dimension as its next version, a folder of its own.

    When another run commits first, the change is made again on that run's
    version. The last version is never touched, so a reader always has a whole one."""
    while True:
        version = V.latest(V.committed(spark, path)) + 1
        load = V.load_name(version)
        change(read_dimension(spark, path)).write.parquet(V.load_path(path, load))
        if V.commit(spark, path, version, [load]):
            return read_dimension(spark, path)


def deal_ids(df: DataFrame, by: str, first: int, name: str) -> DataFrame:
    """``df`` with consecutive numbers from ``first`` on in the order of ``by``.

    Ranges of the order are written once; each is numbered by itself, from
    where the ranges before it end, so no task sees all rows."""
    placed = ranges_by_rank(df, [by], 1 << 20)
    sizes = sorted(tuple(r) for r in placed.groupBy("__range").count().collect())
    starts = [(r, first + sum(n for _, n in sizes[:i])) for i, (r, _) in enumerate(sizes)]
    starts = literal_frame(df.sparkSession, starts, "__range int, __start long")
    within = F.row_number().over(Window.partitionBy("__range").orderBy(by)) - 1
    return placed.join(starts, "__range").withColumn(name, F.col("__start") + within).drop("__range", "__start")


def indicator_dim(facts: DataFrame, topic: str, known: DataFrame) -> DataFrame:
    """The known dimension and a row for each indicator that is new in the
    facts. Names that differ in case or blanks alone are one indicator. New
    ids follow the largest known one, in the order of names."""
    key = name_key("nome_dado")
    names = facts.select(F.col(S.DATA_ID_COL).alias("nome_dado")).groupBy(key.alias("__k")).agg(F.min("nome_dado").alias("nome_dado"))
    new = names.join(known.select(key.alias("__k")), "__k", "left_anti").select("nome_dado")
    top = known.agg(F.coalesce(F.max("dado_id"), F.lit(0))).first()[0]
    rows = deal_ids(new, "nome_dado", top + 1, "dado_id").select(
        F.col("dado_id").cast("int"), "nome_dado", F.lit(topic).alias("topico"), F.lit(None).cast("array<int>").alias("anos_serie_historica"))
    return materialize(known.unionByName(rows))


def register_indicators(spark: SparkSession, path: str, names: list[str], topic: str) -> DataFrame:
    """The dimension with an id for each name, committed; run before the names' facts are loaded. Two runs at once get different ids."""
    listed = literal_frame(spark, [(n,) for n in names], f"{S.DATA_ID_COL} string")
    known = read_dimension(spark, path)
    if listed.join(known.select(name_key("nome_dado").alias("__k")), name_key(S.DATA_ID_COL) == F.col("__k"), "left_anti").isEmpty():
        return known
    return update_dimension(spark, path, lambda dim: indicator_dim(listed, topic, dim))


def run_etl(spark: SparkSession, sf_dir: str, store: str, request: list[str] | dict[str, list[str]] | None = None,
            dimension: str | None = None) -> tuple[DataFrame, list[str]]:
    """Run the requested sources; returns (run log, unknown names).

    A request is a list of sources, or a source -> indicators map (an empty
    list of indicators asks for all). ``dimension`` is the folder of the
    indicator dimension, by default beside the store; new indicators are
    committed to it before each source's load, the years that are in the store after it."""
    from indicarium.plans.queries import registered
    queries = registered()
    chosen, unknown = resolve_request(list(request or []))
    wanted = {resolve_request([k])[0][0]: v for k, v in request.items() if resolve_request([k])[0]} if isinstance(request, dict) else {}
    path = dimension or f"{store.rstrip('/')}-indicadores"
    run_id = uuid.uuid4().hex[:12]
    mun = B.municipalities(B.Tables(spark, sf_dir)).select("municipio_id", "codigo_municipio")
    records = []
    for source in chosen:
        start = dt.datetime.now()
        points, status, info = [], "ok", None
        try:
            names = SOURCES[source]
            parts = [queries[n][0](spark, sf_dir).withColumn(S.VALUE_COL, F.col(S.VALUE_COL).cast("string"))
                     for n in ([names] if isinstance(names, str) else names)]
            facts = reduce(lambda a, b: a.unionByName(b), parts)
            if wanted.get(source):
                facts, missing = request_filter(facts, S.DATA_ID_COL, wanted[source])
                unknown += [f"{source}: {r.name}" for r in missing.collect()]
            # computed once: the load and the run log both read this copy
            facts = materialize(facts)
            # per data point: years and rows (one small aggregate, which the ids need as well)
            points += [(r[0], list(r[1]), int(r[2])) for r in facts.groupBy(S.DATA_ID_COL).agg(
                F.array_sort(F.collect_set(S.YEAR_COL)), F.count(F.lit(1))).collect()]
            if not points:
                raise K.ContractError("empty load")
            dim = register_indicators(spark, path, [p[0] for p in points], source)
            out = load_incremental(facts, dim, mun, store)
            update_dimension(spark, path, lambda dim: with_stored_years(dim, stored_years(V.committed(spark, store))))
            info = f"linhas inseridas: {out['rows']}" + (f", das quais tardias: {out['late']}" if out["late"] else "")
        except Exception as e:  # noqa: BLE001 - one failing source must not stop the others
            status, info = "erro", str(e)
        records.append((run_id, source, start, dt.datetime.now(), status, info, points))
    log = spark.createDataFrame(records, S.RUN_LOG_SCHEMA)
    return log, unknown


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Run indicator sources into a fact store.")
    p.add_argument("--sf", required=True, help="folder with the source tables")
    p.add_argument("--store", required=True, help="fact store folder (partitioned by dado_id, ano)")
    p.add_argument("--log", help="run-log folder (parquet, appended)")
    p.add_argument("--request", nargs="*", default=[], help="sources to run (default: todos)")
    a = p.parse_args(argv)
    from indicarium.session import get_spark
    from indicarium.sources.sinks import append_run_log, run_log_text
    spark = get_spark()
    log, unknown = run_etl(spark, a.sf, a.store, a.request)
    if a.log:
        append_run_log(log, a.log)
    for row in run_log_text(log).collect():
        print(row.texto)
    if unknown:
        print("fontes desconhecidas:", ", ".join(unknown))
    return int(not log.where("status = 'erro'").isEmpty())


if __name__ == "__main__":
    sys.exit(main())
