"""Registered queries that write with one operator and read back with
another: flat JSON, reference list, CSV export, dimension years, run checks
and the stream form of the load."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.operators import filters as D
from indicarium.operators import joins as J
from indicarium.operators import schema_ops as C
from indicarium.operators import sets as U
from indicarium.operators import validate as K
from indicarium.plans import bindings as B
from indicarium.plans.load import read_store, run_audit
from indicarium.plans.queries import REGISTRY, _api_documents, query
from indicarium.session import checkpoint_dir
from indicarium.sources import readers as A
from indicarium.sources import sinks
from indicarium.streaming.incremental import stream_incremental_load

CTE = B.with_ctes


def _folder(spark, kind: str) -> str:
    return f"{checkpoint_dir(spark)}/landed/{kind}-{uuid.uuid4().hex}"


@query("a6_flat_json", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS periodo, o_orderstatus AS valor, CAST(o_custkey AS VARCHAR) AS cod
FROM orders""")
def a6_flat_json(spark, d):
    """One file holds one JSON array, of the records of a thousand order keys."""
    o = B.Tables(spark, d).orders
    record = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("periodo"),
                      F.col("o_orderstatus").alias("valor"), F.col("o_custkey").cast("string").alias("cod"))
    arrays = o.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("file")).agg(F.to_json(F.collect_list(record)).alias("value"))
    path = _folder(spark, "series")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return A.read_flat_json(spark, path)


@query("a11_reference_list", CTE(B.MUN_SQL) + "SELECT nome_municipio AS chave, codigo_municipio AS valor FROM mun")
def a11_reference_list(spark, d):
    path = _folder(spark, "municipios")
    m = B.municipalities(B.Tables(spark, d)).select(S.CITY_CODE_COL, "nome_municipio", "sigla_uf")
    sinks.export_csv(m, path)
    return A.name_code_map(A.read_municipalities(spark, path))


@query("b2_export_csv", CTE(B.ORD_SQL) + "SELECT codigo_municipio, ano, count(*) AS n, max(o_orderstatus) AS estado FROM ord GROUP BY 1, 2")
def b2_export_csv(spark, d):
    path = _folder(spark, "exportado")
    o = B.order_facts(B.Tables(spark, d))
    sinks.export_csv(o.groupBy("codigo_municipio", "ano").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderstatus").alias("estado")), path, sep=";")
    return A.delimited_scan(spark, path, "codigo_municipio long, ano int, n long, estado string", encoding="UTF-8")


@query("b4_dimension_years", CTE(B.ORD_SQL) + """
SELECT o_orderpriority AS nome_dado, array_to_string(list_sort(list_distinct(list_append(list(ano), 1990))), ',') AS anos FROM ord GROUP BY 1""")
def b4_dimension_years(spark, d):
    o = B.order_facts(B.Tables(spark, d))
    dim = o.select(F.col("o_orderpriority").alias("nome_dado")).distinct().withColumn("anos_serie_historica", F.array(F.lit(1990)))
    new = o.groupBy(F.upper("o_orderpriority").alias("nome_dado")).agg(F.collect_set("ano").alias("anos"))
    out = sinks.update_indicator_years(dim, new)
    return out.select("nome_dado", F.array_join(F.transform("anos_serie_historica", lambda y: y.cast("string")), ",").alias("anos"))


@query("c13_shifted_header", "SELECT c_custkey AS codigo, c_name AS nome FROM customer")
def c13_shifted_header(spark, d):
    """A header that begins one column too early, with an empty last column."""
    shifted = B.Tables(spark, d).customer.select(F.col("c_custkey").alias("indice"), F.col("c_name").alias("codigo"), F.lit("").alias("nome"))
    return C.shifted_header_repair(shifted)


@query("d14_schema_drift", "SELECT o_orderkey FROM orders")
def d14_schema_drift(spark, d):
    """Editions of too few columns are left out, the others are read."""
    o = B.Tables(spark, d).orders
    editions = [o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), o.select("o_orderkey", "o_custkey")]
    kept = [e.select("o_orderkey") for e in editions if D.schema_drift_guard(e)]
    out = kept[0]
    for e in kept[1:]:
        out = out.unionByName(e)
    return out


@query("k5_exactly_one", """
SELECT c.c_custkey AS custkey, count(o.o_orderkey) AS n FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY 1 HAVING count(o.o_orderkey) <> 1""")
def k5_exactly_one(spark, d):
    t = B.Tables(spark, d)
    return K.exactly_one(t.orders.select(F.col("o_custkey").alias("custkey")), ["custkey"], t.customer.select(F.col("c_custkey").alias("custkey")))


@query("n_stream_load", CTE(B.MUN_SQL, B.ORD_SQL) + """
, f AS (SELECT codigo_municipio, ano, count(*) AS n FROM ord GROUP BY 1, 2)
SELECT 1 AS dado_id, m.municipio_id, f.ano, 'int' AS tipo_dado, CAST(f.n AS VARCHAR) AS valor
FROM f LEFT JOIN mun m ON f.codigo_municipio = m.codigo_municipio WHERE f.ano <> 1995""")
def n_stream_load(spark, d):
    """Landed files that cut across the years, taken two at a time, and what the store holds then."""
    t = B.Tables(spark, d)
    o, root = B.order_facts(t), _folder(spark, "fluxo")
    facts = o.groupBy("codigo_municipio", "ano").agg(F.count(F.lit(1)).cast("string").alias("valor")).select(
        "codigo_municipio", "ano", F.lit("Pedidos").alias(S.DATA_ID_COL), F.lit("int").alias(S.DTYPE_COL), "valor")
    facts.repartition(5, "codigo_municipio").write.parquet(f"{root}/chegada")
    dim = spark.createDataFrame([(1, "pedidos", "t", [1995])], "dado_id int, nome_dado string, topico string, anos_serie_historica array<int>")
    mun = B.municipalities(t).select("municipio_id", "codigo_municipio")
    stream_incremental_load(spark, f"{root}/chegada", f"{root}/fatos", dim, mun, checkpoint=f"{root}/progresso", max_files_per_batch=2)
    return read_store(spark, f"{root}/fatos").select("dado_id", "municipio_id", S.YEAR_COL, S.DTYPE_COL, S.VALUE_COL)


@query("b3_run_log", """
WITH p AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT 'r' || r AS run, source, concat('fonte: ', source, '  status: ok', chr(10), 'inicio: 2000-01-01 00:00:00  fim: 2000-01-01 00:00:00', chr(10), chr(10),
       string_agg(concat('  ', lang, ': anos [], linhas ', n), chr(10) ORDER BY lang)) AS texto
FROM p, (VALUES (1), (2)) v(r) GROUP BY 1, 2""")
def b3_run_log(spark, d):
    """The logs of two runs, appended to one folder and read back as text."""
    docs = B.Tables(spark, d).documents.select("source", F.col("lang").alias("data_point"), F.lit(None).cast("int").alias("year"))
    path, when = _folder(spark, "registro"), dt.datetime(2000, 1, 1)
    for run in ("r1", "r2"):
        sinks.append_run_log(run_audit(docs, run, when, when), path)
    return sinks.run_log_text(spark.read.parquet(path))


@query("c13_landed_file", "SELECT c_custkey AS codigo, c_name AS nome FROM customer")
def c13_landed_file(spark, d):
    """Files whose header names a column that the rows lack, so every name stands one column too early."""
    c = B.Tables(spark, d).customer
    path = _folder(spark, "deslocado")
    c.select(F.col("c_custkey").cast("string").alias("indice"), F.col("c_name").alias("codigo"), F.lit(None).cast("string").alias("nome")).write.option("header", "true").option("sep", ";").csv(path)
    return C.shifted_header_repair(A.delimited_scan(spark, path, "indice long, codigo string, nome string", encoding="UTF-8"))


@query("a5_answer_lines", REGISTRY["a5_nested_json"][1])
def a5_answer_lines(spark, d):
    """Answers landed as arrays of a thousand order keys a file, framed as a document per line, read as VARIANTs; some hold one result instead of a list."""
    docs = _api_documents(B.Tables(spark, d))
    # the landed text is taken from the payload's own: VARIANTs made and written here only to land it cost more than the reading
    one = F.concat(F.lit("{\"id\":\""), F.get_json_object("payload", "$.id"), F.lit("\",\"variavel\":\""), F.get_json_object("payload", "$.variavel"), F.lit("\",\"unidade\":\""),
                   F.get_json_object("payload", "$.unidade"), F.lit("\",\"resultados\":"), F.get_json_object("payload", "$.resultados[0]"), F.lit("}"))
    texts = docs.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, one).otherwise(F.col("payload")).alias("t"))
    keyed = texts.select("o_orderkey", F.concat(F.lit("{\"o_orderkey\":"), F.col("o_orderkey").cast("string"), F.lit(","), F.substring("t", F.lit(2), F.length("t"))).alias("t"))
    arrays = keyed.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("file")).agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("t")), F.lit("]")).alias("value"))
    root = _folder(spark, "respostas")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/arquivos")
    A.frame_answers(spark, f"{root}/arquivos", f"{root}/linhas")
    return A.read_api_lines(spark, f"{root}/linhas", keep={"o_orderkey": "bigint"})


@query("a10_catalog_dimension", CTE(B.MUN_SQL, B.ORD_SQL) + "SELECT o.o_orderkey, m.municipio_id, o.ano FROM ord o LEFT JOIN mun m ON o.codigo_municipio = m.codigo_municipio")
def a10_catalog_dimension(spark, d):
    """The municipality dimension as a bucketed catalog table; facts get its surrogate ids."""
    t = B.Tables(spark, d)
    name, path = f"municipios_{uuid.uuid4().hex[:12]}", _folder(spark, "dimensao")
    A.write_dimension(B.municipalities(t).select("municipio_id", "codigo_municipio"), name, "codigo_municipio", path, buckets=8)
    facts = B.order_facts(t).select("o_orderkey", "codigo_municipio", "ano")
    return J.to_surrogate(facts, A.read_dimension(spark, table=name)).select("o_orderkey", "municipio_id", "ano")


@query("d14_landed_editions", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders WHERE year(o_orderdate) % 2 = 0")
def d14_landed_editions(spark, d):
    """Landed editions, of which those of odd years have too few columns by their files' own headers and are left out."""
    o = B.Tables(spark, d).orders.withColumn("ano", B.year_of("o_orderdate"))
    root = _folder(spark, "edicoes")
    whole, short = ["o_orderkey", "ano", "o_custkey", "o_orderstatus"], ["o_orderkey", "ano"]
    for name, columns, odd in (("par", whole, 0), ("impar", short, 1)):
        o.where(F.col("ano") % 2 == odd).select(*columns).write.option("header", "true").csv(f"{root}/{name}")
    editions = [spark.read.option("header", "true").csv(f"{root}/{name}") for name in ("par", "impar")]
    kept = U.union_years([e.select(F.col("o_orderkey").cast("bigint"), F.col("ano").cast("int")) for e in editions if D.schema_drift_guard(e)])
    return kept
