"""P1, P9, P12 and P15 over all of their indicators, which catalogue files list.

The files in ``indicarium/catalogues`` hold fixed values: topic, indicator
name as the dimension lists it, and parameters. They go through A7 like any
catalogue; their indicators reach tables by a join (F8), so one plan serves
any number of them. The municipal survey's two files (some 200 questions) are
parameters of P9: they belong to the survey, not to this library.
"""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions import numbers as N
from indicarium.functions import predicates as P
from indicarium.functions import text as X
from indicarium.operators import filters as D
from indicarium.operators import joins as J
from indicarium.operators import reshape as H
from indicarium.operators import schema_ops as C
from indicarium.plans import bindings as B
from indicarium.plans.apis import p12_aggregates
from indicarium.plans.pipelines import MICRO_SQL, checked
from indicarium.plans.queries import query
from indicarium.plans.surveys import p9_munic
from indicarium.session import checkpoint_dir
from indicarium.sources import readers as A

CTE = B.with_ctes
FOLDER = Path(__file__).resolve().parents[1] / "catalogues"


def catalogue(spark: SparkSession, name: str, params: tuple[str, ...] = ("codigo", "tipo")) -> DataFrame:
    """topico, nome_dado and the parameters (codigo, tipo) of a catalogue file of the package."""
    text = J.literal_frame(spark, [((FOLDER / f"{name}.json").read_text(encoding="utf-8"),)], "value string")
    rows = A.catalogue_rows(text.select(F.from_json("value", A.CATALOGUE_TYPE).alias("catalogo")))
    return rows.select("topico", "nome_dado", *[F.col(f"params.{p}").alias(p) for p in params])


def listed(name: str) -> list[tuple[str, str, str]]:
    """(indicator, code, type) in the file's order, for the test bindings and their SQL."""
    doc = json.loads((FOLDER / f"{name}.json").read_text(encoding="utf-8"))
    return [(n, p.get("codigo", ""), p["tipo"]) for inds in doc.values() for n, p in inds.items()]


def values_sql(name: str) -> str:
    rows = ", ".join("({}, '{}', '{}', '{}')".format(i, *(x.replace("'", "''") for x in r)) for i, r in enumerate(listed(name)))
    return f"cat AS (SELECT * FROM (VALUES {rows}) v(i, nome, codigo, tipo))"


def datasus_by_catalogue(raw: DataFrame, indicators: DataFrame, municipalities: DataFrame) -> DataFrame:
    """A2 rows of any number of DATASUS tables (indicador, Município, Valor, ano) -> D7 -> D3 -> D6 -> E1 -> D5 -> E2 -> F8 -> F1 -> K1."""
    df = D.drop_nulls(raw).filter(P.not_total_row("Município"))
    df = D.drop_nulls(df.withColumn("Valor", P.null_token("Valor", ["..."])))
    df = df.withColumn("codigo", X.digits_only("Município")).filter(P.non_empty("codigo"))
    df = J.catalogue_join(df, indicators.select(F.col("nome_dado").alias("indicador"), "tipo"), ["indicador"])
    df = df.select(F.col("codigo").try_cast("bigint").alias(S.CITY_CODE_COL), S.YEAR_COL, F.col("indicador").alias(S.DATA_ID_COL),
                   F.col("tipo").alias(S.DTYPE_COL), N.decimal_comma("Valor").alias(S.VALUE_COL))
    return checked(J.upgrade_city_code(df, S.CITY_CODE_COL, municipalities))


@query("p1_catalogue", CTE(B.ORD_SQL, values_sql("datasus")) + """
SELECT codigo_municipio, ano, c.nome AS dado_identificador, c.tipo AS tipo_dado, CAST(count(*) AS DOUBLE) + 0.5 AS valor
FROM ord o JOIN cat c ON o.o_orderkey % 9 = c.i GROUP BY ALL""")
def p1_catalogue(spark, d):
    t = B.Tables(spark, d)
    names = F.array(*[F.lit(n) for n, _, _ in listed("datasus")])
    o = B.order_facts(t).withColumn("indicador", names[(F.col("o_orderkey") % 9).cast("int")])
    per = o.groupBy("indicador", "o_custkey", "ano").agg(F.count(F.lit(1)).alias("n"))
    cities = per.select("indicador", F.concat_ws(" ", (F.lit(100000) + F.col("o_custkey")).cast("string"), F.lit("MUNICIPIO")).alias("Município"),
                        F.concat(F.col("n").cast("string"), F.lit(",5")).alias("Valor"), "ano")
    totals = per.groupBy("indicador", "ano").agg(F.sum("n").cast("string").alias("Valor")).select("indicador", F.lit("Total").alias("Município"), "Valor", "ano")
    return datasus_by_catalogue(cities.unionByName(totals), catalogue(spark, "datasus"), B.municipalities(t))


def snis_by_catalogue(raw: DataFrame, indicators: DataFrame, municipalities: DataFrame) -> DataFrame:
    """E11 -> D11 -> C9 -> H2 -> D6 -> E20 -> F8 -> E4/E10 by type -> F1 -> K1; values as text of their type."""
    df = raw.select(*[X.printable_clean(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    df = df.filter(P.not_sentinel("Ano de Referência", "---"))
    keys = ["Código do Município", "Ano de Referência"]
    df = C.select_by_pattern(df, "-", keep=keys)
    df = H.unpivot_indicators(df, keys, [c for c in df.columns if c not in keys], name_col="cabecalho")
    df = D.drop_nulls(df.withColumn(S.VALUE_COL, P.null_token(S.VALUE_COL, ["-", ""])), [S.VALUE_COL])
    df = J.catalogue_join(df.withColumn("codigo", X.code_from_header("cabecalho")), indicators, ["codigo"])
    value = (F.when(F.col("tipo") == "float", N.parse_br_number(S.VALUE_COL).cast("decimal(18,2)").cast("string"))
              .when(F.col("tipo") == "bool", N.binary_answer(S.VALUE_COL).cast("string")).otherwise(F.col(S.VALUE_COL)))
    df = df.select(F.col("Código do Município").try_cast("bigint").alias(S.CITY_CODE_COL), F.col("Ano de Referência").try_cast("int").alias(S.YEAR_COL),
                   F.col("nome_dado").alias(S.DATA_ID_COL), F.col("tipo").alias(S.DTYPE_COL), value.alias(S.VALUE_COL))
    return checked(J.upgrade_city_code(D.drop_nulls(df, [S.VALUE_COL]), S.CITY_CODE_COL, municipalities))


@query("p15_snis_catalogue", CTE(MICRO_SQL, values_sql("snis")) + """
, per AS (SELECT codigo_municipio, ano, CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n FROM micro GROUP BY 1, 2)
SELECT codigo_municipio, ano, c.nome AS dado_identificador, c.tipo AS tipo_dado,
       CASE c.tipo WHEN 'float' THEN CAST(CAST(q * (c.i + 1) AS DECIMAL(18,2)) AS VARCHAR) WHEN 'bool' THEN CAST((n + c.i) % 2 AS VARCHAR) ELSE 'texto ' || CAST(n AS VARCHAR) END AS valor
FROM per, cat c""")
def p15_snis_catalogue(spark, d):
    t = B.Tables(spark, d)
    per = B.micro(t).groupBy("o_custkey", "ano").agg(F.sum("l_quantity").cast("bigint").alias("q"), F.count(F.lit(1)).alias("n"))
    columns = []
    for i, (name, code, kind) in enumerate(listed("snis")):
        number = F.translate(F.format_number((F.col("q") * (i + 1)).cast("double"), 2), ",.", ".,")
        answer = F.when((F.col("n") + i) % 2 == 1, F.lit("Sim")).otherwise(F.lit("Não"))
        value = number if kind == "float" else answer if kind == "bool" else F.concat(F.lit("texto "), F.col("n").cast("string"))
        columns.append(F.concat(value, F.lit("\t")).alias(f"{code} - coluna {i}"))
    raw = per.select((F.lit(100000) + F.col("o_custkey")).cast("string").alias("Código do Município"), F.col("ano").cast("string").alias("Ano de Referência"), *columns)
    return snis_by_catalogue(raw, catalogue(spark, "snis"), B.municipalities(t))


def rais_by_catalogue(raw: DataFrame, indicators: DataFrame, municipalities: DataFrame) -> DataFrame:
    """RAIS tables (indicador, Município, Total, ano): D4 -> E6 -> F8 -> F1 -> K1."""
    df = raw.filter(P.all_digits("Município", 6)).withColumn("Total", N.cast_by_tag("Total", "int").cast("bigint"))
    df = J.catalogue_join(df, indicators.select(F.col("nome_dado").alias("indicador"), "tipo"), ["indicador"])
    df = df.select(F.col("Município").try_cast("bigint").alias(S.CITY_CODE_COL), S.YEAR_COL, F.col("indicador").alias(S.DATA_ID_COL),
                   F.col("tipo").alias(S.DTYPE_COL), F.col("Total").alias(S.VALUE_COL))
    return checked(J.upgrade_city_code(df, S.CITY_CODE_COL, municipalities))


@query("p15_rais_catalogue", CTE(B.ORD_SQL, values_sql("rais")) + """
SELECT codigo_municipio, ano, c.nome AS dado_identificador, c.tipo AS tipo_dado, count(*) AS valor
FROM ord o JOIN cat c ON o.o_orderkey % 3 = c.i GROUP BY ALL""")
def p15_rais_catalogue(spark, d):
    t = B.Tables(spark, d)
    names = F.array(*[F.lit(n) for n, _, _ in listed("rais")])
    o = B.order_facts(t).withColumn("indicador", names[(F.col("o_orderkey") % 3).cast("int")])
    per = o.groupBy("indicador", "o_custkey", "ano").agg(F.count(F.lit(1)).alias("n"))
    cities = per.select("indicador", (F.lit(100000) + F.col("o_custkey")).cast("string").alias("Município"), F.col("n").cast("string").alias("Total"), "ano")
    total = per.groupBy("indicador", "ano").agg(F.sum("n").cast("string").alias("Total")).select("indicador", F.lit("Total").alias("Município"), "Total", "ano")
    return rais_by_catalogue(cities.unionByName(total), catalogue(spark, "rais"), B.municipalities(t))


# ---------------------------------------------------------------------------
# What tells an indicator of the aggregates API apart is table, variable and classification
# ---------------------------------------------------------------------------
P12_KEYS = ("agregado", "variavel", "classificacao")


def _p12_listed() -> list[tuple[str, ...]]:
    doc = json.loads((FOLDER / "agregados.json").read_text(encoding="utf-8"))
    return [(n, *(str(p[k]) for k in P12_KEYS)) for inds in doc.values() for n, p in inds.items()]


def p12_by_catalogue(rows: DataFrame, indicators: DataFrame) -> DataFrame:
    """API rows (with the table and classification that were asked for) of any number of indicators, as ``p12_aggregates``."""
    return p12_aggregates(rows, indicators.withColumnRenamed("nome_dado", "nome").withColumnRenamed("variavel", "variavel_id"), ["agregado", "variavel_id", "classificacao"])


@query("p12_catalogue", CTE(B.ORD_SQL) + f"""
, cat AS (SELECT * FROM (VALUES {", ".join("(" + str(i) + ", '" + r[0] + "')" for i, r in enumerate(_p12_listed()))}) v(i, nome)),
t AS (SELECT c.nome, codigo_municipio, ano, {B.api_raw_sql('o_orderkey', 'o_totalprice')} AS raw FROM ord JOIN cat c ON o_orderkey % {len(_p12_listed())} = c.i),
v AS (SELECT *, CASE WHEN raw = '-' THEN 0 WHEN raw IN ('..', '...', 'X') THEN NULL ELSE CAST(raw AS DOUBLE) END AS v FROM t)
SELECT codigo_municipio, ano, nome AS dado_identificador, 'int' AS tipo_dado, sum(v) AS valor FROM v GROUP BY 1, 2, 3 HAVING count(v) = count(*)""")
def p12_catalogue_query(spark, d):
    o = B.order_facts(B.Tables(spark, d))
    which = (F.col("o_orderkey") % len(_p12_listed())).cast("int")
    asked = [F.array(*[F.lit(r[k]) for r in _p12_listed()])[which].alias(n) for k, n in ((1, "agregado"), (2, "variavel_id"), (3, "classificacao"))]
    rows = o.select(*asked, F.lit("unidades").alias("unidade"), S.CITY_CODE_COL, S.YEAR_COL, B.api_raw(F.col("o_orderkey"), F.col("o_totalprice")).alias("raw"))
    return p12_by_catalogue(rows, catalogue(spark, "agregados", P12_KEYS))


# ---------------------------------------------------------------------------
# The survey's questions come from its two files
# ---------------------------------------------------------------------------
P9_YEAR = 2018

P9_SQL = CTE(B.MUN_SQL) + f"""
, q AS (SELECT DISTINCT p_type AS nome FROM part),
a AS (SELECT m.codigo_municipio, concat('C', upper(substr(md5(q.nome), 1, 7))) AS codigo, CASE WHEN length(q.nome) % 2 = 0 THEN 'bool' ELSE 'str' END AS tipo,
             (m.c_custkey + length(q.nome)) % 4 AS r FROM mun m, q)
SELECT codigo_municipio, CAST({P9_YEAR} AS INTEGER) AS ano, codigo AS dado_identificador, tipo AS tipo_dado,
       CASE WHEN tipo = 'bool' THEN CASE r WHEN 0 THEN '1' ELSE '0' END ELSE CASE r WHEN 0 THEN 'Sim' WHEN 1 THEN 'Não' ELSE 'Recusa' END END AS valor
FROM a WHERE r < 3"""


@query("p9_catalogue", P9_SQL)
def p9_catalogue_query(spark, d):
    """A survey of a question for each type of ``part``, catalogued in the survey's two files; a code of another year is another's."""
    t, root = B.Tables(spark, d), f"{checkpoint_dir(spark)}/landed/munic-{uuid.uuid4().hex}"
    asked = t.part.select(F.col("p_type").alias("nome")).distinct().select(
        "nome", F.concat(F.lit("C"), F.upper(F.substring(F.md5("nome"), 1, 7))).alias("codigo"), F.when(F.length("nome") % 2 == 0, "bool").otherwise("str").alias("tipo"))
    # the files list questions; one document each
    listed = asked.agg(F.map_from_entries(F.collect_list(F.struct("nome", F.create_map(F.lit("categoria"), F.lit("Gestão"), F.lit("tipo"), F.col("tipo"))))).alias("m"),
                       F.map_from_entries(F.collect_list(F.struct("nome", "codigo"))).alias("c"), F.map_from_entries(F.collect_list(F.struct("nome", F.lit("OUTRO")))).alias("o"))
    listed.select(F.to_json("m")).write.text(f"{root}/informacao")
    listed.select(F.to_json(F.create_map(F.lit(str(P9_YEAR)), F.col("c"), F.lit("2020"), F.col("o")))).write.text(f"{root}/codigos")
    questions = [(r.nome, r.codigo) for r in asked.collect()]  # the columns of the sheet
    # every fourth answer is missing
    answer = lambda q: F.element_at(F.array(F.lit("Sim"), F.lit("Não"), F.lit("Recusa"), F.lit(None)), ((F.col("c_custkey") + len(q)) % 4 + 1).cast("int"))
    sheet = B.municipalities(t).select(F.col("codigo_municipio").alias("CodMun"), *[answer(q).alias(c.lower()) for q, c in questions])
    return p9_munic([sheet], J.listed(A.read_survey_catalogue(spark, f"{root}/informacao", f"{root}/codigos")), P9_YEAR)
