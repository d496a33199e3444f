"""Pipelines P12-P15 (API answers, broadband, sanitation and RAIS) and
the release-discovery composition M4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions import numbers as N
from indicarium.functions import predicates as P
from indicarium.functions import text as X
from indicarium.operators import aggregates as G
from indicarium.operators import filters as D
from indicarium.operators import joins as J
from indicarium.operators import release as M
from indicarium.operators import reshape as H
from indicarium.operators import schema_ops as C
from indicarium.operators import validate as K
from indicarium.plans import bindings as B
from indicarium.plans.pipelines import checked, MICRO_SQL
from indicarium.plans.queries import query, _api_documents, UNIT_SQL, TYPE_SQL
from indicarium.session import materialize
from indicarium.sources import readers as A

CTE = B.with_ctes
MUN, ORD, FEED, REL = B.MUN_SQL, B.ORD_SQL, B.FEED_SQL, B.REL_SQL

# ---------------------------------------------------------------------------
# P12 statistical-office aggregates API
# ---------------------------------------------------------------------------
# variable id -> (indicator, topic)
P12_CATALOGUE = [("1", "Receita urgente", "Financas"), ("2", "Receita alta", "Financas"),
                 ("3", "Pessoas atendidas", "Social"), ("4", "Unidades registradas", "Social"),
                 ("5", "Situacao informada", "Social")]


P12_REQUIRED = ["variavel_id", "unidade", S.CITY_CODE_COL, S.YEAR_COL]


def p12_aggregates(rows: DataFrame, catalogue: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A5 rows -> H3 -> E9 -> E7 -> E8 -> G5 -> F8 -> H5 -> K1.

    Results of one variable are added by key (city, year), null when any
    of them is null; the type comes from the unit text (one per variable).
    ``by`` names what tells variables apart, in the rows and in the catalogue.
    A text that is no number fails the job; text-typed variables are
    ``p12_texts``."""
    by = by or ["variavel_id"]
    required = list(dict.fromkeys([*by, *P12_REQUIRED]))
    # K4: every data point must carry its variable, unit, locality and year
    rows = K.enforce_fields(rows, required, "API answer missing a required field")
    s = N.special_code("raw")
    u = N.unit_inference("unidade")
    value = F.when(s["tipo_dado"].isNotNull(), s["valor"].cast("double")).otherwise(
        N.scale_by_unit("raw", u["multiplicador"], u["tipo_dado"]).cast("double"))
    # a row without a required field stays until the check above has seen it
    rows = rows.filter((u["tipo_dado"] != "str") | F.greatest(*[F.col(c).isNull() for c in required]))
    bad = s["tipo_dado"].isNull() & F.col("raw").isNotNull() & value.isNull()
    value = F.when(bad, F.raise_error(F.concat(F.lit("not a number: "), F.col("raw"))).cast("double")).otherwise(value)
    typed = rows.select(*by, "unidade", S.CITY_CODE_COL, S.YEAR_COL, value.alias("v"))
    summed = G.null_poison_sum(typed, [*by, "unidade", S.CITY_CODE_COL, S.YEAR_COL], "v")
    summed = summed.withColumn(S.DTYPE_COL, N.unit_inference("unidade")["tipo_dado"])
    named = J.catalogue_join(summed, catalogue, by)
    fact = H.rows_to_fact(named, S.CITY_CODE_COL, S.YEAR_COL, "nome", S.DTYPE_COL, S.VALUE_COL)
    return checked(fact)


def p12_texts(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """A5 rows -> E9 -> G5 -> F8 -> H5 -> K1 for variables whose unit tells no
    number: their texts stay, results of one key (city, year) joined in
    order; a key with a null among them has no value."""
    rows = rows.filter(N.unit_inference("unidade")["tipo_dado"] == "str")
    s = N.special_code("raw")
    text = F.when(s["tipo_dado"].isNotNull(), s["valor"].cast("string")).otherwise(F.col("raw"))
    keys = ["variavel_id", S.CITY_CODE_COL, S.YEAR_COL]
    all_ = rows.select(*keys, "resultado", text.alias("v")).groupBy(*keys).agg(
        F.when(F.count("v") == F.count(F.lit(1)), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("resultado", "v"))), lambda r: r["v"]), "; ")).alias(S.VALUE_COL))
    named = J.catalogue_join(all_, catalogue, ["variavel_id"]).withColumn(S.DTYPE_COL, F.lit("str"))
    return checked(H.rows_to_fact(named, S.CITY_CODE_COL, S.YEAR_COL, "nome", S.DTYPE_COL, S.VALUE_COL))


def p12_catalogue(spark) -> DataFrame:
    return J.literal_frame(spark, P12_CATALOGUE, "variavel_id string, nome string, topico string")


P12_CAT_SQL = "cat AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in P12_CATALOGUE) + \
    ") v(variavel_id, nome, topico))"


@query("p12", CTE(ORD, FEED, P12_CAT_SQL) + f"""
, u AS (SELECT *, {UNIT_SQL} AS mult, {TYPE_SQL} AS tipo FROM feed),
t AS (SELECT variavel_id, unidade, tipo, codigo_municipio, ano,
             CASE WHEN raw = '-' THEN CAST(0 AS DOUBLE) WHEN raw IN ('..', '...', 'X') THEN NULL
                  WHEN tipo = 'int' THEN CAST(TRY_CAST(raw AS BIGINT) * mult AS DOUBLE)
                  WHEN tipo = 'float' THEN TRY_CAST(raw AS DOUBLE) * mult END AS v FROM u WHERE tipo <> 'str'),
g AS (SELECT variavel_id, codigo_municipio, ano, any_value(tipo) AS tipo_dado,
             CASE WHEN count(v) = count(*) THEN sum(v) END AS valor
      FROM t GROUP BY variavel_id, unidade, codigo_municipio, ano)
SELECT g.codigo_municipio, g.ano, c.nome AS dado_identificador, g.tipo_dado, g.valor
FROM g JOIN cat c ON g.variavel_id = c.variavel_id WHERE g.valor IS NOT NULL""")
def p12(spark, d):
    docs = _api_documents(B.Tables(spark, d))
    rows = A.flatten_api(docs.select(F.from_json("payload", A.API_SCHEMA).alias("doc")), doc="doc")
    return p12_aggregates(rows, p12_catalogue(spark))


@query("p12_text", CTE(ORD, FEED, P12_CAT_SQL) + f"""
, u AS (SELECT *, CASE WHEN raw = '-' THEN '0' WHEN raw IN ('..', '...', 'X') THEN NULL ELSE raw END AS v FROM feed WHERE {TYPE_SQL} = 'str')
SELECT codigo_municipio, ano, c.nome AS dado_identificador, 'str' AS tipo_dado, string_agg(v, '; ' ORDER BY v) AS valor
FROM u JOIN cat c USING (variavel_id) GROUP BY codigo_municipio, ano, c.nome HAVING count(v) = count(*)""")
def p12_text(spark, d):
    docs = _api_documents(B.Tables(spark, d))
    rows = A.flatten_api(docs.select(F.from_json("payload", A.API_SCHEMA).alias("doc")), doc="doc")
    return p12_texts(rows, p12_catalogue(spark))


# ---------------------------------------------------------------------------
# P13 homicide-rate API: flat JSON records, '0' means "no data"
# ---------------------------------------------------------------------------
def bind_p13(t: B.Tables) -> DataFrame:
    """Landed JSON records, one text per record."""
    o = t.orders
    k = F.col("o_orderkey")
    raw = F.when(k % 10 == 0, F.lit("0")).when(k % 10 == 5, F.lit("0.0")).otherwise(B.money_text(F.col("o_totalprice")))
    rec = F.struct(k.cast("string").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("periodo"),
                   raw.alias("valor"), B.city_code(F.col("o_custkey")).cast("string").alias("cod"))
    return o.select(F.to_json(rec).alias("value"))


def p13_homicide_rate(records: DataFrame, name: str = "Taxa de homicídios") -> DataFrame:
    """A6 -> D10 -> E17 -> E6 -> H5 -> K1."""
    df = records.select(F.from_json("value", A.FLAT_SERIES_SCHEMA).alias("r")).select("r.*")
    df = df.filter(P.not_raw_zero("valor"))
    df = df.select(F.col("cod").alias("c"), N.year_from_iso("periodo").alias("a"),
                   F.lit(name).alias("n"), F.lit("float").alias("t"), F.col("valor").try_cast("double").alias("v"))
    return checked(H.rows_to_fact(df, "c", "a", "n", "t", "v"))


@query("p13", f"""
SELECT {B.city_code_sql('o_custkey')} AS codigo_municipio, CAST(year(o_orderdate) AS INTEGER) AS ano,
       'Taxa de homicídios' AS dado_identificador, 'float' AS tipo_dado, CAST(raw AS DOUBLE) AS valor
FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN '0' WHEN o_orderkey % 10 = 5 THEN '0.0'
                     ELSE {B.money_text_sql('o_totalprice')} END AS raw FROM orders)
WHERE raw <> '0'""")
def p13(spark, d):
    return p13_homicide_rate(bind_p13(B.Tables(spark, d)))


# ---------------------------------------------------------------------------
# P14 broadband density: CSV with service names, decimal-comma density
# ---------------------------------------------------------------------------
# service -> indicator (services not listed are dropped)
P14_SERVICES = {"Banda Larga Fixa": "Densidade banda larga fixa", "Telefonia Móvel": "Densidade telefonia móvel"}
P14_SERVICE_OF_STATUS = {"F": "Banda Larga Fixa", "O": "Telefonia Móvel", "P": "TV por Assinatura"}


def bind_p14(t: B.Tables) -> DataFrame:
    o = B.order_facts(t)
    per = o.groupBy("codigo_municipio", "ano").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col("o_orderstatus") == s, 1)).alias(svc) for s, svc in P14_SERVICE_OF_STATUS.items()])
    long = per.unpivot(["codigo_municipio", "ano", "n"], list(P14_SERVICE_OF_STATUS.values()), "Serviço", "k")
    dens = F.replace(F.format_string("%.2f", F.round(F.lit(100.0) * F.col("k") / F.col("n"), 2)), F.lit("."), F.lit(","))
    return long.select(F.col("Serviço"), dens.alias("Densidade"), F.col("codigo_municipio").alias("Código IBGE"),
                       F.col("ano").alias("Ano"), F.lit("grupo").alias("Grupo Econômico"))


def p14_broadband(raw: DataFrame, services: dict[str, str] = P14_SERVICES) -> DataFrame:
    """D1 -> C3 -> C2 -> E2 -> C11 -> K1."""
    df = D.in_list(raw, "Serviço", list(services))
    df = C.rename_columns(df, {"Código IBGE": S.CITY_CODE_COL, "Ano": S.YEAR_COL, "Densidade": S.VALUE_COL})
    df = C.drop_columns(df, ["Grupo Econômico"])
    df = df.withColumn(S.VALUE_COL, N.decimal_comma(S.VALUE_COL))
    names = F.create_map(*[x for k, v in services.items() for x in (F.lit(k), F.lit(v))])
    df = df.withColumn(S.DATA_ID_COL, F.element_at(names, F.col("Serviço")))
    return checked(C.add_metadata(df, tipo_dado="float"))


@query("p14", CTE(ORD) + """
, per AS (SELECT codigo_municipio, ano, count(*) AS n,
                 count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS o
          FROM ord GROUP BY 1, 2)
SELECT codigo_municipio, ano, 'Densidade banda larga fixa' AS dado_identificador, 'float' AS tipo_dado,
       round(CAST(100.0 AS DOUBLE) * f / n, 2) AS valor FROM per
UNION ALL
SELECT codigo_municipio, ano, 'Densidade telefonia móvel', 'float', round(CAST(100.0 AS DOUBLE) * o / n, 2) FROM per""")
def p14(spark, d):
    return p14_broadband(bind_p14(B.Tables(spark, d)))


# ---------------------------------------------------------------------------
# P15 sanitation (SNIS) and formal jobs (RAIS)
# ---------------------------------------------------------------------------
# indicator code -> (name, type)
SNIS_CATALOGUE = [("IN001", "Volume de pedidos", "float"), ("IN002", "Valor dos pedidos", "float")]


def bind_p15_base(t: B.Tables) -> DataFrame:
    """Per (customer, year) line-item totals: one microdata join and one
    aggregate feed both the SNIS and the RAIS tables (written once to the
    checkpoint folder, so the join is not recomputed per consumer)."""
    return materialize(B.micro(t).groupBy("o_custkey", "ano").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v")))


def bind_snis(per: DataFrame) -> DataFrame:
    """Wide CSV body: 6-digit code, reference year ('---' on broken
    lines), '<code> - <name>' columns in Brazilian number format."""
    br = lambda c: F.translate(F.format_number(c.cast("double"), 2), ",.", ".,")
    year = F.when(F.col("o_custkey") % 50 == 0, F.lit("---")).otherwise(F.col("ano").cast("string"))
    return per.select((F.lit(100000) + F.col("o_custkey")).cast("string").alias("Código do Município"),
                      year.alias("Ano de Referência"),
                      F.concat(F.lit('"'), br(F.col("q")), F.lit("\t")).alias("IN001 - Volume de pedidos"),
                      F.when(F.col("v") > 0, br(F.col("v"))).otherwise(F.lit("-")).alias("IN002 - Valor dos pedidos"))


def snis_pipeline(raw: DataFrame, catalogue: DataFrame, municipalities: DataFrame) -> DataFrame:
    """E11 -> D11 -> C9 -> H2 -> D6 -> E4 -> E20 -> F8 -> F1 -> K1."""
    df = raw.select(*[X.printable_clean(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    df = df.filter(P.not_sentinel("Ano de Referência", "---"))
    keys = ["Código do Município", "Ano de Referência"]
    df = C.select_by_pattern(df, "-", keep=keys)
    df = H.unpivot_indicators(df, keys, [c for c in df.columns if c not in keys], name_col="cabecalho")
    df = df.withColumn(S.VALUE_COL, P.null_token(S.VALUE_COL, ["-", ""]))
    df = D.drop_nulls(df, [S.VALUE_COL])
    df = df.withColumn(S.VALUE_COL, N.parse_br_number(S.VALUE_COL)).withColumn("codigo", X.code_from_header("cabecalho"))
    df = J.catalogue_join(df, catalogue, ["codigo"])
    df = df.select(F.col("Código do Município").try_cast("bigint").alias(S.CITY_CODE_COL),
                   F.col("Ano de Referência").try_cast("int").alias(S.YEAR_COL),
                   F.col("nome").alias(S.DATA_ID_COL), F.col("tipo").alias(S.DTYPE_COL), S.VALUE_COL)
    return J.upgrade_city_code(df, S.CITY_CODE_COL, municipalities)


def bind_rais(per: DataFrame) -> DataFrame:
    """RAIS table per year: city lines by 6-digit code, a total line and
    a labelled line that is not a city."""
    cities = per.select((F.lit(100000) + F.col("o_custkey")).cast("string").alias("Município"),
                        F.col("n").cast("string").alias("Total"), "ano")
    per_year = per.groupBy("ano").agg(F.sum("n").alias("n"))
    totals = per_year.select(F.lit("Total").alias("Município"), F.col("n").cast("string").alias("Total"), "ano")
    labelled = per_year.select(F.lit("{ñ class}").alias("Município"), F.lit("0").alias("Total"), "ano")
    return cities.unionByName(totals).unionByName(labelled)


def rais_pipeline(raw: DataFrame, municipalities: DataFrame) -> DataFrame:
    """D4 -> E6 -> F1 -> C3 -> C11 -> K1."""
    df = raw.filter(P.all_digits("Município", 6))
    df = df.withColumn("Total", N.cast_by_tag("Total", "int").cast("double"))
    df = df.withColumn("Município", F.col("Município").try_cast("bigint"))
    df = J.upgrade_city_code(df, "Município", municipalities)
    df = C.rename_columns(df, {"Município": S.CITY_CODE_COL, "Total": S.VALUE_COL})
    return C.add_metadata(df, dado_identificador="Empregos RAIS", tipo_dado="int")


def p15_sanitation_jobs(snis_raw: DataFrame, rais_raw: DataFrame, municipalities: DataFrame, spark) -> DataFrame:
    cat = J.literal_frame(spark, SNIS_CATALOGUE, "codigo string, nome string, tipo string")
    snis = snis_pipeline(snis_raw, cat, municipalities)
    rais = rais_pipeline(rais_raw, municipalities)
    return checked(C.to_fact_order(snis).unionByName(C.to_fact_order(rais)))


@query("p15", CTE(MICRO_SQL) + """
, per AS (SELECT o_custkey, codigo_municipio, ano, count(*) AS n, sum(l_quantity) AS q,
                 sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM micro GROUP BY 1, 2, 3)
SELECT codigo_municipio, ano, 'Volume de pedidos' AS dado_identificador, 'float' AS tipo_dado,
       CAST(printf('%.2f', q) AS DOUBLE) AS valor FROM per WHERE o_custkey % 50 <> 0
UNION ALL
SELECT codigo_municipio, ano, 'Valor dos pedidos', 'float', CAST(printf('%.2f', CAST(v AS DOUBLE)) AS DOUBLE)
FROM per WHERE o_custkey % 50 <> 0 AND v > 0
UNION ALL
SELECT codigo_municipio, ano, 'Empregos RAIS', 'int', CAST(n AS DOUBLE) FROM per""")
def p15(spark, d):
    t = B.Tables(spark, d)
    base = bind_p15_base(t)
    return p15_sanitation_jobs(bind_snis(base), bind_rais(base), B.municipalities(t), spark)


# ---------------------------------------------------------------------------
# M4/M5 release discovery over listed file names
# ---------------------------------------------------------------------------
@query("m4_best_release", CTE(ORD, REL) + f"""
, y AS (SELECT fonte, pos, link, {B.year_from_text_sql('link')} AS y0 FROM rel),
c AS (SELECT *, CASE WHEN contains(link, 'corrigido') THEN y0 - 1 ELSE y0 END AS y1 FROM y),
f AS (SELECT fonte, pos, link, COALESCE(y1, last_value(y1 IGNORE NULLS) OVER (PARTITION BY fonte ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1) AS ano FROM c),
rk AS (SELECT *, row_number() OVER (PARTITION BY fonte, ano ORDER BY pos DESC) AS rn FROM f)
SELECT fonte, ano, link, pos,
       CASE WHEN contains(link, 'csv') THEN 'csv' WHEN contains(link, '.xlsx') THEN 'xlsx' ELSE 'erro' END AS leitor
FROM rk WHERE rn = 1""")
def m4_best_release(spark, d):
    r = B.releases(B.Tables(spark, d))
    r = M.link_years(r, "link", "pos", partition=["fonte"])
    best = M.best_release_per_year(r, "ano", "pos", partition=["fonte"])
    return best.select("fonte", "ano", "link", "pos", M.reader_kind("link").alias("leitor"))
