"""Indicator pipelines P1-P15 as compositions of the library operators.

Each pipeline is a plain function over its raw inputs (columns named as in
the public files) returning the long fact shape
(codigo_municipio, ano, dado_identificador, tipo_dado, valor) with
``valor`` in its native type. ``bind_*`` functions land those raw inputs
from the driver's tables (SURVEY 7.3) and the registered ``pN`` queries
run binding -> pipeline, each with a DuckDB oracle for the same facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions import numbers as N
from indicarium.functions import predicates as P
from indicarium.functions import text as X
from indicarium.operators import aggregates as G
from indicarium.operators import filters as D
from indicarium.operators import joins as J
from indicarium.operators import reshape as H
from indicarium.operators import schema_ops as C
from indicarium.operators import sets as U
from indicarium.operators import validate as K
from indicarium.plans import bindings as B
from indicarium.plans.queries import query
from indicarium.session import materialize

CTE = B.with_ctes
MUN, ORD, FEED = B.MUN_SQL, B.ORD_SQL, B.FEED_SQL


def checked(df: DataFrame) -> DataFrame:
    """C12 + K1 inline: fact column order, contract checked while the rows flow."""
    return K.enforce_contract(C.to_fact_order(df))

# ---------------------------------------------------------------------------
# P1 DATASUS: 'CODE6 NAME;value' tables per year with totals, ignored-city
# lines, '...' null tokens and footer notes
# ---------------------------------------------------------------------------
P1_NAME, P1_TYPE, P1_TOPIC = "pedido_medio", "float", "Saude"


def bind_p1(t: B.Tables) -> DataFrame:
    o = B.order_facts(t)
    seg = B.municipalities(t).select("c_custkey", "c_mktsegment", "sigla_uf")
    per_city = o.groupBy("o_custkey", "ano").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")) * 100).cast("bigint").alias("cents"))
    # four consumers below: written once instead of re-aggregated per consumer
    per_city = materialize(per_city.join(seg, F.col("o_custkey") == F.col("c_custkey")))
    # mean in cents by integer division, written with a decimal comma
    mean = F.floor(F.col("cents") / F.col("n")).cast("bigint")
    value = F.when(F.col("n") == 1, F.lit("...")).otherwise(
        F.concat((mean / 100).cast("bigint").cast("string"), F.lit(","), F.lpad((mean % 100).cast("string"), 2, "0")))
    cities = per_city.select(
        F.concat_ws(" ", (F.lit(100000) + F.col("o_custkey")).cast("string"), F.upper("c_mktsegment")).alias("Município"),
        value.alias("Valor"), "ano")
    per_uf = per_city.groupBy("sigla_uf", "ano").agg(F.sum("n").alias("n"))
    totals = per_uf.select(F.lit("Total").alias("Município"), F.col("n").cast("string").alias("Valor"), "ano")
    ignored = per_uf.select(F.concat(F.lit("MUNICIPIO IGNORADO - "), F.col("sigla_uf")).alias("Município"),
                            F.lit("1").alias("Valor"), "ano")
    notes = per_uf.select(F.lit("Fonte: pedidos").alias("Município"), F.lit(None).cast("string").alias("Valor"),
                          "ano").distinct()
    return cities.unionByName(totals).unionByName(ignored).unionByName(notes)


def p1_datasus(raw: DataFrame, municipalities: DataFrame, data_name: str = P1_NAME,
               dtype: str = P1_TYPE) -> DataFrame:
    """A2 -> D7 -> D3 -> D6 -> D7 -> C8 -> C11 -> J1 -> E1 -> D5 -> E2 -> F1 -> K1."""
    return _datasus_finish(_datasus_rows(raw, data_name, dtype), municipalities)


def _datasus_rows(raw: DataFrame, data_name: str, dtype: str) -> DataFrame:
    """The cleaning part of the DATASUS chain, up to six-digit codes."""
    df = D.drop_nulls(raw)                                          # footer notes
    df = df.filter(P.not_total_row("Município"))                    # totals / ignored
    df = df.withColumn("Valor", P.null_token("Valor", ["..."]))     # '...'
    df = D.drop_nulls(df)
    df = C.positional_value(df, 1)                                  # 2nd column is the value
    df = C.add_metadata(df, dado_identificador=data_name, tipo_dado=dtype)
    df = df.withColumn("codigo", X.digits_only("Município")).filter(P.non_empty("codigo"))
    df = df.withColumn(S.CITY_CODE_COL, F.col("codigo").try_cast("bigint"))
    return C.to_fact_order(df.withColumn(S.VALUE_COL, N.decimal_comma(S.VALUE_COL)))


def _datasus_finish(df: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Code upgrade and contract, once for any number of DATASUS tables."""
    return checked(J.upgrade_city_code(df, S.CITY_CODE_COL, municipalities))


# the Gini-style table: one column per census year
P1_GINI_NAME = "indice_gini"
# the bucket table: count columns labelled by ranges, summed up to a ceiling
P1_WEIGHT_NAME, P1_WEIGHT_CEILING = "nascidos_baixo_peso", 199999


def _label6(custkey):
    return F.concat_ws(" ", (F.lit(100000) + custkey).cast("string"), F.lit("MUNICIPIO"))


def bind_p1_gini(t: B.Tables) -> DataFrame:
    """One line per city, a decimal-comma share per census year ('...'
    when the city has no order that year)."""
    o = B.order_facts(t)
    years = B.years_in(o)
    per = o.groupBy("o_custkey").agg(*[
        F.count(F.when(F.col("ano") == y, 1)).alias(f"n{y}") for y in years], *[
        F.count(F.when((F.col("ano") == y) & (F.col("o_orderstatus") == "F"), 1)).alias(f"f{y}") for y in years])
    share = {str(y): F.when(F.col(f"n{y}") == 0, F.lit("...")).otherwise(F.replace(
        F.format_string("%.3f", F.round(F.col(f"f{y}") / F.col(f"n{y}"), 3)), F.lit("."), F.lit(",")))
        for y in years}
    return per.select(_label6(F.col("o_custkey")).alias("Município"), *[v.alias(k) for k, v in share.items()])


def bind_p1_weight(t: B.Tables) -> DataFrame:
    """Per city and year, counts per labelled range ('-' for none)."""
    from indicarium.plans.queries import BUCKETS
    o = B.order_facts(t)
    aggs, lo = [], None
    for label, hi in BUCKETS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("o_totalprice") >= lo)
        if hi is not None:
            cond = cond & (F.col("o_totalprice") < hi)
        aggs.append(F.count(F.when(cond, 1)).alias(label))
        lo = hi
    wide = o.groupBy("o_custkey", "ano").agg(*aggs)
    return wide.select(_label6(F.col("o_custkey")).alias("Município"), "ano", *[
        F.when(F.col(f"`{label}`") == 0, F.lit("-")).otherwise(F.col(f"`{label}`").cast("string")).alias(label)
        for label, _ in BUCKETS])


# fixed values: (ceiling, pattern of the numbers in a range's label, columns that always count)
LOW_WEIGHT_RANGES = (2499, r"\d{3,4}", [])
LOW_PRENATAL_RANGES = (6, r"\d{1}", ["Nenhuma"])


def p1_datasus_all(standard: DataFrame, gini: DataFrame, weight: DataFrame, municipalities: DataFrame,
                   ceiling: int, pattern: str) -> DataFrame:
    """The three DATASUS table shapes through one chain: plain yearly
    tables; the Gini table unpivoted (H1); the range table summed up to
    the ceiling (G4), skipped when its schema lost the ranges (D14)."""
    parts = [_datasus_rows(standard, P1_NAME, P1_TYPE)]
    years = [c for c in gini.columns if c.isdigit()]
    gini_long = H.unpivot_years(gini, ["Município"], years, value="Valor")
    parts.append(_datasus_rows(gini_long.select("Município", "Valor", "ano"), P1_GINI_NAME, "float"))
    if D.schema_drift_guard(weight, 4):
        w = G.bucket_sum(weight, ["Município", "ano"], ceiling, pattern)
        w = w.select("Município", F.col(S.VALUE_COL).cast("string").alias("Valor"), "ano")
        parts.append(_datasus_rows(w, P1_WEIGHT_NAME, "int"))
    # one code-upgrade join and one contract check for the three tables
    return _datasus_finish(reduce(lambda a, b: a.unionByName(b), parts), municipalities)


@query("p1", CTE(ORD) + f"""
SELECT codigo_municipio, ano, '{P1_NAME}' AS dado_identificador, '{P1_TYPE}' AS tipo_dado,
       CAST(CAST(c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS valor
FROM (SELECT codigo_municipio, ano, count(*) AS n,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) // count(*) AS c
      FROM ord GROUP BY codigo_municipio, ano)
WHERE n > 1
UNION ALL
SELECT codigo_municipio, ano, '{P1_GINI_NAME}', 'float',
       round(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) / count(*), 3)
FROM ord GROUP BY codigo_municipio, ano
UNION ALL
SELECT codigo_municipio, ano, '{P1_WEIGHT_NAME}', 'int',
       CAST(count(CASE WHEN o_totalprice < 200000 THEN 1 END) AS DOUBLE)
FROM ord GROUP BY codigo_municipio, ano""")
def p1(spark, d):
    t = B.Tables(spark, d)
    return p1_datasus_all(bind_p1(t), bind_p1_gini(t), bind_p1_weight(t), B.municipalities(t),
                          P1_WEIGHT_CEILING, r"\d{3,6}")


# ---------------------------------------------------------------------------
# P2 formal jobs: wide 'Cod. Loc.' x year columns, thousands dots
# ---------------------------------------------------------------------------
def bind_p2(t: B.Tables) -> DataFrame:
    m, years = B.micro(t), B.years_in(B.order_facts(t))
    per = m.groupBy("o_custkey").agg(*[
        F.sum(F.when(F.col("ano") == y, F.col("l_quantity"))).cast("bigint").alias(str(y)) for y in years])
    dotted = {str(y): F.when(F.col(str(y)).isNull(), F.lit("-")).otherwise(
        F.translate(F.format_number(F.col(str(y)), 0), ",", ".")) for y in years}
    cities = per.select((F.lit(100000) + F.col("o_custkey")).cast("string").alias("Cod. Loc."),
                        *[dotted[str(y)].alias(str(y)) for y in years])
    total = per.agg(*[F.sum(str(y)).alias(str(y)) for y in years]).select(
        F.lit("Total").alias("Cod. Loc."), *[F.col(str(y)).cast("string").alias(str(y)) for y in years])
    return cities.unionByName(total)


def p2_formal_jobs(raw: DataFrame, municipalities: DataFrame) -> DataFrame:
    """A1 -> H1 -> J1 -> C3 -> D4 -> E3 -> D6 -> C11 -> F1 -> K1."""
    years = [c for c in raw.columns if c.isdigit()]
    df = H.unpivot_years(raw, ["Cod. Loc."], years)
    df = C.rename_columns(df, {"Cod. Loc.": S.CITY_CODE_COL})
    df = df.filter(P.all_digits(S.CITY_CODE_COL, 6))
    df = df.withColumn(S.VALUE_COL, P.null_token(N.strip_thousands(S.VALUE_COL), ["-"]))
    df = D.drop_nulls(df, [S.VALUE_COL])
    df = df.withColumn(S.VALUE_COL, F.col(S.VALUE_COL).try_cast("bigint"))
    df = C.add_metadata(df, dado_identificador="População ocupada com vínculo formal", tipo_dado="int")
    df = df.withColumn(S.CITY_CODE_COL, F.col(S.CITY_CODE_COL).try_cast("bigint"))
    return checked(J.upgrade_city_code(df, S.CITY_CODE_COL, municipalities))


MICRO_SQL = f"""micro AS (
  SELECT l.*, o.o_custkey, {B.city_code_sql('o.o_custkey')} AS codigo_municipio, CAST(year(o.o_orderdate) AS INTEGER) AS ano,
         o.o_orderstatus, o.o_orderpriority
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


@query("p2", CTE(MICRO_SQL) + f"""
SELECT codigo_municipio, ano, 'População ocupada com vínculo formal' AS dado_identificador, 'int' AS tipo_dado, CAST(sum(l_quantity) AS BIGINT) AS valor
FROM micro GROUP BY codigo_municipio, ano""")
def p2(spark, d):
    t = B.Tables(spark, d)
    return p2_formal_jobs(bind_p2(t), B.municipalities(t))


# ---------------------------------------------------------------------------
# P3 CAPAG: one file per year, code and grade columns renamed across years
# ---------------------------------------------------------------------------
def _grade(max_price):
    return (F.when(max_price > 400000, "A").when(max_price > 300000, "B")
             .when(max_price > 200000, "C").otherwise("D"))


P3_GRADE_SQL = ("CASE WHEN max(o_totalprice) > 400000 THEN 'A' WHEN max(o_totalprice) > 300000 THEN 'B' "
                "WHEN max(o_totalprice) > 200000 THEN 'C' ELSE 'D' END")


def bind_p3(t: B.Tables) -> list[DataFrame]:
    """CAPAG files by layout: older years name the columns differently and
    newer ones carry two columns with 'capag' in the name."""
    files = []
    for old, frame in zip((True, False), B.layout_editions(t.orders.select("o_custkey", "o_totalprice", "o_orderdate"), "o_orderdate", [1998])):
        g = frame.groupBy("o_custkey", "ano").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("mx"))
        grade = F.when(F.col("n") == 1, F.lit("n.d.")).otherwise(_grade(F.col("mx")))
        code = B.city_code(F.col("o_custkey"))
        if old:
            files.append(g.select("ano", code.alias("Código_Município_Completo"), grade.alias("CAPAG")))
        else:
            files.append(g.select("ano", code.alias("Cod.IBGE"), grade.alias("Classificação_CAPAG"),
                                  F.col("n").cast("string").alias("Nota_CAPAG_2")))
    return files


def p3_capag(files: list[DataFrame] | dict[int, DataFrame]) -> DataFrame:
    """C5 -> C6 -> C7 -> C1 -> D6 -> D7 -> J1 -> C11 -> K1: per layout, then one
    union. Files of one layout are one frame with their year; a dict
    has a frame for each year."""
    frames = []
    for year, df in files.items() if isinstance(files, dict) else [(None, f) for f in files]:
        df = C.normalise_column_names(df, "spaced")
        df = C.resolve_column(df, ["código município completo", "cod.ibge"], S.CITY_CODE_COL)
        df = C.resolve_by_fragment(df, "capag", S.VALUE_COL, tie_break="classificação")
        df = C.keep_columns(df if year is None else df.withColumn(S.YEAR_COL, F.lit(year).cast("int")), [S.CITY_CODE_COL, S.YEAR_COL, S.VALUE_COL])
        df = df.withColumn(S.VALUE_COL, P.null_token(S.VALUE_COL, S.CAPAG_NULL_TOKENS))
        frames.append(D.drop_nulls(df))
    df = U.union_years(frames)
    df = C.add_metadata(df, dado_identificador="Capacidade de pagamento dos municípios (CAPAG)", tipo_dado="str")
    return checked(df)


@query("p3", CTE(ORD) + f"""
SELECT codigo_municipio, ano, 'Capacidade de pagamento dos municípios (CAPAG)' AS dado_identificador, 'str' AS tipo_dado, {P3_GRADE_SQL} AS valor
FROM ord GROUP BY codigo_municipio, ano HAVING count(*) > 1""")
def p3(spark, d):
    return p3_capag(bind_p3(B.Tables(spark, d)))


# ---------------------------------------------------------------------------
# P4 higher-education places (flagship): microdata -> in-list filter ->
# zero-fill conditional sum -> metadata -> contract
# ---------------------------------------------------------------------------
# fixed values: the census codes that count
HIGHER_EDUCATION_CODES = {
    "TP_GRAU_ACADEMICO": [1, 2, 3, 4],
    "TP_NIVEL_ACADEMICO": [1, 2],
    "TP_ORGANIZACAO_ACADEMICA": [1, 2, 3, 4, 5],
    "TP_CATEGORIA_ADMINISTRATIVA": [1, 2, 3, 4, 5, 7],
    "TP_MODALIDADE_ENSINO": [1],
}

# the test binding's codes
P4_LISTS = {
    "TP_GRAU_ACADEMICO": ["A", "R"],
    "TP_NIVEL_ACADEMICO": ["F"],
    "TP_ORGANIZACAO_ACADEMICA": ["F", "P"],
    "TP_CATEGORIA_ADMINISTRATIVA": ["1-URGENT", "2-HIGH", "3-MEDIUM"],
    "TP_MODALIDADE_ENSINO": [1, 2, 3, 4],
}


def bind_p4(t: B.Tables) -> DataFrame:
    """Course microdata: one line item = one course offer."""
    m = B.micro(t)
    return m.select(F.col("l_returnflag").alias("TP_GRAU_ACADEMICO"), F.col("l_linestatus").alias("TP_NIVEL_ACADEMICO"),
                    F.col("o_orderstatus").alias("TP_ORGANIZACAO_ACADEMICA"),
                    F.col("o_orderpriority").alias("TP_CATEGORIA_ADMINISTRATIVA"),
                    F.col("l_linenumber").alias("TP_MODALIDADE_ENSINO"),
                    F.col("l_quantity").alias("QT_VG_TOTAL"), F.col("codigo_municipio").alias("CO_MUNICIPIO"), "ano")


def p4_higher_education(raw: DataFrame, lists: dict) -> DataFrame:
    """D7 -> D2 -> F9 -> D11 -> C1 -> G1 -> C11 -> K1 in one aggregate:
    places summed over the courses passing the in-lists; a city whose
    courses all fail, or hold no number, comes back with 0 (no anti join, no
    union). Codes are compared as text, whole numbers without their zeros."""
    df = D.drop_nulls(raw, ["CO_MUNICIPIO", "ano"])

    def code(c):
        text = F.col(c).cast("string")
        return F.coalesce(text.try_cast("double").try_cast("bigint").cast("string"), text)

    keep = reduce(lambda a, b: a & b, [code(c).isin(*map(str, v)) for c, v in lists.items()])
    df = df.withColumn("CO_MUNICIPIO", F.col("CO_MUNICIPIO").try_cast("bigint")).withColumn(
        "QT_VG_TOTAL", F.coalesce(F.col("QT_VG_TOTAL").try_cast("double"), F.lit(0.0)))
    df = df.filter(P.not_sentinel("CO_MUNICIPIO", 0))
    df = J.zero_fill_sum(df.withColumnRenamed("CO_MUNICIPIO", S.CITY_CODE_COL), [S.CITY_CODE_COL, "ano"],
                         keep, "QT_VG_TOTAL")
    df = df.withColumn(S.VALUE_COL, F.col(S.VALUE_COL).cast("bigint"))
    df = C.add_metadata(df, dado_identificador="Vagas no ensino superior", tipo_dado="int")
    return checked(df)


@query("p4", CTE(MICRO_SQL) + """
SELECT codigo_municipio, ano, 'Vagas no ensino superior' AS dado_identificador, 'int' AS tipo_dado,
       CAST(SUM(CASE WHEN l_returnflag IN ('A', 'R') AND l_linestatus IN ('F') AND o_orderstatus IN ('F', 'P')
                      AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND l_linenumber IN (1, 2, 3, 4)
                     THEN l_quantity ELSE 0 END) AS BIGINT) AS valor
FROM micro GROUP BY codigo_municipio, ano""")
def p4(spark, d):
    return p4_higher_education(bind_p4(B.Tables(spark, d)), P4_LISTS)


# ---------------------------------------------------------------------------
# P5 school age-grade distortion: sheet with location x dependency
# breakdown including 'Total' lines (a cube of the two)
# ---------------------------------------------------------------------------
def bind_p5(t: B.Tables) -> DataFrame:
    o = B.order_facts(t)
    loc = F.when(F.col("o_orderstatus") == "F", "Urbana").otherwise("Rural")
    dep = F.when(F.col("o_orderpriority") < "3", "Municipal").otherwise("Estadual")
    src = o.select("codigo_municipio", "ano", loc.alias("loc"), dep.alias("dep"), "o_orderpriority")
    # full city-year groups, in which loc and dep may roll up to 'Total'
    key, loc, dep = [F.col("codigo_municipio"), F.col("ano")], F.col("loc"), F.col("dep")
    cube = src.groupingSets([[*key, loc, dep], [*key, loc], [*key, dep], key], *key, loc, dep).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("u"))
    return cube.select(F.col("codigo_municipio").alias("Unnamed: 3"),
                       F.coalesce("loc", F.lit("Total")).alias("Unnamed: 5"),
                       F.coalesce("dep", F.lit("Total")).alias("Unnamed: 6"),
                       F.round(F.lit(100.0) * F.col("u") / F.col("n"), 2).alias("Total"), "ano")


def p5_school_distortion(raw: DataFrame) -> DataFrame:
    """D8 -> C2 -> C3 -> C11 -> D7 -> K1."""
    df = raw.filter(P.both_total("Unnamed: 5", "Unnamed: 6"))
    df = C.drop_columns(df, ["Unnamed: 5", "Unnamed: 6"])
    df = C.rename_columns(df, {"Unnamed: 3": S.CITY_CODE_COL, "Total": S.VALUE_COL})
    df = C.add_metadata(df, dado_identificador="Taxa de distorção idade-série", tipo_dado="float")
    return checked(D.drop_nulls(df))


@query("p5", CTE(ORD) + """
SELECT codigo_municipio, ano, 'Taxa de distorção idade-série' AS dado_identificador, 'float' AS tipo_dado,
       round(CAST(100.0 AS DOUBLE) * count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) / count(*), 2) AS valor
FROM ord GROUP BY codigo_municipio, ano""")
def p5(spark, d):
    return p5_school_distortion(bind_p5(B.Tables(spark, d)))
