"""Pipelines P6-P11: sheet-shaped survey sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions import numbers as N
from indicarium.functions import predicates as P
from indicarium.functions import text as X
from indicarium.operators import filters as D
from indicarium.operators import joins as J
from indicarium.operators import ordering as I
from indicarium.operators import reshape as H
from indicarium.operators import schema_ops as C
from indicarium.plans import bindings as B
from indicarium.plans.pipelines import checked, MICRO_SQL
from indicarium.plans.queries import query, _network

CTE = B.with_ctes
MUN, ORD = B.MUN_SQL, B.ORD_SQL

# ---------------------------------------------------------------------------
# P6 IDEB final years: one line per (city, network) with 'IDEB <year>'
# columns; the capital district keeps the public network, others the
# municipal one
# ---------------------------------------------------------------------------
def bind_p6(t: B.Tables) -> DataFrame:
    o = B.order_facts(t).withColumn("rede", _network(F.col("o_orderstatus")))
    years = B.years_in(o)
    per = o.groupBy("o_custkey", "rede").agg(*[
        F.count(F.when(F.col("ano") == y, 1)).alias(f"n{y}") for y in years], *[
        F.count(F.when((F.col("ano") == y) & (F.col("o_orderpriority") == "1-URGENT"), 1)).alias(f"u{y}")
        for y in years])
    uf = B.municipalities(t).select("c_custkey", "sigla_uf")
    per = per.join(uf, F.col("o_custkey") == F.col("c_custkey"))
    cols = {f"IDEB {y} (N x P)": F.when(F.col(f"n{y}") == 0, F.lit("-")).otherwise(
        F.format_string("%.1f", F.round(F.lit(10.0) * F.col(f"u{y}") / F.col(f"n{y}"), 1))) for y in years}
    return per.select(F.col("sigla_uf").alias("Sigla da UF"), F.col("rede").alias("Rede"),
                      B.city_code(F.col("o_custkey")).alias("Código do Município"),
                      *[v.alias(k) for k, v in cols.items()], F.lit("x").alias("Nome da Rede"))


# fixed value: the federal district, whose schools are not municipal
CAPITAL_DISTRICT = "DF"


def p6_ideb(raw: DataFrame, capital_state: str = CAPITAL_DISTRICT) -> DataFrame:
    """D9 -> C9 -> C10 -> H1 -> D6 -> D7 -> E6 -> C11 -> K1."""
    df = raw.filter(P.state_network("Sigla da UF", "Rede", special_state=capital_state))
    df = C.select_by_pattern(df, "IDEB", keep=["Código do Município"])
    df = C.year_named_columns(df)
    df = H.unpivot_years(df, ["Código do Município"])
    df = df.withColumn(S.VALUE_COL, P.null_token(S.VALUE_COL, ["-"]))
    df = D.drop_nulls(df)
    df = df.withColumn(S.VALUE_COL, F.col(S.VALUE_COL).try_cast("double"))
    df = C.rename_columns(df, {"Código do Município": S.CITY_CODE_COL})
    df = C.add_metadata(df, dado_identificador="Índice de desenvolvimento da educação básica (IDEB) - anos finais", tipo_dado="float")
    return checked(df)


@query("p6", CTE(MUN, ORD) + f"""
, r AS (SELECT o.*, m.sigla_uf,
               CASE o.o_orderstatus WHEN 'F' THEN 'Municipal' WHEN 'O' THEN 'Pública' WHEN 'P' THEN 'Estadual' END AS rede
        FROM ord o JOIN mun m ON o.o_custkey = m.c_custkey)
SELECT codigo_municipio, ano, 'Índice de desenvolvimento da educação básica (IDEB) - anos finais' AS dado_identificador, 'float' AS tipo_dado,
       CAST(printf('%.1f', round(CAST(10.0 AS DOUBLE) * count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) / count(*), 1)) AS DOUBLE) AS valor
FROM r WHERE rede = CASE WHEN sigla_uf = '{B.CAPITAL_STATE}' THEN 'Pública' ELSE 'Municipal' END
GROUP BY codigo_municipio, ano, rede""")
def p6(spark, d):
    return p6_ideb(bind_p6(B.Tables(spark, d)), B.CAPITAL_STATE)


# ---------------------------------------------------------------------------
# P7 IDH-M: one sheet per year, 'Name (UF)' territories, resolved by name
# and state
# ---------------------------------------------------------------------------
def bind_p7(t: B.Tables) -> DataFrame:
    o = B.order_facts(t)
    per = o.groupBy("o_custkey", "ano").agg(F.count(F.lit(1)).alias("n"),
                                           F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("f"))
    m = B.municipalities(t).select("c_custkey", "nome_municipio", "sigla_uf")
    per = per.join(m, F.col("o_custkey") == F.col("c_custkey"))
    cities = per.select(F.concat("nome_municipio", F.lit(" ("), "sigla_uf", F.lit(")")).alias("Territorialidade"),
                        F.round(F.col("f") / F.col("n"), 3).alias("IDHM"), "ano")
    # the country line re-aggregates the per-city counts (no second scan)
    country = per.groupBy("ano").agg(F.round(F.sum("f") / F.sum("n"), 3).alias("IDHM")).select(
        F.lit("Brasil (BR)").alias("Territorialidade"), "IDHM", "ano")
    return cities.unionByName(country)


def p7_idhm(raw: DataFrame, municipalities: DataFrame) -> DataFrame:
    """E16 -> F2 -> C1 -> C11 -> C3 -> K1."""
    name, uf = X.split_name_state("Territorialidade")
    df = raw.select(name.alias("nome"), uf.alias("uf"), "IDHM", "ano")
    df = J.resolve_by_name_state(df, "nome", "uf", municipalities)
    df = C.keep_columns(df, [S.CITY_CODE_COL, "ano", "IDHM"])
    df = C.add_metadata(df, dado_identificador="Índice de desenvolvimento humano do município (IDH-M)", tipo_dado="float")
    return checked(C.rename_columns(df, {"IDHM": S.VALUE_COL}))


@query("p7", CTE(ORD) + """
SELECT codigo_municipio, ano, 'Índice de desenvolvimento humano do município (IDH-M)' AS dado_identificador, 'float' AS tipo_dado,
       round(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) / count(*), 3) AS valor
FROM ord GROUP BY codigo_municipio, ano""")
def p7(spark, d):
    t = B.Tables(spark, d)
    return p7_idhm(bind_p7(t), B.municipalities(t))


# ---------------------------------------------------------------------------
# P8 city network: several lines per city, keep the first; two
# indicators (level, class) unpivoted
# ---------------------------------------------------------------------------
def bind_p8(t: B.Tables) -> DataFrame:
    o = B.order_facts(t)
    return o.select(F.col("codigo_municipio").alias("cod_ori"), F.col("o_orderpriority").alias("nivel_ori"),
                    F.col("o_orderstatus").alias("classe_ori"), "ano", F.col("o_orderkey").alias("linha"))


def p8_city_network(raw: DataFrame) -> DataFrame:
    """I3 -> H2 -> D7 -> E6 -> C11 -> K1 (keep-first before the unpivot
    halves the rows that the de-duplication shuffles)."""
    df = I.keep_first(raw, ["cod_ori", "ano"], ["linha"])
    df = H.unpivot_indicators(df.drop("linha"), ["cod_ori", "ano"], ["nivel_ori", "classe_ori"])
    df = D.drop_nulls(df)
    df = df.withColumn(S.VALUE_COL, N.cast_by_tag(S.VALUE_COL, "str"))
    df = C.rename_columns(df, {"cod_ori": S.CITY_CODE_COL})
    return checked(C.add_metadata(df, tipo_dado="str"))


@query("p8", CTE(ORD) + """
, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY codigo_municipio, ano ORDER BY o_orderkey) AS rn FROM ord) WHERE rn = 1)
SELECT codigo_municipio, ano, 'nivel_ori' AS dado_identificador, 'str' AS tipo_dado, o_orderpriority AS valor FROM f
UNION ALL
SELECT codigo_municipio, ano, 'classe_ori', 'str', o_orderstatus FROM f""")
def p8(spark, d):
    return p8_city_network(bind_p8(B.Tables(spark, d)))


# ---------------------------------------------------------------------------
# P9 MUNIC survey: coded answer columns spread over sheets merged on the
# city key, unpivoted, attached to the question catalogue and mapped to 0/1
# ---------------------------------------------------------------------------
P9_EDITION = 2001
# question code -> (question, topic, type); answers derived per status
P9_QUESTIONS = [
    ("MTIP01", "F", "Pedidos faturados", "Gestao"),
    ("MTIP02", "O", "Pedidos abertos", "Gestao"),
    ("MTIP03", "P", "Pedidos parciais", "Gestao"),
]
P9_URGENT = ("MURG01", "Pedidos urgentes", "Prioridade")
P9_TEXT = ("MFAIXA", "Faixa de pedidos", "Gestao")


def bind_p9(t: B.Tables) -> list[DataFrame]:
    """Two sheets: answers per status, and the urgency question; answers
    'Sim' / 'Não' / 'Recusa' ('Recusa' when the city has one order only)."""
    o = B.order_facts(t)
    per = o.groupBy("codigo_municipio").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col("o_orderstatus") == s, 1)).alias(code) for code, s, _, _ in P9_QUESTIONS],
        F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias(P9_URGENT[0]))

    def answer(c):
        return F.when(F.col("n") == 1, F.lit("Recusa")).when(F.col(c) > 0, F.lit("Sim")).otherwise(F.lit("Não"))

    sheet1 = per.select(F.col("codigo_municipio").alias("CodMun"), *[answer(q[0]).alias(q[0].lower()) for q in P9_QUESTIONS],
                        F.when(F.col("n") > 10, "Acima de dez").otherwise("Ate dez").alias(P9_TEXT[0].lower()))
    sheet2 = per.filter(F.col(P9_URGENT[0]) > 0).select(F.col("codigo_municipio").alias("CodMun"),
                                                       answer(P9_URGENT[0]).alias(P9_URGENT[0].lower()))
    return [sheet1, sheet2]


def p9_catalogue(spark) -> DataFrame:
    rows = [(P9_EDITION, c, q, tp, "bool") for c, _, q, tp in P9_QUESTIONS]
    rows.append((P9_EDITION, P9_URGENT[0], P9_URGENT[1], P9_URGENT[2], "bool"))
    rows.append((P9_EDITION, P9_TEXT[0], P9_TEXT[1], P9_TEXT[2], "str"))
    return J.literal_frame(spark, rows, "ano int, codigo string, nome string, topico string, tipo string")


def p9_munic(sheets: list[DataFrame], catalogue: DataFrame, edition: int = P9_EDITION) -> DataFrame:
    """C4 -> F5 -> C5 -> H2 -> F8 -> E10 -> K1. Facts are named by question
    code (``munic_lookup_names`` has the names the dimension knows); answers
    of yes/no questions become 1 and 0, others stay as they are."""
    sheets = [C.rename_columns(s, {"CodMun": "CODMUN"}) for s in sheets]   # C4 per-edition renames
    df = J.outer_merge(sheets, "CODMUN")
    df = C.normalise_column_names(df, "upper")
    codes = [c for c in df.columns if c != "CODMUN"]
    df = H.unpivot_indicators(df, ["CODMUN"], codes, name_col="codigo")
    df = df.withColumn("ano", F.lit(edition).cast("int"))
    df = J.catalogue_join(df, catalogue, ["ano", "codigo"])
    answer = F.when(F.col("tipo") == "bool", N.binary_answer(S.VALUE_COL).cast("string")).otherwise(F.col(S.VALUE_COL))
    df = df.withColumn(S.VALUE_COL, answer)
    df = D.drop_nulls(df, [S.VALUE_COL])
    df = df.select(F.col("CODMUN").alias(S.CITY_CODE_COL), "ano", F.col("codigo").alias(S.DATA_ID_COL),
                   F.col("tipo").alias(S.DTYPE_COL), S.VALUE_COL)
    return checked(df)


def munic_lookup_names(catalogue: DataFrame) -> DataFrame:
    """Question code -> the 'name - code' under which the dimension lists it."""
    return catalogue.select("codigo", X.name_with_code("nome", "codigo").alias("nome_dado")).distinct()


@query("e21_name_with_code", "SELECT p_partkey, concat(p_name, ' - ', p_partkey) AS nome_dado FROM part")
def e21_name_with_code(spark, d):
    return B.Tables(spark, d).part.select("p_partkey", X.name_with_code("p_name", F.col("p_partkey").cast("string")).alias("nome_dado"))


def _p9_sql() -> str:
    parts = []
    for code, st, q, _ in P9_QUESTIONS:
        parts.append(f"""SELECT codigo_municipio, {P9_EDITION} AS ano, '{code}' AS dado_identificador, 'bool' AS tipo_dado,
  CASE WHEN count(*) = 1 THEN 0 WHEN count(CASE WHEN o_orderstatus = '{st}' THEN 1 END) > 0 THEN 1 ELSE 0 END AS valor
FROM ord GROUP BY codigo_municipio""")
    code, q, _ = P9_URGENT
    parts.append(f"""SELECT codigo_municipio, {P9_EDITION}, '{code}', 'bool',
  CASE WHEN count(*) = 1 THEN 0 ELSE 1 END
FROM ord GROUP BY codigo_municipio HAVING count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) > 0""")
    parts.append(f"""SELECT codigo_municipio, {P9_EDITION}, '{P9_TEXT[0]}', 'str', CASE WHEN count(*) > 10 THEN 'Acima de dez' ELSE 'Ate dez' END
FROM ord GROUP BY codigo_municipio""")
    parts[:-1] = [f"SELECT * REPLACE (CAST(valor AS VARCHAR) AS valor) FROM ({p}) x(codigo_municipio, ano, dado_identificador, tipo_dado, valor)" for p in parts[:-1]]
    return CTE(ORD) + "SELECT codigo_municipio, CAST(ano AS INTEGER) AS ano, dado_identificador, tipo_dado, valor FROM (\n" + "\nUNION ALL\n".join(parts) + ")"


@query("p9", _p9_sql())
def p9(spark, d):
    return p9_munic(bind_p9(B.Tables(spark, d)), p9_catalogue(spark))


# ---------------------------------------------------------------------------
# P10 municipal GDP: long multi-line headers, agriculture's share in R$ 1,000
# ---------------------------------------------------------------------------
# fixed values: the published headers
AGRI_HEADER = "Valor adicionado bruto da Agropecuária, \na preços correntes\n(R$ 1.000)"
GDP_PC_HEADER = "Produto Interno Bruto per capita, \na preços correntes\n(R$ 1,00)"
P10_FIRST, P10_LAST = 1996, 2000


def bind_p10(t: B.Tables) -> DataFrame:
    o = B.order_facts(t)
    per = o.groupBy("codigo_municipio", "ano").agg(
        F.count(F.lit(1)).alias("n"), F.floor(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).cast("bigint").alias("s"))
    return per.select(F.col("ano").alias("Ano"), F.col("codigo_municipio").alias("Código do Município"),
                      F.floor(F.col("s") / 1000).cast("bigint").cast("string").alias(AGRI_HEADER),
                      F.floor(F.col("s") / F.col("n")).cast("bigint").cast("string").alias(GDP_PC_HEADER),
                      F.lit("x").alias("Nome da Grande Região"))


def p10_gdp(raw: DataFrame, first: int = P10_FIRST, last: int = P10_LAST) -> DataFrame:
    """D12 -> C5 -> C1 -> C3 -> D7 -> E6 -> H2 -> E8 -> C11 -> K1."""
    df = raw.filter(F.col("Ano").between(first, last))
    df = C.normalise_column_names(df, "compact")
    agri = C._norm_name(AGRI_HEADER, "compact")
    pc = C._norm_name(GDP_PC_HEADER, "compact")
    df = C.keep_columns(df, ["ano", "códigodomunicípio", f"`{agri}`", f"`{pc}`"])
    df = C.rename_columns(df, {"códigodomunicípio": S.CITY_CODE_COL, agri: "PIB Agropecuária", pc: "PIB per capita"})
    df = D.drop_nulls(df)
    df = H.unpivot_indicators(df, [S.CITY_CODE_COL, "ano"], ["PIB Agropecuária", "PIB per capita"], value_type="double")
    mult = F.when(F.col(S.DATA_ID_COL) == "PIB Agropecuária", F.lit(1000)).otherwise(F.lit(1))
    df = df.withColumn(S.VALUE_COL, N.scale_by_unit(S.VALUE_COL, mult, F.lit("float")))
    return checked(C.add_metadata(df, tipo_dado="float"))


@query("p10", CTE(ORD) + f"""
, per AS (SELECT codigo_municipio, ano, count(*) AS n, CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS s
          FROM ord WHERE ano BETWEEN {P10_FIRST} AND {P10_LAST} GROUP BY 1, 2)
SELECT codigo_municipio, ano, 'PIB Agropecuária' AS dado_identificador, 'float' AS tipo_dado, CAST(s // 1000 AS DOUBLE) * 1000 AS valor FROM per
UNION ALL
SELECT codigo_municipio, ano, 'PIB per capita', 'float', CAST(s // n AS DOUBLE) FROM per""")
def p10(spark, d):
    return p10_gdp(bind_p10(B.Tables(spark, d)))


# ---------------------------------------------------------------------------
# P11 school equipment: school rows with IN_* flags, located through a
# lookup file keyed by (non-unique) school name
# ---------------------------------------------------------------------------
# flag -> measure name; one measure is listed twice in the source list
P11_FLAGS = [("IN_DEVOLVIDO", "Itens devolvidos"), ("IN_ACEITO", "Itens aceitos"),
             ("IN_NOVO", "Itens novos"), ("IN_FECHADO", "Itens fechados"),
             ("IN_ABERTO", "Itens abertos"), ("IN_DESCONTO", "Itens com desconto"),
             ("IN_DEVOLVIDO", "Itens devolvidos")]


def bind_p11(t: B.Tables) -> tuple[DataFrame, DataFrame]:
    """(school rows, lookup): a line item is a school row named by its
    part's name; the lookup maps each part name to the city of every part
    carrying it (names repeat, so a school can sit in several cities)."""
    m = B.micro(t)
    named = m.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    flags = {
        "IN_DEVOLVIDO": F.col("l_returnflag") == "R", "IN_ACEITO": F.col("l_returnflag") == "A",
        "IN_NOVO": F.col("l_returnflag") == "N", "IN_FECHADO": F.col("l_linestatus") == "F",
        "IN_ABERTO": F.col("l_linestatus") == "O", "IN_DESCONTO": F.col("l_discount") > 0.05,
    }
    schools = named.select(F.col("p_name").alias("NO_ENTIDADE"), "ano",
                           *[v.cast("int").alias(k) for k, v in flags.items()])
    lookup = t.part.select(F.col("p_name").alias("NO_ENTIDADE"), B.city_code(F.col("p_size")).alias("CO_MUNICIPIO"))
    return schools, lookup


def p11_school_equipment(schools: DataFrame, lookup: DataFrame) -> DataFrame:
    """A9 -> F4 -> D7 -> E6 -> G2 -> C3 -> H2 -> K1.

    The name lookup fans out (same name, several cities). Instead of
    materialising every copy, flags are summed per (name, year) and the
    lookup is counted per (name, city): the join of the two aggregates
    times the copy count is the same sum, with no pair explosion."""
    measures = list(dict.fromkeys(f for f, _ in P11_FLAGS))
    per_name = D.drop_nulls(schools).groupBy("NO_ENTIDADE", "ano").agg(*[F.sum(m).alias(m) for m in measures])
    copies = lookup.groupBy("NO_ENTIDADE", "CO_MUNICIPIO").agg(F.count(F.lit(1)).alias("__copies"))
    joined = per_name.join(copies, "NO_ENTIDADE")
    per_city = joined.groupBy("CO_MUNICIPIO", "ano").agg(
        *[F.sum(F.col(m) * F.col("__copies")).cast("bigint").alias(m) for m in measures])
    names = dict(P11_FLAGS)
    per_city = C.rename_columns(per_city, {"CO_MUNICIPIO": S.CITY_CODE_COL, **names})
    df = H.unpivot_indicators(per_city, [S.CITY_CODE_COL, "ano"], [names[m] for m in measures])
    return checked(C.add_metadata(df, tipo_dado="int"))


def _p11_sql() -> str:
    flags = {
        "Itens devolvidos": "l_returnflag = 'R'", "Itens aceitos": "l_returnflag = 'A'",
        "Itens novos": "l_returnflag = 'N'", "Itens fechados": "l_linestatus = 'F'",
        "Itens abertos": "l_linestatus = 'O'", "Itens com desconto": "l_discount > 0.05",
    }
    cols = ", ".join(f"CAST(sum(CASE WHEN {v} THEN 1 ELSE 0 END) AS BIGINT) AS \"{k}\"" for k, v in flags.items())
    return CTE(MICRO_SQL) + f"""
, w AS (SELECT {B.city_code_sql('lk.p_size')} AS codigo_municipio, m.ano, {cols}
        FROM micro m JOIN part p ON m.l_partkey = p.p_partkey JOIN part lk ON lk.p_name = p.p_name
        GROUP BY 1, 2)
SELECT codigo_municipio, ano, dado_identificador, 'int' AS tipo_dado, valor
FROM (UNPIVOT w ON {", ".join(f'"{k}"' for k in flags)} INTO NAME dado_identificador VALUE valor)"""


@query("p11", _p11_sql())
def p11(spark, d):
    schools, lookup = bind_p11(B.Tables(spark, d))
    return p11_school_equipment(schools, lookup)
