"""Registered operator queries: one Spark plan per operator of SURVEY 2
on the driver's tables, each with its DuckDB oracle SQL.

Every query reads whole tables; no row is sampled, capped or skipped to
keep a check cheap. Floating sums are rounded to cents on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions import numbers as N
from indicarium.functions import predicates as P
from indicarium.functions import text as X
from indicarium.operators import aggregates as G
from indicarium.operators import filters as D
from indicarium.operators import joins as J
from indicarium.operators import ordering as I
from indicarium.operators import release as M
from indicarium.operators import reshape as H
from indicarium.operators import schema_ops as C
from indicarium.operators import sets as U
from indicarium.operators import validate as K
from indicarium.plans import bindings as B
from indicarium.plans import munic_editions as ME
from indicarium.sources import readers as A

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


CTE = B.with_ctes
MUN, ORD, FEED, REL = B.MUN_SQL, B.ORD_SQL, B.FEED_SQL, B.REL_SQL


# ---------------------------------------------------------------------------
# 2.A scans
# ---------------------------------------------------------------------------
def _api_documents(t: B.Tables) -> DataFrame:
    """The feed as nested API documents (one small document per order)."""
    o = B.order_facts(t).join(B.municipalities(t).select("c_custkey", "nome_municipio"),
                              F.col("o_custkey") == F.col("c_custkey"))
    raw = B.api_raw(F.col("o_orderkey"), F.col("o_totalprice"))
    doc = F.struct(
        F.substring("o_orderpriority", 1, 1).alias("id"),
        F.col("o_orderpriority").alias("variavel"),
        B.unit_of(F.col("o_orderpriority")).alias("unidade"),
        F.array(F.struct(
            F.array(F.struct(F.col("o_orderstatus").alias("id"), F.lit("situacao").alias("nome"),
                             F.create_map(F.col("o_orderstatus"), F.col("o_orderstatus")).alias("categoria"))
                    ).alias("classificacoes"),
            F.array(F.struct(
                F.struct(F.col("codigo_municipio").cast("string").alias("id"),
                         F.col("nome_municipio").alias("nome")).alias("localidade"),
                F.create_map(F.col("ano").cast("string"), raw).alias("serie"))).alias("series"),
        )).alias("resultados"))
    return o.select("o_orderkey", F.to_json(doc).alias("payload"))


@query("a5_nested_json", CTE(MUN, ORD) + f"""
SELECT o.o_orderkey, substr(o.o_orderpriority, 1, 1) AS variavel_id, o.o_orderpriority AS variavel,
       {B.unit_of_sql('o.o_orderpriority')} AS unidade, CAST(0 AS INTEGER) AS resultado,
       o.o_orderstatus AS classificacao, o.codigo_municipio, m.nome_municipio, o.ano,
       {B.api_raw_sql('o.o_orderkey', 'o.o_totalprice')} AS raw
FROM ord o JOIN mun m ON o.o_custkey = m.c_custkey""")
def a5_nested_json(spark, d):
    docs = _api_documents(B.Tables(spark, d))
    parsed = docs.select("o_orderkey", F.from_json("payload", A.API_SCHEMA).alias("doc"))
    return A.flatten_api(parsed, doc="doc", keep=["o_orderkey"])


@query("a7_catalogue", """
WITH g AS (SELECT p_type AS topico, p_brand AS nome_dado, CAST(count(*) AS VARCHAR) AS n,
                  CAST(min(p_size) AS VARCHAR) AS min_size FROM part GROUP BY 1, 2)
SELECT topico, nome_dado, 'n' AS param, n AS valor FROM g
UNION ALL SELECT topico, nome_dado, 'min_size', min_size FROM g""")
def a7_catalogue(spark, d):
    t = B.Tables(spark, d)
    per_ind = t.part.groupBy("p_type", "p_brand").agg(
        F.count(F.lit(1)).cast("string").alias("n"), F.min("p_size").cast("string").alias("min_size"))
    # one catalogue document per topic; a topic holds its indicators only
    docs = per_ind.groupBy("p_type").agg(F.map_from_entries(F.collect_list(F.struct(
        "p_brand", F.create_map(F.lit("n"), F.col("n"), F.lit("min_size"), F.col("min_size"))))).alias("inds"))
    text = docs.select(F.to_json(F.create_map(F.col("p_type"), F.col("inds"))).alias("value"))
    rows = A.catalogue_rows(text.select(F.from_json("value", A.CATALOGUE_TYPE).alias("catalogo")))
    return rows.select("topico", "nome_dado", F.explode("params").alias("param", "valor"))


# ---------------------------------------------------------------------------
# 2.C schema
# ---------------------------------------------------------------------------
EDITION_LAYOUTS = {
    1995: ("A", {"CODMUN": "codigo6", "VL_TOTAL": "valor_total", "SITUACAO": "situacao", "PRIORIDADE": "prioridade"}),
    1998: ("B", {"cod_mun": "codigo6", "valor_total": "valor_total", "situacao": "situacao"}),
    2000: ("C", {"CodMun": "codigo6", "Total": "valor_total", "Prioridade": "prioridade"}),
}


def _editions_together(t: B.Tables) -> DataFrame:
    """The editions as one scan gives them: the columns of all layouts, null where a row's edition has another."""
    ano, src = B.year_of("o_orderdate"), {
        "codigo6": (F.lit(100000) + F.col("o_custkey")).cast("bigint"), "valor_total": F.col("o_totalprice"),
        "situacao": F.col("o_orderstatus"), "prioridade": F.col("o_orderpriority")}
    starts = sorted(EDITION_LAYOUTS)
    cells: dict[str, list] = {"EXTRA": [F.when(ano.isin(_layout_years("B")), F.col("o_orderkey") % 100)]}
    for start in starts:
        layout, names = EDITION_LAYOUTS[start]
        for column, common in names.items():
            cells.setdefault(column.upper(), []).append(F.when(ano.isin(_layout_years(layout)), src[common]))
    return t.orders.select("o_orderkey", ano.alias("ano"), *[F.coalesce(*c).alias(name) for name, c in cells.items()])


def _layout_years(layout: str, last: int = 2010) -> list[int]:
    starts = sorted(EDITION_LAYOUTS)
    return [y for y in range(1990, last) if EDITION_LAYOUTS[max([s for s in starts if s <= y], default=starts[0])][0] == layout]


@query("c4_harmonise", """
SELECT o_orderkey, CAST(100000 + o_custkey AS BIGINT) AS codigo6, o_totalprice AS valor_total,
       CASE WHEN year(o_orderdate) >= 2000 THEN NULL ELSE o_orderstatus END AS situacao,
       CASE WHEN year(o_orderdate) IN (1998, 1999) THEN NULL ELSE o_orderpriority END AS prioridade,
       CAST(year(o_orderdate) AS INTEGER) AS ano
FROM orders""")
def c4_harmonise(spark, d):
    table = [(y, column, common) for layout, names in EDITION_LAYOUTS.values() for y in _layout_years(layout) for column, common in names.items()]
    out = C.harmonise_by_table(_editions_together(B.Tables(spark, d)), "ano", table, keep=["o_orderkey"], drops=[(y, "EXTRA") for y in _layout_years("B")])
    return out.select("o_orderkey", "codigo6", "valor_total", "situacao", "prioridade", "ano")


def _munic_sql(name: str) -> str:
    """A customer's value of a common name, null in editions whose files lack it."""
    whens = " ".join(f"WHEN {e} THEN {int(name in (ME.COMMON if e not in ME.RENAMES else ME.RENAMES[e].values()))}" for e in ME.EDITIONS)
    return f"""CASE WHEN CASE edicao {whens} END = 1 THEN concat('{name} ', c_custkey) END AS "{name}" """


@query("c4_munic_editions", f"""
WITH e AS (SELECT c_custkey, [{", ".join(map(str, ME.EDITIONS))}][1 + c_custkey % {len(ME.EDITIONS)}] AS edicao FROM customer)
SELECT c_custkey, CAST(edicao AS INTEGER) AS edicao, {", ".join(_munic_sql(n) for n in ME.COMMON)} FROM e""")
def c4_munic_editions(spark, d):
    """The survey's 17 editions, whose files name the same variables in 15 ways, in one scan."""
    c = B.Tables(spark, d).customer
    edition = F.element_at(F.array(*[F.lit(e) for e in ME.EDITIONS]), (F.col("c_custkey") % len(ME.EDITIONS) + 1).cast("int"))
    cells: dict[str, list] = {}
    for e in ME.EDITIONS:
        for column, common in (ME.RENAMES.get(e) or {n: n for n in ME.COMMON}).items():
            cells.setdefault(column.upper(), []).append(F.when(edition == e, F.concat(F.lit(f"{common} "), F.col("c_custkey").cast("string"))))
    for e, column in ME.DROP_ROWS:
        cells.setdefault(column, []).append(F.when(edition == e, F.lit("fora")))
    raw = c.select("c_custkey", edition.alias("edicao"), *[F.coalesce(*v).alias(name) for name, v in cells.items()])
    return C.harmonise_by_table(raw, "edicao", ME.RENAME_ROWS, keep=["c_custkey", *ME.COMMON], drops=ME.DROP_ROWS)


# ---------------------------------------------------------------------------
# 2.D filters
# ---------------------------------------------------------------------------
D2_LISTS = {
    "l_returnflag": ["A", "R"],
    "l_linestatus": ["F"],
    "o_orderstatus": ["F", "P"],
    "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"],
    "l_linenumber": [1, 2, 3, 4],
}


def _d2_sql_pred(alias_l="l", alias_o="o") -> str:
    return (f"{alias_l}.l_returnflag IN ('A', 'R') AND {alias_l}.l_linestatus IN ('F') "
            f"AND {alias_o}.o_orderstatus IN ('F', 'P') "
            f"AND {alias_o}.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') "
            f"AND {alias_l}.l_linenumber IN (1, 2, 3, 4)")


@query("d2_in_lists", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE {_d2_sql_pred()}""")
def d2_in_lists(spark, d):
    t = B.Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return D.in_lists(j, D2_LISTS).select("l_orderkey", "l_linenumber", "l_quantity")


def _datasus_raw(t: B.Tables) -> DataFrame:
    """DATASUS-style table: city lines '100001 NAME;value', a 'Total' line
    per state and an 'IGNORADO' line per state."""
    m = B.municipalities(t)
    cities = m.select(F.concat_ws(" ", F.col("codigo6").cast("string"), F.upper("c_mktsegment")).alias("municipio"),
                      B.money_text(F.col("c_acctbal")).alias("valor"))
    per_uf = m.groupBy("sigla_uf").agg(F.count(F.lit(1)).alias("n"))
    totals = per_uf.select(F.lit("Total").alias("municipio"), F.col("n").cast("string").alias("valor"))
    ignored = per_uf.select(F.concat(F.lit("MUNICIPIO IGNORADO - "), F.col("sigla_uf")).alias("municipio"),
                            F.lit("...").alias("valor"))
    return cities.unionByName(totals).unionByName(ignored)


DATASUS_SQL = f"""ds AS (
  SELECT codigo6 || ' ' || upper(c_mktsegment) AS municipio, {B.money_text_sql('c_acctbal')} AS valor FROM mun
  UNION ALL SELECT 'Total', CAST(count(*) AS VARCHAR) FROM mun GROUP BY sigla_uf
  UNION ALL SELECT 'MUNICIPIO IGNORADO - ' || sigla_uf, '...' FROM mun GROUP BY sigla_uf)"""


@query("d3_totals", CTE(MUN, DATASUS_SQL) + """
SELECT municipio, valor FROM ds WHERE municipio <> 'Total' AND NOT contains(municipio, 'IGNORADO')""")
def d3_totals(spark, d):
    return _datasus_raw(B.Tables(spark, d)).filter(P.not_total_row("municipio"))


def _null_token_raw(k, p):
    return (F.when(k % 7 == 0, F.lit("...")).when(k % 11 == 0, F.lit("n.d.")).when(k % 13 == 0, F.lit("-"))
             .when(k % 17 == 0, F.lit("Não Disponível")).when(k % 19 == 0, F.lit(""))
             .when(k % 23 == 0, F.lit("N.E.")).otherwise(B.money_text(p)))


def _null_token_raw_sql(k, p):
    return (f"CASE WHEN {k} % 7 = 0 THEN '...' WHEN {k} % 11 = 0 THEN 'n.d.' WHEN {k} % 13 = 0 THEN '-' "
            f"WHEN {k} % 17 = 0 THEN 'Não Disponível' WHEN {k} % 19 = 0 THEN '' WHEN {k} % 23 = 0 THEN 'N.E.' "
            f"ELSE {B.money_text_sql(p)} END")


@query("d6_null_tokens", f"""
SELECT o_orderkey, CASE WHEN raw IN ('...', 'n.d.', 'N.D.', 'n.e.', 'N.E.', '-', 'Não Disponível', '') THEN NULL
                        ELSE raw END AS valor
FROM (SELECT o_orderkey, {_null_token_raw_sql('o_orderkey', 'o_totalprice')} AS raw FROM orders)""")
def d6_null_tokens(spark, d):
    o = B.Tables(spark, d).orders
    raw = o.select("o_orderkey", _null_token_raw(F.col("o_orderkey"), F.col("o_totalprice")).alias("raw"))
    return raw.select("o_orderkey", P.null_token("raw").alias("valor"))


def _network(status):
    out = F.lit(None).cast("string")
    for k, v in B.NETWORK_OF_STATUS.items():
        out = F.when(status == k, F.lit(v)).otherwise(out)
    return out


@query("d9_state_filter", CTE(MUN, ORD) + f"""
SELECT o.o_orderkey, o.codigo_municipio, m.sigla_uf,
       CASE o.o_orderstatus WHEN 'F' THEN 'Municipal' WHEN 'O' THEN 'Pública' WHEN 'P' THEN 'Estadual' END AS rede
FROM ord o JOIN mun m ON o.o_custkey = m.c_custkey
WHERE (CASE o.o_orderstatus WHEN 'F' THEN 'Municipal' WHEN 'O' THEN 'Pública' WHEN 'P' THEN 'Estadual' END)
      = CASE WHEN m.sigla_uf = '{B.CAPITAL_STATE}' THEN 'Pública' ELSE 'Municipal' END""")
def d9_state_filter(spark, d):
    t = B.Tables(spark, d)
    o = B.order_facts(t).select("o_orderkey", "o_custkey", "codigo_municipio", "o_orderstatus")
    m = B.municipalities(t).select("c_custkey", "sigla_uf")
    j = o.join(m, F.col("o_custkey") == F.col("c_custkey")).withColumn("rede", _network(F.col("o_orderstatus")))
    out = j.filter(P.state_network("sigla_uf", "rede", special_state=B.CAPITAL_STATE))
    return out.select("o_orderkey", "codigo_municipio", "sigla_uf", "rede")


@query("d10_raw_zero", f"""
SELECT o_orderkey, CAST(raw AS DOUBLE) AS valor
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '0' WHEN o_orderkey % 10 = 5 THEN '0.0'
                              ELSE {B.money_text_sql('o_totalprice')} END AS raw FROM orders)
WHERE raw <> '0'""")
def d10_raw_zero(spark, d):
    o = B.Tables(spark, d).orders
    k = F.col("o_orderkey")
    raw = F.when(k % 10 == 0, F.lit("0")).when(k % 10 == 5, F.lit("0.0")).otherwise(B.money_text(F.col("o_totalprice")))
    src = o.select("o_orderkey", raw.alias("raw"))
    return src.filter(P.not_raw_zero("raw")).select("o_orderkey", F.col("raw").try_cast("double").alias("valor"))


MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in S.MONTHS_PT) + "]"


@query("d13_one_month", f"""
SELECT o_orderkey, rotulo, TRY_CAST(split_part(rotulo, '/', -1) AS INTEGER) AS ano
FROM (SELECT o_orderkey, {MONTHS_SQL}[month(o_orderdate)] || '/' || CAST(year(o_orderdate) AS VARCHAR) AS rotulo
      FROM orders)
WHERE contains(lower(rotulo), 'dez')""")
def d13_one_month(spark, d):
    o = B.Tables(spark, d).orders
    lab = o.select("o_orderkey", X.month_label_pt("o_orderdate").alias("rotulo"))
    return lab.filter(P.december_option("rotulo")).withColumn("ano", P.year_after_slash("rotulo"))


# ---------------------------------------------------------------------------
# 2.E expressions
# ---------------------------------------------------------------------------
@query("e1_digits", CTE(MUN) + """
SELECT c_custkey, rotulo, CAST(regexp_replace(rotulo, '[^0-9]', '', 'g') AS BIGINT) AS codigo6
FROM (SELECT c_custkey, CAST(codigo6 AS VARCHAR) || ' ' || upper(c_mktsegment) AS rotulo FROM mun)""")
def e1_digits(spark, d):
    m = B.municipalities(B.Tables(spark, d))
    lab = m.select("c_custkey", F.concat_ws(" ", F.col("codigo6").cast("string"), F.upper("c_mktsegment")).alias("rotulo"))
    return lab.withColumn("codigo6", X.digits_only("rotulo").cast("bigint"))


@query("e4_br_number", """
SELECT o_orderkey, texto,
       CAST(replace(replace(texto, '.', ''), ',', '.') AS DOUBLE) AS valor
FROM (SELECT o_orderkey, translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS texto FROM orders)""")
def e4_br_number(spark, d):
    o = B.Tables(spark, d).orders
    txt = o.select("o_orderkey", F.translate(F.format_number("o_totalprice", 2), ",.", ".,").alias("texto"))
    return txt.withColumn("valor", N.parse_br_number("texto"))


UNIT_SQL = """CASE WHEN contains(lower(unidade), 'mil') THEN 1000 WHEN contains(lower(unidade), 'cem') THEN 100 ELSE 1 END"""
TYPE_SQL = """CASE WHEN contains(lower(unidade), 'reais') THEN 'float' WHEN contains(lower(unidade), 'real') THEN 'float'
                   WHEN contains(lower(unidade), 'pessoas') THEN 'int' WHEN contains(lower(unidade), 'unidades') THEN 'int'
                   ELSE 'str' END"""


@query("e7_unit_infer", CTE(ORD, FEED) + f"""
SELECT o_orderkey, unidade, multiplicador, tipo_dado, tipo_dado <> 'str' AS inferido,
       CAST(CASE WHEN tipo_dado = 'int' THEN TRY_CAST(raw AS BIGINT) * multiplicador
                 WHEN tipo_dado = 'float' THEN TRY_CAST(raw AS DOUBLE) * multiplicador END AS DOUBLE) AS valor
FROM (SELECT o_orderkey, unidade, raw, {UNIT_SQL} AS multiplicador, {TYPE_SQL} AS tipo_dado FROM feed)""")
def e7_unit_infer(spark, d):
    f = B.api_feed(B.Tables(spark, d))
    u = f.select("o_orderkey", "unidade", "raw", N.unit_inference("unidade").alias("u"))
    return u.select("o_orderkey", "unidade", "u.multiplicador", "u.tipo_dado", "u.inferido",
                    N.scale_by_unit("raw", "u.multiplicador", "u.tipo_dado").cast("double").alias("valor"))


@query("e9_special_codes", CTE(ORD, FEED) + """
SELECT o_orderkey, raw, CASE WHEN raw = '-' THEN CAST(0 AS BIGINT) END AS valor,
       CASE WHEN raw = '-' THEN 'int' WHEN raw IN ('..', '...', 'X') THEN 'NULL' END AS tipo_dado
FROM feed""")
def e9_special_codes(spark, d):
    f = B.api_feed(B.Tables(spark, d))
    return f.select("o_orderkey", "raw", N.special_code("raw").alias("s")).select(
        "o_orderkey", "raw", "s.valor", "s.tipo_dado")


ANSWERS = S.BINARY_POSITIVE + S.BINARY_NEGATIVE + ["zzz"]
ANSWERS_SQL = "[" + ", ".join("'" + a.replace("'", "''") + "'" for a in ANSWERS) + "]"


@query("e10_binary_map", f"""
SELECT o_orderkey, resposta,
       CASE WHEN resposta IN ({", ".join("'" + a + "'" for a in S.BINARY_POSITIVE)}) THEN 1
            WHEN resposta IN ({", ".join("'" + a + "'" for a in S.BINARY_NEGATIVE)}) THEN 0 END AS valor
FROM (SELECT o_orderkey, {ANSWERS_SQL}[CAST(o_orderkey % {len(ANSWERS)} AS INTEGER) + 1] AS resposta FROM orders)""")
def e10_binary_map(spark, d):
    o = B.Tables(spark, d).orders
    arr = F.array(*[F.lit(a) for a in ANSWERS])
    src = o.select("o_orderkey", F.element_at(arr, (F.col("o_orderkey") % len(ANSWERS)).cast("int") + 1).alias("resposta"))
    return src.withColumn("valor", N.binary_answer("resposta"))


@query("e12_ascii_fold", r"""
SELECT doc_id, regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g') AS texto FROM documents""")
def e12_ascii_fold(spark, d):
    docs = B.Tables(spark, d).documents
    return docs.select("doc_id", X.ascii_fold("text").alias("texto"))


TITLE_RX = r"<title>(.*?)</title>"


@query("e14_slug", r"""
SELECT page_id, titulo,
       'fato_topico_' || substr(regexp_replace(lower(translate(regexp_replace(strip_accents(substr(titulo, 1, 20)),
            '[^\x00-\x7F]', '', 'g'), ' -', '__')), '[^a-zA-Z0-9_]', '', 'g'), 1, 63) AS slug
FROM (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS titulo FROM pages)""")
def e14_slug(spark, d):
    p = B.Tables(spark, d).pages
    t = p.select("page_id", F.regexp_extract("html", TITLE_RX, 1).alias("titulo"))
    return t.withColumn("slug", X.topic_slug("titulo"))


@query("e16_name_uf", CTE(MUN) + r"""
SELECT c_custkey, split_part(rotulo, '(', 1) AS nome, regexp_extract(rotulo, '\((..)', 1) AS uf
FROM (SELECT c_custkey, nome_municipio || ' (' || sigla_uf || ')' AS rotulo FROM mun)""")
def e16_name_uf(spark, d):
    m = B.municipalities(B.Tables(spark, d))
    lab = m.select("c_custkey", F.concat("nome_municipio", F.lit(" ("), "sigla_uf", F.lit(")")).alias("rotulo"))
    name, uf = X.split_name_state("rotulo")
    return lab.select("c_custkey", name.alias("nome"), uf.alias("uf"))


@query("e18_years_in_text", CTE(ORD, REL) + f"""
SELECT pos AS o_orderkey, link, {B.year_from_text_sql('link')} AS ano FROM rel""")
def e18_years_in_text(spark, d):
    r = B.releases(B.Tables(spark, d))
    return r.select(F.col("pos").alias("o_orderkey"), "link", X.year_from_text("link").alias("ano"))


# ---------------------------------------------------------------------------
# 2.F joins
# ---------------------------------------------------------------------------
@query("f1_code_upgrade", CTE(MUN) + """
SELECT s.o_orderkey, CASE WHEN s.codigo BETWEEN 1000000 AND 9999999 THEN s.codigo ELSE m.codigo_municipio END AS codigo_municipio
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(1000000 + 10*o_custkey + o_custkey % 10 AS BIGINT)
                              ELSE CAST(100000 + o_custkey AS BIGINT) END AS codigo FROM orders) s
LEFT JOIN mun m ON m.codigo6 = s.codigo""")
def f1_code_upgrade(spark, d):
    t = B.Tables(spark, d)
    k = F.col("o_custkey")
    code = F.when(F.col("o_orderkey") % 3 == 0, B.city_code(k)).otherwise((F.lit(100000) + k).cast("bigint"))
    src = t.orders.select("o_orderkey", code.alias("codigo_municipio"))
    return J.upgrade_city_code(src, "codigo_municipio", B.municipalities(t))


@query("f2_name_state", CTE(MUN, ORD) + r"""
, src AS (SELECT o.o_orderkey, o.ano, o.o_totalprice AS valor,
                 CASE WHEN o.o_orderkey % 50 = 0 THEN 'Desconhecido (' || m.sigla_uf || ')'
                      ELSE m.nome_municipio || ' (' || m.sigla_uf || ')' END AS rotulo
          FROM ord o JOIN mun m ON o.o_custkey = m.c_custkey),
sp AS (SELECT *, split_part(rotulo, '(', 1) AS nome, regexp_extract(rotulo, '\((..)', 1) AS uf FROM src)
SELECT sp.o_orderkey, m.codigo_municipio, sp.ano, sp.valor
FROM sp JOIN mun m ON replace(lower(sp.nome), ' ', '') = replace(lower(m.nome_municipio), ' ', '') AND sp.uf = m.sigla_uf""")
def f2_name_state(spark, d):
    t = B.Tables(spark, d)
    m = B.municipalities(t)
    o = B.order_facts(t).select("o_orderkey", "o_custkey", "ano", F.col("o_totalprice").alias("valor"))
    lab_name = F.when(F.col("o_orderkey") % 50 == 0, F.lit("Desconhecido")).otherwise(F.col("nome_municipio"))
    src = o.join(m.select("c_custkey", "nome_municipio", "sigla_uf"),
                 F.col("o_custkey") == F.col("c_custkey")) \
           .select("o_orderkey", "ano", "valor", F.concat(lab_name, F.lit(" ("), "sigla_uf", F.lit(")")).alias("rotulo"))
    name, uf = X.split_name_state("rotulo")
    sp = src.select("o_orderkey", "ano", "valor", name.alias("nome"), uf.alias("uf"))
    return J.resolve_by_name_state(sp, "nome", "uf", m).select("o_orderkey", "codigo_municipio", "ano", "valor")


@query("f3_unique_lookup", """
WITH req AS (SELECT l.l_orderkey, l.l_linenumber, p.p_name AS nome,
                    CASE WHEN l.l_orderkey % 13 = 0 THEN 'DESCONHECIDO' ELSE p.p_type END AS tipo
             FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
lk AS (SELECT replace(lower(p_name), ' ', '') AS k1, p_type AS k2, count(*) AS n, min(p_partkey) AS v FROM part GROUP BY 1, 2)
SELECT req.l_orderkey, req.l_linenumber, CAST(COALESCE(CASE WHEN lk.n = 1 THEN lk.v END, -1) AS BIGINT) AS codigo
FROM req LEFT JOIN lk ON replace(lower(req.nome), ' ', '') = lk.k1 AND req.tipo = lk.k2""")
def f3_unique_lookup(spark, d):
    t = B.Tables(spark, d)
    p = t.part.select("p_partkey", "p_name", "p_type")
    req = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(
        p, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", F.col("p_name").alias("nome"),
        F.when(F.col("l_orderkey") % 13 == 0, F.lit("DESCONHECIDO")).otherwise(F.col("p_type")).alias("tipo"))
    out = J.unique_lookup(req, {"n": X.name_key("nome"), "t": F.col("tipo")}, p,
                          {"n": X.name_key("p_name"), "t": F.col("p_type")}, F.col("p_partkey"), "codigo")
    return out.select("l_orderkey", "l_linenumber", F.col("codigo").cast("bigint"))


@query("f4_lookup_fanout", """
SELECT lk.p_brand, round(sum(l.l_quantity), 2) AS l_quantity,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN part lk ON lk.p_name = p.p_name
GROUP BY lk.p_brand""")
def f4_lookup_fanout(spark, d):
    t = B.Tables(spark, d)
    # money is summed as exact decimals: totals per brand are large enough
    # for double rounding to depend on the summation order
    facts = t.lineitem.select("l_partkey", "l_quantity", F.col("l_extendedprice").cast("decimal(18,2)")).join(
        t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).select(
        "p_name", "l_quantity", "l_extendedprice")
    lookup = t.part.select("p_name", "p_brand")
    out = J.fanout_sum(facts, lookup, "p_name", "p_brand", ["l_quantity", "l_extendedprice"])
    return out.select("p_brand", F.round("l_quantity", 2).alias("l_quantity"),
                      F.col("l_extendedprice").cast("double").alias("l_extendedprice"))


@query("f5_outer_sheets", CTE(MUN, ORD) + """
, s1 AS (SELECT codigo_municipio, count(*) AS n_urgente FROM ord WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
s2 AS (SELECT codigo_municipio, round(sum(o_totalprice), 2) AS total_f FROM ord WHERE o_orderstatus = 'F' GROUP BY 1),
s3 AS (SELECT codigo_municipio, c_acctbal AS saldo FROM mun WHERE c_acctbal > 0)
SELECT COALESCE(s1.codigo_municipio, s2.codigo_municipio, s3.codigo_municipio) AS codigo_municipio,
       s1.n_urgente, s2.total_f, s3.saldo
FROM s1 FULL OUTER JOIN s2 ON s1.codigo_municipio = s2.codigo_municipio
FULL OUTER JOIN s3 ON COALESCE(s1.codigo_municipio, s2.codigo_municipio) = s3.codigo_municipio""")
def f5_outer_sheets(spark, d):
    t = B.Tables(spark, d)
    o = B.order_facts(t)
    s1 = o.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("codigo_municipio").agg(
        F.count(F.lit(1)).alias("n_urgente"))
    s2 = o.filter(F.col("o_orderstatus") == "F").groupBy("codigo_municipio").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_f"))
    s3 = B.municipalities(t).filter(F.col("c_acctbal") > 0).select("codigo_municipio", F.col("c_acctbal").alias("saldo"))
    return J.outer_merge([s1, s2, s3], "codigo_municipio")


@query("f6_surrogate", CTE(MUN) + """
SELECT s.o_orderkey, m.municipio_id
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN CAST(9999999 AS BIGINT)
                              ELSE CAST(1000000 + 10*o_custkey + o_custkey % 10 AS BIGINT) END AS codigo_municipio
      FROM orders) s
LEFT JOIN mun m ON s.codigo_municipio = m.codigo_municipio""")
def f6_surrogate(spark, d):
    t = B.Tables(spark, d)
    code = F.when(F.col("o_orderkey") % 97 == 0, F.lit(9999999).cast("bigint")).otherwise(B.city_code(F.col("o_custkey")))
    src = t.orders.select("o_orderkey", code.alias("codigo_municipio"))
    return J.to_surrogate(src, B.municipalities(t))


# indicator code -> (first year, last year, topic, type tag)
CATALOGUE = [
    ("1-URGENT", 1995, 2001, "Saude", "float"),
    ("2-HIGH", 1995, 1998, "Saude", "float"),
    ("3-MEDIUM", 1999, 2001, "Educacao", "int"),
    ("4-NOT SPECIFIED", 1995, 2001, "Educacao", "int"),
]
CATALOGUE_SQL = "cat AS (SELECT codigo, CAST(unnest(range(y0, y1 + 1)) AS INTEGER) AS ano, topico, tipo_dado FROM (VALUES " + \
    ", ".join(f"('{c}', {a}, {b}, '{tp}', '{ty}')" for c, a, b, tp, ty in CATALOGUE) + \
    ") v(codigo, y0, y1, topico, tipo_dado))"


def catalogue_df(spark: SparkSession) -> DataFrame:
    lit = J.literal_frame(spark, CATALOGUE, "codigo string, y0 int, y1 int, topico string, tipo_dado string")
    return I.expand_year_range(lit, "y0", "y1").select("codigo", "ano", "topico", "tipo_dado")


@query("f8_catalogue_join", CTE(ORD, CATALOGUE_SQL) + """
SELECT f.codigo_municipio, f.ano, f.codigo, c.topico, c.tipo_dado, f.valor
FROM (SELECT codigo_municipio, ano, o_orderpriority AS codigo, round(sum(o_totalprice), 2) AS valor
      FROM ord GROUP BY 1, 2, 3) f
JOIN cat c ON f.ano = c.ano AND f.codigo = c.codigo""")
def f8_catalogue_join(spark, d):
    o = B.order_facts(B.Tables(spark, d))
    f = o.groupBy("codigo_municipio", "ano", F.col("o_orderpriority").alias("codigo")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("valor"))
    return J.catalogue_join(f, catalogue_df(spark), ["ano", "codigo"]).select(
        "codigo_municipio", "ano", "codigo", "topico", "tipo_dado", "valor")


def _microdata(t: B.Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                           "l_returnflag", "l_linestatus")
    o = B.order_facts(t).select("o_orderkey", "codigo_municipio", "ano", "o_orderstatus", "o_orderpriority")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


MICRO_SQL = f"""micro AS (
  SELECT l.*, {B.city_code_sql('o.o_custkey')} AS codigo_municipio, CAST(year(o.o_orderdate) AS INTEGER) AS ano,
         o.o_orderstatus, o.o_orderpriority
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def _d2_pred():
    from functools import reduce
    return reduce(lambda a, b: a & b, [F.col(c).isin(*v) for c, v in D2_LISTS.items()])


@query("f9_zero_fill", CTE(MICRO_SQL) + f"""
SELECT codigo_municipio, ano, SUM(CASE WHEN {_d2_sql_pred('micro', 'micro')} THEN l_quantity ELSE 0 END) AS valor
FROM micro GROUP BY 1, 2""")
def f9_zero_fill(spark, d):
    m = D.drop_nulls(_microdata(B.Tables(spark, d)), ["codigo_municipio", "ano", "l_quantity"])
    return J.zero_fill_sum(m, ["codigo_municipio", "ano"], _d2_pred(), "l_quantity")


F10_REQUEST = ["1-URGENT", "3-Medium", "nao existe"]


@query("f10_request_semi", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE replace(lower(o_orderpriority), ' ', '') IN ('1-urgent', '3-medium', 'naoexiste')""")
def f10_request_semi(spark, d):
    o = B.Tables(spark, d).orders.select("o_orderkey", "o_orderpriority")
    kept, _unknown = J.request_filter(o, "o_orderpriority", F10_REQUEST)
    return kept


# ---------------------------------------------------------------------------
# 2.G aggregates
# ---------------------------------------------------------------------------
@query("g1_group_sum", CTE(ORD) + """
SELECT codigo_municipio, ano, round(sum(o_totalprice), 2) AS valor FROM ord GROUP BY 1, 2""")
def g1_group_sum(spark, d):
    o = B.order_facts(B.Tables(spark, d))
    return G.group_sum(o, ["codigo_municipio", "ano"], "o_totalprice").withColumn("valor", F.round("valor", 2))


@query("g2_sum_all", CTE(MICRO_SQL) + """
SELECT codigo_municipio, ano, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
       round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax
FROM micro GROUP BY 1, 2""")
def g2_sum_all(spark, d):
    m = _microdata(B.Tables(spark, d)).select("codigo_municipio", "ano", "l_quantity", "l_extendedprice",
                                               "l_discount", "l_tax")
    out = G.group_sum_all(m, ["codigo_municipio", "ano"])
    return out.select("codigo_municipio", "ano", *[F.round(c, 2).alias(c) for c in
                                                   ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]])


# price bucket label -> upper bound (exclusive); the last has none
BUCKETS = [("Menos de 50000", 50000), ("50000 a 99999", 100000), ("100000 a 199999", 200000),
           ("200000 a 299999", 300000), ("300000 ou mais", None)]


def _bucket_wide(o: DataFrame) -> DataFrame:
    """Wide DATASUS-style table: per city counts per price bucket as text,
    '-' meaning zero, plus the seed column 'Nenhuma'."""
    aggs, lo = [], None
    for label, hi in BUCKETS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("o_totalprice") >= lo)
        if hi is not None:
            cond = cond & (F.col("o_totalprice") < hi)
        aggs.append(F.count(F.when(cond, 1)).alias(label))
        lo = hi
    aggs.append(F.count(F.when(F.col("o_orderstatus") == "P", 1)).alias("Nenhuma"))
    wide = o.groupBy("codigo_municipio").agg(*aggs)
    return wide.select("codigo_municipio", *[
        F.when(F.col(f"`{c}`") == 0, F.lit("-")).otherwise(F.col(f"`{c}`").cast("string")).alias(c)
        for c in wide.columns if c != "codigo_municipio"])


@query("g4_bucket_sum", CTE(ORD) + """
SELECT codigo_municipio, CAST(count(CASE WHEN o_totalprice < 200000 THEN 1 END)
                              + count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS BIGINT) AS valor
FROM ord GROUP BY 1""")
def g4_bucket_sum(spark, d):
    wide = _bucket_wide(B.order_facts(B.Tables(spark, d)))
    return G.bucket_sum(wide, "codigo_municipio", 199999, r"\d{3,6}", seed=["Nenhuma"])


def _typed_feed(t: B.Tables) -> DataFrame:
    f = B.api_feed(t)
    s = N.special_code("raw")
    return f.withColumn("v", F.when(s["tipo_dado"].isNotNull(), s["valor"]).otherwise(F.col("raw").try_cast("bigint")))


TYPED_SQL = """typed AS (SELECT *, CASE WHEN raw = '-' THEN CAST(0 AS BIGINT) WHEN raw IN ('..', '...', 'X') THEN NULL
                              ELSE TRY_CAST(raw AS BIGINT) END AS v FROM feed)"""


@query("g5_poison_sum", CTE(ORD, FEED, TYPED_SQL) + """
SELECT codigo_municipio, ano, variavel, CAST(CASE WHEN count(v) = count(*) THEN sum(v) END AS BIGINT) AS valor
FROM typed GROUP BY 1, 2, 3""")
def g5_poison_sum(spark, d):
    f = _typed_feed(B.Tables(spark, d))
    return G.null_poison_sum(f, ["codigo_municipio", "ano", "variavel"], "v")


@query("g6_series_years", CTE(ORD) + """
SELECT o_orderpriority AS variavel, array_to_string(list_sort(list_distinct(list(ano))), ', ') AS anos
FROM ord GROUP BY 1""")
def g6_series_years(spark, d):
    o = B.order_facts(B.Tables(spark, d)).withColumnRenamed("o_orderpriority", "variavel")
    return G.series_years(o, ["variavel"]).select("variavel", X.years_text("anos").alias("anos"))


@query("g7_longest_series", CTE(ORD, FEED, TYPED_SQL) + """
, pc AS (SELECT variavel, codigo_municipio, list_sort(list_distinct(list(ano))) AS ys FROM typed WHERE v IS NOT NULL GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY variavel ORDER BY len(ys) DESC, codigo_municipio ASC) AS rn FROM pc)
SELECT variavel, array_to_string(ys, ', ') AS anos FROM rk WHERE rn = 1""")
def g7_longest_series(spark, d):
    f = _typed_feed(B.Tables(spark, d)).filter(F.col("v").isNotNull())
    out = G.longest_series(f, ["variavel"])
    return out.select("variavel", X.years_text("anos").alias("anos"))


# ---------------------------------------------------------------------------
# 2.H reshape
# ---------------------------------------------------------------------------
def _wide_by_year(o: DataFrame) -> DataFrame:
    return o.groupBy("codigo_municipio").agg(*[
        F.round(F.sum(F.when(F.col("ano") == y, F.col("o_totalprice"))), 2).alias(str(y)) for y in B.years_in(o)])


@query("h1_unpivot_years", CTE(ORD) + """
SELECT codigo_municipio, ano, round(sum(o_totalprice), 2) AS valor FROM ord GROUP BY 1, 2""")
def h1_unpivot_years(spark, d):
    wide = _wide_by_year(B.order_facts(B.Tables(spark, d)))
    return D.drop_nulls(H.unpivot_years(wide, ["codigo_municipio"]), ["valor"])


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("h2_unpivot_indicators", CTE(MICRO_SQL) + f"""
, w AS (SELECT codigo_municipio, {", ".join(f'round(sum({m}), 2) AS {m}' for m in MEASURES)} FROM micro GROUP BY 1)
SELECT codigo_municipio, dado_identificador, valor
FROM (UNPIVOT w ON {", ".join(MEASURES)} INTO NAME dado_identificador VALUE valor)""")
def h2_unpivot_indicators(spark, d):
    m = _microdata(B.Tables(spark, d))
    wide = m.groupBy("codigo_municipio").agg(*[F.round(F.sum(c), 2).alias(c) for c in MEASURES])
    return H.unpivot_indicators(wide, ["codigo_municipio"])


# ---------------------------------------------------------------------------
# 2.I ordering
# ---------------------------------------------------------------------------
@query("i1_latest_release", CTE(ORD, REL) + f"""
, y AS (SELECT fonte, pos, link, {B.year_from_text_sql('link')} AS ano FROM rel),
rk AS (SELECT *, row_number() OVER (PARTITION BY fonte, ano ORDER BY pos DESC) AS rn FROM y)
SELECT fonte, ano, link, pos FROM rk WHERE rn = 1""")
def i1_latest_release(spark, d):
    r = B.releases(B.Tables(spark, d)).withColumn("ano", X.year_from_text("link"))
    return I.latest_per_key(r, ["fonte", "ano"], "pos").select("fonte", "ano", "link", "pos")


@query("i2_fill_year", CTE(ORD, REL) + f"""
, y AS (SELECT fonte, pos, {B.year_from_text_sql('link')} AS ano FROM rel)
SELECT fonte, pos, COALESCE(ano, last_value(ano IGNORE NULLS) OVER (PARTITION BY fonte ORDER BY pos
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1) AS ano
FROM y""")
def i2_fill_year(spark, d):
    r = B.releases(B.Tables(spark, d)).select("fonte", "pos", X.year_from_text("link").alias("ano"))
    return I.fill_missing_year(r, "ano", "pos", partition=["fonte"])


@query("i3_keep_first", CTE(ORD) + """
SELECT codigo_municipio, ano, o_orderkey, o_totalprice AS valor
FROM (SELECT *, row_number() OVER (PARTITION BY codigo_municipio, ano ORDER BY o_orderkey) AS rn FROM ord)
WHERE rn = 1""")
def i3_keep_first(spark, d):
    o = B.order_facts(B.Tables(spark, d)).select("codigo_municipio", "ano", "o_orderkey",
                                                  F.col("o_totalprice").alias("valor"))
    return I.keep_first(o, ["codigo_municipio", "ano"], ["o_orderkey"])


@query("i4_best_dataset", CTE(ORD, REL) + f"""
, y AS (SELECT fonte, pos, link, {B.years_in_text_sql('link')} AS ys FROM rel),
c AS (SELECT *, list_max(ys) AS mx FROM y WHERE len(ys) > 0),
rk AS (SELECT *, row_number() OVER (PARTITION BY fonte ORDER BY mx DESC, pos ASC) AS rn FROM c)
SELECT fonte, link AS arquivo, CASE WHEN len(ys) = 1 THEN 1 ELSE ys[-1] - ys[1] END AS anos_serie,
       ys[1] AS primeiro_ano, ys[-1] AS ultimo_ano
FROM rk WHERE rn = 1""")
def i4_best_dataset(spark, d):
    r = B.releases(B.Tables(spark, d)).withColumn("ys", X.years_in_text("link"))
    return I.best_dataset(r, ["fonte"], "link", "ys", "pos")


@query("i7_year_sequence", CTE(ORD) + """
SELECT variavel, CAST(unnest(range(y0, y1 + 1)) AS INTEGER) AS ano
FROM (SELECT o_orderpriority AS variavel, min(ano) AS y0, max(ano) AS y1 FROM ord GROUP BY 1)""")
def i7_year_sequence(spark, d):
    o = B.order_facts(B.Tables(spark, d))
    rng = o.groupBy(F.col("o_orderpriority").alias("variavel")).agg(F.min("ano").alias("y0"), F.max("ano").alias("y1"))
    return I.expand_year_range(rng, "y0", "y1").select("variavel", "ano")


# ---------------------------------------------------------------------------
# 2.J sets
# ---------------------------------------------------------------------------
@query("j1_union_years", CTE(ORD) + """
SELECT o_orderkey, codigo_municipio, o_totalprice AS valor,
       CASE WHEN ano >= 1999 THEN o_orderstatus END AS situacao, ano
FROM ord""")
def j1_union_years(spark, d):
    """Editions of two layouts: a scan for each layout, not for each year."""
    old, new = B.layout_editions(B.Tables(spark, d).orders, "o_orderdate", [1999])
    columns = ["o_orderkey", B.city_code(F.col("o_custkey")).alias("codigo_municipio"), F.col("o_totalprice").alias("valor")]
    return U.union_years([old.select(*columns, "ano"), new.select(*columns, F.col("o_orderstatus").alias("situacao"), "ano")]).select(
        "o_orderkey", "codigo_municipio", "valor", "situacao", "ano")


@query("j4_year_arrays", CTE(ORD) + """
, cur AS (SELECT o_orderpriority AS variavel, list_distinct(list(ano)) AS novos FROM ord GROUP BY 1),
old AS (SELECT o_orderpriority AS variavel, list_distinct(list(ano)) AS antigos FROM ord WHERE ano <= 1997 GROUP BY 1)
SELECT cur.variavel,
       array_to_string(list_sort(list_distinct(list_concat(COALESCE(old.antigos, []), cur.novos))), ', ') AS anos_todos,
       array_to_string(list_sort(list_filter(cur.novos, lambda y: NOT list_contains(COALESCE(old.antigos, []), y))), ', ') AS anos_novos
FROM cur LEFT JOIN old ON cur.variavel = old.variavel""")
def j4_year_arrays(spark, d):
    o = B.order_facts(B.Tables(spark, d)).withColumnRenamed("o_orderpriority", "variavel")
    # stored and new year sets from one aggregate (one scan, no join)
    j = o.groupBy("variavel").agg(
        F.array_sort(F.collect_set("ano")).alias("novos"),
        F.array_sort(F.collect_set(F.when(F.col("ano") <= 1997, F.col("ano")))).alias("antigos"))
    return j.select("variavel", X.years_text(U.years_union("antigos", "novos")).alias("anos_todos"),
                    X.years_text(F.array_sort(U.years_new("novos", "antigos"))).alias("anos_novos"))


# ---------------------------------------------------------------------------
# 2.K validation
# ---------------------------------------------------------------------------
def _dirty_facts(t: B.Tables) -> DataFrame:
    o = B.order_facts(t)
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 101 == 0, F.lit(123).cast("bigint")).otherwise(F.col("codigo_municipio")).alias("codigo_municipio"),
        F.when(k % 103 == 0, F.lit(1970)).otherwise(F.col("ano")).alias("ano"),
        F.col("o_orderpriority").alias("dado_identificador"),
        F.when(k % 107 == 0, F.lit("decimal")).otherwise(F.lit("float")).alias("tipo_dado"),
        F.when(k % 109 == 0, F.lit(None).cast("string")).otherwise(B.money_text(F.col("o_totalprice"))).alias("valor"))


@query("k1_contract_report", CTE(ORD) + f"""
, f AS (SELECT CASE WHEN o_orderkey % 101 = 0 THEN 123 ELSE codigo_municipio END AS codigo_municipio,
               CASE WHEN o_orderkey % 103 = 0 THEN 1970 ELSE ano END AS ano,
               o_orderpriority AS dado_identificador,
               CASE WHEN o_orderkey % 107 = 0 THEN 'decimal' ELSE 'float' END AS tipo_dado,
               CASE WHEN o_orderkey % 109 = 0 THEN NULL ELSE {B.money_text_sql('o_totalprice')} END AS valor FROM ord)
SELECT dado_identificador, count(*) AS linhas,
       CAST(sum(CASE WHEN ano IS NULL OR ano < 1980 OR ano > year(current_date) THEN 1 ELSE 0 END) AS BIGINT) AS ano_invalido,
       CAST(sum(CASE WHEN codigo_municipio IS NULL OR codigo_municipio < 1000000 OR codigo_municipio > 9999999 THEN 1 ELSE 0 END) AS BIGINT) AS codigo_invalido,
       CAST(sum(CASE WHEN dado_identificador IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS dado_nulo,
       CAST(sum(CASE WHEN tipo_dado IS NULL OR tipo_dado NOT IN ('int', 'float', 'str', 'bool', 'NULL') THEN 1 ELSE 0 END) AS BIGINT) AS tipo_invalido,
       CAST(sum(CASE WHEN valor IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS valor_nulo,
       CAST(0 AS BIGINT) AS colunas_extras
FROM f GROUP BY 1""")
def k1_contract_report(spark, d):
    return K.contract_report(_dirty_facts(B.Tables(spark, d)), group=["dado_identificador"])


# ---------------------------------------------------------------------------
# 2.M release discovery
# ---------------------------------------------------------------------------
@query("m1_links", """
SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages""")
def m1_links(spark, d):
    return M.links(B.Tables(spark, d).pages, keep=["page_id"])


def registered() -> dict[str, tuple[QueryFn, str | None]]:
    # pipelines and load/audit register themselves on import
    from indicarium.plans import (pipelines, surveys, apis, load, load_queries, catalogue_pipelines, operator_queries,  # noqa: F401
                                  roundtrip_queries, scan_queries)  # noqa: F401
    return REGISTRY
