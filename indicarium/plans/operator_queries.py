"""More registered operator queries: text cleaning on whole documents,
collection typing and counts, top-k per city, key differences and the
link patterns of release discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions import text as X
from indicarium.operators import aggregates as G
from indicarium.operators import filters as D
from indicarium.operators import joins as J
from indicarium.operators import ordering as I
from indicarium.operators import release as M
from indicarium.operators import reshape as H
from indicarium.operators import sets as U
from indicarium.operators import validate as K
from indicarium.functions import numbers as N
from indicarium.plans import bindings as B
from indicarium.plans.queries import query, TYPE_SQL
from indicarium.sources import sinks

CTE = B.with_ctes
ORD, FEED, REL = B.ORD_SQL, B.FEED_SQL, B.REL_SQL

# Python whitespace (str.strip) as an explicit class, for the oracle's RE2
PY_WS_RE2 = r"[\t\n\x0b\x0c\r\x1c-\x1f\x85\p{Z}]"


@query("e11_printable_clean", rf"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '["\n\t\r]', '', 'g'),
         '^{PY_WS_RE2}+|{PY_WS_RE2}+$', '', 'g'), '[^\p{{L}}\p{{M}}\p{{N}}\p{{P}}\p{{Z}}\p{{S}}]', '', 'g') AS texto
FROM documents""")
def e11_printable_clean(spark, d):
    docs = B.Tables(spark, d).documents
    return docs.select("doc_id", X.printable_clean("text").alias("texto"))


@query("e13_text_key", r"""
SELECT doc_id, lower(replace(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'),
       '[^\x20-\x7E\t\n\r\x0B\x0C]', '', 'g'), ' ', '')) AS chave
FROM documents""")
def e13_text_key(spark, d):
    docs = B.Tables(spark, d).documents
    return docs.select("doc_id", X.text_key("text").alias("chave"))


@query("g8_collection_type", CTE(ORD, FEED) + f"""
, u AS (SELECT *, {TYPE_SQL} AS tipo FROM feed WHERE raw NOT IN ('-', '..', '...', 'X'))
SELECT variavel, arg_max(tipo, o_orderkey) AS tipo_dado FROM u GROUP BY variavel""")
def g8_collection_type(spark, d):
    f = B.api_feed(B.Tables(spark, d))
    normal = ~F.col("raw").isin("-", "..", "...", "X")
    typed = f.withColumn("tipo", N.unit_inference("unidade")["tipo_dado"])
    return G.collection_type(typed, ["variavel"], "tipo", "o_orderkey", normal=normal)


@query("g9_row_counts", CTE(ORD) + """
SELECT o_orderpriority AS dado_identificador, ano, count(*) AS linhas, count(DISTINCT codigo_municipio) AS municipios
FROM ord GROUP BY 1, 2""")
def g9_row_counts(spark, d):
    o = B.order_facts(B.Tables(spark, d)).withColumnRenamed("o_orderpriority", "dado_identificador")
    # rows and cities in one aggregate (one scan, one shuffle)
    return o.groupBy("dado_identificador", "ano").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("codigo_municipio").alias("municipios"))


@query("i6_first_n", CTE(ORD) + """
SELECT codigo_municipio, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY codigo_municipio ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM ord)
WHERE rn <= 3""")
def i6_first_n(spark, d):
    o = B.order_facts(B.Tables(spark, d)).select("codigo_municipio", "o_orderkey", "o_totalprice")
    return I.first_n(o, ["codigo_municipio"], [F.desc("o_totalprice"), "o_orderkey"], 3)


@query("j3_key_difference", CTE(ORD) + """
SELECT DISTINCT codigo_municipio FROM ord WHERE ano = 1995
EXCEPT SELECT codigo_municipio FROM ord WHERE ano = 2001""")
def j3_key_difference(spark, d):
    o = B.order_facts(B.Tables(spark, d))
    return U.key_difference(o.filter(F.col("ano") == 1995), o.filter(F.col("ano") == 2001), ["codigo_municipio"])


@query("m2_quoted_link", """
SELECT page_id, unnest(regexp_extract_all(html, '"([^"]*/[^"]*)"', 1)) AS link FROM pages""")
def m2_quoted_link(spark, d):
    return M.links(B.Tables(spark, d).pages, pattern=M.quoted_link_with("/"), keep=["page_id"])


@query("m3_file_pattern", CTE(ORD, REL) + r"""
SELECT pos, regexp_extract(link, '(?i)(base.{0,70}\.(?:zip|xlsx))', 1) AS arquivo
FROM rel WHERE regexp_matches(link, '(?i)base.{0,70}\.(?:zip|xlsx)')""")
def m3_file_pattern(spark, d):
    r = B.releases(B.Tables(spark, d))
    pat = M.file_type_pattern()
    return r.filter(F.col("link").rlike(pat)).select("pos", F.regexp_extract("link", pat, 1).alias("arquivo"))


@query("g6_years_by_count", CTE(ORD) + "SELECT ano, count(*) AS n FROM ord GROUP BY 1 ORDER BY n DESC, ano")
def g6_years_by_count(spark, d):
    return G.years_by_frequency(B.order_facts(B.Tables(spark, d)))


@query("d1_in_catalogue", CTE(ORD) + "SELECT o_orderkey, ano FROM ord WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def d1_in_catalogue(spark, d):
    t = B.Tables(spark, d)
    return D.in_catalogue(B.order_facts(t), "o_custkey", t.customer.where("c_mktsegment = 'BUILDING'"), "c_custkey").select("o_orderkey", "ano")


@query("h3_map_to_rows", CTE(ORD) + """
SELECT codigo_municipio, CAST(ano AS VARCHAR) AS ano, CAST(count(*) AS VARCHAR) AS raw FROM ord GROUP BY 1, 2""")
def h3_map_to_rows(spark, d):
    """A year -> value map of each city, as series APIs answer, to rows."""
    per = B.order_facts(B.Tables(spark, d)).groupBy("codigo_municipio", "ano").agg(F.count(F.lit(1)).cast("string").alias("n"))
    maps = per.groupBy("codigo_municipio").agg(F.map_from_entries(F.collect_list(F.struct(F.col("ano").cast("string"), "n"))).alias("serie"))
    return H.map_to_rows(maps, "serie")


@query("i5_sorted_years", CTE(ORD) + "SELECT codigo_municipio, array_to_string(list_sort(list(ano)), ',') AS anos FROM ord GROUP BY 1")
def i5_sorted_years(spark, d):
    listed = B.order_facts(B.Tables(spark, d)).groupBy("codigo_municipio").agg(F.collect_list("ano").alias("anos"))
    return listed.select("codigo_municipio", F.array_join(F.transform(I.sort_years("anos"), lambda y: y.cast("string")), ",").alias("anos"))


@query("j2_union_disjoint", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 200000")
def j2_union_disjoint(spark, d):
    o = B.Tables(spark, d).orders
    done = F.col("o_orderstatus") == "F"
    return U.union_disjoint(o.where(done), o.where(~done & (F.col("o_totalprice") > 200000))).select("o_orderkey", "o_orderstatus")


@query("k3_require", "SELECT 'colunas' AS regra, 'falhou' AS resultado UNION ALL SELECT 'vazio', 'falhou' UNION ALL SELECT 'linhas', 'ok' FROM (SELECT count(*) AS n FROM orders) WHERE n > 0")
def k3_require(spark, d):
    """What the checks before a load say of the facts, of facts with a column too many and of none at all."""
    facts = B.order_facts(B.Tables(spark, d)).select("codigo_municipio", "ano", F.col("o_orderpriority").alias(S.DATA_ID_COL), F.lit("int").alias(S.DTYPE_COL), F.lit("1").alias(S.VALUE_COL))

    def verdict(check):
        try:
            check()
        except K.ContractError:
            return "falhou"
        return "ok"

    def whole():
        K.require_columns(facts, facts.columns)
        K.require_rows(facts)

    said = [("colunas", verdict(lambda: K.require_columns(facts.withColumn("mais", F.lit(1)), S.FACT_COLUMNS, ordered=False))),
            ("vazio", verdict(lambda: K.require_rows(facts.where("ano < 1900")))), ("linhas", verdict(whole))]
    return J.literal_frame(spark, said, "regra string, resultado string")


@query("b5_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def b5_preview(spark, d):
    o = B.Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return sinks.preview(o.orderBy(F.desc("o_totalprice"), "o_orderkey"), 5)
