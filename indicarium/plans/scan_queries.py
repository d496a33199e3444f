"""Registered scan queries: driver tables landed as the file shapes the
source system reads (delimited Latin-1 text, title lines and footer
notes around a table, malformed lines, one folder per year), then read
back with the scan operators. Files go to the application's folder under
``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicarium.plans import bindings as B
from indicarium.plans.queries import query
from indicarium.session import checkpoint_dir
from indicarium.sources import readers as A


def _landing(spark, kind: str) -> str:
    root = checkpoint_dir(spark)
    return os.path.join(root, "landed", f"{kind}-{uuid.uuid4().hex}")


def _land_lines(lines: DataFrame, kind: str) -> str:
    path = _landing(lines.sparkSession, kind)
    lines.write.text(path)
    return path


@query("a1_delimited_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def a1_delimited_scan(spark, d):
    c = B.Tables(spark, d).customer
    path = _landing(spark, "cadastro")
    c.write.option("sep", ";").option("encoding", "ISO-8859-1").option("header", "true").csv(path)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return A.delimited_scan(spark, path, schema, columns=["c_custkey", "c_name", "c_acctbal"])


@query("a2_preamble_scan", """
SELECT CAST(100000 + c_custkey AS VARCHAR) || ' ' || upper(c_mktsegment) AS municipio,
       replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS valor
FROM customer
UNION ALL SELECT 'Total', CAST(count(*) AS VARCHAR) FROM customer""")
def a2_preamble_scan(spark, d):
    c = B.Tables(spark, d).customer
    body = c.select(F.concat_ws(";", F.concat_ws(" ", (F.lit(100000) + F.col("c_custkey")).cast("string"),
                                                 F.upper("c_mktsegment")),
                                F.replace(B.money_text(F.col("c_acctbal")), F.lit("."), F.lit(","))).alias("value"))
    total = c.agg(F.concat(F.lit("Total;"), F.count(F.lit(1)).cast("string")).alias("value"))
    title = spark.createDataFrame([("Cadastro de clientes",), ("Período: todos",), ("Município;Valor",)], "value string")
    notes = spark.createDataFrame([("Fonte: tabelas de teste",), ("Notas:",)], "value string")
    path = _land_lines(title.unionByName(body).unionByName(total).unionByName(notes), "datasus")
    schema = T.StructType([T.StructField("municipio", T.StringType()), T.StructField("valor", T.StringType())])
    return A.preamble_tolerant_scan(spark, path, schema, header_value="Município", encoding="UTF-8")


@query("a3_malformed_scan", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def a3_malformed_scan(spark, d):
    o = B.Tables(spark, d).orders
    k, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    # well-formed lines for status F; lines of other orders are broken: a
    # text where a number belongs (O) or extra fields (P)
    line = (F.when(F.col("o_orderstatus") == "F", F.concat_ws(";", k, cust))
             .when(F.col("o_orderstatus") == "O", F.concat_ws(";", k, F.lit("sem-codigo")))
             .otherwise(F.concat_ws(";", k, cust, F.lit("x"), F.lit("y"))))
    path = _land_lines(o.select(line.alias("value")), "rais")
    # the landed lines carry no header line
    return A.malformed_skipping_scan(spark, path, "o_orderkey long, o_custkey long", encoding="UTF-8", header=False)


@query("a4_quoted_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def a4_quoted_scan(spark, d):
    c = B.Tables(spark, d).customer
    path = _landing(spark, "snis")
    # every field quoted; names carry stray tabs and a control character
    dirty = F.concat(F.lit("\t"), F.col("c_name"), F.lit("\u0007"))
    (c.select(F.col("c_custkey").cast("string").alias("c_custkey"), dirty.alias("c_name"), "c_mktsegment")
      .write.option("sep", ";").option("quoteAll", "true").option("header", "true").option("encoding", "ISO-8859-1")
      .csv(path))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("c_custkey", "c_name", "c_mktsegment")])
    df = A.quoted_clean_scan(spark, path, schema)
    return df.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")


@query("a9_side_files", """
SELECT o.o_orderkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def a9_side_files(spark, d):
    t = B.Tables(spark, d)
    root = _landing(spark, "equipamentos")
    # facts as .csv files, the lookup as .txt files, side by side in one folder
    t.orders.select("o_orderkey", "o_custkey").write.option("sep", ";").option("header", "true").csv(os.path.join(root, "a"))
    t.customer.select(F.concat_ws(";", "c_custkey", "c_nationkey").alias("value")).write.text(os.path.join(root, "b"))
    facts, lookup = A.side_file_split(spark, root, "o_orderkey long, o_custkey long", "*.csv",
                                      "c_custkey long, c_nationkey int", "*.txt", lookup_header=False,
                                      encoding="UTF-8", year_regex=r"/(\d{4})-ano/")
    return facts.join(lookup, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")


@query("a8_yearly_scan", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders""")
def a8_yearly_scan(spark, d):
    o = B.Tables(spark, d).orders.select("o_orderkey", "o_totalprice", B.year_of("o_orderdate").alias("ano"))
    root = _landing(spark, "censo")
    # one folder per year, files named by Spark; a notes file that must be skipped
    (o.hint("rebalance", "ano").write.partitionBy("ano").option("sep", ";").option("header", "true")
      .csv(os.path.join(root, "dados")))
    spark.createDataFrame([("leia-me",)], "value string").write.text(os.path.join(root, "notas"))
    return A.yearly_files_scan(spark, root, "o_orderkey long, o_totalprice double", "*.csv",
                               year_regex=r"/ano=(\d{4})/")
