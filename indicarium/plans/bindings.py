"""How the municipal concepts sit on the driver's tables.

Each binding exists twice on purpose: as Spark DataFrames (what the
queries run on) and as a DuckDB SQL snippet (what the oracle runs on), so
both sides of the correctness gate read the same definitions.

- municipality: one customer. code7 = 1000000 + 10*c_custkey + c_custkey % 10
  (its first six digits are code6 = 100000 + c_custkey), name = c_name,
  state = two-digit c_nationkey, surrogate = c_custkey + 1.
- fact rows: orders (year of o_orderdate, indicator = o_orderpriority).
- microdata: lineitem joined to orders.
- API feed: one raw text value per order with special codes mixed in.
- release listings: file names generated per order, listed per customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.sources.readers import read_table

# ---------------------------------------------------------------------------
# Fixed binding values
# ---------------------------------------------------------------------------
# state that plays the capital district
CAPITAL_STATE = "07"
# unit text of each "variable" (order priority) of the API feed
UNIT_OF_PRIORITY = {
    "1-URGENT": "Mil Reais",
    "2-HIGH": "Reais",
    "3-MEDIUM": "Pessoas",
    "4-NOT SPECIFIED": "Cem unidades",
    "5-LOW": "Domicílios",
}
# network of each order status
NETWORK_OF_STATUS = {"F": "Municipal", "O": "Pública", "P": "Estadual"}
# ---------------------------------------------------------------------------


class Tables:
    """Lazy parquet readers for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def city_code(custkey: Column) -> Column:
    return (F.lit(1000000) + custkey * 10 + custkey % 10).cast("bigint")


def city_code_sql(k: str) -> str:
    return f"CAST(1000000 + 10*{k} + {k} % 10 AS BIGINT)"


def municipalities(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    return c.select(
        k,
        city_code(k).alias("codigo_municipio"),
        (F.lit(100000) + k).cast("bigint").alias("codigo6"),
        F.col("c_name").alias("nome_municipio"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("sigla_uf"),
        (k + 1).cast("int").alias("municipio_id"),
        "c_mktsegment", "c_acctbal",
    )


MUN_SQL = f"""mun AS (
  SELECT c_custkey, {city_code_sql('c_custkey')} AS codigo_municipio,
         CAST(100000 + c_custkey AS BIGINT) AS codigo6, c_name AS nome_municipio,
         lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS sigla_uf,
         CAST(c_custkey + 1 AS INTEGER) AS municipio_id, c_mktsegment, c_acctbal
  FROM customer)"""


def year_of(ts: str) -> Column:
    return F.year(F.col(ts)).cast("int")


def order_facts(t: Tables) -> DataFrame:
    """orders with the municipality code and year (no join needed: the
    code is a function of the customer key)."""
    o = t.orders
    return o.select("o_orderkey", "o_custkey", city_code(F.col("o_custkey")).alias("codigo_municipio"),
                    year_of("o_orderdate").alias("ano"), "o_totalprice", "o_orderpriority",
                    "o_orderstatus", "o_orderdate")


ORD_SQL = f"""ord AS (
  SELECT o_orderkey, o_custkey, {city_code_sql('o_custkey')} AS codigo_municipio,
         CAST(year(o_orderdate) AS INTEGER) AS ano, o_totalprice, o_orderpriority,
         o_orderstatus, o_orderdate
  FROM orders)"""


def money_text(c: Column) -> Column:
    """Exact two-decimal text of a price."""
    return c.cast("decimal(18,2)").cast("string")


def money_text_sql(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


def api_raw(key: Column, price: Column) -> Column:
    """Raw API text: statistical special codes mixed into integer texts."""
    return (F.when(key % 29 == 0, F.lit("-"))
             .when(key % 31 == 0, F.lit(".."))
             .when(key % 37 == 0, F.lit("..."))
             .when(key % 41 == 0, F.lit("X"))
             .otherwise(F.floor(price).cast("bigint").cast("string")))


def api_raw_sql(k: str, p: str) -> str:
    return (f"CASE WHEN {k} % 29 = 0 THEN '-' WHEN {k} % 31 = 0 THEN '..' "
            f"WHEN {k} % 37 = 0 THEN '...' WHEN {k} % 41 = 0 THEN 'X' "
            f"ELSE CAST(CAST(floor({p}) AS BIGINT) AS VARCHAR) END")


def unit_of(priority: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in reversed(list(UNIT_OF_PRIORITY.items())):
        out = F.when(priority == k, F.lit(v)).otherwise(out)
    return out


def unit_of_sql(p: str) -> str:
    whens = " ".join(f"WHEN {p} = '{k}' THEN '{v}'" for k, v in UNIT_OF_PRIORITY.items())
    return f"CASE {whens} END"


def api_feed(t: Tables) -> DataFrame:
    """One API data point per order: variable = priority, unit by variable."""
    o = order_facts(t)
    return o.select("o_orderkey", "codigo_municipio", "ano",
                    F.substring("o_orderpriority", 1, 1).alias("variavel_id"),
                    F.col("o_orderpriority").alias("variavel"),
                    unit_of(F.col("o_orderpriority")).alias("unidade"),
                    F.col("o_orderstatus").alias("classificacao"),
                    api_raw(F.col("o_orderkey"), F.col("o_totalprice")).alias("raw"))


FEED_SQL = f"""feed AS (
  SELECT o_orderkey, codigo_municipio, ano, substr(o_orderpriority, 1, 1) AS variavel_id,
         o_orderpriority AS variavel, {unit_of_sql('o_orderpriority')} AS unidade,
         o_orderstatus AS classificacao, {api_raw_sql('o_orderkey', 'o_totalprice')} AS raw
  FROM ord)"""


def release_name(key: Column, year: Column) -> Column:
    """A generated release file name (four shapes, by key)."""
    y = year.cast("string")
    return (F.when(key % 4 == 0, F.concat(F.lit("capag-"), y, F.lit("-v"),
                                          F.lpad((key % 100000).cast("string"), 5, "0"), F.lit(".csv")))
             .when(key % 4 == 1, F.concat(F.lit("base_"), y, F.lit("_"), (year + 1).cast("string"), F.lit(".zip")))
             .when(key % 4 == 2, F.concat(F.lit("corrigido-"), y, F.lit(".csv")))
             .otherwise(F.concat(F.lit("serie_"), (F.lit(2040) + key % 20).cast("string"), F.lit(".xlsx"))))


def release_name_sql(k: str, y: str) -> str:
    return (f"CASE WHEN {k} % 4 = 0 THEN 'capag-' || CAST({y} AS VARCHAR) || '-v' || "
            f"lpad(CAST({k} % 100000 AS VARCHAR), 5, '0') || '.csv' "
            f"WHEN {k} % 4 = 1 THEN 'base_' || CAST({y} AS VARCHAR) || '_' || CAST({y} + 1 AS VARCHAR) || '.zip' "
            f"WHEN {k} % 4 = 2 THEN 'corrigido-' || CAST({y} AS VARCHAR) || '.csv' "
            f"ELSE 'serie_' || CAST(2040 + {k} % 20 AS VARCHAR) || '.xlsx' END")


def releases(t: Tables) -> DataFrame:
    """Release listings: per source (customer) the files in listed order."""
    o = order_facts(t)
    return o.select(F.col("o_custkey").alias("fonte"), F.col("o_orderkey").alias("pos"),
                    release_name(F.col("o_orderkey"), F.col("ano")).alias("link"))


REL_SQL = f"""rel AS (
  SELECT o_custkey AS fonte, o_orderkey AS pos, {release_name_sql('o_orderkey', 'ano')} AS link
  FROM ord)"""


def year_from_text_sql(c: str) -> str:
    """Oracle form of E18 (RE2 has no look-behind): runs of digits of
    length exactly four, last one wins, >= 2050 is not a year."""
    last = f"TRY_CAST(list_filter(regexp_extract_all({c}, '[0-9]+'), lambda x: length(x) = 4)[-1] AS INTEGER)"
    return f"CASE WHEN {last} < 2050 THEN {last} END"


def years_in_text_sql(c: str) -> str:
    return (f"list_transform(list_filter(regexp_extract_all({c}, '[0-9]+'), lambda x: length(x) = 4), "
            f"lambda x: CAST(x AS INTEGER))")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def years_in(df: DataFrame, year_col: str = "ano") -> list[int]:
    """The data's years, which name the columns of a wide edition (a handful of values, one small job)."""
    return sorted(r[0] for r in df.select(year_col).where(F.col(year_col).isNotNull()).distinct().collect())


def yearly_editions(df: DataFrame, date_col: str) -> dict[int, DataFrame]:
    """Yearly editions of one table: each is a range of dates, which the
    scan gets as a pushed filter. Nothing is written; the list of years is
    the one thing asked beforehand."""
    date = F.col(date_col)
    return {y: df.filter((date >= F.lit(f"{y}-01-01").cast("date")) & (date < F.lit(f"{y + 1}-01-01").cast("date")))
            for y in years_in(df.select(year_of(date_col).alias("ano")))}


def layout_editions(df: DataFrame, date_col: str, starts: list[int]) -> list[DataFrame]:
    """The editions of one table by layout: those before the first year of
    ``starts``, then those from each of them on, with their year. Each is one
    range of dates, a pushed filter of one scan, however many editions it has."""
    date, first = F.col(date_col), [F.lit(f"{y}-01-01").cast("date") for y in starts]
    ranges = [date < first[0], *[(date >= a) & (date < b) for a, b in zip(first, first[1:])], date >= first[-1]]
    return [df.where(r).withColumn("ano", year_of(date_col)) for r in ranges]


def micro(t: Tables) -> DataFrame:
    """Microdata: line items with their order's municipality and year."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                           "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    o = order_facts(t).select("o_orderkey", "o_custkey", "codigo_municipio", "ano", "o_orderstatus",
                              "o_orderpriority")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
