"""Fact shape, dimension shapes and the fixed values the pipelines rely on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# ---------------------------------------------------------------------------
CITY_CODE_COL = "codigo_municipio"
YEAR_COL = "ano"
DATA_ID_COL = "dado_identificador"
DTYPE_COL = "tipo_dado"
VALUE_COL = "valor"
FACT_COLUMNS = [CITY_CODE_COL, YEAR_COL, DATA_ID_COL, DTYPE_COL, VALUE_COL]
LOADED_FACT_COLUMNS = ["dado_id", "municipio_id", "ano", "tipo_dado", "valor"]

NUMBER_OF_CITIES = 5570
OLDEST_YEAR = 1980
SMALLEST_CITY_CODE = 1000000
HIGHEST_CITY_CODE = 9999999

# type tags carried in tipo_dado ("UNKNOWN" is an alias of "str")
TYPE_TAGS = ["int", "float", "str", "bool", "NULL"]

# null tokens found in the public tables
CAPAG_NULL_TOKENS = ["n.d.", "N.D.", "n.e.", "N.E."]
NULL_TOKENS = ["...", "n.d.", "N.D.", "n.e.", "N.E.", "-", "Não Disponível", ""]

# statistical-office special codes: token -> (value, type tag)
SPECIAL_CODE_ZERO = "-"                  # numeric zero not from rounding -> 0, int
SPECIAL_CODES_NULL = ["..", "...", "X"]  # not applicable / unavailable / omitted -> null, NULL

# unit text -> multiplier (first match wins, in this order)
UNIT_MULTIPLIERS = [("mil", 1000), ("cem", 100)]
# unit text -> type tag (first match wins, in this order)
UNIT_TYPES = [("reais", "float"), ("real", "float"), ("pessoas", "int"), ("unidades", "int")]

# survey answers -> binary flag
BINARY_POSITIVE = ["Sim", "Parcialmente adaptada", "Totalmente adaptada"]
BINARY_NEGATIVE = [
    "Não", "-", "Sem adaptação", "Recusa", "Não informou", "Não sabe",
    "Não sabe informar", "Legislação não faz referencia ao tipo de bem tombado",
]

# table slug rules
TOPIC_CUT = 20
SLUG_PREFIX = "fato_topico_"
SLUG_MAX = 63
LOAD_STRING_CUT = 20

# a number found in a file name at or above this is not a year
YEAR_CEILING = 2050
# default insert batch of the relational sink
JDBC_BATCH = 2500

# Portuguese month abbreviations of monthly series labels
MONTHS_PT = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
# ---------------------------------------------------------------------------

FACT_SCHEMA = T.StructType([
    T.StructField(CITY_CODE_COL, T.LongType(), False),
    T.StructField(YEAR_COL, T.IntegerType(), False),
    T.StructField(DATA_ID_COL, T.StringType(), False),
    T.StructField(DTYPE_COL, T.StringType(), False),
    T.StructField(VALUE_COL, T.StringType(), False),
])

MUNICIPALITY_SCHEMA = T.StructType([
    T.StructField(CITY_CODE_COL, T.LongType(), False),
    T.StructField("nome_municipio", T.StringType(), True),
    T.StructField("sigla_uf", T.StringType(), True),
])

MUNICIPALITY_DIM_SCHEMA = T.StructType([
    T.StructField("municipio_id", T.IntegerType(), False),
    T.StructField(CITY_CODE_COL, T.LongType(), False),
])

INDICATOR_DIM_SCHEMA = T.StructType([
    T.StructField("dado_id", T.IntegerType(), False),
    T.StructField("nome_dado", T.StringType(), False),
    T.StructField("topico", T.StringType(), True),
    T.StructField("anos_serie_historica", T.ArrayType(T.IntegerType()), True),
])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("start", T.TimestampType(), True),
    T.StructField("finish", T.TimestampType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("info", T.StringType(), True),
    T.StructField("points", T.ArrayType(T.StructType([
        T.StructField("data_point", T.StringType()),
        T.StructField("years", T.ArrayType(T.IntegerType())),
        T.StructField("rows", T.LongType()),
    ]))),
])
