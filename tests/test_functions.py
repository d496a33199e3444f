"""Expression rules pinned on the small cases of FIXTURES.md section 4."""

import unicodedata

from pyspark.sql import functions as F

from indicarium.functions import numbers as N
from indicarium.functions import predicates as P
from indicarium.functions import text as X


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_thousands_and_br_number(spark):
    assert one(spark, N.strip_thousands("v"), "401.192") == "401192"
    assert one(spark, N.parse_br_number("v"), "1.210,5") == 1210.5
    assert one(spark, N.decimal_comma("v"), "0,5") == 0.5
    assert one(spark, N.dash_zero_int("v"), "-") == 0
    assert one(spark, N.dash_zero_int("v"), "8") == 8


def test_unit_inference_and_scale(spark):
    u = one(spark, N.unit_inference("v"), "Mil Reais")
    assert (u["multiplicador"], u["tipo_dado"], u["inferido"]) == (1000, "float", True)
    u = one(spark, N.unit_inference("v"), "Domicílios")
    assert (u["multiplicador"], u["tipo_dado"], u["inferido"]) == (1, "str", False)
    # 'mil' also matches inside 'milhões' (kept on purpose)
    assert one(spark, N.unit_inference("v"), "Milhões de pessoas")["multiplicador"] == 1000
    df = spark.createDataFrame([("2.5", 1000, "float"), ("3", 100, "int"), ("x", 1, "str")], "r string, m int, t string")
    got = [r[0] for r in df.select(N.scale_by_unit("r", "m", "t")).collect()]
    assert got == [2500.0, 300, None]


def test_special_codes(spark):
    df = spark.createDataFrame([("-",), ("..",), ("...",), ("X",), ("12",)], "v string")
    got = [tuple(r) for r in df.select(N.special_code("v").alias("s")).select("s.valor", "s.tipo_dado").collect()]
    assert got == [(0, "int"), (None, "NULL"), (None, "NULL"), (None, "NULL"), (None, None)]


def test_raw_zero_and_binary_map(spark):
    df = spark.createDataFrame([("0",), ("0.0",), ("1",)], "v string")
    assert [r.v for r in df.filter(P.not_raw_zero("v")).collect()] == ["0.0", "1"]
    df = spark.createDataFrame([("Sim",), ("Recusa",), ("zzz",), ("Totalmente adaptada",)], "v string")
    assert [r[0] for r in df.select(N.binary_answer("v")).collect()] == [1, 0, None, 1]


def test_slug_and_name_state(spark):
    assert one(spark, X.topic_slug("v"), "Água e Esgoto") == "fato_topico_agua_e_esgoto"
    # the topic is cut to 20 characters before the slug
    assert one(spark, X.topic_slug("v"), "Finanças Públicas - Receitas") == "fato_topico_financas_publicas___"
    name, uf = X.split_name_state("v")
    df = spark.createDataFrame([("Vila Alta (AA)",)], "v string")
    r = df.select(name.alias("n"), uf.alias("u")).first()
    assert (r.n, r.u) == ("Vila Alta ", "AA")


def test_years_in_text(spark):
    assert one(spark, X.year_from_text("v"), "capag-2022-v12345.csv") == 2022
    assert one(spark, X.year_from_text("v"), "base_2002_2009_xls.zip") == 2009
    assert one(spark, X.year_from_text("v"), "serie_2055.csv") is None
    assert one(spark, X.year_from_text("v"), "sem-ano.csv") is None
    df = spark.createDataFrame([("corrigido-2023.csv", 2023), ("capag-2021.csv", 2021)], "n string, y int")
    assert [r[0] for r in df.select(X.corrected_release_year("n", "y")).collect()] == [2022, 2021]


def test_digits_tokens_and_totals(spark):
    assert one(spark, X.digits_only("v"), "100001 VILA ALTA") == "100001"
    df = spark.createDataFrame([("100001 VILA ALTA",), ("Total",), ("MUNICIPIO IGNORADO - AA",)], "v string")
    assert [r.v for r in df.filter(P.not_total_row("v")).collect()] == ["100001 VILA ALTA"]
    df = spark.createDataFrame([("...",), ("n.d.",), ("-",), ("Não Disponível",), ("",), ("7",)], "v string")
    assert [r[0] for r in df.select(P.null_token("v")).collect()] == [None] * 5 + ["7"]
    assert one(spark, P.all_digits("v", 6).cast("int"), "12345") == 0
    assert one(spark, P.all_digits("v", 6).cast("int"), "123456") == 1


def test_printable_clean_and_code_header(spark):
    assert one(spark, X.printable_clean("v"), '  "IN001 -\tVolume"\n ') == "IN001 -Volume"
    assert one(spark, X.printable_clean("v"), "a\u0007b​c") == "abc"
    assert one(spark, X.code_from_header("v"), "IN001 - Volume") == "IN001"
    assert one(spark, X.name_with_code(F.lit("Pergunta"), "v"), "MTIP01") == "Pergunta - MTIP01"


def test_ascii_fold_matches_python(spark):
    samples = ["Água é ﬁm ½ ß Œuvre", "São João…", "𝐀𝐁𝐂 ｆｕｌｌ", "naïve café", "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r[0] for r in df.select(X.ascii_fold("v")).collect()]
    want = [unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii") for s in samples]
    assert got == want


def test_ascii_fold_random_unicode(spark):
    from hypothesis import given, settings, strategies as st
    texts = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40)

    batch = []

    @settings(max_examples=300, database=None)
    @given(texts)
    def collect(t):
        batch.append(t)

    collect()
    df = spark.createDataFrame([(t,) for t in batch], "v string")
    got = [r[0] for r in df.select(X.ascii_fold("v")).collect()]
    want = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii") for t in batch]
    assert got == want


def test_typing_dates_and_log_text(spark):
    df = spark.createDataFrame([("12", "int"), ("1.5", "float"), ("true", "bool"), ("abc", "str"), ("x", "int")],
                               "v string, t string")
    assert [r[0] for r in df.select(N.cast_by_tag("v", "t")).collect()] == ["12", "1.5", "true", "abc", None]
    df = spark.createDataFrame([("2019-01-01",), ("2020",), (None,)], "v string")
    assert [r[0] for r in df.select(N.year_from_iso("v")).collect()] == [2019, 2020, None]
    df = spark.createDataFrame([([2018, 2019],)], "v array<int>")
    assert df.select(X.years_text("v")).first()[0] == "2018, 2019"
    ts = spark.sql("SELECT TIMESTAMP_NTZ'2024-05-06 07:08:09' AS t")
    assert ts.select(X.log_timestamp("t")).first()[0] == "2024-05-06 07:08:09"
    df = spark.createDataFrame([("corrigido.csv", None)], "n string, y int")
    assert df.select(X.corrected_release_year("n", "y")).first()[0] is None


def test_text_key(spark):
    assert one(spark, X.text_key("v"), "São  Paulo\x01") == "saopaulo"
    assert one(spark, X.name_key("v"), "Vila Alta ") == "vilaalta"


def test_month_label_and_state_network(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1997-12-05 00:00:00' AS ts")
    lab = df.select(X.month_label_pt("ts").alias("l")).first().l
    assert lab == "dez/1997"
    df = spark.createDataFrame([("DF", "Pública"), ("DF", "Municipal"), ("SP", "Municipal"), ("SP", "Pública")],
                               "uf string, rede string")
    kept = [tuple(r) for r in df.filter(P.state_network("uf", "rede")).collect()]
    assert kept == [("DF", "Pública"), ("SP", "Municipal")]
