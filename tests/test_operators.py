"""DataFrame operators on the invented fixtures of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from indicarium.operators import aggregates as G
from indicarium.operators import joins as J
from indicarium.operators import ordering as I
from indicarium.operators import reshape as H
from indicarium.operators import schema_ops as C
from indicarium.operators import sets as U
from indicarium.operators import validate as K

MUNIS = [(1000011, "Vila Alta", "AA"), (1000029, "Porto São", "AA"), (2000013, "Vila Alta", "BB"),
         (2000021, "Rio Par", "BB"), (2000039, "Rio Par", "BB")]


@pytest.fixture()
def munis(spark):
    return spark.createDataFrame(MUNIS, "codigo_municipio long, nome_municipio string, sigla_uf string")


def test_code_upgrade(spark, munis):
    df = spark.createDataFrame([(100001,), (1000029,), (999999,)], "c long")
    got = sorted((r.c is None, r.c) for r in J.upgrade_city_code(df, "c", munis).collect())
    assert got == [(False, 1000011), (False, 1000029), (True, None)]


def test_name_state_resolution_and_unique_lookup(spark, munis):
    req = spark.createDataFrame([("Vila Alta ", "AA"), ("Rio Par", "BB"), ("Nada", "AA")], "nome string, uf string")
    fan = J.resolve_by_name_state(req, "nome", "uf", munis)
    assert sorted(r.codigo_municipio for r in fan.collect()) == [1000011, 2000021, 2000039]
    accents = spark.createDataFrame([("Porto Sao", "AA")], "nome string, uf string")
    assert J.resolve_by_name_state(accents, "nome", "uf", munis).count() == 0
    assert [r.codigo_municipio for r in J.resolve_by_name_state(accents, "nome", "uf", munis, fold=True).collect()] == [1000029]
    from indicarium.functions.text import name_key
    one = J.unique_lookup(req, {"n": name_key("nome"), "u": F.col("uf")}, munis,
                          {"n": name_key("nome_municipio"), "u": F.col("sigla_uf")}, F.col("codigo_municipio"), "codigo")
    assert sorted((r.nome, r.codigo) for r in one.collect()) == [("Nada", -1), ("Rio Par", -1), ("Vila Alta ", 1000011)]


def test_zero_fill_keeps_every_key(spark):
    df = spark.createDataFrame([(1, 2020, "ok", 5.0), (1, 2020, "no", 7.0), (2, 2020, "no", 3.0)],
                               "c int, ano int, k string, q double")
    out = {(r.c, r.ano): r.valor for r in J.zero_fill_sum(df, ["c", "ano"], F.col("k") == "ok", "q").collect()}
    assert out == {(1, 2020): 5.0, (2, 2020): 0.0}


def test_fill_missing_year(spark):
    df = spark.createDataFrame([("s", 1, 2018), ("s", 2, None), ("s", 3, None), ("s", 4, 2021), ("t", 1, None)],
                               "src string, pos int, ano int")
    got = [(r.src, r.ano) for r in I.fill_missing_year(df, "ano", "pos", ["src"]).orderBy("src", "pos").collect()]
    assert got == [("s", 2018), ("s", 2019), ("s", 2019), ("s", 2021), ("t", None)]


def test_chunked_fill_equals_whole_window(spark):
    import random
    rnd = random.Random(7)
    rows = [(s, p, rnd.choice([None, None, 1990 + p % 30])) for s in range(3) for p in rnd.sample(range(3000), 300)]
    df = spark.createDataFrame(rows, "s int, p long, y int")
    whole = {(r.s, r.p): r.y for r in I.fill_missing_year(df, "y", "p", ["s"], chunk=None).collect()}
    for width in (5, 128, 10_000):
        got = {(r.s, r.p): r.y for r in I.fill_missing_year(df, "y", "p", ["s"], chunk=width).collect()}
        assert got == whole
    # very sparse positions, no partition, a null source
    sparse = df.withColumn("p", F.col("p") * 1_000_003 + F.col("s") * 7)
    whole_sparse = {(r.s, r.p): r.y for r in I.fill_missing_year(sparse, "y", "p", ["s"], chunk=None).collect()}
    got = {(r.s, r.p): r.y for r in I.fill_missing_year(sparse, "y", "p", ["s"], chunk=10_000_000).collect()}
    assert got == whole_sparse
    glob = {r.p: r.y for r in I.fill_missing_year(df.filter("s = 0"), "y", "p", chunk=10).collect()}
    assert glob == {p: v for (s, p), v in whole.items() if s == 0}
    null = df.filter("s = 0").withColumn("s", F.lit(None).cast("int"))
    got = {r.p: r.y for r in I.fill_missing_year(null, "y", "p", ["s"], chunk=5).collect()}
    assert got == glob


def test_year_arrays(spark):
    df = spark.createDataFrame([([2010, 2012], [2012, 2011])], "old array<int>, new array<int>")
    r = df.select(U.years_union("old", "new").alias("u"), U.years_new("new", "old").alias("n")).first()
    assert (r.u, r.n) == ([2010, 2011, 2012], [2011])


def test_bucket_sum_rules(spark):
    w = spark.createDataFrame([(1, "-", "3", "8")], "k int, `Menos de 500g` string, `500 a 999g` string, `2500 a 2999g` string")
    assert G.bucket_sum(w, "k", 2499, r"\d{3,4}").first().valor == 3
    p = spark.createDataFrame([(1, "1", "2", "3", "9")],
                              "k int, Nenhuma string, `De 1 a 3 consultas` string, `De 4 a 6 consultas` string, `7 ou mais consultas` string")
    assert G.bucket_sum(p, "k", 6, r"\d{1}", seed=["Nenhuma"]).first().valor == 6


def test_null_poison_sum_and_longest_series(spark):
    df = spark.createDataFrame([(1, 3), (1, 4), (2, 3), (2, None)], "k int, v int")
    assert {r.k: r.valor for r in G.null_poison_sum(df, ["k"], "v").collect()} == {1: 7, 2: None}
    s = spark.createDataFrame([("x", 1, 2018), ("x", 1, 2019), ("x", 2, 2019), ("x", 3, 2017), ("x", 3, 2020)],
                              "s string, codigo_municipio int, ano int")
    assert G.longest_series(s, ["s"]).first().anos == [2018, 2019]


def test_fanout_sum_equals_literal_join(spark):
    facts = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "name string, q double")
    lookup = spark.createDataFrame([("a", 10), ("a", 10), ("a", 20), ("b", 20)], "name string, city int")
    fast = {r.city: r.q for r in J.fanout_sum(facts, lookup, "name", "city", ["q"]).collect()}
    slow = {r.city: r.q for r in facts.join(lookup, "name").groupBy("city").agg(F.sum("q").alias("q")).collect()}
    assert fast == slow == {10: 6.0, 20: 8.0}


def test_unpivot_keeps_rows_times_columns(spark):
    df = spark.range(10).select(F.col("id").alias("c"), *[(F.col("id") * i).alias(str(2000 + i)) for i in range(5)])
    long = H.unpivot_years(df, ["c"])
    assert long.count() == 10 * 5
    assert dict(long.dtypes)["ano"] == "int"


def test_harmonise_and_shifted_header(spark):
    a = spark.createDataFrame([(1, "x")], "CODMUN int, RESP string")
    b = spark.createDataFrame([(2, "y", 0)], "cod_mun int, resposta string, EXTRA int")
    out = C.harmonise_editions({2019: a, 2020: b}, {2019: {"CODMUN": "c", "RESP": "r"}, 2020: {"cod_mun": "c", "resposta": "r"}},
                               {2020: ["EXTRA"]})
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 2019), (2, "y", 2020)]
    bad = spark.createDataFrame([("100001", "5", "junk")], "h0 string, Codigo string, Valor string")
    assert C.shifted_header_repair(bad).columns == ["Codigo", "Valor"]
    with pytest.raises(KeyError):
        C.resolve_by_fragment(spark.createDataFrame([(1, 2)], "`nota capag` int, `capag x` int"), "capag", "v")


def test_best_dataset_and_first_n(spark):
    df = spark.createDataFrame([("s", "base_2002_2009.zip", 0), ("s", "base_2010.zip", 1), ("s", "x_2005_2010.zip", 2)],
                               "src string, f string, pos int")
    from indicarium.functions.text import years_in_text
    best = I.best_dataset(df.withColumn("ys", years_in_text("f")), ["src"], "f", "ys", "pos").first()
    assert (best.arquivo, best.anos_serie, best.primeiro_ano, best.ultimo_ano) == ("base_2010.zip", 1, 2010, 2010)
    top = I.first_n(spark.range(10).withColumn("g", F.col("id") % 2), ["g"], [F.desc("id")], 2)
    assert sorted(r.id for r in top.collect()) == [6, 7, 8, 9]


def test_contract(spark):
    good = spark.createDataFrame([(1000011, 2020, "x", "int", "1")], "codigo_municipio long, ano int, dado_identificador string, tipo_dado string, valor string")
    K.assert_contract(good)
    assert K.enforce_contract(good).count() == 1
    bad = spark.createDataFrame([(123, 1970, "x", "decimal", None)], good.schema)
    rep = K.contract_report(bad).first()
    assert (rep.ano_invalido, rep.codigo_invalido, rep.tipo_invalido, rep.valor_nulo) == (1, 1, 1, 1)
    with pytest.raises(K.ContractError):
        K.assert_contract(bad)
    with pytest.raises(Exception):
        K.enforce_contract(bad).collect()


def test_request_filter(spark):
    df = spark.createDataFrame([("Datasus",), ("IBGE Munic",), ("capag",)], "src string")
    kept, unknown = J.request_filter(df, "src", ["ibge munic", "nope"])
    assert [r.src for r in kept.collect()] == ["IBGE Munic"]
    assert [r.name for r in unknown.collect()] == ["nope"]
    kept_all, _ = J.request_filter(df, "src", ["todos"])
    assert kept_all.count() == 3


def test_outer_merge_and_exactly_one(spark):
    a = spark.createDataFrame([(1, "a")], "k int, x string")
    b = spark.createDataFrame([(2, "b")], "k int, y string")
    assert sorted(r.k for r in J.outer_merge([a, b], "k").collect()) == [1, 2]
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    asked = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert sorted(tuple(r) for r in K.exactly_one(dup, ["k"], asked).collect()) == [(1, 2), (3, 0)]
    sheet = spark.createDataFrame([(1, "p"), (1, "q")], "k int, z string")
    assert sorted(tuple(r) for r in J.outer_merge([a, sheet], "k").collect()) == [(1, "a", "p"), (1, "a", "q")]
    with pytest.raises(Exception):
        J.outer_merge([a, sheet], "k", unique_keys=True).collect()
    assert sorted(tuple(r) for r in J.outer_merge([a, b], "k", unique_keys=True).collect()) == [(1, "a", None), (2, None, "b")]


def test_checks_and_long_buckets(spark):
    from indicarium.operators import filters as D
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert K.missing_fields(df, ["a", "b"]).first().campos_ausentes == 1
    K.require_columns(df, ["a", "b"])
    with pytest.raises(K.ContractError):
        K.require_columns(df, ["b", "a"])
    with pytest.raises(K.ContractError):
        K.require_rows(df.filter("a > 5"))
    assert D.schema_drift_guard(df, 2) and not D.schema_drift_guard(df, 3)
    long = spark.createDataFrame([(1, "Menos de 500g", 2), (1, "500 a 999g", 3), (1, "2500 a 2999g", 8)],
                                 "k int, faixa string, n int")
    assert G.bucket_sum_long(long, ["k"], "faixa", "n", 2499).first().valor == 5


def test_year_fill_on_sparse_orders(spark):
    """Positions in epoch milliseconds, a third of the rows in one source: ranges of some rows each, the same years."""
    import random
    rnd = random.Random(3)
    at = lambda: 1_500_000_000_000 + rnd.randrange(10**11)
    rows = [("hot", p, rnd.choice([None, None, None, 2000 + i % 20])) for i, p in enumerate(sorted(at() for _ in range(2000)))]
    rows += [(f"s{i % 40}", at(), rnd.choice([None, 2010])) for i in range(4000)]
    df = spark.createDataFrame(rows, "src string, pos long, ano int").distinct()
    whole = {(r.src, r.pos): r.ano for r in I.fill_missing_year(df, "ano", "pos", ["src"], chunk=None).collect()}
    assert {(r.src, r.pos): r.ano for r in I.fill_missing_year(df, "ano", "pos", ["src"], chunk=250).collect()} == whole
    sizes = [r["count"] for r in I.ranges_by_rank(df, ["src", "pos"], 250).groupBy("__range").count().collect()]
    assert sum(sizes) == len(whole) and len(sizes) > 20 and max(sizes) < 3 * 250


def test_editions_by_table(spark):
    """Names that differ in case are one column; a name of its own counts in the editions that don't rename or drop it."""
    df = spark.createDataFrame([(2019, "a", "n1", None, "x"), (2020, None, "n2", "b", "y"), (2021, "c", "n3", "d", "z")], "ano int, A1 string, Nome string, B2 string, EXTRA string")
    out = C.harmonise_by_table(df, "ano", [(2019, "a1", "Valor"), (2020, "B2", "Valor"), (2021, "a1", "Valor"), (2021, "B2", "nome")], ["nome", "EXTRA", "nada"], [(2020, "EXTRA"), (2021, "Nome")])
    assert out.columns == ["ano", "nome", "EXTRA", "nada", "Valor"]
    assert sorted(map(tuple, out.collect())) == [(2019, "n1", "x", None, "a"), (2020, "n2", None, None, "b"), (2021, "d", "z", None, "c")]


def test_a_guard_does_not_move(spark):
    """Rows that a filter or join takes out before the contract are no breach of it."""
    from indicarium.operators import validate as K
    cat = J.literal_frame(spark, [("a", "A")], "k string, dado_identificador string")
    df = spark.createDataFrame([("a", 1000011, 2000, "1"), ("a", 1000011, 2001, None), ("b", 5, 2000, "1")], "k string, codigo_municipio long, ano int, valor string")
    facts = J.catalogue_join(df, cat, ["k"]).withColumn("tipo_dado", F.lit("int")).dropna(subset=["valor"])
    assert [r.ano for r in K.enforce_contract(facts.drop("k")).collect()] == [2000]


def test_years_by_frequency_in_order(spark):
    df = spark.createDataFrame([(y,) for y in (2001, 2000, 2000, 2003, 2003, 2002)], "ano int")
    assert [tuple(r) for r in G.years_by_frequency(df).collect()] == [(2000, 2), (2003, 2), (2001, 1), (2002, 1)]
