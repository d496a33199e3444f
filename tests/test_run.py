"""The ETL run: request filter, load of each source, run log; a rerun loads nothing."""

import os

from tables import SF0001
from indicarium.plans.pipelines import HIGHER_EDUCATION_CODES, P4_LISTS, p4_higher_education
from indicarium.plans.run import SOURCES, indicator_dim, read_dimension, resolve_request, run_etl


def test_resolve_request():
    assert resolve_request([]) == (list(SOURCES), [])
    assert resolve_request(["Todos"]) == (list(SOURCES), [])
    assert resolve_request(["CAPAG", "pib municipal", "nope"]) == (["capag", "pib_municipal"], ["nope"])


def test_p4_from_landed_yearly_csv(spark, scratch):
    """P4 fed the way the source is: one ';' CSV (Latin-1) per census year in
    nested folders, year taken from the path; same facts as the registered query."""
    from pyspark.sql import functions as F
    from indicarium.plans import bindings as B
    from indicarium.plans.pipelines import bind_p4, p4_higher_education
    from indicarium.sources.readers import yearly_files_scan
    import __spark_entry__ as E
    raw = bind_p4(B.Tables(spark, SF0001))
    root = os.path.join(scratch, "censo_superior")
    for r in raw.select("ano").distinct().collect():
        y = r.ano
        (raw.filter(F.col("ano") == y).drop("ano").coalesce(1).write.option("sep", ";")
            .option("encoding", "ISO-8859-1").option("header", "true")
            .csv(os.path.join(root, str(y), f"microdados_{y}", "dados")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw.drop("ano").schema.fields)
    landed = yearly_files_scan(spark, root, schema, "part-*.csv", year_regex=r"censo_superior/(\d{4})/")
    got = sorted(tuple(r) for r in p4_higher_education(landed, P4_LISTS).collect())
    want = sorted(tuple(r) for r in E.queries()["p4"](spark, SF0001).collect())
    assert got == want and len(got) > 0


def test_run_then_rerun(spark, scratch):
    store = os.path.join(scratch, "fatos")
    log, unknown = run_etl(spark, SF0001, store, ["capag", "IDHM", "nope"])
    rows = {r.source: r for r in log.collect()}
    assert unknown == ["nope"] and set(rows) == {"capag", "idhm"}
    assert all(r.status == "ok" for r in rows.values())
    assert rows["capag"].points[0]["data_point"] == "Capacidade de pagamento dos municípios (CAPAG)" and rows["capag"].points[0]["rows"] > 0
    loaded = spark.read.parquet(store).count()
    assert loaded == sum(p["rows"] for r in rows.values() for p in r.points)
    again, _ = run_etl(spark, SF0001, store, ["capag", "idhm"])
    assert all(r.info == "linhas inseridas: 0" for r in again.collect())
    assert spark.read.parquet(store).count() == loaded
    dim = {r.nome_dado: r for r in read_dimension(spark, store + "-indicadores").collect()}
    assert sorted(r.dado_id for r in dim.values()) == [1, 2] and all(r.anos_serie_historica for r in dim.values())


def test_request_of_indicators(spark, scratch):
    store = os.path.join(scratch, "fatos")
    log, unknown = run_etl(spark, SF0001, store, {"PIB municipal": ["pib per capita", "nada"], "capag": []})
    points = {r.source: [p.data_point for p in r.points] for r in log.collect()}
    assert points["pib_municipal"] == ["PIB per capita"] and len(points["capag"]) == 1
    assert unknown == ["pib_municipal: nada"]


def test_indicator_names_that_differ_in_case(spark):
    facts = spark.createDataFrame([("Leitos SUS",), ("leitos sus",), ("Outro",)], "dado_identificador string")
    known = spark.createDataFrame([(5, "OUTRO", "t", [2000])], "dado_id int, nome_dado string, topico string, anos_serie_historica array<int>")
    assert sorted((r.dado_id, r.nome_dado) for r in indicator_dim(facts, "t", known).collect()) == [(5, "OUTRO"), (6, "Leitos SUS")]


def test_higher_education_on_census_codes(spark):
    """Text codes as the census files have them; a city without a counted course, or without any number, is there with 0."""
    raw = spark.createDataFrame([("1.0", "1", "2", "4", "1", "30", "1100015", 2019), ("1", "1", "2", "6", "1", "50", "1100015", 2019),
                                 ("3", "2", "5", "7", "2", "10", "1100023", 2019), ("1", "1", "1", "1", "1", None, "1100031", 2019)],
                                "TP_GRAU_ACADEMICO string, TP_NIVEL_ACADEMICO string, TP_ORGANIZACAO_ACADEMICA string, TP_CATEGORIA_ADMINISTRATIVA string, TP_MODALIDADE_ENSINO string, QT_VG_TOTAL string, CO_MUNICIPIO string, ano int")
    got = p4_higher_education(raw, HIGHER_EDUCATION_CODES).collect()
    assert sorted((r.codigo_municipio, r.valor) for r in got) == [(1100015, 30), (1100023, 0), (1100031, 0)]
