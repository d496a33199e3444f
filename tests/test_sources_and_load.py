"""Readers on small landed files, the idempotent load and its stream form."""

import json
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicarium.sources import readers as A
from indicarium.sources import sinks as B
from indicarium.plans.load import load_incremental, run_audit
from indicarium.streaming.incremental import LANDED_FACT_SCHEMA, stream_incremental_load


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_preamble_tolerant_scan(spark, scratch):
    p = os.path.join(scratch, "datasus.csv")
    write(p, "Nascidos vivos\nPeriodo: 2019\nMunicípio;Valor\n100001 VILA ALTA;0,5\nTotal;9\n"
             "100002 PORTO;...\nFonte: x\n", encoding="latin-1")
    schema = T.StructType([T.StructField("Município", T.StringType()), T.StructField("Valor", T.StringType())])
    df = A.preamble_tolerant_scan(spark, p, schema, header_value="Município")
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("100001 VILA ALTA", "0,5"), ("100002 PORTO", "..."), ("Total", "9")]
    # the DATASUS chain on top: only the city with a value survives
    from indicarium.plans.pipelines import p1_datasus
    munis = spark.createDataFrame([(1000011, "Vila Alta", "AA")], "codigo_municipio long, nome_municipio string, sigla_uf string")
    facts = p1_datasus(df.withColumn("ano", F.lit(2019)), munis).collect()
    assert [(r.codigo_municipio, r.ano, r.valor) for r in facts] == [(1000011, 2019, 0.5)]


def test_malformed_and_quoted_scans(spark, scratch):
    p = os.path.join(scratch, "rais.csv")
    write(p, "Município;Total\n100001;12\n100002;13;extra;cols\n100003;x\n", encoding="latin-1")
    df = A.malformed_skipping_scan(spark, p, "`Município` string, Total int")
    assert sorted(tuple(r) for r in df.collect()) == [("100001", 12)]
    q = os.path.join(scratch, "snis.csv")
    write(q, 'Código;IN001 - Volume\n100001;"1.210,5"\n', encoding="latin-1")
    df = A.quoted_clean_scan(spark, q, T.StructType([T.StructField("Código", T.StringType()), T.StructField("IN001 - Volume", T.StringType())]))
    assert [tuple(r) for r in df.collect()] == [("100001", "1.210,5")]


def test_api_and_flat_json(spark, scratch):
    doc = [{"id": "123", "variavel": "Receita", "unidade": "Mil Reais", "resultados": [
        {"classificacoes": [{"id": "1", "nome": "c", "categoria": {"1": "a"}}],
         "series": [{"localidade": {"id": "1000011", "nome": "Vila Alta"}, "serie": {"2019": "2.5", "2020": "-"}}]},
        {"classificacoes": [{"id": "2", "nome": "c", "categoria": {"2": "b"}}],
         "series": [{"localidade": {"id": "1000011", "nome": "Vila Alta"}, "serie": {"2019": "1", "2020": "..."}}]}]}]
    p = os.path.join(scratch, "api", "v.json")
    write(p, json.dumps(doc))
    rows = A.read_api_json(spark, os.path.dirname(p))
    assert rows.count() == 4
    from indicarium.plans.apis import p12_aggregates
    cat = spark.createDataFrame([("123", "Receita municipal", "Financas")], "variavel_id string, nome string, topico string")
    facts = {(r.ano, r.tipo_dado): r.valor for r in p12_aggregates(rows, cat).collect()}
    # 2019: (2.5 + 1) * 1000; 2020: 0 + null -> null -> dropped
    assert facts == {(2019, "float"): 3500.0}
    # an answer without its unit fails the job (K4), as the source raised
    import pytest
    with pytest.raises(Exception):
        p12_aggregates(rows.withColumn("unidade", F.lit(None).cast("string")), cat).collect()
    f = os.path.join(scratch, "ipea", "x.json")
    write(f, json.dumps([{"id": "1", "periodo": "2019-01-01", "valor": "0", "cod": "1000011"},
                         {"id": "1", "periodo": "2020-01-01", "valor": "0.0", "cod": "1000011"}]))
    flat = A.read_flat_json(spark, os.path.dirname(f))
    assert flat.count() == 2


def test_catalogue_and_yearly_files(spark, scratch):
    c = os.path.join(scratch, "cat", "m.json")
    write(c, json.dumps({"Educação": {"IDEB": {"tipo": "float"}, "Vagas": {"tipo": "int"}}, "Saúde": {"Leitos": {"tipo": "int"}}}))
    cat = A.read_catalogue(spark, os.path.dirname(c))
    assert sorted((r.topico, r.nome_dado) for r in cat.collect()) == [("Educação", "IDEB"), ("Educação", "Vagas"), ("Saúde", "Leitos")]
    root = os.path.join(scratch, "censo")
    write(os.path.join(root, "2019", "MICRODADOS_CURSOS_2019.csv"), "CO_MUNICIPIO;QT\n1000011;3\n")
    write(os.path.join(root, "2020", "dados", "MICRODADOS_CURSOS_2020.csv"), "CO_MUNICIPIO;QT\n1000011;4\n")
    write(os.path.join(root, "2020", "leia-me.txt"), "x")
    write(os.path.join(root, "2020", "LOOKUP_ESCOLAS.csv"), "CO_MUNICIPIO;QT\n9;9\n")
    year_rx = r"censo/(\d{4})/"      # the year folder (the scratch path may hold other digits)
    df = A.yearly_files_scan(spark, root, "CO_MUNICIPIO long, QT int", "*CURSOS*.csv", year_regex=year_rx)
    assert sorted(tuple(r) for r in df.collect()) == [(1000011, 3, 2019), (1000011, 4, 2020)]
    facts, lookup = A.side_file_split(spark, root, "CO_MUNICIPIO long, QT int", "*CURSOS*.csv",
                                      "CO_MUNICIPIO long, QT int", "LOOKUP*.csv", year_regex=year_rx)
    assert lookup.count() == 1 and facts.count() == 2


def _facts(spark, years, value="1"):
    rows = [(1000011, y, "Leitos", "int", value) for y in years] + [(1000029, y, "Leitos", "int", value) for y in years]
    return spark.createDataFrame(rows, "codigo_municipio long, ano int, dado_identificador string, tipo_dado string, valor string")


def _dims(spark):
    ind = spark.createDataFrame([(7, "leitos", "Saúde", [2018])],
                                "dado_id int, nome_dado string, topico string, anos_serie_historica array<int>")
    mun = spark.createDataFrame([(1, 1000011), (2, 1000029)], "municipio_id int, codigo_municipio long")
    return ind, mun


def test_incremental_load_is_idempotent(spark, scratch):
    ind, mun = _dims(spark)
    store = os.path.join(scratch, "fatos")
    first = load_incremental(_facts(spark, [2018, 2019, 2020]), ind, mun, store)
    assert first["rows"] == 4                       # 2018 is already in the dimension
    again = load_incremental(_facts(spark, [2018, 2019, 2020]), ind, mun, store)
    assert again["rows"] == 0
    assert spark.read.parquet(store).count() == 4
    dim = first["indicator_dim"].first()
    assert dim.anos_serie_historica == [2018, 2019, 2020]
    more = load_incremental(_facts(spark, [2021]), ind, mun, store)
    assert more["rows"] == 2 and spark.read.parquet(store).count() == 6


def test_stream_load_takes_each_file_once(spark, scratch):
    ind, mun = _dims(spark)
    landing, store = os.path.join(scratch, "landing"), os.path.join(scratch, "fatos")
    ckpt = os.path.join(scratch, "ckpt")
    _facts(spark, [2019]).write.parquet(os.path.join(landing, "a"))
    os.rename(os.path.join(landing, "a"), os.path.join(landing, "lote1"))
    got = stream_incremental_load(spark, os.path.join(landing, "*"), store, ind, mun, checkpoint=ckpt)
    assert got["rows"] == 2
    got = stream_incremental_load(spark, os.path.join(landing, "*"), store, ind, mun, checkpoint=ckpt)
    assert got["rows"] == 0                         # nothing new landed
    assert spark.read.parquet(store).count() == 2
    # a backlog of several files is taken in bounded batches
    for y in (2020, 2021, 2022):
        _facts(spark, [y]).coalesce(1).write.parquet(os.path.join(landing, f"lote{y}"))
    got = stream_incremental_load(spark, os.path.join(landing, "*"), store, ind, mun, checkpoint=ckpt,
                                  max_files_per_batch=1)
    assert got["rows"] == 6 and got["batches"] == 3
    assert spark.read.parquet(store).count() == 8


def test_one_pair_over_several_files(spark, scratch):
    """The store is the same however files are dealt out over micro-batches."""
    ind, mun = _dims(spark)
    for cap in (1, 2, 1000):
        landing, store = os.path.join(scratch, f"landing{cap}"), os.path.join(scratch, f"fatos{cap}")
        for i, code in enumerate((1000011, 1000029, 1000011)):
            spark.createDataFrame([(code, 2019, "Leitos", "int", str(i))], LANDED_FACT_SCHEMA).coalesce(1).write.parquet(
                os.path.join(landing, f"lote{i}"))
        got = stream_incremental_load(spark, os.path.join(landing, "*"), store, ind, mun, checkpoint=os.path.join(scratch, f"c{cap}"),
                                      max_files_per_batch=cap)
        assert got["rows"] == 3
        assert sorted(r.valor for r in spark.read.parquet(store).collect()) == ["0", "1", "2"]


def test_an_unreadable_store_is_an_error(spark, scratch):
    ind, mun = _dims(spark)
    store = os.path.join(scratch, "fatos")
    write(os.path.join(store, "dado_id=7", "ano=2019", "part-0.parquet"), "no parquet")
    with pytest.raises(Exception):
        load_incremental(_facts(spark, [2019]), ind, mun, store)


def test_scans_by_header(spark, scratch):
    root = os.path.join(scratch, "c")
    write(os.path.join(root, "2019", "a.csv"), "CO;QT\n1;3\n")
    write(os.path.join(root, "2020", "a.csv"), "QT;CO\n4;2\n")
    with pytest.raises(Exception):
        A.yearly_files_scan(spark, root, "CO long, QT int", "*.csv").collect()
    p = os.path.join(scratch, "m.csv")
    write(p, "1;2\nx;2\n3;4;5\n6;y\n")
    df = A.malformed_skipping_scan(spark, p, "a long, b long", header=False)
    assert df.count() == len(df.collect()) == df.select("a").count() == df.select("b").count() == 1
    q = os.path.join(scratch, "bad.json")
    write(q, "[1]")
    with pytest.raises(Exception):
        A.read_catalogue(spark, q).collect()


def test_run_audit_and_text(spark):
    src = spark.createDataFrame([("datasus", "Leitos", 2019), ("datasus", "Leitos", 2020), ("capag", "CAPAG", 2021)],
                                "source string, data_point string, year int")
    import datetime as dt
    log = run_audit(src, "r1", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11))
    rows = {r.source: r for r in log.collect()}
    assert rows["datasus"].points[0]["years"] == [2019, 2020] and rows["datasus"].points[0]["rows"] == 2
    text = {r.source: r.texto for r in B.run_log_text(log).collect()}
    assert "anos [2019, 2020], linhas 2" in text["datasus"]
    assert "inicio: 2024-01-01 10:00:00" in text["capag"]


def test_materialize_and_yearly_editions(spark):
    from indicarium.session import checkpoint_dir, materialize
    from indicarium.plans.bindings import yearly_editions
    df = spark.range(100).select((F.col("id") % 7).alias("k"), (1995 + F.col("id") % 3).cast("int").alias("ano"))
    m = materialize(df)
    assert sorted(map(tuple, m.collect())) == sorted(map(tuple, df.collect()))
    root = checkpoint_dir(spark).replace("file:", "")
    assert any(root in f.replace("file:", "") for f in m.inputFiles())
    days = spark.sql("SELECT id, date_add(DATE'1995-12-30', CAST(id * 100 AS INT)) AS d FROM range(10) UNION ALL SELECT 99, NULL")
    eds = yearly_editions(days, "d")
    assert sorted(eds) == [1995, 1996, 1997, 1998] and sum(e.count() for e in eds.values()) == 10


def test_dimension_readers_and_small_sinks(spark, scratch):
    p = os.path.join(scratch, "municipios.csv")
    write(p, "codigo_municipio,nome_municipio,sigla_uf\n1000011,Vila Alta,AA\n1000029,Porto São,AA\n")
    m = A.read_municipalities(spark, p)
    assert sorted(r.codigo_municipio for r in A.city_codes(m).collect()) == [1000011, 1000029]
    assert {r.chave: r.valor for r in A.name_code_map(m).collect()} == {"Vila Alta": 1000011, "Porto São": 1000029}
    assert {r.chave: r.valor for r in A.name_code_map(m, inverse=True).collect()}[1000029] == "Porto São"
    dim_path = os.path.join(scratch, "dim")
    m.write.parquet(dim_path)
    assert A.read_dimension(spark, path=dim_path).count() == 2
    out = os.path.join(scratch, "export")
    B.export_csv(m, out, sep=";")
    back = spark.read.option("header", "true").option("sep", ";").csv(out)
    assert back.count() == 2 and back.columns == m.columns
    ind = spark.createDataFrame([(7, "Leitos SUS", "Saúde", [2010, 2012])],
                                "dado_id int, nome_dado string, topico string, anos_serie_historica array<int>")
    new = spark.createDataFrame([("leitossus", [2012, 2011])], "nome_dado string, anos array<int>")
    assert B.update_indicator_years(ind, new).first().anos_serie_historica == [2010, 2011, 2012]
    assert B.preview(m, 1).count() == 1


def _files_opened(df):
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        if "Scan" in p.nodeName():
            found.append(p.metrics().apply("numFiles").value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    walk(plan)
    return sum(found)


def test_a_year_opens_its_files_only(spark, scratch):
    for y in (2018, 2019, 2020):
        write(os.path.join(scratch, "censo", str(y), "dados", "a.csv"), f"CO;QT\n1;{y}\n")
    df = A.yearly_files_scan(spark, os.path.join(scratch, "censo"), "CO long, QT int", "*.csv", year_regex=r"censo/(\d{4})/")
    assert _files_opened(df) == 3
    one = df.where("ano = 2019")
    assert [r.QT for r in one.collect()] == [2019] and _files_opened(df.where("ano = 2019")) == 1


def test_answers_by_line(spark, scratch):
    """One answer file of many variables becomes lines that several tasks read; other shapes fail, whatever is missing is null for K4."""
    serie = lambda c, y, v: {"localidade": {"id": str(c), "nome": "x"}, "serie": {str(y): v}}
    result = lambda i: {"classificacoes": [{"id": "1", "nome": "n", "categoria": {"0": "Total"}}], "series": [serie(1000000 + i, 2019, str(i)), serie(1000000 + i, 2020, "-")]}
    docs = [{"id": str(i), "variavel": f"v{i}", "unidade": "Pessoas", "resultados": [result(i)] if i % 2 else result(i)} for i in range(300)]
    docs.append({"id": "sem", "resultados": [result(1)]})
    write(os.path.join(scratch, "in", "a.json"), json.dumps(docs, indent=1))
    A.frame_answers(spark, os.path.join(scratch, "in"), os.path.join(scratch, "lines"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = A.read_api_lines(spark, os.path.join(scratch, "lines"))
        assert df.rdd.getNumPartitions() > 3
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 602 and {(r.variavel_id, r.codigo_municipio, r.ano, r.raw) for r in rows} >= {("7", 1000007, 2019, "7"), ("8", 1000008, 2020, "-")}
    assert [r.unidade for r in rows if r.variavel_id == "sem"] == [None, None]
    write(os.path.join(scratch, "odd", "a"), '{"id": "1", "resultados": "nada"}')
    with pytest.raises(Exception, match="another shape"):
        A.read_api_lines(spark, os.path.join(scratch, "odd")).collect()


def test_answer_lines_are_parsed_once(spark, scratch):
    """No filter below the parsing repeats it for each line; a file without answers, an answer without results and one without series give no rows."""
    result = {"classificacoes": [], "series": [{"localidade": {"id": "1000001", "nome": "x"}, "serie": {"2019": "5", "2020": None}}]}
    docs = [{"id": "1", "resultados": [result, result]}, {"id": "2"}, {"id": "3", "resultados": {**result, "series": []}}]
    write(os.path.join(scratch, "in", "a.json"), json.dumps(docs))
    write(os.path.join(scratch, "in", "b.json"), "[]")
    A.frame_answers(spark, os.path.join(scratch, "in"), os.path.join(scratch, "lines"))
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(os.path.join(scratch, "lines")).collect()) == ["1", "2", "3"]
    df = A.read_api_lines(spark, os.path.join(scratch, "lines"))
    assert sorted((r.variavel_id, r.resultado, r.ano, r.raw) for r in df.collect()) == [("1", 0, 2019, "5"), ("1", 0, 2020, None), ("1", 1, 2019, "5"), ("1", 1, 2020, None)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and plan.count("try_variant_get(doc") == 3


def test_survey_catalogue(spark, scratch):
    write(os.path.join(scratch, "i.json"), '{"Tem plano?": {"categoria": "Gestão", "tipo": "bool"}, "Qual?": {"categoria": "Gestão", "tipo": "str"}}')
    write(os.path.join(scratch, "c.json"), '{"2018": {"Tem plano?": "M1", "Qual?": "M2"}, "2020": {"Tem plano?": "X9"}}')
    got = A.read_survey_catalogue(spark, os.path.join(scratch, "i.json"), os.path.join(scratch, "c.json"))
    assert sorted(map(tuple, got.collect())) == [(2018, "M1", "Tem plano?", "Gestão", "bool"), (2018, "M2", "Qual?", "Gestão", "str"), (2020, "X9", "Tem plano?", "Gestão", "bool")]
    write(os.path.join(scratch, "d.json"), '{"2018": {"Outra?": "M3"}}')
    with pytest.raises(Exception, match="no information"):
        A.read_survey_catalogue(spark, os.path.join(scratch, "i.json"), os.path.join(scratch, "d.json")).collect()


def test_store_written_by_others_is_refused(spark, scratch):
    ind, mun = _dims(spark)
    store = os.path.join(scratch, "fatos")
    _facts(spark, [2019]).write.parquet(os.path.join(store, "dado_id=7"))
    with pytest.raises(ValueError, match="no load wrote"):
        load_incremental(_facts(spark, [2019]), ind, mun, store)

