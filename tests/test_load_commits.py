"""The load as one step: killed at each of its steps, late rows, stable ids, two runs at once."""

import os

import pytest
from pyspark.sql import functions as F

from indicarium.plans import load as L
from indicarium.plans import run as R
from indicarium.sources import versions as V
from indicarium.streaming.incremental import LANDED_FACT_SCHEMA

MUN = [(i, 1000000 + i) for i in range(1, 9)]


@pytest.fixture()
def dims(spark):
    ind = spark.createDataFrame([(7, "Leitos", "t", None), (8, "Vagas", "t", [2018])], "dado_id int, nome_dado string, topico string, anos_serie_historica array<int>")
    return ind, spark.createDataFrame(MUN, "municipio_id int, codigo_municipio long")


def facts(spark, cities, years, name="Leitos", value="1"):
    return spark.createDataFrame([(1000000 + c, y, name, "int", value) for c in cities for y in years], LANDED_FACT_SCHEMA)


def rows(spark, store, version=None):
    df = L.read_store(spark, store, version)
    return None if df is None else sorted(map(tuple, df.collect()), key=repr)


class Killed(BaseException):
    pass


STEPS = ["_write_counted", "_write_late", "V.drop_partitions", "V.commit"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_killed_between_steps(spark, scratch, dims, monkeypatch, step, after):
    store, control = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    second = facts(spark, [1, 2, 3], [2019, 2020], value="2")
    for s in (store, control):
        L.load_incremental(facts(spark, [1, 2], [2018, 2019]), *dims, s)
    L.load_incremental(second, *dims, control)
    before = rows(spark, store)
    owner, name = (V, step[2:]) if step.startswith("V.") else (L, step)
    real = getattr(owner, name)

    def dies(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(owner, name, dies)
        with pytest.raises(Killed):
            L.load_incremental(second, *dims, store)
    done = after and step == "V.commit"
    assert rows(spark, store) == (rows(spark, control) if done else before)
    again = L.load_incremental(second, *dims, store)
    assert rows(spark, store) == rows(spark, control) and again["rows"] == (0 if done else 4)
    assert rows(spark, store, version=1) == before
    gone = V.remove_unfinished(spark, store)
    assert rows(spark, store) == rows(spark, control) and V.remove_unfinished(spark, store) == []
    assert done or step == "_write_counted" and not after or gone


def test_late_rows_are_merged_and_counted(spark, scratch, dims):
    store = os.path.join(scratch, "fatos")
    load = lambda *a, **k: {n: v for n, v in L.load_incremental(facts(spark, *a, **k), *dims, store).items() if n in ("rows", "late", "present", "unmatched", "version")}
    assert load([1, 2], [2019]) == {"rows": 2, "late": 0, "present": 0, "unmatched": 0, "version": 1}
    assert load([2, 3], [2019, 2020]) == {"rows": 3, "late": 1, "present": 1, "unmatched": 0, "version": 2}
    assert load([2, 3], [2019, 2020], value="9") == {"rows": 0, "late": 0, "present": 4, "unmatched": 0, "version": 2}
    # a city that is not in the dimension: loaded once, without an id
    assert load([50], [2021]) == {"rows": 1, "late": 0, "present": 0, "unmatched": 1, "version": 3}
    assert load([50], [2021]) == {"rows": 0, "late": 0, "present": 1, "unmatched": 1, "version": 3}
    assert rows(spark, store) == sorted([(7, 1, 2019, "int", "1"), (7, 2, 2019, "int", "1"), (7, 3, 2019, "int", "1"), (7, 2, 2020, "int", "1"), (7, 3, 2020, "int", "1"), (7, None, 2021, "int", "1")], key=repr)
    # a year that the dimension lists and the store lacks was loaded elsewhere
    assert load([1], [2018, 2019], name="Vagas")["rows"] == 1
    assert load([], [])["rows"] == 0


def test_years_come_from_the_commits(spark, scratch, dims):
    store = os.path.join(scratch, "fatos")
    L.load_incremental(facts(spark, [1], [2020, 2019]), *dims, store)
    out = L.load_incremental(facts(spark, [1, 2], [2020, 2021], name="VAGAS "), *dims, store)
    assert {r.dado_id: r.anos_serie_historica for r in out["indicator_dim"].collect()} == {7: [2019, 2020], 8: [2018, 2020, 2021]}
    assert L.stored_years(V.committed(spark, store)) == {7: [2019, 2020], 8: [2020, 2021]}


def test_the_loser_of_two_loads_starts_over(spark, scratch, dims, monkeypatch):
    store = os.path.join(scratch, "fatos")
    real, runs = V.commit, []

    def beaten(*args, **kwargs):
        if not runs:
            runs.append(1)
            L.load_incremental(facts(spark, [1, 2], [2019], value="other"), *dims, store)
        return real(*args, **kwargs)

    monkeypatch.setattr(V, "commit", beaten)
    out = L.load_incremental(facts(spark, [2, 3], [2019]), *dims, store)
    assert (out["rows"], out["late"], out["present"], out["version"]) == (1, 1, 1, 2)
    assert rows(spark, store) == [(7, 1, 2019, "int", "other"), (7, 2, 2019, "int", "other"), (7, 3, 2019, "int", "1")]


def test_a_version_is_made_once(spark, scratch):
    root = os.path.join(scratch, "v")
    assert V.committed(spark, root) == [] and V.remove_unfinished(spark, root) == []
    assert V.commit(spark, root, 1, ["a"], rows=3) and not V.commit(spark, root, 1, ["b"])
    assert V.committed(spark, root) == [{"version": 1, "loads": ["a"], "rows": 3}]


def test_columns_are_checked(spark, scratch, dims):
    with pytest.raises(Exception, match="columns"):
        L.load_incremental(facts(spark, [1], [2019]).withColumn("extra", F.lit(1)), *dims, os.path.join(scratch, "s"))


def test_two_runs_deal_different_ids(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "dim")
    R.register_indicators(spark, path, ["B", "a"], "t")
    real, runs = V.commit, []

    def beaten(*args, **kwargs):
        if not runs:
            runs.append(1)
            R.register_indicators(spark, path, ["Y", "both"], "other")
        return real(*args, **kwargs)

    monkeypatch.setattr(V, "commit", beaten)
    R.register_indicators(spark, path, ["X", "BOTH"], "t")
    got = {r.nome_dado: r.dado_id for r in R.read_dimension(spark, path).collect()}
    assert got == {"B": 1, "a": 2, "Y": 3, "both": 4, "X": 5}


def test_ids_of_a_dead_run_stay(spark, scratch):
    """X's run dies before its facts; Y gets another id; X's own comes back whatever its case."""
    path = os.path.join(scratch, "dim")
    R.register_indicators(spark, path, ["X"], "t")
    R.register_indicators(spark, path, ["Y"], "t")
    assert {r.nome_dado: r.dado_id for r in R.register_indicators(spark, path, ["x "], "t").collect()} == {"X": 1, "Y": 2}


def test_ids_over_many_ranges(spark):
    df = spark.createDataFrame([(f"n{i:05d}",) for i in range(3000)], "nome string").repartition(7)
    got = sorted((r.nome, r.id) for r in R.deal_ids(df, "nome", 11, "id").collect())
    assert [i for _, i in got] == list(range(11, 3011))


def test_a_failed_source_ends_the_process_with_1(spark, scratch, monkeypatch, capsys):
    from tables import SF0001

    args = ["--sf", SF0001, "--store", os.path.join(scratch, "s"), "--log", os.path.join(scratch, "log"), "--request", "capag"]
    monkeypatch.setitem(R.SOURCES, "capag", "no_such_query")
    assert R.main(args) == 1 and "status: erro" in capsys.readouterr().out
    assert [r.status for r in spark.read.parquet(os.path.join(scratch, "log")).collect()] == ["erro"]


def test_rows_without_a_year_fail_the_load(spark, scratch, dims):
    store = os.path.join(scratch, "fatos")
    with pytest.raises(Exception, match="without a year"):
        L.load_incremental(facts(spark, [1], [2019, None]), *dims, store)
    assert rows(spark, store) is None
    assert L.load_incremental(facts(spark, [1], [2019]), *dims, store)["rows"] == 1
    # a load that adds nothing leaves nothing
    V.remove_unfinished(spark, store)
    assert L.load_incremental(facts(spark, [1], [2019]), *dims, store)["present"] == 1 and V.remove_unfinished(spark, store) == []


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_keys_are_merged_not_hashed(spark, scratch, dims, monkeypatch):
    """The store's keys grow with the facts: no task holds a table of them, however small their files look."""
    store, plans, real = os.path.join(scratch, "s"), [], L._write_counted
    monkeypatch.setattr(L, "_write_counted", lambda df, *a: (plans.append(plan_of(df)), real(df, *a))[1])
    L.load_incremental(facts(spark, [1, 2], [2019]), *dims, store)
    out = L.load_incremental(facts(spark, [2, 3], [2019]), *dims, store)
    assert (out["rows"], out["late"], out["present"]) == (1, 1, 1) and len(plans) == 3
    assert "SortMergeJoin" in plans[-1] and "HashJoin" not in plans[-1]


def test_indicators_do_not_deal_the_facts(spark, scratch, dims, monkeypatch):
    """A handful of indicators is broadcast also where Spark would not do it of its own accord; facts aren't shuffled by their names."""
    store, plans, real = os.path.join(scratch, "s"), [], L._write_counted
    monkeypatch.setattr(L, "_write_counted", lambda df, *a: (plans.append(plan_of(df)), real(df, *a))[1])
    ind = dims[0].groupBy("dado_id", "nome_dado", "topico").agg(F.first("anos_serie_historica").alias("anos_serie_historica"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.load_incremental(facts(spark, [1, 2], [2019]), ind, dims[1], store)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert out["rows"] == 2 and "hashpartitioning(__nk" not in plans[0] and "BroadcastHashJoin [__nk_l" in plans[0]
