"""Scale guard on every registered query's physical plan: no cartesian or
nested-loop join (no pairs within a group) and no exchange that funnels
all rows into one partition (unpartitioned window or sort)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from tables import SF0001

FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|Exchange SinglePartition")


def physical_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_has_no_pairing_or_funnel(spark, name):
    plan = physical_plan(E.queries()[name](spark, SF0001))
    assert not FORBIDDEN.findall(plan), FORBIDDEN.findall(plan)


def plan_without_small_tables(spark, name: str) -> str:
    """The plan where Spark broadcasts nothing of its own accord: what is broadcast then is a literal frame."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return physical_plan(E.queries()[name](spark, SF0001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


CATALOGUE_KEY = r"(?:ano#\d+, )?(?:codigo|variavel_id|indicador|agregado)#"


@pytest.mark.parametrize("name", ["f8_catalogue_join", "p1_catalogue", "p9", "p9_catalogue", "p12", "p12_text", "p12_catalogue", "p15", "p15_snis_catalogue", "p15_rais_catalogue"])
def test_facts_are_not_shuffled_by_the_catalogue_key(spark, name):
    plan = plan_without_small_tables(spark, name)
    assert re.search(rf"BroadcastHashJoin \[{CATALOGUE_KEY}", plan)
    assert not re.search(rf"SortMergeJoin \[{CATALOGUE_KEY}", plan)
    assert not re.search(r"Exchange hashpartitioning\((?:codigo|variavel_id|indicador)#\w+, \d+\)", plan)


@pytest.mark.parametrize("name, scans", [("c4_harmonise", 1), ("c4_munic_editions", 1), ("j1_union_years", 2), ("p3", 2)])
def test_scans_do_not_grow_with_editions(spark, name, scans):
    assert physical_plan(E.queries()[name](spark, SF0001)).count("FileScan") == scans


def test_a_bucketed_dimension_is_not_shuffled(spark):
    plan = plan_without_small_tables(spark, "a10_catalog_dimension")
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning(codigo_municipio#" in plan and "Exchange hashpartitioning(__nat#" not in plan
