"""What the physical plans must and must not contain."""

import ast
import importlib
import pkgutil
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import gleanwork
from gleanwork.operators import upsert
from gleanwork.plans.queries import QUERIES
from gleanwork.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"
STORING = {"append_startups", "append_products", "append_entity_mappings", "store_papers", "lookup_by_url", "run_summary",
           "read_records", "export_csv", "stream_dedup_urls", "stream_dedup_exact", "stream_fresh_only", "stream_upsert", "stream_freshness_summary", "read_pages", "read_lookups"}


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORING))
def test_no_query_multiplies_rows_or_gathers_them(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" not in plan and "BatchEvalPython" not in plan


def test_scans_read_only_what_is_used(spark):
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan_of(spark, "normalize_url")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan_of(spark, "canonicalize_ref")
    assert plan_of(spark, "dedup_urls_drop").count("html") == 0


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").where("o_totalprice > 100000")
    numbered = upsert.assign_ids(orders.select((F.col("o_orderkey") * 7).alias("seq")))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)]" in plan


def test_ids_reach_every_order(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    ids = sorted(r.id for r in QUERIES["assign_ids"](spark, SF).collect())
    assert ids == list(range(1001, 1001 + orders))


def test_aggregations_combine_before_the_shuffle(spark):
    plan = plan_of(spark, "upsert_papers")
    assert plan.count("partial_max(") > 0 and plan.count("partial_min(") > 0
    assert "partial_min" in plan_of(spark, "dedup_urls")


@pytest.mark.parametrize("name", ["upsert_papers", "upsert_jobs", "upsert_news", "fetch_outcome"])
def test_folds_sort_nothing(spark, name):
    assert "SortAggregate" not in plan_of(spark, name)


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_module_defines_a_name_twice():
    """A second definition silently takes the place of the first for every caller."""
    for found in pkgutil.walk_packages(gleanwork.__path__, "gleanwork."):
        file = Path(importlib.util.find_spec(found.name).origin)
        tree = ast.parse(file.read_text())
        defined = Counter(x.name for x in tree.body if isinstance(x, (ast.FunctionDef, ast.ClassDef)))
        assert max(defined.values(), default=1) == 1, (found.name, defined.most_common(1))
