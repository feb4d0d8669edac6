"""Plans keep what makes them scale: pushed filters, pruned columns, partial aggregates, no cross joins, no Python where none is needed."""

import re

import pytest

import __spark_entry__ as entry
from longtide.operators import series
from longtide.operators.snapshots import observation_changes
from longtide.session import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf):
    p = plan(table(spark, sf, "series").filter(series.grain("series_id", "lantern_so")).select("series_id"))
    assert "StringStartsWith" in p and "ReadSchema: struct<series_id:string>" in p
    p = plan(series.date_window(table(spark, sf, "facts"), "2010-01-01", "2011-01-01").select("value"))
    assert "GreaterThanOrEqual(obs_date" in p and re.search(r"ReadSchema: struct<obs_date:date,value:double>", p)


def test_snapshots_take_two_exchanges_and_combine_first(spark, sf):
    p = plan(observation_changes(table(spark, sf, "obs_snapshots")))
    assert p.count("Exchange hashpartitioning") == 2 and "partial_max_by" in p and "Python" not in p and "SortAggregate" not in p


PYTHON = {"p1_found", "p1_values", "source_zip", "source_xlsx", "source_tar", "source_merged_heads", "store_footers", "store_connector"}
SMALL_CROSS = {"split_cardinality", "rotation", "flow_selection", "daily_ring", "source_jsonstat"}  # with one row, or the sixty cells of a cube


@pytest.mark.parametrize("name", [n for m in entry.MODULES if not m.__name__.startswith("longtide.llm") for n in m.QUERIES])
def test_no_cross_joins_nor_python(spark, sf, name):
    p = plan(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in p
    assert ("BroadcastNestedLoopJoin" not in p) or name in SMALL_CROSS
    assert not re.search(r"MapInPandas|MapInArrow|PythonUDF|ArrowEvalPython|BatchEvalPython", p) or name in PYTHON


def test_a_parent_that_is_not_broadcast_is_salted(spark, sf):
    p = plan(entry.queries()["p4_salted"](spark, sf))
    assert "__salt" in p and "sent" not in "".join(x for x in p.split("\n") if "BroadcastExchange" in x)


def test_composite_references_plan_every_mask(spark, sf):
    p = plan(entry.queries()["p4_pairs"](spark, sf))
    assert p.count("LeftAnti") == 5  # both columns under each semantics, and each column alone under partial match
