"""What plans must look like, whatever the data's size."""

import re

import pytest

from linecorpus.plans import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_filters_and_columns_reach_the_scan(spark, data):
    p = plan(catalog.queries()["flt01_labeled_target"](spark, data))
    assert "EqualNullSafe(status,labeled)" in p and "EqualNullSafe(predicted_lang,Cherokee)" in p
    assert sorted(re.search(r"ReadSchema: struct<([^>]*)>", p).group(1).split(",")) == ["ord:bigint", "predicted_lang:string", "status:string"]


@pytest.mark.parametrize("name", ["str06_script_class", "str05_class_counts", "flt04_error_purge", "str27_or_else", "geo09_padded_boxes", "split10_variations"])
def test_row_wise_queries_do_not_shuffle_or_leave_the_jvm(spark, data, name):
    p = plan(catalog.queries()[name](spark, data))
    assert "Exchange" not in p and "Python" not in p


@pytest.mark.parametrize("name", sorted(n for n in catalog.queries() if n not in ("join09_rule_grid", "agg14_best_grid_point", "join10_parameter_grid")))
def test_no_cartesian_products(spark, data, name):
    p = plan(catalog.queries()[name](spark, data))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_keyed_union_combines_before_the_shuffle(spark, data):
    p = plan(catalog.queries()["set02_last_wins"](spark, data))
    assert p.count("Aggregate(") >= 2 or p.count("Aggregate") >= 2
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
