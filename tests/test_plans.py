"""Plans of the registered queries at a size where nothing is small enough to broadcast."""

import re

import pytest

from catalog import QUERIES

SF = "/root/testdata/sf0.001"
# Single-task steps that only see counts: one row per partition, chunk or task.
OVER_COUNTS = {
    "order_batches", "batch_report", "throughput", "quarantined_rows", "phone_report",
    "name_report", "unique_email_report", "site_outcomes",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|MapInPandas", plan)
    assert "SinglePartition" not in plan or name in OVER_COUNTS
    assert plan.count("ArrowEvalPython") <= 1
    if name not in OVER_COUNTS:
        assert "BroadcastExchange" not in plan


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["dedup_phones"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string>" in plan
    plan = QUERIES["order_batches"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan
