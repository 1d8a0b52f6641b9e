"""Plan shape guards: the properties the design relies on at scale."""

from helpers import SF_SMALL
from kinspark.operators.collab import collaborative_similarity
from kinspark.operators.rules import association_rules
from kinspark.plans.views import flat_basket, implicit


def _final_plan(df) -> str:
    df._jdf.queryExecution().toRdd().count()  # run the plan itself so AQE settles its final form
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_plan_shape(spark):
    plan = _final_plan(association_rules(flat_basket(spark, SF_SMALL)))
    # the member self-join is a sort-merge join over one reused exchange, never a broadcast
    assert "SortMergeJoin" in plan
    assert "REPARTITION_BY_COL" in plan and "ReusedExchange" in plan
    # no cartesian product anywhere
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # scans read the two basket columns only
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in line, line
    # partial aggregation happens before the pair shuffle
    assert "partial_count" in plan


def test_collab_plan_shape(spark):
    plan = _final_plan(collaborative_similarity(implicit(spark, SF_SMALL)))
    assert "SortMergeJoin" in plan and "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pair_table_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (association_rules(flat_basket(spark, SF_SMALL)), collaborative_similarity(implicit(spark, SF_SMALL))):
            plan = _final_plan(df).split("== Initial Plan ==")[0]
            above = plan[: plan.index("SortMergeJoin")]  # from the result down to the self-join
            assert above.count("Exchange hashpartitioning") == 1, above
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
