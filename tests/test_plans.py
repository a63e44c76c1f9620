"""Physical-plan properties of catalogue queries (checked on the executed final plan)."""

from sparkdeck.plans import queries
from tools.plan_report import final_plan, summarize

from .conftest import SF_SMALL


def _final_plan(spark, name):
    qe = queries()[name](spark, SF_SMALL)._jdf.queryExecution()
    qe.toRdd().count()
    return final_plan(qe.executedPlan().toString())


def test_filters_and_pruning_reach_the_scan(spark):
    plan = _final_plan(spark, "verb_chain")
    assert "PushedFilters: [IsNotNull(l_shipdate), In(l_returnflag" in plan
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "l_partkey" not in read and "l_tax" not in read


def test_group_extremes_aggregate_then_join(spark):
    s = summarize(_final_plan(spark, "daily_best_worst"))
    assert s["window"] == 0 and s["bcast_join"] == 1 and s["hash_exch"] == 1


def test_no_nested_loop_join_on_row_data(spark):
    for name in ("network_regression", "join_natural", "interpolate", "clip_outliers", "log_gauss"):
        assert summarize(_final_plan(spark, name))["bnlj"] == 0, name
