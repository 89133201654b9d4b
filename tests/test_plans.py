"""Plan shape: the scale properties the design relies on."""

import re

from conftest import SF_SMALL
from wattlake.operators import dedup
from wattlake.plans.common import contracts_history, mart


def _plan(df) -> str:
    """The physical plan once, without AQE's repeated initial-plan section."""
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_latest_per_key_combines_before_the_shuffle(spark):
    rows = [(1 if i % 3 == 0 else i, i % 7, i) for i in range(3000)]  # key 1 holds a third
    df = spark.createDataFrame(rows, "k long, d long, v long")
    plan = _plan(dedup.latest_per_key(df, ["k"], ["d", "v"]))
    first_exchange = plan.rfind("Exchange")
    partial = plan.find("partial_max_by", first_exchange)
    assert first_exchange >= 0 and partial > first_exchange  # partial agg below the exchange


def test_mart_contract_side_shuffles_twice(spark):
    plan = _plan(mart(spark, SF_SMALL))
    contract_exchanges = re.findall(r"Exchange hashpartitioning\(contract_id#\d+L?(, modificationdate#\d+)?, ",
                                    plan)
    assert len(contract_exchanges) == 2, plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # The price side passes its size check, so no contract-side shuffle join
    # (AQE alone left the range join as a sort-merge join once).
    assert "SortMergeJoin" not in plan


def test_history_close_keeps_distribution(spark):
    plan = _plan(contracts_history(spark, SF_SMALL))
    assert "Union" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
