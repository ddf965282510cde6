"""Physical-plan guards: pruning reaches the scan, narrow operators stay
shuffle-free, and the size-checked broadcast is used for small sides."""

from conftest import SF_MID
from turnstile.plans import catalog as K


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_narrow_operators_prune_and_do_not_shuffle(spark):
    for name in ("epoch_to_date", "clean", "sentinels_to_null", "one_hot_label",
                 "train_test_split"):
        plan = _plan(K.QUERIES[name](spark, SF_MID))
        assert "Exchange" not in plan, name
    plan = _plan(K.q_epoch_to_date(spark, SF_MID))
    assert "o_orderkey" in plan and "o_orderdate" in plan
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_split_plan_is_a_projection(spark):
    df = K.q_train_test_split(spark, SF_MID)
    plan = _plan(df)
    assert "Sort" not in plan and "Window" not in plan and "Exchange" not in plan


def test_mode_fill_broadcasts_the_small_side(spark):
    plan = _plan(K.q_fill_group_mode(spark, SF_MID))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_profile_is_one_aggregate_pass(spark):
    plan = _plan(K.q_missing_percent(spark, SF_MID))
    assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1
