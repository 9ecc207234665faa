"""Properties that the physical plans must keep."""

import pytest

from abonara.catalog import CASES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
             "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "GlobalLimit", "CollectLimit", "Sample ")
PLANNED = ["fixed_table", "mobile_table", "fmc_waterfall_labels", "transfer_flags", "merged_sales",
           "cohort_rollup", "driver_summary", "contact_summary", "dashboard_counts", "overall_kpis",
           "first_time_resolution_of_billing", "near_fmc_by_email", "claims_in_documents", "phone_matches",
           "repeat_callers", "voluntary_by_order", "accounts_with_order_near_contact"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_forbidden_operators(name, spark, folder):
    plan = plan_of(CASES[name].run(spark, folder))
    assert not [word for word in FORBIDDEN if word in plan]


def test_keep_one_shrinks_before_the_shuffle(spark, folder):
    plan = plan_of(CASES["one_row_per_account"].run(spark, folder))
    exchange = plan.index("Exchange hashpartitioning(account")
    assert "WindowGroupLimit" in plan[exchange:]


def test_columns_are_pruned_at_the_scan(spark, folder):
    plan = plan_of(CASES["rgu_flags"].run(spark, folder))
    scan = plan[plan.index("l_orderkey"):]
    assert "l_tax" not in scan and "l_shipdate" not in scan and "o_totalprice" not in scan


def test_filters_reach_the_scan(spark, folder):
    plan = plan_of(CASES["never_paid_flags"].run(spark, folder))
    assert "EqualTo(event_type,purchase)" in plan and "EqualTo(event_type,signup)" in plan


def test_fixed_table_reads_the_snapshot_once(spark, folder):
    plan = plan_of(CASES["fixed_table"].run(spark, folder))
    assert plan.count("FileScan") == 3


def test_line_items_are_hash_aggregated(spark, folder):
    from abonara.plans.fixtures import Inputs
    plan = plan_of(Inputs(spark, folder).order_lines)
    assert "HashAggregate(keys=[l_orderkey" in plan and "SortAggregate" not in plan


def test_fixed_table_sorts_the_days_of_an_account_once(spark, folder):
    """Pairing and looking back follow that order; sorting both sides of all rows took most memory."""
    plan = plan_of(CASES["fixed_table"].run(spark, folder))
    sorts = [line for line in plan.splitlines() if "Sort [" in line and "account" in line and "order_id" not in line]
    assert len(sorts) == 1 and "SortAggregate" not in plan


def test_converged_labels_leave_other_columns_behind(spark, folder):
    plan = plan_of(CASES["fmc_types"].run(spark, folder))
    assert "collect_list" not in plan and "b_plan#" not in plan and "FullOuter" in plan

def test_phone_chain_broadcasts_no_account_table(spark, tmp_path):
    """Saved tables look small in their files: equal values compress to nothing, in memory they do not."""
    from abonara.plans import tables as T
    moves = {f"fix_{c}": "string" for c in ("churn_flag", "churn_type", "movement")} | {"fix_rejoiner": "int", "fix_e_start": "date"}
    sides = {"active": "int", "tenure": "string", "mrc": "double", "rgus": "int"}
    more = {"mix": "string", "tech": "string", "bill_code": "string", "overdue": "int"}
    fixed = {"period": "date", "fixed_account": "string", "phone1": "string", "phone2": "string"} | moves | {
        f"fix_{s}_{c}": t for s in "be" for c, t in (sides | more).items()}
    mobile = {"period": "date", "mobile_account": "string", "mob_churn_flag": "string", "mob_churn_type": "string",
              "mob_movement": "string", "mob_rejoiner": "int"} | {f"mob_{s}_{c}": t for s in "be" for c, t in sides.items()}
    prepaid = {"phone": "string", "on_b": "int", "on_e": "int"}
    saved = []
    for name, columns in (("fixed", fixed), ("mobile", mobile), ("prepaid", prepaid)):
        spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items())).write.parquet(f"{tmp_path}/{name}")
        saved.append(spark.read.parquet(f"{tmp_path}/{name}"))
    plan = plan_of(T.phone_fmc_table(*saved))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
