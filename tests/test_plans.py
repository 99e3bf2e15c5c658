"""What the physical plans must not contain, and what they must."""

import pytest

from haulmark.catalog import load_all
from tests.conftest import SF_DIR

QUERIES, _ = load_all()
MAIN = [
    "allocate_invoices", "not_fully_billed", "backhaul_expense", "unbilled_expense", "weekly_vendor_metrics", "weekly_margin_loss",
    "supplier_billing_report", "supplier_performance", "supplier_scorecard", "supplier_expense_by_mode", "budget_variance", "reprice",
    "blended_rates", "pricing_out", "allowance_list", "vendor_warehouse_list", "form_summary", "validate_forms", "backhaul_requests",
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", MAIN)
def test_no_cross_join_no_key_window_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window ", "ArrowEvalPython", "BatchEvalPython"):
        assert node not in plan, node


def test_date_window_and_columns_reach_the_scan(spark, bed):
    from pyspark.sql import functions as F

    from haulmark.functions.predicates import in_dates

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    orders = bed["lo_purchase_orders"].filter(in_dates("rec_date", "1996-01-01", "1996-12-31"))
    plan = plan_of(orders.select("lo_purchase_order_id", F.col("total_weight")))
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in plan
    assert "LessThan(l_shipdate,1997-01-01" in plan
    assert "l_extendedprice" not in plan and "l_returnflag" not in plan


def test_no_hint_forces_a_broadcast():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "haulmark"
    for file in root.rglob("*.py"):
        if (root / "llm") in file.parents:
            continue
        text = file.read_text()
        assert "broadcast(" not in text and ".crossJoin(" not in text and "localCheckpoint" not in text, file


def test_all_form_rules_take_two_shuffles(spark, bed, tmp_path):
    """Over stored tables: every rule takes one by pickup location and one by form; the roles of the users take three more. Lookups are broadcast."""
    import datetime as dt

    from haulmark.plans import workflow as W

    names = (
        "fp_freight_form", "fp_ff_pickup_locations", "fp_freight_form_vendor", "fp_ff_approval_status", "tms_whs", "tms_vendor",
        "sec_users", "sec_user_roles", "sec_roles", "fp_escalation_roles", "submissions",
    )
    for name in names:
        bed[name].write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in names}
    day = dt.date(2002, 1, 1)
    assert plan_of(W.form_facts(stored, stored["submissions"], day)).count("Exchange hashpartitioning") == 2
    assert plan_of(W.validate_forms(stored, stored["submissions"], day)).count("Exchange hashpartitioning") <= 5


def exchanges(spark, make) -> int:
    """Shuffles by keys in a plan without broadcasts; one that is used again counts once."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    kept = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = plan_of(make())
        return sum("Exchange hashpartitioning" in line and "ReusedExchange" not in line for line in plan.splitlines())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_an_allocation_shuffles_lines_by_order_and_by_bill_only(spark):
    assert exchanges(spark, lambda: QUERIES["allocate_invoices"](spark, SF_DIR)) <= 7


def test_a_performance_report_cuts_its_tables_to_kept_orders(spark, bed):
    from haulmark.plans import reports as R

    for make in (R.supplier_performance, R.supplier_scorecard):
        plan = plan_of(make(bed, "1997-03-01", "1997-03-28", remit="ALL"))
        assert "InMemoryTableScan" in plan and plan.count("units_original") > 0


def test_kept_rows_are_not_met_by_a_later_run(spark, tmp_path):
    from haulmark.plans import reports as R

    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    one = R.kept(spark.read.parquet(path))
    again = R.kept(spark.read.parquet(path))
    assert one.count() == 3 and one.columns == ["id"]
    assert not one._jdf.queryExecution().analyzed().sameResult(again._jdf.queryExecution().analyzed())


def test_weekly_jobs_meet_lines_links_and_orders_in_few_shuffles(spark):
    for name in ("weekly_vendor_metrics", "weekly_margin_loss"):
        assert exchanges(spark, lambda: QUERIES[name](spark, SF_DIR)) <= 32, name


def test_days_of_vendors_read_their_days_from_a_small_table(spark, bed):
    from pyspark.sql import functions as F

    from haulmark.plans import daily

    days = daily.whole_months(bed["lo_purchase_orders"].select(F.to_date("rec_date").alias(daily.DAY)))
    assert exchanges(spark, lambda: daily.vendor_days(bed, days)) <= 30


def test_wide_orders_of_the_mode_report_meet_their_loads_once(spark, bed):
    """The report's order rows go by order only; what a load says comes with its links."""
    from haulmark.plans import reports as R

    assert exchanges(spark, lambda: R.supplier_expense_by_mode(bed, "1992-01-01", "1999-12-31")) <= 60


def test_the_billing_report_meets_links_and_lines_in_few_shuffles(spark, bed):
    from haulmark.plans import reports as R

    assert exchanges(spark, lambda: R.supplier_billing_report(bed, "1992-01-01", "1999-12-31")) <= 45


def test_rows_that_seldom_repeat_meet_after_a_shuffle_only(spark, bed):
    """No map-side table of nearly all rows in the few tasks that read the forms: the shuffle lies below both steps of the grouping."""
    from haulmark.plans import feeds, reports, workflow

    for df in (
        reports.roll_date_report(bed, "2001-01-01", "2003-12-31"), feeds.pricing_dataset(bed), workflow.backhaul_requests(bed),
    ):
        above, below = plan_of(df).split("REPARTITION_BY_COL", 1)
        keyed = "HashAggregate(keys=[fp_freight_form_id", "HashAggregate(keys=[pickup_day"
        assert above.count("Exchange ") == 1 and "HashAggregate" in above and not any(k in below for k in keyed)


def test_facts_by_month_are_stored_with_zstandard(bed, tmp_path):
    from haulmark.sources import facts

    facts.store_by_month(bed["lo_purchase_orders"], str(tmp_path / "o"), "rec_date")
    assert all(".zstd." in f.name for f in (tmp_path / "o").rglob("*.parquet"))


def test_an_allocation_of_a_narrow_window_gives_the_same_shares_from_cut_lines(spark, bed):
    from haulmark.operators import costs as C

    t = (bed["lo_purchase_orders"], bed["bl_bill_pos"], bed["bl_billing"])
    few = C.received_rows(t[0], "1996-03-01", "1996-03-28").select("lo_purchase_order_id")
    whole, cut = (C.allocate_invoices(*t, None, None, received=few, narrow=n) for n in (False, True))
    assert whole.count() == cut.count() > 0 and whole.exceptAll(cut).isEmpty()
    assert "LeftSemi" in plan_of(cut) and "LeftSemi" not in plan_of(whole)
