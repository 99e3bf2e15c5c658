"""Properties over the whole test tables."""

from pyspark.sql import functions as F

from haulmark.catalog import costs as Q
from haulmark.catalog.rates import repriced
from haulmark.operators import costs as C
from haulmark.operators import rates as R
from haulmark.plans import jobs as J


def shuffled(t):
    """The same tables in another order and partitioning."""
    return {n: t[n].withColumn("_r", F.xxhash64(*t[n].columns)).repartition(5, "_r").sortWithinPartitions(F.desc("_r")).drop("_r") for n in t}


def test_shares_add_up_to_the_invoice(bed):
    shares = Q.allocated(bed).groupBy("bl_billing_id").agg(F.sum("freight_paid_po").alias("paid"), F.count("*").alias("n"))
    gap = shares.join(bed["bl_billing"], "bl_billing_id").filter("paid IS NOT NULL AND abs(paid - invoice_amount) > n * 0.000001")
    # bills listed twice for the same order are the exception the DISTINCT makes
    twice = bed["bl_bill_pos"].groupBy("bl_billing_id", "lo_purchase_order_id").count().filter("count > 1").select("bl_billing_id")
    assert gap.join(twice, "bl_billing_id", "left_anti").count() == 0


def test_pallets_never_exceed_the_cap(bed):
    assert C.fpa_pallets(bed["lo_purchase_orders"], "1990-01-01", "2010-01-01").agg(F.max("max_26pallets_final_calc")).first()[0] <= 26


def test_weekly_metrics_do_not_depend_on_row_order(bed):
    one = J.weekly_vendor_metrics(bed, "2001-12-31")
    two = J.weekly_vendor_metrics(shuffled(bed), "2001-12-31")
    assert one.count() > 0 and one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_repricing_keeps_one_row_per_key_and_any_order(bed):
    one = repriced(bed)
    assert one.count() == one.select("fp_freight_form_vendor_id").distinct().count()
    assert one.exceptAll(repriced(shuffled(bed))).count() == 0


def test_both_weekly_jobs_agree_where_their_filters_do(bed):
    both = dict(bed) | {"fp_default_config": bed["fp_default_config"].withColumn("margin_loss_report_months_back", F.col("supplier_screen_months_back"))}
    both["lo_purchase_orders"] = bed["lo_purchase_orders"].filter("order_type_id IS NULL OR order_type_id <> 1")
    same = ["tms_vendor_id", "total_revenue", "total_freight", "total_allowance", "total_expense", "po_count"]
    assert J.weekly_vendor_metrics(both, "2001-12-31").select(same).exceptAll(J.weekly_margin_loss(both, "2001-12-31").select(same)).count() == 0


def test_quick_set_leaves_other_values(bed):
    rows = R.quick_set(bed["fp_freight_form_vendor"], [1, 2, 3], method_id=5)
    assert {r[0] for r in rows.select("fp_ff_method_id").distinct().collect()} == {5}
    assert rows.filter(~F.col("fp_freight_form_id").isin(1, 2, 3)).count() == 0
