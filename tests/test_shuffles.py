"""What goes through the shuffles of the freight reports and jobs, read from their plans."""

import re
from collections import Counter

from haulmark.operators import costs as C
from haulmark.plans import daily
from haulmark.plans import reports as R


def shuffled_by(df, key) -> list[str]:
    """The line below each shuffle by ``key``: the columns that go through it, where a projection stands there."""
    lines = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString()).splitlines()
    return [below for line, below in zip(lines, lines[1:]) if f"Exchange hashpartitioning({key}" in line]


def test_freight_per_order_needs_no_order_number(spark, bed):
    args = bed["lo_purchase_orders"], bed["bl_bill_pos"], bed["bl_billing"], "1990-01-01", "2005-12-31"
    whole, bare = C.allocate_invoices(*args), C.allocate_invoices(*args, numbered=False)
    assert set(whole.columns) - set(bare.columns) == {"po_number"}
    total = [Counter(map(tuple, C.po_freight(df).collect())) for df in (whole, bare)]
    assert total[0] == total[1] and total[0]


def test_an_allocation_shuffles_its_lines_by_bill_once(spark, bed):
    lines = C.allocate_invoices(bed["lo_purchase_orders"], bed["bl_bill_pos"], bed["bl_billing"], "1990-01-01", "2005-12-31")
    plan = re.sub(r"#\d+L?", "", lines._jdf.queryExecution().executedPlan().toString())
    assert len(set(re.findall(r"hashpartitioning\(bl_billing_id, _part, \d+\), REPARTITION_BY_COL", plan))) == 1


def test_days_are_shuffled_by_month_and_not_by_their_keys(spark, bed):
    days = daily.whole_months(C.received_rows(bed["lo_purchase_orders"], "1997-03-01", "1997-03-31").selectExpr("to_date(rec_date) AS receive_day"))
    states = daily.vendor_days(bed, days)
    assert shuffled_by(states, "receive_month") and not shuffled_by(states, "tms_vendor_id, source_system")


def test_touched_days_shuffle_lines_by_order_once(spark, bed):
    late = bed["bl_bill_pos"].filter("bl_billing_id % 3 = 0").select(C.PO).distinct()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        touched = daily.touched_days(bed, late)
        assert not [b for b in shuffled_by(touched, "bl_billing_id") if C.PO in b]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_names_of_vendors_stay_out_of_the_shuffles_of_orders(spark, bed):
    orders = R.supplier_expense_by_mode(bed, "1990-01-01", "2005-12-31")
    below = shuffled_by(orders, C.PO)
    assert below and not [b for b in below if "vendor_name" in b or "v_address1" in b or "load_destination" in b]
