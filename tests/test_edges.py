"""Hand-made rows: NULLs, zeros, boundaries, ties and hot keys."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from haulmark.functions import classify as cl
from haulmark.functions import numbers as N
from haulmark.functions import predicates as P
from haulmark.operators import costs as C
from haulmark.operators import history as H
from haulmark.operators import rates as R
from haulmark.operators import shared as S
from haulmark.plans import budget as B
from haulmark.plans import feeds
from haulmark.plans import jobs as J
from haulmark.plans import workflow as W
from haulmark.sources import readers, sinks

POS = "lo_purchase_order_id long, po_number string, total_weight decimal(18,3), rec_date timestamp_ntz, tms_status_id long, source_system string"
LINKS = "lo_purchase_order_id long, bl_billing_id long, lo_load_number long, is_deleted boolean"
BILLS = "bl_billing_id long, cr_carrier_id long, invoice_amount decimal(18,3)"
DAY = dt.datetime(2000, 5, 5, 10, 0)
OUT = dt.datetime(2001, 5, 5)


def by(df, key, *cols):
    return {r[key]: (r[cols[0]] if len(cols) == 1 else tuple(r[c] for c in cols)) for r in df.collect()}


def bill_rows(spark):
    pos = spark.createDataFrame(
        [
            (1, "A", D(30), DAY, 9, "UBS"), (2, "B", D(70), OUT, 9, "WBS"),  # shared bill, one order outside the window
            (3, "C", D(0), DAY, 9, "UBS"),  # bill without weight
            (4, "D", D(10), OUT, 9, "UBS"),  # bill with nothing in the window
            (5, "E", D(10), DAY, 8, "UBS"), (6, "F", D(40), DAY, 9, "UBS"),  # excluded order does not share
            (7, "G", D(10), DAY, 9, None),  # no source system
            (8, "H", D(10), DAY, 9, "UBS"),  # bill by a carrier that is never allocated
        ],
        POS,
    )
    links = spark.createDataFrame(
        [(1, 1, 1, None), (2, 1, 1, False), (3, 2, 2, None), (4, 3, 3, None), (5, 4, 4, None), (6, 4, 4, None), (7, 5, 5, None), (8, 6, 6, None), (8, 1, 1, True)],
        LINKS,
    )
    bills = spark.createDataFrame(
        [(1, 500, D(1000)), (2, 500, D(50)), (3, 500, D(50)), (4, 500, D(80)), (5, 500, D(9)), (6, 78, D(9))], BILLS
    )
    return pos, links, bills


def test_allocation_edges(spark):
    pos, links, bills = bill_rows(spark)
    got = by(C.allocate_invoices(pos, links, bills, "2000-05-01", "2000-05-31"), "lo_purchase_order_id", "freight_paid_po")
    assert got == {1: D("300.000000"), 2: D("700.000000"), 3: None, 6: D("80.000000")}


def test_allocation_filters_system_before_sharing(spark):
    pos, links, bills = bill_rows(spark)
    got = by(C.allocate_invoices(pos, links, bills, "2000-05-01", "2000-05-31", "ubs"), "lo_purchase_order_id", "freight_paid_po")
    assert got[1] == D("1000.000000") and 2 not in got


def test_allocation_per_system_opens_on_any_receipt(spark):
    pos = spark.createDataFrame(
        [(1, "A", D(10), OUT.replace(year=1999), 9, "UBS"), (2, "B", D(30), DAY, 9, None), (3, "C", D(5), OUT.replace(year=1999), 9, "WBS"), (4, "D", D(5), OUT.replace(year=1999), 9, "UBS")],
        POS,
    ).withColumn("window_start", F.when(F.col("source_system").isNotNull(), F.lit(dt.date(2000, 1, 1))))
    links = spark.createDataFrame([(1, 1, 1, None), (2, 1, 1, None), (3, 1, 1, None), (4, 2, 2, None)], LINKS)
    bills = spark.createDataFrame([(1, 500, D(90)), (2, 500, D(90))], BILLS)
    got = by(C.allocate_invoices_by_system(pos, links, bills, dt.date(2000, 12, 31)), "lo_purchase_order_id", "freight_paid_po")
    # the order without a system opens bill 1; each system shares the whole invoice; bill 2 stays shut
    assert got == {1: D("90.000000"), 3: D("90.000000")}


def test_allocation_holds_under_a_hot_bill_and_any_order(spark):
    n = 3000
    pos = spark.range(n).select(
        F.col("id").alias("lo_purchase_order_id"), F.concat(F.lit("P"), "id").alias("po_number"), F.lit(D(1)).cast("decimal(18,3)").alias("total_weight"),
        F.lit(str(DAY)).cast("timestamp_ntz").alias("rec_date"), F.lit(9).cast("long").alias("tms_status_id"), F.lit("UBS").alias("source_system"),
    )
    links = spark.range(n).select(
        F.col("id").alias("lo_purchase_order_id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("bl_billing_id"),
        F.col("id").alias("lo_load_number"), F.lit(None).cast("boolean").alias("is_deleted"),
    )
    bills = links.select("bl_billing_id").distinct().select("bl_billing_id", F.lit(500).cast("long").alias("cr_carrier_id"), F.lit(D(600)).cast("decimal(18,3)").alias("invoice_amount"))
    one = C.allocate_invoices(pos, links, bills, "2000-05-01", "2000-05-31")
    two = C.allocate_invoices(pos.repartition(7).orderBy(F.desc("po_number")), links.repartition(5), bills.repartition(3), "2000-05-01", "2000-05-31")
    assert one.exceptAll(two).count() == 0 and one.count() == n
    hot = one.filter("bl_billing_id = -1").agg(F.sum("freight_paid_po"), F.count("*")).first()
    assert hot[0] == D("600.000000") and hot[1] == n // 3


def test_billing_gap_edges(spark):
    pos = spark.createDataFrame([(i, f"P{i}", D(1), DAY, 9, "UBS") for i in range(1, 7)], POS)
    po_loads = spark.createDataFrame([(i, i * 10, None) for i in range(1, 7)], "lo_purchase_order_id long, lo_load_number long, is_deleted boolean")
    loads = spark.createDataFrame([(10, 500, 30), (20, 500, 30), (30, 500, 30), (40, 501, 30), (50, 500, 32), (60, 78, 30)], "lo_load_number long, cr_carrier_id long, tms_status_id long")
    carriers = spark.createDataFrame([(500, False), (501, None), (502, False), (78, False)], "cr_carrier_id long, shuttle_carrier boolean")
    links = spark.createDataFrame([(1, 1, 10, None), (2, 2, 20, None), (3, 3, 30, None)], LINKS)
    bills = spark.createDataFrame([(1, 500, D(5)), (2, 502, D(5)), (3, 500, D(0))], BILLS)
    got = C.not_fully_billed(pos, po_loads, loads, links, bills, carriers, "2000-05-05", "2000-05-05")
    # 1 is billed; 2 by another carrier; 3 with nothing; 4 has an unknown shuttle flag; 5 and 6 are excluded loads
    assert sorted(r[0] for r in got.select("lo_purchase_order_id").collect()) == [2, 3]


@pytest.mark.parametrize(
    "pallets, weight, cubes, expected",
    [
        (4, 1000, 99, 4), (4, 999, 99, 2), (4, 4800, 99, 4), (4, 4801, 99, 2), (4, 999, 100, 4), (1, 10, 100, 1),
        (0, 500, 60, 0), (30, 15000, 900, 26), (2.2, 100, 10, 1), (40, 10, 10, 1), (3, None, None, 3),
    ],
)
def test_pallet_boundaries(spark, pallets, weight, cubes, expected):
    row = spark.createDataFrame([(D(str(pallets)), None if weight is None else D(weight), None if cubes is None else D(cubes))], "p decimal(18,3), w decimal(18,3), c decimal(18,3)")
    assert row.select(cl.fpa_pallets_of(F.col("p"), F.col("w"), F.col("c"))).first()[0] == expected


def test_pallets_unknown_stay_unknown(spark):
    row = spark.createDataFrame([(None, D(1), D(1))], "p decimal(18,3), w decimal(18,3), c decimal(18,3)")
    assert row.select(cl.fpa_pallets_of(F.col("p"), F.col("w"), F.col("c"))).first()[0] is None


def test_backhaul_on_two_loads(spark):
    pos = spark.createDataFrame([(1, 5, DAY, "ubs ", D(3))], "lo_purchase_order_id long, dis_whs_id long, rec_date timestamp_ntz, source_system string, total_pallets decimal(18,3)")
    po_loads = spark.createDataFrame([(1, 20, None), (1, 10, None), (1, 30, True)], "lo_purchase_order_id long, lo_load_number long, is_deleted boolean")
    loads = spark.createDataFrame([(10, 78, None, 6), (20, 78, None, 5), (30, 78, None, 5)], "lo_load_number long, cr_carrier_id long, source_whs_id long, destination_whs_id long")
    calendar = spark.createDataFrame([(2000, dt.date(2000, 5, 1), dt.date(2000, 5, 7))], "fiscal_year int, week_start date, week_end date")
    rates = spark.createDataFrame([(2000, "UBS", D(20), D(7))], "fiscal_year int, source_system string, backhaul_rate decimal(10,3), cross_dock_rate decimal(10,3)")
    for pick, cost in (("sum", D("81.000")), ("one", D("21.000"))):
        got = C.backhaul_expense(pos, po_loads, loads, calendar, rates, F.ceil("total_pallets"), pick=pick).first()
        assert (got["backhaul_expense_po"], got["backhaul_loads"]) == (cost, 2)


def test_on_time_boundaries(spark):
    at = dt.datetime(2000, 5, 5, 0, 0, 59)
    rows = [
        (1, at, dt.datetime(2000, 5, 5, 0, 30)), (2, at, dt.datetime(2000, 5, 5, 0, 31)), (3, at, dt.datetime(2000, 5, 4)), (4, at, None),
    ]
    df = spark.createDataFrame(rows, "id int, a timestamp_ntz, b timestamp_ntz")
    got = by(df.select("id", cl.appointment_status(F.col("a"), F.col("b")).alias("s"), cl.landed_status(F.col("a"), F.col("b")).alias("l"), P.minutes_between(F.col("a"), F.col("b")).alias("m")), "id", "s", "l", "m")
    assert got[1] == ("ON TIME", "ON TIME", 30) and got[2] == ("LATE", "ON TIME", 31)
    assert got[3][0] == "ON TIME" and got[4] == ("LATE", "ON TIME", None)


def test_order_log_skips_text_that_is_no_date(spark):
    log = spark.createDataFrame(
        [(1, "A", D(5), D(1), "soon", "2000-01-01", "OPN"), (2, "A", D(6), D(1), "2000-01-01", "2000-01-02", "OPN"), (3, "A", D(0), D(1), "2000-01-01", "2000-01-02", "OPN"),
         (4, "A", D(8), D(1), "2000-01-01", "2000-01-02", "OPN"), (5, "A", D(9), D(1), "2000-01-01", "2000-01-02", "DEL")],
        "purchaseorderlogid long, po_number string, total_units decimal(18,3), total_weight decimal(18,3), request_date string, expect_date string, status string",
    )
    row = H.first_last_order_log(log).first()
    assert (row["total_units_original"], row["total_units_ordered"]) == (D("6.000"), D("8.000"))


def test_lookback_uses_default_and_drops_unknown_systems(spark):
    pos = spark.createDataFrame([(1, "UBS"), (2, "XYZ"), (3, None)], "lo_purchase_order_id long, source_system string")
    config = spark.createDataFrame([("ubs", 3), ("DEFAULT", 6)], "source_system string, months int")
    got = by(J.lookback_window(pos, config, "months", "2000-08-31"), "lo_purchase_order_id", "months_back", "window_start")
    assert got == {1: (3, dt.date(2000, 5, 31)), 2: (6, dt.date(2000, 2, 29))}


def test_calendar_gap_and_window(spark):
    weeks = [(1999, 1, w, dt.date(1999, 1, 3) + dt.timedelta(7 * (w - 1)), dt.date(1999, 1, 9) + dt.timedelta(7 * (w - 1))) for w in (1, 2, 3, 4)]
    weeks += [(2000, 1, w, s + dt.timedelta(364), e + dt.timedelta(364)) for _, _, w, s, e in weeks]
    calendar = spark.createDataFrame(weeks, "fiscal_year int, period int, week int, week_start date, week_end date")
    row = B.fiscal_window(calendar, 2000, 1, dt.date(2000, 1, 12)).first()
    assert (row["start_date"], row["end_date"], row["total_weeks"], row["weeks_to_forecast"]) == (dt.date(2000, 1, 2), dt.date(2000, 1, 8), 4, 3)
    assert B.fiscal_window(calendar, 2000, 1, dt.date(2000, 3, 1)).first()["weeks_to_forecast"] == 0
    dates = spark.createDataFrame([(dt.date(2000, 1, 2),), (dt.date(1999, 2, 28),), (None,)], "d date")
    got = [r["week"] for r in S.fiscal_period_of(dates, "d", calendar, ("week",)).orderBy("d").collect()]
    assert got == [None, None, 1]


def test_budget_first_row_counts_once_with_copies(spark, bed):
    """A second live agreement doubles a load's rows but not its pounds."""
    window = B.fiscal_window(bed["fiscal_calendar"], 1998, 7, dt.date(1998, 12, 31))
    once = B.budget_po_facts(bed, window)
    twice = B.budget_po_facts({**{n: bed[n] for n in bed}, "cr_agreement": bed["cr_agreement"].unionByName(bed["cr_agreement"])}, window)
    sums = [F.sum("collect_lbs"), F.sum(F.col("is_first").cast("int"))]
    assert once.agg(*sums).first() == twice.agg(*sums).first()
    assert twice.count() > once.count()


def test_blend_membership(spark):
    forms = spark.createDataFrame([(1,), (2,)], "fp_freight_form_id long")
    whs = spark.createDataFrame([(1, "WBS"), (114, "WBS"), (12, "UBS"), (50, "WBS")], "tms_whs_id long, source_system string")
    rows = [(1, 1, D("0.2"), 4, False), (1, 114, D("0.4"), 3, False), (1, 12, D("0.6"), 4, False), (1, 12, None, 3, False), (1, 50, D("0.8"), 3, True), (1, 114, D("9"), 3, True)]
    vendors = spark.createDataFrame(
        [(i, *r, None) for i, r in enumerate(rows)],
        "fp_freight_form_vendor_id long, fp_freight_form_id long, tms_whs_id long, proposed_freight_per_lb decimal(18,6), fp_ff_method_id long, use_east_blended_freight_rate boolean, is_deleted boolean",
    )
    got = by(R.blended_rates(forms, vendors, whs), "fp_freight_form_id", "east_blended_freight_rate", "gilroc_blended_freight_rate", "harcar_blended_freight_rate")
    # East: NULL as zero, both opted-in rows, no vendor-shipped row; the warehouse group keeps the vendor-shipped one
    assert got == {1: (D("3.267"), D("0.300"), None), 2: (None, None, None)}


def test_carrier_rate_edges(spark):
    rows = spark.createDataFrame(
        [(1, 10, 1, 3, 0, True), (2, 20, 1, 3, 0, True), (3, 30, 1, 3, 0, True), (4, 40, 1, 3, 3, True), (5, 10, 1, 1, 0, True), (6, 10, None, 3, 0, True)],
        "id long, tms_whs_id long, fp_ff_pickup_locations_id long, fp_ff_method_id long, fp_ff_temperature_id long, has_warehouse boolean",
    )
    pickups = spark.createDataFrame([(1, "Town", "TX")], "fp_ff_pickup_locations_id long, city string, state string")
    kinds = "cr_rate_id long, cr_carrier_id long, destination_whs_id long, origin_city string, origin_state string, protection_level string, rate_unit string, rate decimal(10,3), mileage decimal(10,4), is_cheapest_rate boolean, primary_rate boolean, is_deleted boolean"
    rates = spark.createDataFrame(
        [
            (7, 1, 10, "Town", "TX", None, "Per Mile", D(2), D(50), False, True, None), (6, 1, 10, "Town", "TX", None, "Flat", D(9), D(10), True, False, None),
            (9, 1, 10, "Town", "TX", None, "Flat", D(1), D(1), False, True, None),
            (5, 1, 20, "Town", "TX", None, "Flat", D(9), D(10), True, False, None),
            (4, 2, 30, "Town", "TX", None, "Flat", D(9), D(10), True, True, None),
            (3, 1, 40, "Town", "TX", "Frozen", "Flat", D(9), D(10), True, False, None),
        ],
        kinds,
    )
    carriers = spark.createDataFrame([(1, True, None), (2, False, None)], "cr_carrier_id long, include_in_freight_pricing boolean, is_deleted boolean")
    got = by(R.pick_carrier_rate(rows, pickups, rates, carriers), "id", "picked_rate_id", "picked_price")
    assert got == {1: (7, D("100.000")), 2: (5, D("0.000")), 3: (None, D("0.000")), 4: (None, None), 5: (None, None), 6: (None, D("0.000"))}


def test_updates_take_nulls_and_keep_one_row_per_key(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    changes = spark.createDataFrame([(1, None, 5)], "k int, v string, other int")
    out = sinks.apply_updates(base, changes, ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, None, 1), (2, "b", 2)]
    assert sinks.duplicate_keys(out, ["k"]).count() == 0


def test_migration_rolls_back(spark):
    names = [f"{n} decimal(10,3)" for n in sinks.FORM_RATE_NAMES]
    old = spark.createDataFrame([], ", ".join(names))
    new = sinks.migrate(old, sinks.SPLIT_FORM_RATES)
    assert "default_tool_margin_target" in new.columns and "ucs_tool_margin_target" in new.columns
    assert sinks.migrate(new, sinks.rollback(sinks.SPLIT_FORM_RATES)).schema == old.schema


def test_config_csv(spark, tmp_path):
    header = (
        "FP_DEFAULT_CONFIG_ID,CROSSDOCK_PALLET_RATE,BACKHAUL_PALLET_RATE,SHUTTLE_RATE_PER_MILE,FUEL_SURCHARGE,ESTIMATED_LUMPER_EXPENSE,ESTIMATED_ACCESSORIAL_EXPENSE,"
        "ANTICIPATED_CROSSDOCK_LOAD_WEIGHT,ANTICIPATED_TL_LOAD_WEIGHT,ANTICIPATED_BACKHAUL_LOAD_WEIGHT,MARGIN_TARGET,PFF_PFH_UPCHARGE,COOLER_FREEZER_UPCHARGE,"
        "FP_ENGINE_MONTHS_BACK,SUPPLIER_SCREEN_MONTHS_BACK,PO_COUNT,AVG_PO_WEIGHT,AVG_PO_UNITS,AVG_PO_PALLETS,MARGIN_LOSS_REPORT_MONTHS_BACK,SOURCE_SYSTEM"
    )
    path = tmp_path / "config.csv"
    path.write_text(header + "\n1,7.000,23.000,2.870,.630,.016,.003,23532.000,20000.000,30000.000,.065,.025,.350,12,12,1.000,2871.000,313.000,3.000,6,\n")
    row = readers.read_config_csv(spark, str(path)).first()
    assert row["fuel_surcharge"] == D("0.630") and row["source_system"] is None and row["margin_loss_report_months_back"] == 6


def test_weekly_job_can_be_rerun(spark, tmp_path):
    path = str(tmp_path / "loss")
    rows = spark.createDataFrame([(1, dt.date(2001, 1, 1)), (2, dt.date(2001, 1, 8))], "v int, report_date date")
    sinks.replace_partitions(rows, path)
    sinks.replace_partitions(rows.filter("v = 2").withColumn("v", F.lit(7)), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 7]


def test_key_filters_and_lists():
    assert P.code_list("all") is None and P.code_list(None) is None
    assert P.id_list(" 1, 2,,3") == [1, 2, 3]


def test_sort_refuses_unknown_columns(spark):
    with pytest.raises(ValueError):
        S.sort_by(spark.range(1), "id; drop", "ASC", ("id",), "id")


def test_ratio_rounds_half_up_and_guards_zero(spark):
    df = spark.createDataFrame([(D(1), D(3)), (D(-1), D(8)), (D(5), D(0))], "a decimal(18,3), b decimal(18,3)")
    assert [r[0] for r in df.select(N.ratio(F.col("a"), F.col("b"), 2)).collect()] == [D("0.33"), D("-0.13"), None]


def _form_tables(spark, kind, method=3):
    """One closing form with one row at a warehouse, and everything it needs."""
    make = spark.createDataFrame
    blends = {f"{b}_blended_freight_rate": D("0.5") for b in ("east", "gilroc", "harcar", "stksgm", "annser")}
    form = dict(fp_freight_form_id=1, tms_status_id=62, fp_ff_type_id=kind, remit_number=None, tms_srm_id=1, supplier_name="S", freight_analyst_user_id=1,
                fp_ff_freight_change_reason_id=1, fp_ff_allowance_type_id=2, is_deleted=None, is_implied_rate=None, submit_date=None, margin_target=None, pff_pfh_up_charge=None, **blends)
    for side in ("default", "ucs"):
        for n in ("cooler_freezer_upcharge", "margin_target", "pff_pfh_upcharge", "fuel_surcharge"):
            form[f"{side}_tool_{n}"] = D(0)
    kinds = {"supplier_name": "string", "submit_date": "date", **{c: "boolean" for c in ("is_deleted", "is_implied_rate", "margin_target", "pff_pfh_up_charge")}}
    ddl = ", ".join(f"{c} {kinds.get(c, 'decimal(10,3)' if 'blended' in c or '_tool_' in c else 'long')}" for c in form)
    row = {c: None for c in feeds.ROW_LOG_COLUMNS} | dict(fp_freight_form_vendor_id=11, fp_freight_form_id=1, tms_whs_id=50, tms_vendor_id=None if kind == 1 else 70,
        fp_ff_pickup_locations_id=5, fp_ff_method_id=method, proposed_freight_per_lb=D("0.7"), is_deleted=None, use_east_blended_freight_rate=False)
    flags = {c: "boolean" for c in ("is_deleted", "processed_flag", "use_east_blended_freight_rate")}
    row_ddl = ", ".join(f"{c} {flags.get(c, 'date' if c == 'effective_date' else 'long' if c.endswith('_id') else 'decimal(18,6)')}" for c in row)
    return {
        "fp_freight_form": make([tuple(form.values())], ddl),
        "fp_freight_form_vendor": make([tuple(row.values())], row_ddl),
        "fp_ff_pickup_locations": make([(5, 1, "D1", 2, None)], "fp_ff_pickup_locations_id long, fp_freight_form_id long, d_rte string, pickup_day int, is_deleted boolean"),
        "tms_whs": make([(50, "W1", "Hall", "WBS", True, None)], "tms_whs_id long, whs_number string, name string, source_system string, include_in_freight_pricing boolean, is_deleted boolean"),
        "tms_vendor": make([(70, "V1", 50, "WBS", D("0.1"), None), (71, "V2", 99, "WBS", D("0.1"), None)], "tms_vendor_id long, vendor_number string, tms_whs_id long, source_system string, booked_freight_per_lb decimal(18,6), is_deleted boolean"),
        "whs_reference_data": make([("WBS", 50, "H1")], "source_system string, tms_whs_id long, whs_number string"),
        "fp_ff_approval_status": make([], "fp_freight_form_id long, is_deleted boolean"),
        "sec_users": make([(3, True)], "sec_users_id long, super_admin boolean"),
        "sec_user_roles": make([], "sec_users_id long, sec_roles_id long, is_deleted boolean"),
        "sec_roles": make([], "sec_roles_id long, is_deleted boolean"),
        "fp_escalation_roles": make([], "sec_roles_id long, fp_escalation_class string"),
    }


SUBMISSION = "fp_freight_form_id long, user_id long, send_to_backhaul boolean, vendor_numbers string, remit_number long, source_system_dates string, comment string"
NOW = dt.datetime(2001, 12, 31, 9, 30)


def test_closing_a_new_form(spark):
    t = _form_tables(spark, 1)
    asked = spark.createDataFrame([(1, 3, None, "70,71", 44, "WBS_2002-01-05", "go")], SUBMISSION)
    out = W.submit_forms(t, asked, NOW)
    assert out["errors"].count() == 0
    form = out["forms"].first()
    assert (form["tms_status_id"], form["remit_number"]) == (66, 44)
    row = out["vendor_rows"].first()
    assert (row["tms_vendor_id"], row["effective_date"], row["processed_flag"]) == (70, dt.date(2002, 1, 5), True)
    assert by(out["vendors"], "tms_vendor_id", "booked_freight_per_lb") == {70: D("0.700000"), 71: D("0.100000")}
    assert out["form_log"].first()["tms_status_id"] == 66 and out["row_log"].count() == 1
    assert out["pricing_out"].count() == 0  # new forms are not sent


def test_closing_an_existing_form_feeds_the_outbox(spark):
    asked = spark.createDataFrame([(1, 3, None, None, None, "WBS_2002-01-05", "go")], SUBMISSION)
    out = W.submit_forms(_form_tables(spark, 2), asked, NOW)["pricing_out"]
    got = {(r["identifier"], r["value"], r["pickup_day"], r["process_status"], r["created_date"]) for r in out.collect()}
    assert got == {("ALW", None, 3, "N", NOW), ("FRT", D("0.700000"), 3, "N", NOW)}


@pytest.mark.parametrize(
    "dates, vendors, title",
    [("WBS_", "70", "Effective Date Required"), ("WBS_2001-12-31", "70", "Valid Effective Date Required"), ("WBS_2002-01-05", "71", "Warehouse has no vendor assigned to it")],
)
def test_closing_errors_keep_the_form(spark, dates, vendors, title):
    asked = spark.createDataFrame([(1, 3, None, vendors, None, dates, "go")], SUBMISSION)
    errors = W.validate_forms(_form_tables(spark, 1), asked, NOW.date())
    assert [r["title"] for r in errors.collect()] == [title]


def test_no_clearance_is_the_only_stage_error(spark):
    t = _form_tables(spark, 2) | {"sec_users": spark.createDataFrame([(3, False)], "sec_users_id long, super_admin boolean")}
    asked = spark.createDataFrame([(1, 3, None, None, None, "WBS_", "go")], SUBMISSION)
    rows = W.validate_forms(t, asked, NOW.date()).collect()
    assert [(r["title"], r["detail"].split(" security")[0]) for r in rows] == [("Insufficient Clearance", "Only Costing or Coding")]


def test_dates_are_read_in_every_accepted_form(spark):
    texts = ["2022-10-01", " 10/01/2022 ", "10/1/2022", "20221001", "2022-10-01 07:30:00", "", "soon", "13/45/2022", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(P.date_of(F.col("t")).alias("d")).collect()
    assert [r.d for r in got] == [dt.date(2022, 10, 1)] * 5 + [None] * 4


def test_an_unreadable_entry_stops_no_other_form(spark):
    rows = spark.createDataFrame([(1, "UBS_10/01/2022,WBS_"), (2, "UBS,WBS_soon,"), (3, "UBS_2022-10-02"), (4, None)], "fp_freight_form_id long, source_system_dates string")
    got = sorted((r[0], r[1], str(r[2])) for r in W.parse_effective_dates(rows).collect())
    assert got == [(1, "UBS", "2022-10-01"), (1, "WBS", "None"), (2, "UBS", "None"), (2, "WBS", "None"), (3, "UBS", "2022-10-02")]


def test_vendor_lists_may_hold_blanks(spark):
    vendors = spark.createDataFrame([(12, 1, "V", "UBS", None)], "tms_vendor_id long, tms_whs_id long, vendor_number string, source_system string, is_deleted boolean")
    asked = spark.createDataFrame([(1, "12,"), (2, "x, 12"), (3, "")], "fp_freight_form_id long, vendor_numbers string")
    assert sorted(r["fp_freight_form_id"] for r in W._chosen_vendors({"tms_vendor": vendors}, asked).collect()) == [1, 2]


def test_order_log_keeps_dates_of_other_forms(spark):
    rows = spark.createDataFrame([(1, "P", "10/01/2022", "20221002", 5, D(7), "O"), (2, "P", "soon", "20221002", 9, D(9), "O")], "purchaseorderlogid long, po_number string, request_date string, expect_date string, total_units int, total_weight decimal(18,3), status string")
    [row] = H.first_last_order_log(rows).collect()
    assert (row.total_units_original, row.total_units_ordered) == (5, 5)
