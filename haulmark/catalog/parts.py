"""One small query per building block of the inventory, over whole tables.

The larger operators use these blocks; here each can be seen and checked alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from haulmark import constants as K
from haulmark.catalog.base import exact_ratio, mean_of, query
from haulmark.functions import numbers as N
from haulmark.functions import predicates as P
from haulmark.operators import shared as S
from haulmark.operators.intervals import join_periods
from haulmark.operators.spread import with_totals
from haulmark.sources import sinks

PO, LOAD, BILL = "lo_purchase_order_id", "lo_load_number", "bl_billing_id"
LIVE = "COALESCE({}.is_deleted, FALSE) = FALSE"
c = F.col


def pos(t):
    return t["lo_purchase_orders"]


def kept(where: str) -> str:
    return f"SELECT lo_purchase_order_id FROM lo_purchase_orders WHERE {where}"


# -- predicates ---------------------------------------------------------------
def _filter(name: str, where: str, test):
    query(name, kept(where))(lambda t: pos(t).filter(test()).select(PO))


query("p1_not_deleted", f"SELECT lo_po_loads_id, {PO} FROM lo_po_loads pl WHERE {LIVE.format('pl')}")(
    lambda t: t["lo_po_loads"].filter(P.not_deleted()).select("lo_po_loads_id", PO)
)
_filter("p2_optional_filter_all", "TRUE", lambda: P.optional_in(c("source_system"), P.code_list("ALL")))
_filter("p2_optional_filter_set", "source_system = 'WBS'", lambda: P.optional_in(c("source_system"), P.code_list("wbs")))
_filter("p3_list_membership", "dis_whs_id IN (1, 12, 114)", lambda: P.optional_in(c("dis_whs_id"), P.id_list(" 1, 12 ,114")))
_filter(
    "p4_date_window",
    "CAST(rec_date AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1999-09-30'",
    lambda: P.in_dates("rec_date", "1996-02-01", "1999-09-30"),
)
_filter("p5_switch_filter_off", "source_system IS NOT NULL", lambda: P.switch_filter(c("source_system"), None))
_filter("p5_switch_filter_on", "source_system = 'TFF'", lambda: P.switch_filter(c("source_system"), "tff"))
query("p6_contains", "SELECT fp_ff_pickup_locations_id FROM fp_ff_pickup_locations WHERE LOWER(pickup_name) LIKE '%up 1%'")(
    lambda t: t["fp_ff_pickup_locations"].filter(P.contains_text(c("pickup_name"), "UP 1")).select("fp_ff_pickup_locations_id")
)


def _keyed(t, remit, vendor):
    from haulmark.plans.reports import _key_filter

    return t["tms_vendor"].filter(_key_filter(remit, vendor)).select("tms_vendor_id")


query("p7_key_by_remit", "SELECT tms_vendor_id FROM tms_vendor WHERE remit_vendor = 10")(lambda t: _keyed(t, 10, "V0"))
query("p7_key_by_vendor", "SELECT tms_vendor_id FROM tms_vendor WHERE vendor_number = 'V0'")(lambda t: _keyed(t, None, "V0"))
query("p7_key_missing", "SELECT tms_vendor_id FROM tms_vendor WHERE FALSE")(lambda t: _keyed(t, None, None))
query(
    "p8_protection_match",
    """SELECT cr_rate_id FROM cr_rate r JOIN fp_freight_form f ON f.fp_freight_form_id = r.cr_rate_id
    WHERE protection_level = CASE WHEN fp_ff_temperature_id = 3 THEN 'Dry' ELSE protection_level END OR protection_level IS NULL""",
)(
    lambda t: t["cr_rate"]
    .join(t["fp_freight_form"].select(c("fp_freight_form_id").alias("cr_rate_id"), "fp_ff_temperature_id"), "cr_rate_id")
    .filter(P.protection_matches(c("fp_ff_temperature_id"), c("protection_level")))
    .select("cr_rate_id")
)
query("p9_is_date", "SELECT purchaseorderlogid FROM purchaseorderslog WHERE TRY_CAST(request_date AS DATE) IS NOT NULL")(
    lambda t: t["purchaseorderslog"].filter(P.is_date(c("request_date"))).select("purchaseorderlogid")
)
query("p10_positive_key", "SELECT tms_vendor_id FROM tms_vendor WHERE remit_vendor > 0")(
    lambda t: t["tms_vendor"].filter(P.positive_key(c("remit_vendor"))).select("tms_vendor_id")
)
_filter(
    "p11_order_state",
    "revenue_type = 'Revenue PO' AND (order_type_id IS NULL OR order_type_id <> 1)",
    lambda: (c("revenue_type") == K.REVENUE_ORDER) & (c("order_type_id").isNull() | (c("order_type_id") != K.SIDE_STREAM_ORDER_TYPE)),
)

# -- joins --------------------------------------------------------------------
query("j1_inner", "SELECT bp.lo_purchase_order_id, b.invoice_amount FROM bl_bill_pos bp JOIN bl_billing b USING (bl_billing_id)", "invoice_amount")(
    lambda t: t["bl_bill_pos"].join(t["bl_billing"].select(BILL, "invoice_amount"), BILL).select(PO, "invoice_amount")
)
query(
    "j2_left_with_condition",
    f"SELECT po.lo_purchase_order_id, pl.lo_load_number FROM lo_purchase_orders po LEFT JOIN lo_po_loads pl ON po.lo_purchase_order_id = pl.lo_purchase_order_id AND {LIVE.format('pl')}",
)(lambda t: pos(t).select(PO).join(S.live(t["lo_po_loads"]).select(PO, LOAD), PO, "left"))
query("j3_semi", kept("lo_purchase_order_id IN (SELECT lo_purchase_order_id FROM lo_po_log WHERE d_rte = 'PEND')"))(
    lambda t: pos(t).select(PO).join(t["lo_po_log"].filter("d_rte = 'PEND'").select(PO), PO, "left_semi")
)
query("j4_anti", kept("lo_purchase_order_id NOT IN (SELECT lo_purchase_order_id FROM bl_bill_pos)"))(
    lambda t: pos(t).select(PO).join(t["bl_bill_pos"].select(PO), PO, "left_anti")
)
query("j5_null_aware_anti", "SELECT fp_freight_form_vendor_id FROM fp_freight_form_vendor WHERE cr_rate_id NOT IN (SELECT cr_rate_id FROM cr_rate WHERE primary_rate)")(
    lambda t: t["fp_freight_form_vendor"]
    .filter(c("cr_rate_id").isNotNull())
    .join(t["cr_rate"].filter("primary_rate").select("cr_rate_id"), "cr_rate_id", "left_anti")
    .select("fp_freight_form_vendor_id")
)
query(
    "j6_anti_three_keys",
    """SELECT pl.lo_purchase_order_id, pl.lo_load_number FROM lo_po_loads pl JOIN lo_loads ld USING (lo_load_number)
    LEFT JOIN (SELECT bp.lo_purchase_order_id, bp.lo_load_number, b.cr_carrier_id, b.bl_billing_id FROM bl_bill_pos bp JOIN bl_billing b USING (bl_billing_id)) v
      ON pl.lo_purchase_order_id = v.lo_purchase_order_id AND pl.lo_load_number = v.lo_load_number AND ld.cr_carrier_id = v.cr_carrier_id WHERE v.bl_billing_id IS NULL""",
)(
    lambda t: t["lo_po_loads"]
    .select(PO, LOAD)
    .join(t["lo_loads"].select(LOAD, "cr_carrier_id"), LOAD)
    .join(t["bl_bill_pos"].select(PO, LOAD, BILL).join(t["bl_billing"].select(BILL, "cr_carrier_id"), BILL), [PO, LOAD, "cr_carrier_id"], "left_anti")
    .select(PO, LOAD)
)
query(
    "j7_exists",
    """SELECT f.fp_freight_form_id FROM fp_freight_form f WHERE EXISTS (SELECT 1 FROM fp_freight_form_vendor v WHERE v.fp_freight_form_id = f.fp_freight_form_id AND v.tms_whs_id = 12)
    AND NOT EXISTS (SELECT 1 FROM fp_ff_approval_status a WHERE a.fp_freight_form_id = f.fp_freight_form_id)""",
)(
    lambda t: t["fp_freight_form"]
    .select("fp_freight_form_id")
    .join(t["fp_freight_form_vendor"].filter("tms_whs_id = 12"), "fp_freight_form_id", "left_semi")
    .join(t["fp_ff_approval_status"], "fp_freight_form_id", "left_anti")
)
query(
    "j8_fiscal_week",
    "SELECT po.lo_purchase_order_id, fc.week FROM lo_purchase_orders po LEFT JOIN fiscal_calendar fc ON CAST(po.rec_date AS DATE) BETWEEN fc.week_start AND fc.week_end",
)(lambda t: S.fiscal_period_of(pos(t).select(PO, "rec_date"), "rec_date", t["fiscal_calendar"], ("week",)).select(PO, "week"))
query(
    "j9_dated_price",
    f"""SELECT l.fp_freight_form_id, l.tms_status_id, p.price FROM fp_freight_form_log l JOIN tms_fuel_avg_price p ON l.created_date BETWEEN p.start_date AND p.end_date AND {LIVE.format('p')}""",
    "price",
)(
    lambda t: join_periods(
        t["fp_freight_form_log"].select("fp_freight_form_id", "tms_status_id", "created_date"),
        S.live(t["tms_fuel_avg_price"]).select("start_date", "end_date", "price"),
        "created_date", "start_date", "end_date", open_ends=False,
    ).select("fp_freight_form_id", "tms_status_id", "price")
)
query(
    "j10_code_or_default",
    """SELECT po.lo_purchase_order_id, c.backhaul_pallet_rate FROM lo_purchase_orders po LEFT JOIN fp_default_config c ON UPPER(RTRIM(c.source_system)) =
      CASE WHEN po.source_system IN (SELECT UPPER(RTRIM(source_system)) FROM fp_default_config WHERE source_system IS NOT NULL) THEN po.source_system ELSE 'DEFAULT' END""",
    "backhaul_pallet_rate",
)(lambda t: S.join_by_code_or_default(pos(t).select(PO, "source_system"), t["fp_default_config"], "source_system", ["backhaul_pallet_rate"]).drop("source_system"))
query(
    "j11_computed_key",
    "SELECT r.cr_rate_id, w.whs_number FROM cr_rate r JOIN tms_whs w ON CASE WHEN w.campus_whs_id IS NULL THEN w.tms_whs_id ELSE w.campus_whs_id END = r.destination_whs_id",
)(
    lambda t: t["cr_rate"]
    .join(t["tms_whs"].select(F.coalesce("campus_whs_id", "tms_whs_id").alias("destination_whs_id"), "whs_number"), "destination_whs_id")
    .select("cr_rate_id", "whs_number")
)
query(
    "j12_lane",
    "SELECT v.fp_freight_form_vendor_id, m.miles FROM fp_freight_form_vendor v JOIN fp_ff_crossdock_miles m ON v.tms_whs_id = m.destination_whs_id AND v.crossdock_whs_id = m.origin_whs_id",
    "miles",
)(
    lambda t: t["fp_freight_form_vendor"]
    .join(
        t["fp_ff_crossdock_miles"].withColumnsRenamed({"origin_whs_id": "crossdock_whs_id", "destination_whs_id": "tms_whs_id"}),
        ["crossdock_whs_id", "tms_whs_id"],
    )
    .select("fp_freight_form_vendor_id", "miles")
)
query(
    "j13_first_and_last",
    """SELECT a.po_number, a.total_units AS first_units, b.total_units AS last_units FROM
      (SELECT *, RANK() OVER (PARTITION BY po_number ORDER BY purchaseorderlogid) AS r FROM purchaseorderslog) a JOIN
      (SELECT *, RANK() OVER (PARTITION BY po_number ORDER BY purchaseorderlogid DESC) AS r FROM purchaseorderslog) b ON a.po_number = b.po_number WHERE a.r = 1 AND b.r = 1""",
    "first_units last_units",
)(
    lambda t: t["purchaseorderslog"]
    .groupBy("po_number")
    .agg(F.min_by("total_units", "purchaseorderlogid").alias("first_units"), F.max_by("total_units", "purchaseorderlogid").alias("last_units"))
)
query("j14_split_list", "SELECT fp_freight_form_id, unnest(string_split(source_system_dates, ',')) AS entry FROM submissions")(
    lambda t: t["submissions"].select("fp_freight_form_id", F.explode(F.split("source_system_dates", ",")).alias("entry"))
)
query(
    "j15_correlated_top1",
    """SELECT po.lo_purchase_order_id, (SELECT MIN_BY(w.name, ld.lo_load_number) FROM lo_po_loads pl JOIN lo_loads ld USING (lo_load_number) JOIN tms_whs w ON w.tms_whs_id = ld.destination_whs_id
      WHERE pl.lo_purchase_order_id = po.lo_purchase_order_id) AS destination FROM lo_purchase_orders po""",
)(
    lambda t: pos(t)
    .select(PO)
    .join(
        t["lo_po_loads"]
        .select(PO, LOAD)
        .join(t["lo_loads"].select(LOAD, c("destination_whs_id").alias("tms_whs_id")), LOAD)
        .join(t["tms_whs"].select("tms_whs_id", "name"), "tms_whs_id")
        .groupBy(PO)
        .agg(F.min_by("name", LOAD).alias("destination")),
        PO,
        "left",
    )
)
query(
    "j16_correlated_sum",
    """SELECT b.bl_billing_id, (SELECT SUM(po.total_weight) FROM bl_bill_pos bp JOIN lo_purchase_orders po USING (lo_purchase_order_id) WHERE bp.bl_billing_id = b.bl_billing_id) AS weight FROM bl_billing b""",
    "weight",
)(
    lambda t: t["bl_billing"]
    .select(BILL)
    .join(
        t["bl_bill_pos"].select(PO, BILL).join(pos(t).select(PO, "total_weight"), PO).groupBy(BILL).agg(F.sum("total_weight").cast("decimal(28,3)").alias("weight")),
        BILL,
        "left",
    )
)
query(
    "j17_correlated_lookup",
    "SELECT v.fp_freight_form_vendor_id, (SELECT a.description FROM fp_ff_allowance_type a WHERE a.fp_ff_allowance_type_id = v.current_allowance_type_id) AS description FROM fp_freight_form_vendor v",
)(
    lambda t: t["fp_freight_form_vendor"]
    .select("fp_freight_form_vendor_id", c("current_allowance_type_id").alias("fp_ff_allowance_type_id"))
    .join(t["fp_ff_allowance_type"].select("fp_ff_allowance_type_id", "description"), "fp_ff_allowance_type_id", "left")
    .select("fp_freight_form_vendor_id", "description")
)
query(
    "j18_total_on_every_group",
    "SELECT cr_carrier_id, SUM(invoice_amount) AS amount, (SELECT SUM(invoice_amount) FROM bl_billing) AS everything FROM bl_billing GROUP BY 1",
    "amount everything",
)(
    lambda t: t["bl_billing"]
    .groupBy("cr_carrier_id")
    .agg(F.sum("invoice_amount").alias("amount"))
    .withColumn("everything", t["bl_billing"].agg(F.sum("invoice_amount").alias("s")).scalar())
)
query(
    "j19_two_roles",
    "SELECT v.fp_freight_form_vendor_id, d.name AS destination, x.name AS crossdock FROM fp_freight_form_vendor v LEFT JOIN tms_whs d ON v.tms_whs_id = d.tms_whs_id LEFT JOIN tms_whs x ON v.crossdock_whs_id = x.tms_whs_id",
)(
    lambda t: t["fp_freight_form_vendor"]
    .select("fp_freight_form_vendor_id", "tms_whs_id", "crossdock_whs_id")
    .join(t["tms_whs"].select("tms_whs_id", c("name").alias("destination")), "tms_whs_id", "left")
    .join(t["tms_whs"].select(c("tms_whs_id").alias("crossdock_whs_id"), c("name").alias("crossdock")), "crossdock_whs_id", "left")
    .drop("tms_whs_id", "crossdock_whs_id")
)

# -- aggregates ---------------------------------------------------------------
query("a1_count", "SELECT source_system, COUNT(*) AS n FROM lo_purchase_orders WHERE tms_status_id = 9 GROUP BY 1")(
    lambda t: pos(t).filter("tms_status_id = 9").groupBy("source_system").agg(F.count(F.lit(1)).alias("n"))
)
query("a2_count_distinct", "SELECT tms_vendor_id, COUNT(DISTINCT po_number) AS n FROM lo_purchase_orders GROUP BY 1")(
    lambda t: pos(t).groupBy("tms_vendor_id").agg(F.count_distinct("po_number").alias("n"))
)
query(
    "a3_by_key",
    f"SELECT tms_vendor_id, SUM(total_weight) AS s, {mean_of('total_weight')} AS a, MIN(total_weight) AS lo, MAX(total_weight) AS hi FROM lo_purchase_orders GROUP BY 1",
    "s a lo hi",
)(
    lambda t: pos(t)
    .groupBy("tms_vendor_id")
    .agg(F.sum("total_weight").alias("s"), N.mean(c("total_weight")).alias("a"), F.min("total_weight").alias("lo"), F.max("total_weight").alias("hi"))
)
query(
    "a4_conditional_sum",
    "SELECT dis_whs_id, SUM(CASE WHEN frz_units > 0 THEN total_weight ELSE 0 END) AS frozen, MAX(CASE WHEN tms_status_id = 9 THEN total_weight END) AS top FROM lo_purchase_orders GROUP BY 1",
    "frozen top",
)(
    lambda t: pos(t)
    .groupBy("dis_whs_id")
    .agg(
        F.sum(F.when(c("frz_units") > 0, c("total_weight")).otherwise(N.or_zero(F.lit(None).cast("decimal(18,3)")))).alias("frozen"),
        F.max(F.when(c("tms_status_id") == 9, c("total_weight"))).alias("top"),
    )
)
query("a5_mean_zero", f"SELECT tms_vendor_id, {mean_of('COALESCE(total_pallets, 0)')} AS a FROM lo_purchase_orders GROUP BY 1", "a")(
    lambda t: pos(t).groupBy("tms_vendor_id").agg(N.mean_zero(c("total_pallets")).alias("a"))
)
query(
    "a6_ratio_of_means",
    f"SELECT tms_vendor_id, {exact_ratio(mean_of('ABS(allowance)'), mean_of('total_weight'), 6, 6, 6)} AS r FROM lo_purchase_orders GROUP BY 1",
    "r",
)(lambda t: pos(t).groupBy("tms_vendor_id").agg(N.mean_ratio(F.abs("allowance"), c("total_weight")).alias("r")))
query(
    "a7_weighted_mean",
    f"SELECT fp_freight_form_id, {exact_ratio('SUM(average_po_weight * total_pos)', 'SUM(total_pos)', 6, 6, 3)} AS a FROM fp_freight_form_vendor GROUP BY 1",
    "a",
)(
    lambda t: t["fp_freight_form_vendor"]
    .groupBy("fp_freight_form_id")
    .agg(N.ratio(F.sum((c("average_po_weight") * c("total_pos")).cast("decimal(24,6)")), F.sum("total_pos")).alias("a"))
)
query("a8_group_by_expression", "SELECT average_po_cubes * total_pos AS cubes, COUNT(*) AS n FROM fp_freight_form_vendor GROUP BY 1", "cubes")(
    lambda t: t["fp_freight_form_vendor"].groupBy((c("average_po_cubes") * c("total_pos")).alias("cubes")).agg(F.count(F.lit(1)).alias("n"))
)
query(
    "a9_pass_through",
    "SELECT v.tms_vendor_id, v.name, v.vendor_number, SUM(po.total_weight) AS w FROM tms_vendor v JOIN lo_purchase_orders po USING (tms_vendor_id) GROUP BY 1, 2, 3",
    "w",
)(
    lambda t: pos(t)
    .groupBy("tms_vendor_id")
    .agg(F.sum("total_weight").alias("w"))
    .join(t["tms_vendor"].select("tms_vendor_id", "name", "vendor_number"), "tms_vendor_id")
)
query(
    "a10_distinct_list",
    "SELECT tms_vendor_id, string_agg(source_system, ',' ORDER BY source_system) AS systems FROM (SELECT DISTINCT tms_vendor_id, source_system FROM lo_purchase_orders WHERE source_system IS NOT NULL) d GROUP BY 1",
)(
    lambda t: pos(t)
    .filter(c("source_system").isNotNull())
    .groupBy("tms_vendor_id")
    .agg(F.array_join(F.array_sort(F.collect_set("source_system")), ",").alias("systems"))
)
query("a11_distinct", "SELECT DISTINCT tms_vendor_id, dis_whs_id FROM lo_purchase_orders")(
    lambda t: pos(t).select("tms_vendor_id", "dis_whs_id").distinct()
)
query("a12_duplicate_keys", "SELECT po_number, COUNT(*) AS rows FROM lo_purchase_orders GROUP BY 1 HAVING COUNT(*) > 1")(
    lambda t: sinks.duplicate_keys(pos(t), ["po_number"])
)
query("a13_several_values", "SELECT po_number, COUNT(DISTINCT tms_vendor_id) > 1 AS several FROM lo_purchase_orders GROUP BY 1")(
    lambda t: pos(t).groupBy("po_number").agg((F.min("tms_vendor_id") != F.max("tms_vendor_id")).alias("several"))
)

# -- group totals instead of windows ---------------------------------------------
query(
    "w1_share_base",
    "SELECT lo_purchase_order_id, SUM(total_weight) OVER (PARTITION BY po_number) AS weight FROM lo_purchase_orders",
    "weight",
)(lambda t: with_totals(pos(t).select(PO, "po_number", "total_weight"), ["po_number"], [PO], weight=F.sum("total_weight")).select(PO, "weight"))
query(
    "w2_conditional_total",
    "SELECT lo_purchase_order_id, SUM(CASE WHEN frz_units > 0 THEN total_weight END) OVER (PARTITION BY dis_whs_id) AS frozen FROM lo_purchase_orders",
    "frozen",
)(
    lambda t: with_totals(
        pos(t).select(PO, "dis_whs_id", "total_weight", "frz_units"), ["dis_whs_id"], [PO], frozen=F.sum(F.when(c("frz_units") > 0, c("total_weight")))
    ).select(PO, "frozen")
)
query(
    "w3_conditional_count",
    "SELECT lo_purchase_order_id, COUNT(CASE WHEN frz_units > 0 THEN 1 END) OVER (PARTITION BY tms_vendor_id) AS frozen FROM lo_purchase_orders",
)(
    lambda t: with_totals(
        pos(t).select(PO, "tms_vendor_id", "frz_units"), ["tms_vendor_id"], [PO], frozen=F.count(F.when(c("frz_units") > 0, 1))
    ).select(PO, "frozen")
)
query(
    "w4_rank_ends",
    """SELECT po_number, MAX(CASE WHEN up = 1 THEN purchaseorderlogid END) AS first_id, MAX(CASE WHEN down = 1 THEN purchaseorderlogid END) AS last_id FROM (
      SELECT *, RANK() OVER (PARTITION BY po_number ORDER BY purchaseorderlogid) AS up, RANK() OVER (PARTITION BY po_number ORDER BY purchaseorderlogid DESC) AS down FROM purchaseorderslog) r GROUP BY 1""",
)(lambda t: t["purchaseorderslog"].groupBy("po_number").agg(F.min("purchaseorderlogid").alias("first_id"), F.max("purchaseorderlogid").alias("last_id")))
query(
    "w5_one_row_per_key",
    "SELECT po_number, lo_purchase_order_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY po_number ORDER BY tms_vendor_id, lo_purchase_order_id) AS rn FROM lo_purchase_orders) r WHERE rn = 1",
)(
    lambda t: pos(t)
    .groupBy("po_number")
    .agg(S.lowest({PO: c(PO)}, c("tms_vendor_id"), c(PO)).alias("row"))
    .select("po_number", c(f"row.{PO}").alias(PO))
)
query("w6_lowest_stop", "SELECT load_number, MIN(seq_number) AS first_stop FROM tms_pc_miler_history GROUP BY 1")(
    lambda t: t["tms_pc_miler_history"].groupBy("load_number").agg(F.min("seq_number").alias("first_stop"))
)
query(
    "w7_load_totals",
    "SELECT pl.lo_purchase_order_id, pl.lo_load_number, SUM(po.total_weight) OVER (PARTITION BY pl.lo_load_number) AS weight FROM lo_po_loads pl JOIN lo_purchase_orders po USING (lo_purchase_order_id)",
    "weight",
)(
    lambda t: with_totals(
        t["lo_po_loads"].select(PO, LOAD).join(pos(t).select(PO, "total_weight"), PO), [LOAD], [PO], weight=F.sum("total_weight")
    ).select(PO, LOAD, "weight")
)
query("w8_sort_key", "SELECT tms_vendor_id, name FROM tms_vendor ORDER BY name DESC, tms_vendor_id")(
    lambda t: S.sort_by(t["tms_vendor"].select("tms_vendor_id", "name"), "NAME", "DESC", ("name",), "tms_vendor_id")
)

# -- order, top rows, set operations -----------------------------------------------
query("o1_fixed_sort", "SELECT po_number, lo_purchase_order_id FROM lo_purchase_orders ORDER BY po_number, lo_purchase_order_id")(
    lambda t: pos(t).select("po_number", PO).orderBy("po_number", PO)
)
query("o2_sort_by_argument", "SELECT fp_freight_form_vendor_id, total_pos FROM fp_freight_form_vendor ORDER BY total_pos, fp_freight_form_vendor_id", "total_pos")(
    lambda t: S.sort_by(t["fp_freight_form_vendor"].select("fp_freight_form_vendor_id", "total_pos"), "TOTAL_POS", "ASC", ("total_pos",), "fp_freight_form_vendor_id")
)
query("o3_first_by_date", "SELECT fp_freight_form_id, MIN(created_date) AS first_date FROM fp_freight_form_log WHERE tms_status_id = 58 GROUP BY 1")(
    lambda t: t["fp_freight_form_log"].filter("tms_status_id = 58").groupBy("fp_freight_form_id").agg(F.min("created_date").alias("first_date"))
)
query(
    "o4_any_row_fixed",
    "SELECT destination_whs_id, origin_city, MIN(cr_rate_id) AS cr_rate_id FROM cr_rate GROUP BY 1, 2",
)(lambda t: t["cr_rate"].groupBy("destination_whs_id", "origin_city").agg(F.min("cr_rate_id").alias("cr_rate_id")))
query(
    "o5_first_or_last",
    """SELECT po_number, MIN_BY(status, purchaseorderlogid) AS first_status, MAX_BY(status, purchaseorderlogid) AS last_status FROM purchaseorderslog GROUP BY 1""",
)(
    lambda t: t["purchaseorderslog"]
    .groupBy("po_number")
    .agg(S.lowest({"status": c("status")}, c("purchaseorderlogid")).alias("a"), S.highest({"status": c("status")}, c("purchaseorderlogid")).alias("b"))
    .select("po_number", c("a.status").alias("first_status"), c("b.status").alias("last_status"))
)
query(
    "u1_union_all",
    "SELECT 'ALW' AS kind, fp_freight_form_vendor_id AS id FROM fp_freight_form_vendor UNION ALL SELECT 'FRT', fp_freight_form_vendor_id FROM fp_freight_form_vendor",
)(
    lambda t: t["fp_freight_form_vendor"]
    .select(F.lit("ALW").alias("kind"), c("fp_freight_form_vendor_id").alias("id"))
    .unionByName(t["fp_freight_form_vendor"].select(F.lit("FRT").alias("kind"), c("fp_freight_form_vendor_id").alias("id")))
)
query("u2_union_distinct", "SELECT lo_load_number FROM lo_po_loads UNION SELECT lo_load_number FROM bl_billing")(
    lambda t: t["lo_po_loads"].select(LOAD).unionByName(t["bl_billing"].select(LOAD)).distinct()
)
query("u3_grouped_once", "SELECT source_system, SUM(total_weight) AS w FROM lo_purchase_orders WHERE source_system IS NOT NULL GROUP BY 1", "w")(
    lambda t: pos(t).filter(c("source_system").isNotNull()).groupBy("source_system").agg(F.sum("total_weight").alias("w"))
)


# -- scalar functions ----------------------------------------------------------
def _scalar(name: str, sql: str, build, table: str = "lo_purchase_orders", key: str = PO, money: str = ""):
    query(name, f"SELECT {key}, {sql} FROM {table}", money)(lambda t: t[table].select(key, *build()))


_scalar("f1_isnull", "COALESCE(prod_frt, 0) AS v, COALESCE(tms_vendor_facility_id, tms_vendor_id) AS w", lambda: [N.or_zero(c("prod_frt")).alias("v"), F.coalesce("tms_vendor_facility_id", "tms_vendor_id").alias("w")], money="v")
_scalar("f2_guarded_division", f"{exact_ratio('prod_frt', 'total_weight')} AS v", lambda: [N.ratio(c("prod_frt"), c("total_weight")).alias("v")], money="v")
_scalar("f3_case", "CASE WHEN total_pallets > 10 THEN 'many' ELSE 'few' END AS v", lambda: [F.when(c("total_pallets") > 10, "many").otherwise("few").alias("v")])
_scalar("f4_cast_rounds", "CAST(prod_frt AS DECIMAL(18, 0)) AS v", lambda: [c("prod_frt").cast(N.dec(18, 0)).alias("v")], money="v")
_scalar("f5_ceiling", "CEIL(total_pallets) AS v", lambda: [N.whole_up(c("total_pallets")).alias("v")], money="v")
_scalar("f6_abs", "ABS(allowance) AS v", lambda: [F.abs("allowance").alias("v")], money="v")
_scalar("f7_days", "CAST(date_diff('day', original_eta_date, CAST(rec_date AS DATE)) AS INTEGER) AS v", lambda: [P.days_between(c("original_eta_date"), c("rec_date")).alias("v")])
_scalar(
    "f8_minutes", "date_diff('minute', appointment_date, datetimelanded) AS v", lambda: [P.minutes_between(c("appointment_date"), c("datetimelanded")).alias("v")],
    "app_appointments", "app_appointment_id",
)
_scalar("f9_add_months", "CAST(CAST(rec_date AS DATE) - to_months(6) AS DATE) AS v", lambda: [F.add_months(F.to_date("rec_date"), -6).alias("v")])
_scalar("f10_today", "CAST(rec_date AS DATE) <= DATE '1998-12-31' AS v", lambda: [(F.to_date("rec_date") <= F.lit(dt.date(1998, 12, 31))).alias("v")])
_scalar("f11_as_of", "TIMESTAMP '2001-12-31 08:00:00' AS v", lambda: [F.lit("2001-12-31 08:00:00").cast("timestamp_ntz").alias("v")])
_scalar("f12_short_date", "strftime(CAST(rec_date AS DATE), '%m/%d/%y') AS v", lambda: [P.short_date(c("rec_date")).alias("v")])
_scalar("f13_text_before", "split_part(lo_purchase_order_id, '-', 1) AS v", lambda: [F.substring_index(PO, "-", 1).alias("v")])
_scalar("f14_position_length", "CAST(instr(d_rte, '1') AS INTEGER) AS v, CAST(length(rtrim(d_rte)) AS INTEGER) AS w", lambda: [F.instr("d_rte", "1").alias("v"), F.length(F.rtrim("d_rte")).alias("w")])
_scalar("f15_trim", "trim(address) AS v", lambda: [F.trim("address").alias("v")], "fp_ff_pickup_locations", "fp_ff_pickup_locations_id")
_scalar("f16_concat_null", "po_number || ' ' || source_system AS v", lambda: [F.concat("po_number", F.lit(" "), "source_system").alias("v")])
_scalar("f17_format_number", "format('{:,.3f}', CAST(total_weight AS DOUBLE)) AS v", lambda: [F.format_number("total_weight", 3).alias("v")])
_scalar(
    "f18_pickup_day",
    "CASE pickup_day WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' WHEN 6 THEN 'Sunday' END AS v, pickup_day + 1 AS w",
    lambda: [P.pickup_day_name(c("pickup_day")).alias("v"), P.pickup_day_number(c("pickup_day")).alias("w")],
    "fp_ff_pickup_locations", "fp_ff_pickup_locations_id",
)
_scalar("f19_dollars", "'$' || CAST(CAST(prod_frt AS DECIMAL(18, 3)) AS VARCHAR) AS v", lambda: [P.dollars(c("prod_frt")).alias("v")])
query(
    "f20_address_fallback",
    "SELECT po.lo_purchase_order_id, COALESCE(f.city, v.city) AS city FROM lo_purchase_orders po LEFT JOIN tms_vendor v USING (tms_vendor_id) LEFT JOIN tms_vendor_facility f USING (tms_vendor_facility_id)",
)(
    lambda t: pos(t)
    .select(PO, "tms_vendor_id", "tms_vendor_facility_id")
    .join(t["tms_vendor"].select("tms_vendor_id", c("city").alias("v_city")), "tms_vendor_id", "left")
    .join(t["tms_vendor_facility"].select("tms_vendor_facility_id", c("city").alias("f_city")), "tms_vendor_facility_id", "left")
    .select(PO, F.coalesce("f_city", "v_city").alias("city"))
)
