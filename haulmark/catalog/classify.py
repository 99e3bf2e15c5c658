"""Classification queries and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.base import query
from haulmark.functions import classify as cl
from haulmark.operators import history as H

PO = "lo_purchase_order_id"
PROTECTION = "CASE WHEN po.frz_units > 0 THEN 'F' WHEN po.chl_units > 0 THEN 'C' ELSE 'D' END"
LEVELS = """array_to_string(list_filter([CASE WHEN po.chl_units > 0 THEN 'C' END, CASE WHEN po.dry_units > 0 OR po.rpk_units > 0 THEN 'D' END,
  CASE WHEN po.frz_units > 0 THEN 'F' END], lambda x: x IS NOT NULL), ',')"""
LIVE = "COALESCE({}.is_deleted, FALSE) = FALSE"

LANDED = "CASE WHEN date_diff('day', CAST({eta} AS DATE), CAST(app.datetimelanded AS DATE)) > 0 THEN 'LATE' ELSE 'ON TIME' END"
APPT = """CASE WHEN date_diff('minute', app.appointment_date, app.datetimelanded) <= 30 OR app.datetimelanded <= app.appointment_date
  THEN 'ON TIME' ELSE 'LATE' END"""

MODE = """CASE WHEN sw.name IS NOT NULL AND ca.cr_rate_id IS NOT NULL THEN rt.mode || ' CROSS DOCK'
    WHEN sw.name IS NULL AND ca.cr_rate_id IS NOT NULL THEN rt.mode
    WHEN COALESCE(cc.ltl_carrier, FALSE) THEN 'LTL' WHEN ld.cr_carrier_id IN (4541) THEN 'CROSS DOCK SHUTTLE'
    WHEN ld.destination_whs_id IN (22, 23, 20) THEN 'CONSOLIDATED' WHEN ld.cr_carrier_id = 78 THEN 'BACKHAUL'
    WHEN ld.lo_load_number IS NULL THEN 'VSP' ELSE 'TL' END"""

LOG_SQL = """SELECT po_number, MAX(CASE WHEN rn = 1 THEN total_units END) AS total_units_original, MAX(CASE WHEN rd = 1 THEN total_units END) AS total_units_ordered,
  MAX(CASE WHEN rn = 1 THEN total_weight END) AS total_weight_original, MAX(CASE WHEN rd = 1 THEN total_weight END) AS total_weight_ordered
FROM (SELECT *, RANK() OVER (PARTITION BY po_number ORDER BY purchaseorderlogid) AS rn, RANK() OVER (PARTITION BY po_number ORDER BY purchaseorderlogid DESC) AS rd
  FROM purchaseorderslog WHERE TRY_CAST(request_date AS DATE) IS NOT NULL AND TRY_CAST(expect_date AS DATE) IS NOT NULL
    AND total_units > 0 AND status NOT IN ('RCV', 'DEL')) x GROUP BY 1"""

ORIGIN_SQL = """SELECT load_number AS lo_load_number, city AS load_origin_city, st AS load_origin_state, zip AS load_origin_zip FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY load_number ORDER BY seq_number, city, st, zip) AS rn FROM tms_pc_miler_history
  WHERE COALESCE(is_deleted, FALSE) = FALSE{more}) x WHERE rn = 1"""


@query("protection_level", f"SELECT lo_purchase_order_id, {PROTECTION} AS protection_level, {LEVELS} AS protection_levels FROM lo_purchase_orders po")
def _(t):
    units = [F.col(c) for c in ("chl_units", "dry_units", "frz_units", "rpk_units")]
    return t["lo_purchase_orders"].select(
        PO,
        cl.protection_level(F.col("frz_units"), F.col("chl_units")).alias("protection_level"),
        cl.protection_levels(*units).alias("protection_levels"),
    )


@query(
    "po_type",
    f"""SELECT po.lo_purchase_order_id, CASE WHEN EXISTS (SELECT 1 FROM lo_po_loads pl WHERE pl.lo_purchase_order_id = po.lo_purchase_order_id
      AND {LIVE.format('pl')}) THEN 'COLLECT' ELSE 'VSP' END AS po_type FROM lo_purchase_orders po""",
)
def _(t):
    from haulmark.operators.shared import live

    linked = live(t["lo_po_loads"]).select(PO, F.lit(True).alias("linked")).distinct()
    return t["lo_purchase_orders"].join(linked, PO, "left").select(
        PO, cl.po_type(F.col("linked").isNotNull()).alias("po_type")
    )


@query(
    "shipping_mode",
    f"""SELECT ld.lo_load_number, {MODE} AS mode FROM lo_loads ld JOIN cr_carriers cc ON ld.cr_carrier_id = cc.cr_carrier_id
    LEFT JOIN tms_whs sw ON ld.source_whs_id = sw.tms_whs_id
    LEFT JOIN cr_agreement ca ON ld.lo_load_number = ca.lo_load_number AND {LIVE.format('ca')}
    LEFT JOIN cr_rate rt ON ca.cr_rate_id = rt.cr_rate_id""",
)
def _(t):
    from haulmark.operators.shared import live

    return (
        t["lo_loads"]
        .join(t["cr_carriers"].select("cr_carrier_id", "ltl_carrier"), "cr_carrier_id")
        .join(t["tms_whs"].select(F.col("tms_whs_id").alias("source_whs_id"), "name"), "source_whs_id", "left")
        .join(live(t["cr_agreement"]).select("lo_load_number", "cr_rate_id"), "lo_load_number", "left")
        .join(t["cr_rate"].select("cr_rate_id", "mode"), "cr_rate_id", "left")
        .select(
            "lo_load_number",
            cl.shipping_mode(
                F.col("lo_load_number"), F.col("cr_carrier_id"), F.col("ltl_carrier"), F.col("name"), F.col("cr_rate_id"),
                F.col("mode"), F.col("destination_whs_id"),
            ).alias("mode"),
        )
    )


@query(
    "on_time_flags",
    f"""SELECT po.lo_purchase_order_id, app.app_appointment_id, {LANDED.format(eta='po.original_eta_date')} AS landed,
      {LANDED.format(eta='COALESCE(app.calculated_eta, po.expect_date)')} AS landed_vs_needby, {APPT} AS appointment_status,
      CAST(COALESCE(app.calculated_eta, po.expect_date) AS DATE) AS need_by_date
    FROM lo_purchase_orders po JOIN app_appointment_pos ap ON po.lo_purchase_order_id = ap.lo_purchase_order_id
    JOIN app_appointments app ON app.app_appointment_id = ap.app_appointment_id""",
)
def _(t):
    rows = t["lo_purchase_orders"].join(t["app_appointment_pos"], PO).join(
        t["app_appointments"].drop("appointment_status"), "app_appointment_id"
    )
    return cl.on_time_flags(rows).select(
        PO, "app_appointment_id", "landed", "landed_vs_needby", "appointment_status", "need_by_date"
    )


@query(
    "backhaul_flag",
    f"""SELECT lo_purchase_order_id, CASE WHEN SUM(CASE WHEN ld.cr_carrier_id = 78 AND ld.source_whs_id IS NULL THEN 1 ELSE 0 END) > 0
      THEN 'YES' ELSE 'NO' END AS backhaul_indicator
    FROM lo_po_loads pl LEFT JOIN lo_loads ld ON pl.lo_load_number = ld.lo_load_number WHERE {LIVE.format('pl')} GROUP BY 1""",
)
def _(t):
    from haulmark.operators.shared import live

    return (
        live(t["lo_po_loads"])
        .join(t["lo_loads"].select("lo_load_number", "cr_carrier_id", "source_whs_id"), "lo_load_number", "left")
        .groupBy(PO)
        .agg(
            F.when(F.max(cl.is_backhaul(F.col("cr_carrier_id"), F.col("source_whs_id"))), "YES")
            .otherwise("NO")
            .alias("backhaul_indicator")
        )
    )


@query(
    "pend_status",
    """SELECT po.lo_purchase_order_id, CASE WHEN po.lo_purchase_order_id IN (SELECT lo_purchase_order_id FROM lo_po_log WHERE d_rte IN ('PEND', 'PND'))
      THEN 1 END AS has_been_in_pend_status FROM lo_purchase_orders po""",
)
def _(t):
    return H.pend_status(t["lo_purchase_orders"].select(PO), t["lo_po_log"])


@query("first_last_order_log", LOG_SQL, "total_units_original total_units_ordered total_weight_original total_weight_ordered")
def _(t):
    return H.first_last_order_log(t["purchaseorderslog"])


@query("load_origin", ORIGIN_SQL.format(more=""))
def _(t):
    return H.load_origin(t["tms_pc_miler_history"])


@query("load_origin_strict", ORIGIN_SQL.format(more=" AND seq_number = 1"))
def _(t):
    return H.load_origin(t["tms_pc_miler_history"], strict=True)
