"""Cost-fact queries and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.base import FIRST_DAY, LAST_DAY, exact_ratio, query, share_of
from haulmark.operators import costs as C

SPAN = f"DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"


def allocation_sql(start: str = FIRST_DAY, end: str = LAST_DAY, more: str = "po.source_system IS NOT NULL") -> str:
    return f"""
SELECT DISTINCT {share_of('s.total_weight', 's.bill_weight', 's.invoice_amount')} AS freight_paid_po,
  lo_purchase_order_id, lo_load_number, bl_billing_id, po_number
FROM (
  SELECT po.lo_purchase_order_id, bp.lo_load_number, b.bl_billing_id, po.po_number, po.total_weight, b.invoice_amount,
    SUM(po.total_weight) OVER (PARTITION BY b.bl_billing_id) AS bill_weight
  FROM lo_purchase_orders po
  JOIN bl_bill_pos bp ON bp.lo_purchase_order_id = po.lo_purchase_order_id AND COALESCE(bp.is_deleted, FALSE) = FALSE
  JOIN bl_billing b ON b.bl_billing_id = bp.bl_billing_id AND b.cr_carrier_id NOT IN (78, 1680, 2629, 69, 2616, 3122)
  WHERE b.bl_billing_id IN (
      SELECT bp2.bl_billing_id FROM lo_purchase_orders p2 JOIN bl_bill_pos bp2
        ON p2.lo_purchase_order_id = bp2.lo_purchase_order_id AND COALESCE(bp2.is_deleted, FALSE) = FALSE
      WHERE CAST(p2.rec_date AS DATE) BETWEEN DATE '{start}' AND DATE '{end}')
    AND po.tms_status_id <> 8 AND {more}) s"""


def gaps_sql(start: str = FIRST_DAY, end: str = LAST_DAY, more: str = "po.source_system IS NOT NULL") -> str:
    return f"""
SELECT po.po_number, po.lo_purchase_order_id, pl.lo_load_number
FROM lo_purchase_orders po
JOIN lo_po_loads pl ON po.lo_purchase_order_id = pl.lo_purchase_order_id AND COALESCE(pl.is_deleted, FALSE) = FALSE
JOIN lo_loads ld ON pl.lo_load_number = ld.lo_load_number AND ld.tms_status_id NOT IN (32)
JOIN cr_carriers cr ON ld.cr_carrier_id = cr.cr_carrier_id
WHERE po.tms_status_id = 9 AND {more}
  AND ld.cr_carrier_id NOT IN (78, 1680, 2496, 1704) AND cr.shuttle_carrier <> TRUE
  AND CAST(po.rec_date AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'
  AND NOT EXISTS (
    SELECT 1 FROM bl_bill_pos bp JOIN bl_billing b ON bp.bl_billing_id = b.bl_billing_id AND COALESCE(bp.is_deleted, FALSE) = FALSE
    WHERE b.invoice_amount > 0 AND bp.lo_purchase_order_id = po.lo_purchase_order_id
      AND bp.lo_load_number = pl.lo_load_number AND b.cr_carrier_id = ld.cr_carrier_id)"""


PALLETS_26 = """CAST(CASE WHEN sized > 26 THEN 26 ELSE sized END AS DECIMAL(10, 3))"""


def pallets_sql(where: str) -> str:
    return f"""
SELECT lo_purchase_order_id, {PALLETS_26} AS max_26pallets_final_calc
FROM (SELECT lo_purchase_order_id,
  CASE WHEN NOT weight_ok AND NOT cube_ok AND by_cube < p THEN by_cube ELSE p END AS sized
  FROM (SELECT lo_purchase_order_id, p, CEIL(total_cubes / 50) AS by_cube,
      COALESCE(total_weight / NULLIF(p, 0) BETWEEN 250 AND 1200, FALSE) AS weight_ok,
      COALESCE(total_cubes / NULLIF(p, 0) BETWEEN 25 AND 100, FALSE) AS cube_ok
    FROM (SELECT *, CEIL(total_pallets) AS p FROM lo_purchase_orders WHERE {where}) a) b) c"""


BACKHAUL_ROWS = """
SELECT po.lo_purchase_order_id, ld.lo_load_number,
  CASE WHEN CEIL(po.total_pallets) > 0 THEN CAST(CEIL(po.total_pallets) AS DECIMAL(16, 0)) *
    CASE WHEN po.dis_whs_id = ld.destination_whs_id THEN phr.backhaul_rate ELSE phr.cross_dock_rate END END AS cost
FROM lo_purchase_orders po
JOIN lo_po_loads pl ON po.lo_purchase_order_id = pl.lo_purchase_order_id AND COALESCE(pl.is_deleted, FALSE) = FALSE
JOIN lo_loads ld ON pl.lo_load_number = ld.lo_load_number AND ld.cr_carrier_id = 78 AND ld.source_whs_id IS NULL
LEFT JOIN fiscal_calendar fc ON CAST(po.rec_date AS DATE) BETWEEN fc.week_start AND fc.week_end
LEFT JOIN pallet_handling_rate phr ON fc.fiscal_year = phr.fiscal_year AND po.source_system = phr.source_system"""


def allocated(t, numbered=True):
    return C.allocate_invoices(t["lo_purchase_orders"], t["bl_bill_pos"], t["bl_billing"], FIRST_DAY, LAST_DAY, numbered=numbered)


def gaps(t, start=FIRST_DAY, end=LAST_DAY):
    return C.not_fully_billed(
        t["lo_purchase_orders"], t["lo_po_loads"], t["lo_loads"], t["bl_bill_pos"], t["bl_billing"],
        t["cr_carriers"], start, end,
    )


@query("allocate_invoices", allocation_sql(), "freight_paid_po")
def _(t):
    return allocated(t)


@query(
    "allocate_invoices_one_system",
    allocation_sql("1996-03-01", "1999-09-30", "UPPER(po.source_system) = 'UBS'"),
    "freight_paid_po",
)
def _(t):
    return C.allocate_invoices(
        t["lo_purchase_orders"], t["bl_bill_pos"], t["bl_billing"], "1996-03-01", "1999-09-30", "ubs"
    )


@query("not_fully_billed", gaps_sql())
def _(t):
    return gaps(t)


@query("fpa_pallets", pallets_sql("tms_status_id = 9 AND source_system IS NOT NULL"), "max_26pallets_final_calc")
def _(t):
    return C.fpa_pallets(t["lo_purchase_orders"], FIRST_DAY, LAST_DAY)


def _backhaul(t, pick):
    return C.backhaul_expense(
        t["lo_purchase_orders"], t["lo_po_loads"], t["lo_loads"], t["fiscal_calendar"],
        t["pallet_handling_rate"], F.ceil("total_pallets"), pick=pick,
    )


@query(
    "backhaul_expense",
    f"SELECT lo_purchase_order_id, SUM(cost) AS backhaul_expense_po, COUNT(*) AS backhaul_loads FROM ({BACKHAUL_ROWS}) r GROUP BY 1",
    "backhaul_expense_po",
)
def _(t):
    return _backhaul(t, "sum")


@query(
    "backhaul_expense_one_load",
    f"""SELECT lo_purchase_order_id, cost AS backhaul_expense_po, n AS backhaul_loads FROM (
      SELECT *, COUNT(*) OVER (PARTITION BY lo_purchase_order_id) AS n,
        ROW_NUMBER() OVER (PARTITION BY lo_purchase_order_id ORDER BY lo_load_number) AS rn FROM ({BACKHAUL_ROWS}) r) x WHERE rn = 1""",
    "backhaul_expense_po",
)
def _(t):
    return _backhaul(t, "one")


@query(
    "po_freight",
    f"SELECT lo_purchase_order_id, SUM(COALESCE(freight_paid_po, 0)) AS freight_paid_po FROM ({allocation_sql()}) a GROUP BY 1",
    "freight_paid_po",
)
def _(t):
    return C.po_freight(allocated(t, numbered=False))


@query(
    "po_revenue",
    f"""SELECT lo_purchase_order_id, r AS total_revenue,
      CASE WHEN total_weight > 0 THEN {exact_ratio('r', 'total_weight')} ELSE 0 END AS total_revenue_lb
    FROM (SELECT *, COALESCE(prod_frt, 0) + ABS(COALESCE(allowance, 0)) AS r FROM lo_purchase_orders) x""",
    "total_revenue total_revenue_lb",
)
def _(t):
    return C.po_revenue(t["lo_purchase_orders"])


@query(
    "bill_status",
    f"""SELECT a.lo_purchase_order_id, a.freight_paid_po, CASE WHEN n.lo_purchase_order_id IS NOT NULL THEN 'Not Fully Billed' END AS bill_status
    FROM (SELECT lo_purchase_order_id, SUM(COALESCE(freight_paid_po, 0)) AS freight_paid_po FROM ({allocation_sql()}) q GROUP BY 1) a
    LEFT JOIN (SELECT DISTINCT lo_purchase_order_id FROM ({gaps_sql()}) g) n ON a.lo_purchase_order_id = n.lo_purchase_order_id""",
    "freight_paid_po",
)
def _(t):
    return C.bill_status(C.po_freight(allocated(t, numbered=False)), gaps(t))


COUNTS_SQL = """SELECT po.lo_purchase_order_id,
  CAST((SELECT NULLIF(COUNT(DISTINCT ld.lo_load_number), 0) FROM lo_po_loads pl JOIN lo_loads ld ON pl.lo_load_number = ld.lo_load_number
    WHERE pl.lo_purchase_order_id = po.lo_purchase_order_id AND COALESCE(pl.is_deleted, FALSE) = FALSE AND ld.cr_carrier_id <> 78) AS INTEGER) AS load_count,
  CAST((SELECT NULLIF(COUNT(DISTINCT bp.bl_billing_id), 0) FROM bl_bill_pos bp
    WHERE bp.lo_purchase_order_id = po.lo_purchase_order_id AND COALESCE(bp.is_deleted, FALSE) = FALSE) AS INTEGER) AS bill_count
FROM lo_purchase_orders po"""


@query("load_and_bill_counts", COUNTS_SQL)
def _(t):
    return C.load_and_bill_counts(
        t["lo_purchase_orders"].select("lo_purchase_order_id"), t["lo_po_loads"], t["lo_loads"], t["bl_bill_pos"]
    )


CURRENT, PRIOR = ("1998-01-01", "1999-12-31"), ("1996-01-01", "1997-12-31")


def unbilled_sql(current=CURRENT, prior=PRIOR) -> str:
    return f"""
SELECT DISTINCT lo_load_number FROM (
  SELECT lo_load_number FROM ({gaps_sql(*current)}) a UNION ALL SELECT lo_load_number FROM ({gaps_sql(*prior)}) b) d
WHERE lo_load_number NOT IN (
  SELECT pl.lo_load_number FROM bl_bill_pos bp
  JOIN lo_po_loads pl ON bp.lo_purchase_order_id = pl.lo_purchase_order_id AND bp.lo_load_number = pl.lo_load_number
  JOIN bl_billing b ON bp.bl_billing_id = b.bl_billing_id AND b.cr_carrier_id <> 66 AND b.invoice_amount > 0
  WHERE COALESCE(pl.is_deleted, FALSE) = FALSE AND COALESCE(bp.is_deleted, FALSE) = FALSE)"""


def unbilled_expense_sql(current=CURRENT, prior=PRIOR) -> str:
    return f"""
SELECT COALESCE(SUM(CASE WHEN w > 0 THEN {exact_ratio('wt', 'w', 6, 6, 3)} ELSE 0 END), 0) AS unbilled_expense
FROM (SELECT n.lo_load_number, SUM(po.total_weight) AS w, SUM(po.total_weight * ca.total) AS wt
  FROM lo_purchase_orders po
  JOIN bl_bill_pos bp ON po.lo_purchase_order_id = bp.lo_purchase_order_id AND COALESCE(bp.is_deleted, FALSE) = FALSE
  JOIN ({unbilled_sql(current, prior)}) n ON n.lo_load_number = bp.lo_load_number
  JOIN cr_agreement ca ON n.lo_load_number = ca.lo_load_number GROUP BY 1) q"""


def unbilled(t, current=CURRENT, prior=PRIOR):
    return C.unbilled_loads([gaps(t, *current), gaps(t, *prior)], t["bl_bill_pos"], t["lo_po_loads"], t["bl_billing"])


@query("unbilled_loads", unbilled_sql())
def _(t):
    return unbilled(t)


@query("unbilled_expense", unbilled_expense_sql(), "unbilled_expense")
def _(t):
    return C.unbilled_expense(unbilled(t), t["bl_bill_pos"], t["lo_purchase_orders"], t["cr_agreement"])
