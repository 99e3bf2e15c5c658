"""Rate-calculator queries and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.base import exact_ratio, mean_of, query
from haulmark.operators import rates as R
from haulmark.operators.shared import live

LIVE = "COALESCE({}.is_deleted, FALSE) = FALSE"


def form_rate(name: str) -> str:
    return f"CASE WHEN w.source_system <> 'UCS' THEN f.default_{name} ELSE f.ucs_{name} END"


CONFIG_ROW = """(SELECT * FROM fp_default_config c WHERE UPPER(RTRIM(c.source_system)) =
   CASE WHEN EXISTS (SELECT 1 FROM fp_default_config c2 WHERE UPPER(RTRIM(c2.source_system)) = w.source_system) THEN w.source_system ELSE 'DEFAULT' END)"""

RATES = f"""(SELECT r.* FROM cr_rate r JOIN cr_carriers c ON r.cr_carrier_id = c.cr_carrier_id
   WHERE c.include_in_freight_pricing AND {LIVE.format('r')} AND {LIVE.format('c')})"""

PROTECTED = "({0}.protection_level = CASE WHEN f.fp_ff_temperature_id = 3 THEN 'Dry' ELSE {0}.protection_level END OR {0}.protection_level IS NULL)"

# All surviving rate pairs of a direct row, lowest ids first.
PICKED = f"""picked AS (SELECT * FROM (SELECT v.fp_freight_form_vendor_id,
    CASE WHEN p.rate IS NOT NULL THEN p.cr_rate_id ELSE r.cr_rate_id END AS picked_rate_id,
    CASE WHEN p.rate IS NOT NULL THEN p.mileage ELSE r.mileage END AS picked_miles,
    CASE WHEN p.rate IS NOT NULL THEN p.cr_carrier_id ELSE r.cr_carrier_id END AS picked_carrier_id,
    COALESCE(CAST(CASE WHEN p.rate_unit = 'Flat' THEN p.rate WHEN p.rate_unit = 'Per Mile' THEN p.rate * p.mileage END AS DECIMAL(10, 3)), 0) AS picked_price,
    ROW_NUMBER() OVER (PARTITION BY v.fp_freight_form_vendor_id ORDER BY p.cr_rate_id, r.cr_rate_id) AS rn
  FROM fp_freight_form_vendor v JOIN fp_freight_form f ON v.fp_freight_form_id = f.fp_freight_form_id
  JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id
  LEFT JOIN fp_ff_pickup_locations pk ON v.fp_ff_pickup_locations_id = pk.fp_ff_pickup_locations_id
  LEFT JOIN {RATES} r ON w.tms_whs_id = r.destination_whs_id AND r.is_cheapest_rate AND pk.city = r.origin_city AND pk.state = r.origin_state
  LEFT JOIN {RATES} p ON w.tms_whs_id = p.destination_whs_id AND p.primary_rate AND pk.city = p.origin_city AND pk.state = p.origin_state
  WHERE v.fp_ff_method_id = 3 AND {LIVE.format('v')} AND {PROTECTED.format('r')} AND {PROTECTED.format('p')}) q WHERE rn = 1)"""

LANES = """lanes AS (SELECT v.fp_freight_form_vendor_id,
    CASE WHEN v.fp_ff_method_id = 1 THEN CAST(0 AS DECIMAL(10, 4)) WHEN v.fp_ff_method_id IN (2, 5) THEN
      (SELECT MIN(miles) FROM fp_ff_crossdock_miles m WHERE v.tms_whs_id = m.destination_whs_id AND v.crossdock_whs_id = m.origin_whs_id) END AS lane_miles,
    CASE WHEN v.fp_ff_method_id IN (2, 5) THEN COALESCE((SELECT MIN(number_of_stops) FROM fp_ff_crossdock_stops s
      WHERE v.tms_whs_id = s.destination_whs_id AND v.crossdock_whs_id = s.origin_whs_id), 0) ELSE 0 END AS lane_stops
  FROM fp_freight_form_vendor v)"""

DOCK = f"""{exact_ratio('({0} * COALESCE(pallets, 0))', 'weight', 9, 6)} + {exact_ratio('all_in', 'lw', 9)} + lumper * lane_stops + extra"""

REPRICED = f"""{PICKED}, {LANES},
base AS (SELECT v.*, w.tms_whs_id IS NOT NULL AS known, l.lane_stops, average_po_weight AS weight, average_pallets_per_po AS pallets,
    CASE WHEN v.fp_ff_method_id = 3 THEN k.picked_miles ELSE l.lane_miles END AS miles, k.picked_rate_id, k.picked_price,
    {', '.join(f'{form_rate(n)} AS f_{n}' for n in R.FORM_RATES)}, c.shuttle_rate_per_mile, c.estimated_lumper_expense AS lumper, c.estimated_accessorial_expense AS extra,
    c.crossdock_pallet_rate AS cfg_x, c.backhaul_pallet_rate AS cfg_b, c.anticipated_backhaul_load_weight, c.anticipated_crossdock_load_weight, c.anticipated_tl_load_weight
  FROM fp_freight_form_vendor v JOIN fp_freight_form f ON v.fp_freight_form_id = f.fp_freight_form_id
  JOIN lanes l ON v.fp_freight_form_vendor_id = l.fp_freight_form_vendor_id
  LEFT JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id
  LEFT JOIN picked k ON v.fp_freight_form_vendor_id = k.fp_freight_form_vendor_id
  LEFT JOIN fp_default_config c ON UPPER(RTRIM(c.source_system)) = CASE WHEN w.source_system IN (SELECT UPPER(RTRIM(source_system)) FROM fp_default_config WHERE source_system IS NOT NULL)
    THEN w.source_system ELSE 'DEFAULT' END
  WHERE {LIVE.format('v')}),
s1 AS (SELECT * REPLACE (CAST(CASE WHEN known THEN CASE fp_ff_method_id WHEN 1 THEN pallets * f_backhaul_pallet_rate
      WHEN 2 THEN pallets * (f_crossdock_pallet_rate + f_backhaul_pallet_rate) + miles * shuttle_rate_per_mile WHEN 3 THEN picked_price
      WHEN 5 THEN pallets * f_crossdock_pallet_rate + miles * shuttle_rate_per_mile END END AS DECIMAL(18, 3)) AS calc_rate,
    CASE WHEN projected_load_weight_override OR NOT known THEN projected_load_weight WHEN fp_ff_method_id = 1 THEN anticipated_backhaul_load_weight
      WHEN fp_ff_method_id IN (2, 5) THEN anticipated_crossdock_load_weight ELSE anticipated_tl_load_weight END AS projected_load_weight) FROM base),
s2 AS (SELECT *, CAST(CASE WHEN known THEN calc_rate + miles * f_tool_fuel_surcharge END AS DECIMAL(18, 3)) AS all_in, COALESCE(NULLIF(projected_load_weight, 0), 1) AS lw,
    CAST(CASE WHEN known THEN COALESCE(proposed_allowance_per_lb, 0) * COALESCE(weight, 0) * total_pos END AS DECIMAL(18, 3)) AS allow FROM s1),
s3 AS (SELECT *, CAST(CASE WHEN weight = 0 OR weight IS NULL OR all_in = 0 OR all_in IS NULL OR NOT known THEN NULL ELSE CASE fp_ff_method_id
      WHEN 1 THEN {exact_ratio('all_in', 'weight', 9)} + lumper + extra WHEN 2 THEN {DOCK.replace('{0}', '(cfg_x + cfg_b)')}
      WHEN 3 THEN {exact_ratio('all_in', 'lw', 9)} + lumper + extra WHEN 5 THEN {DOCK.replace('{0}', 'cfg_x')} END END AS DECIMAL(18, 3)) AS landed FROM s2),
s4 AS (SELECT *, CAST(landed * weight * total_pos AS DECIMAL(18, 3)) AS expense,
    CAST(CASE WHEN booked_freight_override THEN proposed_freight_per_lb WHEN known THEN landed * (COALESCE(f_tool_cooler_freezer_upcharge, 0) + 1) + COALESCE(f_tool_margin_target, 0)
      + COALESCE(f_tool_pff_pfh_upcharge, 0) END AS DECIMAL(18, 3)) AS freight FROM s3),
s5 AS (SELECT *, CAST(freight * weight * total_pos AS DECIMAL(18, 3)) AS booked FROM s4),
repriced AS (SELECT fp_freight_form_vendor_id, fp_freight_form_id, tms_whs_id, fp_ff_method_id, use_east_blended_freight_rate,
  CASE WHEN fp_ff_method_id <> 4 OR projected_load_weight_override THEN projected_load_weight END AS projected_load_weight,
  CASE WHEN fp_ff_method_id <> 4 THEN freight WHEN booked_freight_override THEN freight END AS proposed_freight_per_lb,
  CASE WHEN fp_ff_method_id <> 4 THEN booked END AS proposed_booked_freight, CASE WHEN fp_ff_method_id = 3 THEN picked_rate_id END AS cr_rate_id,
  CASE WHEN fp_ff_method_id <> 4 THEN allow END AS proposed_total_allowance, CASE WHEN fp_ff_method_id <> 4 THEN landed END AS landed_expense_per_lb,
  CASE WHEN fp_ff_method_id <> 4 THEN expense END AS proposed_total_expense, CASE WHEN fp_ff_method_id <> 4 THEN calc_rate END AS calc_rate,
  CASE WHEN fp_ff_method_id <> 4 THEN all_in END AS calc_all_in_rate, CASE WHEN fp_ff_method_id <> 4 THEN allow + booked - expense END AS proposed_projected_margin
FROM s5)"""


def blend_sql(rows: str) -> str:
    def avg(test: str) -> str:
        return f"CAST({mean_of(f'CASE WHEN {test} THEN COALESCE(v.proposed_freight_per_lb, 0) END', 6)} AS DECIMAL(10, 3))"

    groups = {"gilroc": "(1, 114)", "harcar": "(168, 169)", "stksgm": "(160, 214)", "annser": "(178, 186)"}
    cols = [f"{avg('(w.source_system = ' + chr(39) + 'UBS' + chr(39) + ' OR v.use_east_blended_freight_rate) AND v.fp_ff_method_id <> 4')} AS east_blended_freight_rate"]
    cols += [f"{avg(f'w.tms_whs_id IN {ids} AND v.use_east_blended_freight_rate <> TRUE')} AS {n}_blended_freight_rate" for n, ids in groups.items()]
    names = ", ".join(f"{n}_blended_freight_rate" for n in ("east", *groups))
    return f"""SELECT f.fp_freight_form_id, {names} FROM (SELECT fp_freight_form_id FROM fp_freight_form) f LEFT JOIN (SELECT v.fp_freight_form_id, {', '.join(cols)}
  FROM {rows} v JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id GROUP BY 1) b ON f.fp_freight_form_id = b.fp_freight_form_id"""


BLENDS = " ".join(f"{n}_blended_freight_rate" for n in ("east", "gilroc", "harcar", "stksgm", "annser"))
LIVE_ROWS = "(SELECT * FROM fp_freight_form_vendor WHERE COALESCE(is_deleted, FALSE) = FALSE)"
MEASURES = (
    "projected_load_weight proposed_freight_per_lb proposed_booked_freight proposed_total_allowance landed_expense_per_lb proposed_total_expense calc_rate "
    "calc_all_in_rate proposed_projected_margin"
)
KEYS = ("fp_freight_form_vendor_id", "fp_freight_form_id", "tms_whs_id", "fp_ff_method_id", "use_east_blended_freight_rate")


def repriced(t, vendors=None):
    return R.reprice(
        vendors or t["fp_freight_form_vendor"], t["fp_freight_form"], t["tms_whs"], t["fp_default_config"], t["fp_ff_pickup_locations"],
        t["cr_rate"], t["cr_carriers"], t["fp_ff_crossdock_miles"], t["fp_ff_crossdock_stops"],
    )


def _rows_with_whs(t):
    return live(t["fp_freight_form_vendor"]).join(
        t["tms_whs"].select("tms_whs_id", F.col("source_system").alias("whs_system"), F.lit(True).alias("has_warehouse")), "tms_whs_id", "left"
    )


@query(
    "resolve_config",
    f"""SELECT v.fp_freight_form_vendor_id, c.backhaul_pallet_rate AS cfg_backhaul_pallet_rate, c.anticipated_tl_load_weight AS cfg_anticipated_tl_load_weight
    FROM {LIVE_ROWS} v LEFT JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id LEFT JOIN fp_default_config c ON UPPER(RTRIM(c.source_system)) =
      CASE WHEN w.source_system IN (SELECT UPPER(RTRIM(source_system)) FROM fp_default_config WHERE source_system IS NOT NULL) THEN w.source_system ELSE 'DEFAULT' END""",
    "cfg_backhaul_pallet_rate cfg_anticipated_tl_load_weight",
)
def _(t):
    rows = R.resolve_config(_rows_with_whs(t), t["fp_default_config"], "whs_system")
    return rows.select("fp_freight_form_vendor_id", "cfg_backhaul_pallet_rate", "cfg_anticipated_tl_load_weight")


@query(
    "form_rate",
    f"""SELECT v.fp_freight_form_vendor_id, {', '.join(f'{form_rate(n)} AS {n}' for n in R.FORM_RATES)} FROM {LIVE_ROWS} v
    JOIN fp_freight_form f ON v.fp_freight_form_id = f.fp_freight_form_id LEFT JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id""",
    " ".join(R.FORM_RATES),
)
def _(t):
    rows = _rows_with_whs(t).join(t["fp_freight_form"].drop("is_deleted"), "fp_freight_form_id")
    return rows.select(
        "fp_freight_form_vendor_id", *[R.form_rate(n, F.col("whs_system")).alias(n) for n in R.FORM_RATES]
    )


@query("lane_lookup", f"WITH {LANES} SELECT lanes.* FROM lanes JOIN {LIVE_ROWS} v USING (fp_freight_form_vendor_id)", "lane_miles")
def _(t):
    rows = R.lane_lookup(live(t["fp_freight_form_vendor"]), t["fp_ff_crossdock_miles"], t["fp_ff_crossdock_stops"])
    return rows.select("fp_freight_form_vendor_id", "lane_miles", "lane_stops")


@query(
    "pick_carrier_rate",
    f"""WITH {PICKED} SELECT v.fp_freight_form_vendor_id, picked_rate_id, picked_miles, picked_carrier_id, picked_price FROM {LIVE_ROWS} v
    JOIN fp_freight_form f ON v.fp_freight_form_id = f.fp_freight_form_id LEFT JOIN picked k ON v.fp_freight_form_vendor_id = k.fp_freight_form_vendor_id""",
    "picked_miles picked_price",
)
def _(t):
    rows = _rows_with_whs(t).withColumn("has_warehouse", F.coalesce("has_warehouse", F.lit(False)))
    rows = rows.join(t["fp_freight_form"].select("fp_freight_form_id", "fp_ff_temperature_id"), "fp_freight_form_id")
    picked = R.pick_carrier_rate(rows, t["fp_ff_pickup_locations"], t["cr_rate"], t["cr_carriers"])
    return picked.select("fp_freight_form_vendor_id", "picked_rate_id", "picked_miles", "picked_carrier_id", "picked_price")


@query("reprice", f"WITH {REPRICED} SELECT * FROM repriced", MEASURES)
def _(t):
    return repriced(t).select(*KEYS, "cr_rate_id", *MEASURES.split())


@query(
    "calc_rate",
    f"WITH {REPRICED} SELECT fp_freight_form_vendor_id, calc_rate, projected_load_weight FROM s1",
    "calc_rate projected_load_weight",
)
def _(t):
    rows = _rows_with_whs(t).withColumn("has_warehouse", F.coalesce("has_warehouse", F.lit(False)))
    form_columns = [f"{s}_{n}" for s in ("default", "ucs") for n in R.FORM_RATES]
    rows = rows.join(t["fp_freight_form"].select("fp_freight_form_id", "fp_ff_temperature_id", *form_columns), "fp_freight_form_id")
    rows = R.resolve_config(rows, t["fp_default_config"], "whs_system")
    rows = R.lane_lookup(rows, t["fp_ff_crossdock_miles"], t["fp_ff_crossdock_stops"])
    rows = R.pick_carrier_rate(rows, t["fp_ff_pickup_locations"], t["cr_rate"], t["cr_carriers"])
    rows = rows.withColumn("miles", F.when(F.col("fp_ff_method_id") == 3, F.col("picked_miles")).otherwise(F.col("lane_miles")))
    return R.calc_rate(rows).select("fp_freight_form_vendor_id", "calc_rate", "projected_load_weight")


@query(
    "price_steps",
    f"""WITH {REPRICED} SELECT fp_freight_form_vendor_id, CASE WHEN fp_ff_method_id <> 4 THEN all_in END AS calc_all_in_rate,
      CASE WHEN fp_ff_method_id <> 4 THEN allow END AS proposed_total_allowance,
      CASE WHEN fp_ff_method_id <> 4 THEN landed END AS landed_expense_per_lb,
      CASE WHEN fp_ff_method_id <> 4 THEN expense END AS proposed_total_expense,
      CASE WHEN fp_ff_method_id <> 4 OR booked_freight_override THEN freight END AS proposed_freight_per_lb,
      CASE WHEN fp_ff_method_id <> 4 THEN booked END AS proposed_booked_freight,
      CASE WHEN fp_ff_method_id <> 4 THEN allow + booked - expense END AS proposed_projected_margin
    FROM s5""",
    "calc_all_in_rate proposed_total_allowance landed_expense_per_lb proposed_total_expense proposed_freight_per_lb proposed_booked_freight proposed_projected_margin",
)
def _(t):
    return repriced(t).select(
        "fp_freight_form_vendor_id", "calc_all_in_rate", "proposed_total_allowance", "landed_expense_per_lb", "proposed_total_expense",
        "proposed_freight_per_lb", "proposed_booked_freight", "proposed_projected_margin",
    )


@query(
    "vsp_reset",
    f"""SELECT fp_freight_form_vendor_id, CASE WHEN fp_ff_method_id <> 4 OR projected_load_weight_override THEN projected_load_weight END AS projected_load_weight,
      CASE WHEN fp_ff_method_id <> 4 OR booked_freight_override THEN proposed_freight_per_lb END AS proposed_freight_per_lb,
      {', '.join(f'CASE WHEN fp_ff_method_id <> 4 THEN {c} END AS {c}' for c in R.RESET_MEASURES)} FROM {LIVE_ROWS} v""",
    "projected_load_weight proposed_freight_per_lb " + " ".join(c for c in R.RESET_MEASURES if c != "cr_rate_id"),
)
def _(t):
    return R.vsp_reset(live(t["fp_freight_form_vendor"])).select(
        "fp_freight_form_vendor_id", "projected_load_weight", "proposed_freight_per_lb", *R.RESET_MEASURES
    )


@query("blended_rates", blend_sql(LIVE_ROWS), BLENDS)
def _(t):
    return R.blended_rates(t["fp_freight_form"], t["fp_freight_form_vendor"], t["tms_whs"])


@query("reprice_blended_rates", f"WITH {REPRICED} {blend_sql('repriced')}", BLENDS)
def _(t):
    new_rows = repriced(t)
    return R.blended_rates(t["fp_freight_form"], new_rows, t["tms_whs"])


QUICK = REPRICED.replace("FROM fp_freight_form_vendor v", "FROM quick v")
QUICK_ROWS = """quick AS (SELECT * REPLACE (CAST(2 AS BIGINT) AS fp_ff_method_id, CAST(18000 AS DECIMAL(18, 3)) AS projected_load_weight)
  FROM fp_freight_form_vendor WHERE COALESCE(is_deleted, FALSE) = FALSE)"""


@query("quick_set", f"WITH {QUICK_ROWS}, {QUICK} SELECT fp_freight_form_vendor_id, fp_ff_method_id, cr_rate_id, {', '.join(MEASURES.split())} FROM repriced", MEASURES)
def _(t):
    rows = R.quick_set(t["fp_freight_form_vendor"], method_id=2, projected_load_weight=18000)
    return repriced(t, rows).select("fp_freight_form_vendor_id", "fp_ff_method_id", "cr_rate_id", *MEASURES.split())


@query(
    "no_rate_errors",
    f"""WITH {REPRICED} SELECT 'No Rate' AS title, 'No Rate found for this Warehouse ' || w.whs_number || ' ' || w.name AS detail, 'CR_RATE_ID' AS field_name,
      fp_freight_form_id AS form_id, fp_freight_form_vendor_id AS form_vendor_id FROM repriced r JOIN tms_whs w ON r.tms_whs_id = w.tms_whs_id
    WHERE fp_ff_method_id = 3 AND cr_rate_id IS NULL""",
)
def _(t):
    return R.no_rate_errors(repriced(t), t["tms_whs"])


_CHAIN = """CASE WHEN {first} w.source_system = 'UBS' THEN f.east_blended_freight_rate WHEN w.tms_whs_id IN (1, 114) THEN f.gilroc_blended_freight_rate
  WHEN w.tms_whs_id IN (168, 169) THEN f.harcar_blended_freight_rate WHEN w.tms_whs_id IN (160, 214) THEN f.stksgm_blended_freight_rate
  WHEN w.tms_whs_id IN (178, 186) THEN f.annser_blended_freight_rate {last} ELSE v.proposed_freight_per_lb END"""


@query(
    "blended_rate_of",
    f"""SELECT v.fp_freight_form_vendor_id, {_CHAIN.format(first='', last='')} AS rate, {_CHAIN.format(first='', last='WHEN v.fp_ff_method_id = 4 THEN 0')} AS feed_rate,
      CASE WHEN w.tms_whs_id IN (1, 114) THEN 1 WHEN w.tms_whs_id IN (168, 169) THEN 2 WHEN w.tms_whs_id IN (160, 214) THEN 3 WHEN w.tms_whs_id IN (178, 186) THEN 4
        WHEN w.source_system = 'UBS' THEN 5 ELSE 0 END AS code
    FROM {LIVE_ROWS} v JOIN fp_freight_form f ON v.fp_freight_form_id = f.fp_freight_form_id LEFT JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id""",
    "rate feed_rate",
)
def _(t):
    rows = live(t["fp_freight_form_vendor"]).join(t["fp_freight_form"].drop("is_deleted", "projected_load_weight"), "fp_freight_form_id")
    rows = rows.join(t["tms_whs"].select("tms_whs_id", F.col("source_system").alias("whs_system")), "tms_whs_id", "left")
    own, system, whs = F.col("proposed_freight_per_lb"), F.col("whs_system"), F.col("tms_whs_id")
    return rows.select(
        "fp_freight_form_vendor_id",
        R.blended_rate_of(system, whs, own).alias("rate"),
        R.blended_rate_of(system, whs, own, F.col("fp_ff_method_id") == 4, F.lit(0)).alias("feed_rate"),
        R.blended_rate_code(system, whs).alias("code"),
    )


@query(
    "clear_allowance",
    f"""SELECT v.fp_freight_form_vendor_id, CASE WHEN f.fp_ff_allowance_type_id = 1 THEN NULL ELSE v.offered_pickup_allowance END AS offered_pickup_allowance
    FROM {LIVE_ROWS} v JOIN fp_freight_form f ON v.fp_freight_form_id = f.fp_freight_form_id""",
    "offered_pickup_allowance",
)
def _(t):
    return R.clear_allowance(t["fp_freight_form_vendor"], t["fp_freight_form"]).select("fp_freight_form_vendor_id", "offered_pickup_allowance")


@query(
    "fuel_price_at",
    """SELECT l.fp_freight_form_id, l.fuel_date, MIN(p.price) AS fuel_price FROM (
      SELECT fp_freight_form_id, MIN(created_date) AS fuel_date FROM fp_freight_form_log WHERE tms_status_id = 58 GROUP BY 1) l
    LEFT JOIN tms_fuel_avg_price p ON l.fuel_date BETWEEN p.start_date AND p.end_date AND COALESCE(p.is_deleted, FALSE) = FALSE GROUP BY 1, 2""",
    "fuel_price",
)
def _(t):
    return R.fuel_price_at(t["fp_freight_form_log"], t["tms_fuel_avg_price"])
