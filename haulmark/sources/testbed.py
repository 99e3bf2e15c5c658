"""Freight tables derived from the generic star-schema test tables.

Each entry is one SELECT that Spark and an outside SQL engine both run, so a
query and its check start from the same rows. ``[[name]]`` stands for a source
table; ``SERIES(a, b)`` makes one row per step. Every table scales with the
source table it reads: orders become loads and bills, line items become
purchase orders, parts become pricing forms, suppliers become vendors.

The four line-item key columns together identify a purchase order; they are
joined into a text key because no packing of them fits a long at every scale.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _whs(key: str) -> str:
    return (
        f"CASE {key} % 25 WHEN 2 THEN 114 WHEN 3 THEN 168 WHEN 4 THEN 169 WHEN 5 THEN 160 "
        f"WHEN 6 THEN 214 WHEN 7 THEN 178 WHEN 8 THEN 186 ELSE {key} % 25 END"
    )


def _system(key: str) -> str:
    return (
        f"CASE {key} % 5 WHEN 2 THEN 'UBS' WHEN 1 THEN 'WBS' WHEN 0 THEN 'ALB' "
        f"WHEN 3 THEN 'TFF' ELSE 'UCS' END"
    )


def _carrier(key: str) -> str:
    return (
        f"CASE {key} % 25 WHEN 0 THEN 78 WHEN 1 THEN 1680 WHEN 2 THEN 4541 WHEN 3 THEN 66 "
        f"WHEN 4 THEN 69 WHEN 5 THEN 2496 WHEN 6 THEN 78 ELSE 500 + {key} % 25 END"
    )


def _flag(key: str, mod: int, yes: int = 0, null: int = 1) -> str:
    return f"CASE {key} % {mod} WHEN {yes} THEN TRUE WHEN {null} THEN CAST(NULL AS BOOLEAN) ELSE FALSE END"


def _money(expr: str, scale: int = 3) -> str:
    return f"CAST({expr} AS DECIMAL(18, {scale}))"


_PO_ID = (
    "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
    "CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"
)
_SHIP = "CAST(l_shipdate AS DATE)"

TABLES: dict[str, str] = {
    "lo_purchase_orders": f"""
SELECT {_PO_ID} AS lo_purchase_order_id,
  'PO' || CAST(l_orderkey AS STRING) AS po_number,
  CAST(CASE l_partkey % 20 WHEN 0 THEN 8 WHEN 1 THEN 5 ELSE 9 END AS BIGINT) AS tms_status_id,
  CASE WHEN l_partkey % 61 = 0 THEN CAST(NULL AS STRING) ELSE {_system('l_orderkey')} END AS source_system,
  CAST(l_orderkey % 5 AS BIGINT) AS sales_region_id,
  l_suppkey AS tms_vendor_id,
  CASE WHEN l_partkey % 3 = 0 THEN l_suppkey END AS tms_vendor_facility_id,
  CAST(l_suppkey % 25 AS BIGINT) AS tms_buyer,
  CAST({_whs('l_orderkey')} AS BIGINT) AS dis_whs_id,
  CAST(l_partkey % 6 AS BIGINT) AS commodity_code_id,
  CASE WHEN l_linenumber = 4 THEN CAST(NULL AS BIGINT) ELSE CAST(l_linenumber % 4 AS BIGINT) END AS order_type_id,
  CASE WHEN l_returnflag = 'R' THEN 'Non-Revenue PO' ELSE 'Revenue PO' END AS revenue_type,
  l_shipdate AS rec_date,
  {_SHIP} + CAST(l_partkey % 5 - 2 AS INT) AS expect_date,
  {_SHIP} - CAST(l_partkey % 4 AS INT) AS request_date,
  {_SHIP} + CAST(l_suppkey % 3 - 1 AS INT) AS original_eta_date,
  {_SHIP} - CAST(5 AS INT) AS original_pickup_date,
  CASE WHEN l_partkey % 50 = 7 THEN {_money('0')}
    ELSE {_money("CAST(l_quantity AS BIGINT) * (90 + l_partkey % 331)")} END AS total_weight,
  {_money("CAST(l_quantity AS BIGINT) * 12")} AS total_units,
  CASE l_suppkey % 11 WHEN 0 THEN CAST(NULL AS DECIMAL(18, 3)) WHEN 1 THEN {_money('0')}
    ELSE {_money("CAST(l_quantity AS DECIMAL(10, 0)) * CAST(0.375 AS DECIMAL(4, 3)) * CAST(1 + l_suppkey % 3 AS DECIMAL(4, 0))")} END AS total_pallets,
  {_money("CAST(l_quantity AS BIGINT) * (4 + l_partkey % 47)")} AS total_cubes,
  {_money("CASE WHEN l_partkey % 7 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END")} AS frz_units,
  {_money("CASE WHEN l_partkey % 5 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END")} AS chl_units,
  {_money("CASE WHEN l_partkey % 2 = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END")} AS dry_units,
  {_money("CASE WHEN l_partkey % 9 = 0 THEN CAST(l_quantity AS BIGINT) END")} AS rpk_units,
  CASE WHEN l_partkey % 23 = 5 THEN CAST(NULL AS DECIMAL(18, 3))
    ELSE {_money("CAST(l_extendedprice AS DECIMAL(14, 2)) * CAST(l_tax AS DECIMAL(4, 2))")} END AS prod_frt,
  CASE WHEN l_partkey % 19 = 3 THEN CAST(NULL AS DECIMAL(18, 3))
    ELSE {_money("CAST(-l_extendedprice AS DECIMAL(14, 2)) * CAST(l_discount AS DECIMAL(4, 2))")} END AS allowance,
  {_money("CAST(l_extendedprice AS DECIMAL(14, 2))")} AS po_dollar_value,
  'R' || CAST(l_suppkey % 17 AS STRING) AS d_rte,
  'A' || CAST(l_suppkey % 13 AS STRING) AS alt_rte_1
FROM [[lineitem]]""",
    "lo_po_loads": f"""
SELECT l_orderkey * 16 + l_linenumber * 2 AS lo_po_loads_id, {_PO_ID} AS lo_purchase_order_id,
  l_orderkey * 2 AS lo_load_number,
  {_flag('l_partkey', 29)} AS is_deleted
FROM [[lineitem]] WHERE l_linenumber <> 7
UNION ALL
SELECT l_orderkey * 16 + l_linenumber * 2 + 1 AS lo_po_loads_id, {_PO_ID} AS lo_purchase_order_id,
  l_orderkey * 2 + 1 AS lo_load_number,
  CAST(NULL AS BOOLEAN) AS is_deleted
FROM [[lineitem]] WHERE l_linenumber = 1""",
    "lo_loads": f"""
SELECT o_orderkey * 2 AS lo_load_number,
  CAST({_carrier('o_custkey')} AS BIGINT) AS cr_carrier_id,
  CASE WHEN o_custkey % 8 = 3 THEN CAST({_whs('o_custkey')} AS BIGINT) END AS source_whs_id,
  CASE WHEN o_custkey % 3 = 0 THEN CAST({_whs('o_custkey')} AS BIGINT) ELSE CAST({_whs('o_orderkey')} AS BIGINT) END AS destination_whs_id,
  CAST(CASE WHEN o_custkey % 31 = 0 THEN 32 ELSE 30 END AS BIGINT) AS tms_status_id,
  o_custkey % 25 AS tms_master_route_id, o_custkey AS created_by
FROM [[orders]]
UNION ALL
SELECT o_orderkey * 2 + 1 AS lo_load_number,
  CAST({_carrier('(o_custkey + o_orderkey)')} AS BIGINT) AS cr_carrier_id,
  CASE WHEN o_custkey % 6 = 1 THEN CAST({_whs('o_custkey')} AS BIGINT) END AS source_whs_id,
  CAST({_whs('o_orderkey')} AS BIGINT) AS destination_whs_id,
  CAST(30 AS BIGINT) AS tms_status_id,
  CAST(NULL AS BIGINT) AS tms_master_route_id, o_custkey AS created_by
FROM [[orders]]""",
    "bl_bill_pos": f"""
SELECT {_PO_ID} AS lo_purchase_order_id, l_orderkey AS bl_billing_id, l_orderkey * 2 AS lo_load_number,
  {_flag('l_partkey', 37)} AS is_deleted
FROM [[lineitem]] WHERE l_linenumber <> 7""",
    "bl_billing": f"""
SELECT o_orderkey AS bl_billing_id,
  CAST(CASE WHEN o_orderkey % 5 = 3 THEN {_carrier('(o_custkey + 1)')} ELSE {_carrier('o_custkey')} END AS BIGINT) AS cr_carrier_id,
  o_orderkey * 2 AS lo_load_number,
  CASE WHEN o_orderkey % 11 = 0 THEN {_money('0')} ELSE {_money('CAST(o_totalprice AS DECIMAL(14, 2))')} END AS invoice_amount
FROM [[orders]] WHERE o_orderstatus <> 'O'""",
    "cr_carriers": f"""
SELECT CAST({_carrier('n_nationkey')} AS BIGINT) AS cr_carrier_id, 'Carrier ' || n_name AS name,
  CASE n_nationkey % 9 WHEN 8 THEN TRUE WHEN 7 THEN CAST(NULL AS BOOLEAN) ELSE FALSE END AS shuttle_carrier,
  {_flag('n_nationkey', 4)} AS ltl_carrier,
  n_nationkey % 3 <> 1 AS include_in_freight_pricing,
  {_flag('n_nationkey', 13, 11, 5)} AS is_deleted
FROM [[nation]] WHERE n_nationkey <> 6""",
    "cr_agreement": f"""
SELECT o_orderkey * 2 AS lo_load_number, CASE WHEN o_orderkey % 7 = 2 THEN CAST(NULL AS BIGINT) ELSE o_custkey END AS cr_rate_id,
  {_money('CAST(o_totalprice AS DECIMAL(14, 2)) * CAST(0.1 AS DECIMAL(2, 1))')} AS total,
  {_flag('o_orderkey', 17, 5, 6)} AS is_deleted
FROM [[orders]] WHERE o_orderkey % 3 <> 1""",
    "cr_rate": f"""
SELECT p_partkey AS cr_rate_id, CAST({_carrier('p_partkey')} AS BIGINT) AS cr_carrier_id,
  CAST({_whs('(p_partkey * 3)')} AS BIGINT) AS destination_whs_id,
  'City ' || CAST(p_size % 10 AS STRING) AS origin_city, 'S' || CAST(p_size % 10 AS STRING) AS origin_state,
  CASE p_partkey % 4 WHEN 0 THEN 'Dry' WHEN 1 THEN 'Frozen' WHEN 2 THEN CAST(NULL AS STRING) ELSE 'Chill' END AS protection_level,
  CASE p_partkey % 3 WHEN 0 THEN 'Flat' WHEN 1 THEN 'Per Mile' ELSE 'Per Stop' END AS rate_unit,
  CASE p_partkey % 2 WHEN 0 THEN 'TL' ELSE 'IM' END AS mode,
  CAST(CAST(p_retailprice AS DECIMAL(9, 2)) AS DECIMAL(10, 3)) AS rate,
  CAST(100 + p_partkey % 900 AS DECIMAL(10, 4)) AS mileage,
  p_partkey % 5 = 0 AS is_cheapest_rate, p_partkey % 7 = 0 AS primary_rate,
  {_flag('p_partkey', 41)} AS is_deleted
FROM [[part]]""",
    "tms_vendor": f"""
SELECT s_suppkey AS tms_vendor_id, 'V' || CAST(s_suppkey - s_suppkey % 8 AS STRING) AS vendor_number, s_name AS name,
  CASE WHEN s_suppkey % 14 = 13 THEN CAST(NULL AS BIGINT) ELSE s_suppkey - s_suppkey % 10 END AS remit_vendor,
  CAST({_whs('s_nationkey')} AS BIGINT) AS tms_whs_id,
  CAST(s_suppkey % 5 AS BIGINT) AS tms_allowance_type_id,
  'Street ' || CAST(s_suppkey AS STRING) AS address1, 'Town ' || CAST(s_suppkey % 40 AS STRING) AS city,
  'S' || CAST(s_suppkey % 10 AS STRING) AS state, CAST(10000 + s_suppkey % 90000 AS STRING) AS zip,
  {_system('s_nationkey')} AS source_system,
  {_money('CAST(s_acctbal AS DECIMAL(14, 2)) * CAST(0.0001 AS DECIMAL(5, 4))', 6)} AS booked_freight_per_lb,
  {_flag('s_suppkey', 9)} AS is_transfer_vendor, {_flag('s_suppkey', 33)} AS is_deleted
FROM [[supplier]]""",
    "tms_vendor_facility": """
SELECT s_suppkey AS tms_vendor_facility_id, 'Dock ' || CAST(s_suppkey AS STRING) AS address1,
  CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE 'Port ' || CAST(s_suppkey % 30 AS STRING) END AS city,
  'S' || CAST(s_suppkey % 9 AS STRING) AS state, CAST(20000 + s_suppkey % 70000 AS STRING) AS zip
FROM [[supplier]] WHERE s_suppkey % 6 <> 4""",
    "tms_whs": f"""
SELECT CAST({_whs('n_nationkey')} AS BIGINT) AS tms_whs_id, 'W' || CAST(100 + n_nationkey AS STRING) AS whs_number, n_name AS name,
  CASE WHEN n_nationkey = 24 THEN CAST(NULL AS STRING) ELSE {_system('n_regionkey')} END AS source_system,
  'Gate ' || CAST(n_nationkey AS STRING) AS address1, 'Metro ' || CAST(n_nationkey AS STRING) AS city,
  CAST(30000 + n_nationkey AS STRING) AS zip, 'dock' || CAST(n_nationkey AS STRING) || '@example.com' AS backhaul_email,
  CASE WHEN n_nationkey % 10 = 9 THEN CAST({_whs('(n_nationkey - 1)')} AS BIGINT) END AS campus_whs_id,
  CASE WHEN n_nationkey % 10 = 4 THEN CAST(NULL AS BOOLEAN) ELSE n_nationkey <> 7 END AS include_in_freight_pricing,
  CAST(CASE WHEN n_nationkey = 21 THEN TRUE END AS BOOLEAN) AS is_deleted
FROM [[nation]]""",
    "whs_reference_data": f"""
SELECT {_system('n_regionkey')} AS source_system, CAST({_whs('n_nationkey')} AS BIGINT) AS tms_whs_id,
  'H' || CAST(n_nationkey AS STRING) AS whs_number
FROM [[nation]] WHERE n_nationkey <> 19""",
    "tms_buyer": """
SELECT CAST(n_nationkey AS BIGINT) AS tms_buyer_id, 'Buyer ' || n_name AS name, 'b' || CAST(n_nationkey AS STRING) || '@example.com' AS email
FROM [[nation]]""",
    "sales_region": """
SELECT CAST(r_regionkey AS BIGINT) AS sales_region_id, r_name AS sales_region_name FROM [[region]]""",
    "commodity_codes": """
SELECT CAST(r_regionkey AS BIGINT) AS commodity_code_id, 'Goods ' || r_name AS commodity_code_description,
  CASE r_regionkey WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS is_deleted FROM [[region]]""",
    "order_types": """
SELECT CAST(r_regionkey AS BIGINT) AS order_type_id, 'Type ' || r_name AS order_type_description FROM [[region]]""",
    "fiscal_calendar": """
SELECT CAST(extract(YEAR FROM week_start) AS INT) AS fiscal_year,
  CAST(LEAST(13, 1 + FLOOR(FLOOR((dayofyear(week_start) - 1) / 7) / 4)) AS INT) AS period,
  CAST(LEAST(4, 1 + FLOOR(FLOOR((dayofyear(week_start) - 1) / 7) / 13)) AS INT) AS quarter,
  CAST(1 + FLOOR((dayofyear(week_start) - 1) / 7) AS INT) AS week,
  week_start, week_start + CAST(6 AS INT) AS week_end
FROM (SELECT CAST(day AS DATE) AS week_start FROM (
  SELECT SERIES(first_day, last_day, INTERVAL '7' DAY) AS day FROM (
    SELECT CAST(MIN(o_orderdate) AS DATE) AS first_day, CAST(MAX(o_orderdate) AS DATE) AS last_day FROM [[orders]]) spans) days) weeks""",
    "pallet_handling_rate": f"""
SELECT CAST(fiscal_year AS INT) AS fiscal_year, {_system('r_regionkey')} AS source_system,
  CAST(20 + r_regionkey + fiscal_year % 10 + 0.25 AS DECIMAL(10, 3)) AS backhaul_rate,
  CAST(7 + r_regionkey + fiscal_year % 10 + 0.125 AS DECIMAL(10, 3)) AS cross_dock_rate
FROM (SELECT r_regionkey, SERIES(1994, 2000) AS fiscal_year FROM [[region]]) rates""",
    "fp_default_config": """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS fp_default_config_id,
  CAST(7 + r_regionkey AS DECIMAL(10, 3)) AS crossdock_pallet_rate, CAST(23 + r_regionkey AS DECIMAL(10, 3)) AS backhaul_pallet_rate,
  CAST(2.87 AS DECIMAL(10, 3)) AS shuttle_rate_per_mile, CAST(0.63 AS DECIMAL(10, 3)) AS fuel_surcharge,
  CAST(0.016 AS DECIMAL(10, 3)) AS estimated_lumper_expense, CAST(0.003 AS DECIMAL(10, 3)) AS estimated_accessorial_expense,
  CAST(23532 AS DECIMAL(10, 3)) AS anticipated_crossdock_load_weight, CAST(20000 + 100 * r_regionkey AS DECIMAL(10, 3)) AS anticipated_tl_load_weight,
  CAST(30000 AS DECIMAL(10, 3)) AS anticipated_backhaul_load_weight,
  CASE WHEN r_regionkey = 1 THEN CAST(NULL AS INT) ELSE CAST(60 + 6 * r_regionkey AS INT) END AS supplier_screen_months_back,
  CAST(54 + 6 * r_regionkey AS INT) AS margin_loss_report_months_back,
  CASE r_regionkey WHEN 0 THEN 'ubs' WHEN 1 THEN 'WBS ' WHEN 2 THEN 'UCS' WHEN 3 THEN 'DEFAULT' END AS source_system
FROM [[region]]""",
    "bl_budget_data": f"""
SELECT CAST(budget_year AS INT) AS budget_year, CAST(budget_period AS INT) AS budget_period,
  CASE r_regionkey WHEN 2 THEN 'ubs' ELSE {_system('r_regionkey')} END AS source_system,
  CAST(100000 + 1000 * budget_period + 100 * r_regionkey + 10 * version + orders AS DECIMAL(18, 2)) AS budget_collect_lbs,
  CAST(40000 + 900 * budget_period + 70 * version AS DECIMAL(18, 2)) AS budget_vsp_lbs,
  CAST(9000 + 17 * budget_period + budget_year AS DECIMAL(18, 2)) AS budget_booked_freight,
  CAST(1500 + 13 * r_regionkey + version AS DECIMAL(18, 2)) AS budget_allowance,
  CAST(7000 + 11 * budget_period AS DECIMAL(18, 2)) AS budget_expense,
  CASE WHEN r_regionkey = 3 THEN CAST(0 AS DECIMAL(18, 2)) ELSE CAST(98000 + 990 * budget_period + 9 * version AS DECIMAL(18, 2)) END AS forecast_collect_lbs,
  CAST(39000 + 890 * budget_period + 7 * version AS DECIMAL(18, 2)) AS forecast_vsp_lbs,
  CAST(8800 + 15 * budget_period + version AS DECIMAL(18, 2)) AS forecast_booked_freight,
  CAST(1400 + 12 * r_regionkey AS DECIMAL(18, 2)) AS forecast_allowance,
  CAST(6900 + 10 * budget_period + version + orders AS DECIMAL(18, 2)) AS forecast_expense,
  CAST(1300 + 7 * budget_period + version AS DECIMAL(18, 2)) AS actual_east_allowance,
  CAST('1994-01-01' AS DATE) + CAST(version * 11 + budget_period AS INT) AS created_date
FROM (SELECT r_regionkey, budget_year, budget_period, orders, SERIES(1, 3) AS version FROM (
  SELECT r_regionkey, budget_year, budget_period, COUNT(*) AS orders FROM (
    SELECT CAST(o_orderkey % 5 AS INT) AS r_regionkey, CAST(extract(YEAR FROM o_orderdate) AS INT) AS budget_year,
      CAST(LEAST(13, 1 + FLOOR((dayofyear(CAST(o_orderdate AS DATE)) - 1) / 28)) AS INT) AS budget_period FROM [[orders]]) o
  GROUP BY r_regionkey, budget_year, budget_period) g) v""",
    "app_appointments": f"""
SELECT o_orderkey AS app_appointment_id,
  CASE WHEN o_orderkey % 13 = 4 THEN CAST({_whs('o_custkey')} AS BIGINT) ELSE CAST({_whs('o_orderkey')} AS BIGINT) END AS tms_whs_id,
  CAST(o_orderkey % 16 AS INT) AS appointment_status,
  o_orderdate + INTERVAL '45' DAY AS appointment_date,
  CASE o_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate + INTERVAL '45' DAY + INTERVAL '30' MINUTE
    WHEN 2 THEN o_orderdate + INTERVAL '45' DAY + INTERVAL '31' MINUTE WHEN 3 THEN o_orderdate + INTERVAL '45' DAY + INTERVAL '1859' SECOND
    WHEN 4 THEN o_orderdate + INTERVAL '30' DAY WHEN 5 THEN o_orderdate + INTERVAL '90' DAY ELSE o_orderdate + INTERVAL '44' DAY END AS datetimelanded,
  CASE WHEN o_custkey % 2 = 0 THEN o_orderdate + INTERVAL '46' DAY END AS calculated_eta
FROM [[orders]]""",
    "app_appointment_pos": f"""
SELECT l_orderkey AS app_appointment_id, {_PO_ID} AS lo_purchase_order_id, {_flag('l_partkey', 43)} AS is_deleted
FROM [[lineitem]]""",
    "lo_po_log": f"""
SELECT {_PO_ID} AS lo_purchase_order_id,
  CASE l_suppkey % 12 WHEN 0 THEN 'PEND' WHEN 1 THEN 'PND' ELSE 'R' || CAST(l_suppkey % 17 AS STRING) END AS d_rte
FROM [[lineitem]] WHERE l_linenumber % 2 = 1""",
    "purchaseorderslog": """
SELECT event_id AS purchaseorderlogid, 'PO' || CAST(event_id - event_id % 4 AS STRING) AS po_number,
  CAST(CASE WHEN event_id % 29 = 0 THEN 0 ELSE 10 + event_id % 50 END AS DECIMAL(18, 3)) AS total_units,
  CAST(100 + user_id AS DECIMAL(18, 3)) AS total_weight,
  CASE WHEN event_id % 31 = 0 THEN 'soon' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS request_date,
  CASE WHEN event_id % 37 = 0 THEN '' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS expect_date,
  CASE event_type WHEN 'error' THEN 'DEL' WHEN 'signup' THEN 'RCV' ELSE 'OPN' END AS status
FROM [[events]]""",
    "apvenmast": """
SELECT s_suppkey AS vendor, 'Remit ' || s_name AS vendor_vname FROM [[supplier]] WHERE s_suppkey % 10 = 0""",
    "tms_pc_miler_history": f"""
SELECT l_orderkey * 2 AS load_number, CAST(l_linenumber AS INT) AS seq_number, 'Stop ' || CAST(l_suppkey AS STRING) AS city,
  'S' || CAST(l_suppkey % 10 AS STRING) AS st, CAST(10000 + l_suppkey AS STRING) AS zip, {_flag('l_partkey', 53)} AS is_deleted
FROM [[lineitem]]""",
    "tms_master_route": """
SELECT CAST(n_nationkey AS BIGINT) AS tms_master_route_id, 'Master ' || n_name AS master_route FROM [[nation]]""",
    "sec_users": """
SELECT c_custkey AS sec_users_id, 'u' || CAST(c_custkey AS STRING) AS user_name, 'First' || CAST(c_custkey AS STRING) AS first_name,
  c_name AS last_name, 'u' || CAST(c_custkey AS STRING) || '@example.com' AS email_address, c_custkey % 10 = 0 AS super_admin
FROM [[customer]]""",
    "sec_user_roles": f"""
SELECT c_custkey AS sec_users_id, c_custkey % 7 AS sec_roles_id, {_flag('c_custkey', 11)} AS is_deleted FROM [[customer]]
UNION ALL
SELECT c_custkey AS sec_users_id, c_custkey % 5 AS sec_roles_id, CAST(NULL AS BOOLEAN) AS is_deleted FROM [[customer]] WHERE c_custkey % 2 = 0""",
    "sec_roles": """
SELECT CAST(r_regionkey AS BIGINT) AS sec_roles_id, CASE WHEN r_regionkey = 4 THEN TRUE END AS is_deleted FROM [[region]]""",
    "fp_escalation_roles": """
SELECT CAST(r_regionkey AS BIGINT) AS sec_roles_id, CASE r_regionkey WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'A' END AS fp_escalation_class
FROM [[region]] WHERE r_regionkey <> 3""",
    "fp_freight_form": """
SELECT p_partkey AS fp_freight_form_id, CAST(1 + p_partkey % 4 AS BIGINT) AS fp_ff_type_id,
  CAST(p_partkey % 4 AS BIGINT) AS fp_ff_temperature_id, CAST(p_partkey % 3 AS BIGINT) AS fp_ff_temperature_protection_id,
  CASE WHEN p_partkey % 29 = 4 THEN CAST(NULL AS BIGINT) ELSE CAST(p_partkey % 5 AS BIGINT) END AS fp_ff_allowance_type_id,
  CASE p_partkey % 15 WHEN 0 THEN CAST(53 AS BIGINT) WHEN 1 THEN 54 WHEN 2 THEN 55 WHEN 3 THEN 56 WHEN 4 THEN 57 WHEN 5 THEN 58 WHEN 6 THEN 59
    WHEN 7 THEN 60 WHEN 8 THEN 61 WHEN 9 THEN 62 WHEN 10 THEN 67 WHEN 11 THEN 66 WHEN 12 THEN 62 WHEN 13 THEN 58 ELSE 62 END AS tms_status_id,
  CASE WHEN p_partkey % 6 = 0 THEN CAST(NULL AS BIGINT) ELSE p_partkey - p_partkey % 10 END AS remit_number,
  CASE WHEN p_partkey % 8 = 1 THEN CAST(NULL AS BIGINT) ELSE CAST(p_partkey % 20 AS BIGINT) END AS tms_srm_id,
  CAST(p_partkey % 5 AS BIGINT) AS lo_load_temperatures_id,
  CASE WHEN p_partkey % 13 = 2 THEN CAST(NULL AS BIGINT) ELSE p_partkey % 100 END AS freight_analyst_user_id,
  CASE WHEN p_partkey % 17 = 3 THEN CAST(NULL AS BIGINT) ELSE CAST(p_partkey % 6 AS BIGINT) END AS fp_ff_freight_change_reason_id,
  CASE WHEN p_partkey % 19 = 7 THEN CAST(NULL AS STRING) ELSE 'Maker ' || p_brand END AS supplier_name,
  CAST('2001-01-01' AS DATE) + CAST(p_partkey % 300 AS INT) AS submit_date,
  CAST(0.025 + (p_partkey % 3) AS DECIMAL(10, 3)) AS default_tool_pff_pfh_upcharge,
  CASE WHEN p_partkey % 9 = 0 THEN CAST(NULL AS DECIMAL(10, 3)) ELSE CAST(0.35 AS DECIMAL(10, 3)) END AS default_tool_cooler_freezer_upcharge,
  CAST(0.065 AS DECIMAL(10, 3)) AS default_tool_margin_target, CAST(0.63 AS DECIMAL(10, 3)) AS default_tool_fuel_surcharge,
  CAST(23 + p_partkey % 4 AS DECIMAL(10, 3)) AS default_backhaul_pallet_rate, CAST(7 + p_partkey % 3 AS DECIMAL(10, 3)) AS default_crossdock_pallet_rate,
  CAST(6 AS DECIMAL(10, 3)) AS ucs_tool_pff_pfh_upcharge, CAST(4 AS DECIMAL(10, 3)) AS ucs_tool_cooler_freezer_upcharge,
  CAST(5 AS DECIMAL(10, 3)) AS ucs_tool_margin_target, CAST(1 AS DECIMAL(10, 3)) AS ucs_tool_fuel_surcharge,
  CAST(3 AS DECIMAL(10, 3)) AS ucs_backhaul_pallet_rate, CAST(2 AS DECIMAL(10, 3)) AS ucs_crossdock_pallet_rate,
  CAST(0.111 + p_partkey % 7 AS DECIMAL(10, 3)) AS east_blended_freight_rate, CAST(0.222 + p_partkey % 7 AS DECIMAL(10, 3)) AS gilroc_blended_freight_rate,
  CAST(0.333 + p_partkey % 7 AS DECIMAL(10, 3)) AS harcar_blended_freight_rate,
  CASE WHEN p_partkey % 6 = 1 THEN CAST(NULL AS DECIMAL(10, 3)) ELSE CAST(0.444 + p_partkey % 7 AS DECIMAL(10, 3)) END AS stksgm_blended_freight_rate,
  CAST(0.555 + p_partkey % 7 AS DECIMAL(10, 3)) AS annser_blended_freight_rate,
  CASE p_partkey % 10 WHEN 3 THEN TRUE WHEN 4 THEN CAST(NULL AS BOOLEAN) ELSE FALSE END AS is_implied_rate,
  p_partkey % 21 = 5 AS rejected_vsp_flag, p_partkey % 2 = 0 AS is_hub_and_spoke, p_partkey % 3 = 0 AS is_hub_and_spoke_vsp,
  p_partkey % 4 = 0 AS is_vsp_crossdock, p_partkey % 5 = 0 AS is_price_list_submitted,
  p_partkey % 2 = 1 AS margin_target, p_partkey % 3 = 1 AS pff_pfh_up_charge,
  CASE p_partkey % 47 WHEN 5 THEN TRUE WHEN 6 THEN FALSE END AS is_deleted
FROM [[part]]""",
    "fp_freight_form_vendor": f"""
SELECT k AS fp_freight_form_vendor_id, p_partkey AS fp_freight_form_id,
  CASE WHEN k % 26 = 9 THEN CAST(NULL AS BIGINT) ELSE s_suppkey END AS tms_vendor_id,
  CASE WHEN k % 81 = 8 THEN CAST(999 AS BIGINT) WHEN k % 8 = 5 THEN CAST(12 AS BIGINT) ELSE CAST({_whs('s_nationkey')} AS BIGINT) END AS tms_whs_id,
  CASE WHEN k % 30 = 4 THEN CAST(NULL AS BIGINT) ELSE p_partkey * 2 + k % 2 END AS fp_ff_pickup_locations_id,
  CASE WHEN k % 4 = 1 THEN k % 1000 END AS cr_rate_id, CAST(NULL AS BIGINT) AS fp_ff_crossdock_stops_id,
  CASE WHEN k % 31 = 6 THEN CAST(NULL AS BIGINT) ELSE 1 + k % 5 END AS fp_ff_method_id,
  CASE WHEN k % 3 <> 0 THEN CAST({_whs('(k + 7)')} AS BIGINT) END AS crossdock_whs_id,
  CAST(1 + k % 9 AS DECIMAL(18, 3)) AS total_pos,
  {_money('CAST(p_retailprice AS DECIMAL(9, 2)) * 0.5')} AS total_margin, {_money('CAST(p_retailprice AS DECIMAL(9, 2)) * 0.2')} AS total_allowance,
  CASE WHEN k % 7 = 0 THEN CAST(NULL AS DECIMAL(18, 3)) ELSE {_money('CAST(p_retailprice AS DECIMAL(9, 2)) * 0.4')} END AS total_booked_freight,
  CASE WHEN k % 5 = 3 THEN CAST(NULL AS DECIMAL(18, 3)) ELSE {_money('CAST(k % 90 AS DECIMAL(5, 0)) * 0.01')} END AS offered_pickup_allowance,
  CASE k % 23 WHEN 2 THEN CAST(0 AS DECIMAL(18, 3)) WHEN 3 THEN CAST(NULL AS DECIMAL(18, 3)) ELSE CAST(500 + k % 4000 AS DECIMAL(18, 3)) END AS average_po_weight,
  CAST(20 + k % 300 AS DECIMAL(18, 3)) AS average_po_units,
  CASE WHEN k % 37 = 5 THEN CAST(NULL AS DECIMAL(18, 3)) ELSE CAST(1 + k % 24 AS DECIMAL(18, 3)) END AS average_pallets_per_po,
  CAST(30 + k % 200 AS DECIMAL(18, 3)) AS average_po_cubes,
  {_money('CAST(p_retailprice AS DECIMAL(9, 2)) * 1.5')} AS proposed_total_expense, CAST(15000 + k % 5000 AS DECIMAL(18, 3)) AS projected_load_weight,
  CASE WHEN k % 6 = 5 THEN CAST(NULL AS DECIMAL(18, 6)) ELSE {_money('CAST(k % 70 AS DECIMAL(5, 0)) * 0.0125', 6)} END AS proposed_allowance_per_lb,
  CASE WHEN k % 11 = 7 THEN CAST(NULL AS DECIMAL(18, 6)) ELSE {_money('CAST(k % 130 AS DECIMAL(5, 0)) * 0.003125', 6)} END AS proposed_freight_per_lb,
  CAST(k % 500 AS DECIMAL(18, 3)) AS proposed_total_allowance, CAST(k % 700 AS DECIMAL(18, 3)) AS proposed_booked_freight,
  CAST(k % 200 AS DECIMAL(18, 3)) AS proposed_projected_margin,
  {_money('CAST(k % 50 AS DECIMAL(5, 0)) * 0.002', 6)} AS booked_freight_per_lb, {_money('CAST(k % 40 AS DECIMAL(5, 0)) * 0.003', 6)} AS allowance_per_lb,
  {_money('CAST(k % 30 AS DECIMAL(5, 0)) * 0.004', 6)} AS letter_freight_per_lb, {_money('CAST(k % 20 AS DECIMAL(5, 0)) * 0.005', 6)} AS landed_expense_per_lb,
  CAST(k % 900 AS DECIMAL(18, 3)) AS calc_rate, CAST(k % 950 AS DECIMAL(18, 3)) AS calc_all_in_rate,
  {_flag('k', 14, 3, 4)} AS booked_freight_override, {_flag('k', 16, 5, 6)} AS projected_load_weight_override,
  CASE WHEN k % 3 = 0 THEN CAST(NULL AS BIGINT) ELSE k % 5 END AS current_allowance_type_id,
  CASE WHEN k % 4 = 0 AND p_partkey % 5 <> 2 THEN CAST(CAST(k % 60 AS DECIMAL(5, 0)) * 0.5 AS DECIMAL(10, 3)) END AS current_allowance,
  CASE WHEN p_partkey % 4 = 1 THEN {_flag('k', 2, 0, 9)} ELSE {_flag('k', 33, 1, 2)} END AS processed_flag,
  CAST('2001-03-01' AS DATE) + CAST(k % 400 AS INT) AS effective_date,
  {_money('CAST(k % 60 AS DECIMAL(5, 0)) * 0.01', 6)} AS current_freight_rate, CAST(k % 800 AS DECIMAL(18, 3)) AS current_expense,
  k % 12 = 7 AS use_east_blended_freight_rate, {_flag('k', 28, 7, 8)} AS is_deleted
FROM (SELECT p_partkey, p_retailprice, p_partkey * 8 + i AS k, (p_partkey * 5 + i * 17) % (SELECT COUNT(*) FROM [[supplier]]) AS vendor_key
      FROM (SELECT p_partkey, p_retailprice, SERIES(0, 5) AS i FROM [[part]] WHERE p_partkey % 53 <> 1) r) f
JOIN [[supplier]] ON s_suppkey = vendor_key""",
    "fp_ff_pickup_locations": """
SELECT p_partkey * 2 + i AS fp_ff_pickup_locations_id, p_partkey AS fp_freight_form_id, 'Pickup ' || CAST(p_partkey % 100 AS STRING) AS pickup_name,
  ' ' || CAST(p_size AS STRING) || ' Main St ' AS address, 'City ' || CAST((p_size + i) % 10 AS STRING) AS city,
  'S' || CAST((p_size + i) % 10 AS STRING) AS state, CAST(40000 + p_size AS STRING) AS zip,
  CASE WHEN p_partkey % 12 = 6 THEN CAST(NULL AS STRING) ELSE 'D' || CAST(p_partkey % 9 AS STRING) END AS d_rte,
  CASE WHEN p_partkey % 14 = 9 THEN CAST(NULL AS INT) ELSE CAST(p_partkey % 7 AS INT) END AS pickup_day,
  CASE (p_partkey + i) % 24 WHEN 5 THEN TRUE WHEN 6 THEN FALSE END AS is_deleted
FROM (SELECT p_partkey, p_size, SERIES(0, 1) AS i FROM [[part]] WHERE p_partkey % 59 <> 2) p""",
    "fp_ff_crossdock_miles": f"""
SELECT CAST({_whs('n_nationkey')} AS BIGINT) AS origin_whs_id, CAST({_whs('i')} AS BIGINT) AS destination_whs_id,
  CAST(20 + n_nationkey * 11 + i * 7 AS DECIMAL(10, 4)) AS miles
FROM (SELECT n_nationkey, SERIES(0, 24) AS i FROM [[nation]]) lanes WHERE i % 6 <> 5""",
    "fp_ff_crossdock_stops": f"""
SELECT CAST({_whs('n_nationkey')} AS BIGINT) AS origin_whs_id, CAST({_whs('i')} AS BIGINT) AS destination_whs_id,
  CAST(1 + (n_nationkey + i) % 3 AS INT) AS number_of_stops
FROM (SELECT n_nationkey, SERIES(0, 24) AS i FROM [[nation]]) lanes WHERE i % 4 <> 3""",
    "fp_ff_method": """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS fp_ff_method_id, 'Method ' || r_name AS description FROM [[region]]""",
    "fp_ff_type": """
SELECT CAST(r_regionkey AS BIGINT) AS fp_ff_type_id, 'Form ' || r_name AS description FROM [[region]]""",
    "fp_ff_temperature": """
SELECT CAST(r_regionkey AS BIGINT) AS fp_ff_temperature_id, 'Temp ' || r_name AS description FROM [[region]]""",
    "fp_ff_temperature_protection": """
SELECT CAST(r_regionkey AS BIGINT) AS fp_ff_temperature_protection_id, 'Protect ' || r_name AS description FROM [[region]]""",
    "fp_ff_allowance_type": """
SELECT CAST(r_regionkey AS BIGINT) AS fp_ff_allowance_type_id, 'Allow ' || r_name AS description, CASE WHEN r_regionkey = 3 THEN TRUE END AS is_deleted FROM [[region]]""",
    "lo_load_temperatures": """
SELECT CAST(r_regionkey AS BIGINT) AS lo_load_temperatures_id, 'T' || r_name AS temperature, 'P' || r_name AS protection_level FROM [[region]]""",
    "tms_status": """
SELECT CAST(50 + n_nationkey AS BIGINT) AS tms_status_id, 'Status ' || n_name AS status FROM [[nation]]""",
    "fp_ff_linked_forms": """
SELECT p_partkey * 8 AS main_form_id, (p_partkey + i) * 8 + i AS linked_form_id, CASE WHEN p_partkey % 15 = 4 THEN TRUE END AS is_deleted
FROM (SELECT p_partkey, SERIES(1, 3) AS i FROM [[part]] WHERE p_partkey % 3 = 0) p""",
    "fp_ff_approval_status": """
SELECT p_partkey AS fp_freight_form_id, CASE WHEN p_partkey % 9 = 0 THEN TRUE END AS is_deleted FROM [[part]] WHERE p_partkey % 4 = 1""",
    "fp_freight_form_log": """
SELECT p_partkey AS fp_freight_form_id, CAST(57 + i AS BIGINT) AS tms_status_id, CAST('2000-02-01' AS DATE) + CAST(p_partkey % 200 + i * 3 AS INT) AS created_date
FROM (SELECT p_partkey, SERIES(0, 2) AS i FROM [[part]]) p""",
    "tms_fuel_avg_price": """
SELECT CAST(2 + n_nationkey * 0.05 AS DECIMAL(10, 3)) AS price, CAST('2000-01-01' AS DATE) + CAST(n_nationkey * 14 AS INT) AS start_date,
  CAST('2000-01-01' AS DATE) + CAST(n_nationkey * 14 + 13 AS INT) AS end_date, CASE WHEN n_nationkey = 7 THEN TRUE END AS is_deleted
FROM [[nation]]""",
    "submissions": """
SELECT p_partkey AS fp_freight_form_id, (p_partkey * 3) % (SELECT COUNT(*) FROM [[customer]]) AS user_id,
  CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS send_to_backhaul,
  CASE WHEN p_partkey % 4 = 0 THEN CAST((p_partkey * 5) % (SELECT COUNT(*) FROM [[supplier]]) AS STRING) || ',' || CAST((p_partkey * 5 + 17) % (SELECT COUNT(*) FROM [[supplier]]) AS STRING)
    || ',' || CAST((p_partkey * 5 + 34) % (SELECT COUNT(*) FROM [[supplier]]) AS STRING) END AS vendor_numbers,
  CASE WHEN p_partkey % 7 = 0 THEN CAST(NULL AS BIGINT) ELSE p_partkey - p_partkey % 10 + CASE WHEN p_partkey % 40 = 1 THEN 1 ELSE 0 END END AS remit_number,
  CASE p_partkey % 5 WHEN 0 THEN 'UBS_2002-01-01,WBS_2002-02-01' WHEN 1 THEN 'WBS_2002-03-01' WHEN 2 THEN 'UBS_' WHEN 3 THEN 'ALB_1999-01-01,UBS_2002-01-05'
    ELSE 'UBS_2002-01-01,WBS_2002-01-01,ALB_2002-01-01,TFF_2002-01-01,UCS_2002-01-01' END AS source_system_dates,
  'note ' || CAST(p_partkey AS STRING) AS comment
FROM [[part]]""",
}


def _split_args(text: str, start: int) -> tuple[str, int]:
    depth, i = 1, start
    while depth:
        depth += {"(": 1, ")": -1}.get(text[i], 0)
        i += 1
    return text[start : i - 1], i


def _series(sql: str, form: str) -> str:
    out, pos = [], 0
    for hit in re.finditer(r"SERIES\(", sql):
        args, end = _split_args(sql, hit.end())
        out += [sql[pos : hit.start()], form.format(args)]
        pos = end
    return "".join(out) + sql[pos:]


def spark_sql_of(name: str, view_of) -> str:
    sql = _series(TABLES[name], "explode(sequence({}))")
    return re.sub(r"\[\[(\w+)\]\]", lambda m: view_of(m[1]), sql)


def check_sql_of(name: str) -> str:
    """The same SELECT for the checking engine, over its pre-registered views."""
    sql = _series(TABLES[name], "unnest(generate_series({}))")
    return re.sub(r"\[\[(\w+)\]\]", r"\1", sql)


# Resolved plans per session and folder: a table is parsed and its footer read once.
_FRAMES: dict[tuple[str, str], dict[str, DataFrame]] = {}


class TestBed(Mapping):
    """Lazy name → DataFrame mapping over the derived freight tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir.rstrip("/")
        session = f"{spark.sparkContext.applicationId}-{id(spark)}"
        self._frames = _FRAMES.setdefault((session, self._dir), {})

    def _view(self, source: str) -> str:
        name = "src_" + re.sub(r"\W+", "_", f"{self._dir}_{source}")
        if source not in self._frames:
            self._frames[source] = self._spark.read.parquet(f"{self._dir}/{source}.parquet")
            self._frames[source].createOrReplaceTempView(name)
        return name

    def __getitem__(self, name: str) -> DataFrame:
        if name in SOURCES:
            self._view(name)
        elif name not in self._frames:
            self._frames[name] = self._spark.sql(spark_sql_of(name, self._view))
        return self._frames[name]

    def store(self, folder: str) -> None:
        """Write every table below ``folder`` and read it from there in this session, as a warehouse would hold it."""
        for name in TABLES:
            path = f"{folder.rstrip('/')}/{name}"
            self[name].write.mode("overwrite").parquet(path)
            self._frames[name] = self._spark.read.parquet(path)

    def __iter__(self):
        return iter(TABLES)

    def __len__(self):
        return len(TABLES)


def with_tables(sql: str, *names: str) -> str:
    """Prefix a checking query with the derived tables it names."""
    found = [n for n in TABLES if n in names or re.search(rf"\b{n}\b", sql)]
    ctes = [f"{n} AS ({check_sql_of(n)})" for n in dict.fromkeys(found)]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes + [body[5:]])
    return "WITH " + ",\n".join(ctes) + "\n" + body
