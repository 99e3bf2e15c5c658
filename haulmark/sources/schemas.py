"""Declared schemas of the tables whose layout is fixed.

All columns are nullable except the ids. Bare decimals are written out as
(18, 0); Spark's own default is (10, 0).
"""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "id": T.LongType(),
    "int": T.IntegerType(),
    "text": T.StringType(),
    "flag": T.BooleanType(),
    "time": T.TimestampNTZType(),
    "date": T.DateType(),
    "rate": T.DecimalType(10, 3),
    "miles": T.DecimalType(10, 4),
    "money": T.DecimalType(18, 3),
    "per_lb": T.DecimalType(18, 6),
    "budget": T.DecimalType(18, 2),
}


def _schema(spec: str, required: tuple[str, ...] = ()) -> T.StructType:
    fields = []
    for part in spec.split(";"):
        kind, names = part.split(":")
        fields += [T.StructField(n, _KINDS[kind.strip()], n not in required) for n in names.split()]
    return T.StructType(fields)


DEFAULT_CONFIG = _schema(
    "id: fp_default_config_id; rate: crossdock_pallet_rate backhaul_pallet_rate shuttle_rate_per_mile fuel_surcharge "
    "estimated_lumper_expense estimated_accessorial_expense anticipated_crossdock_load_weight anticipated_tl_load_weight "
    "anticipated_backhaul_load_weight margin_target pff_pfh_upcharge cooler_freezer_upcharge; "
    "int: fp_engine_months_back supplier_screen_months_back; rate: po_count avg_po_weight avg_po_units avg_po_pallets; "
    "int: margin_loss_report_months_back; text: source_system",
    ("fp_default_config_id",),
)

FREIGHT_FORM = _schema(
    "id: fp_freight_form_id fp_ff_type_id fp_ff_review_reason_id fp_ff_temperature_id; time: submit_date; "
    "id: fp_ff_temperature_protection_id fp_ff_special_considerations_id fp_ff_allowance_type_id; text: product_description; "
    "id: tms_status_id remit_number tms_srm_id lo_load_temperatures_id; text: authorizer_name phone_number; id: freight_analyst_user_id; "
    "text: email; flag: is_hub_and_spoke is_hub_and_spoke_vsp is_vsp_crossdock is_price_list_submitted margin_target pff_pfh_up_charge "
    "chill_frz_up_charge; time: created_date; id: created_by; time: modified_date; id: modified_by; "
    "rate: default_tool_pff_pfh_upcharge default_tool_cooler_freezer_upcharge default_tool_margin_target default_tool_fuel_surcharge; "
    "flag: is_deleted; text: supplier_name; rate: east_blended_freight_rate gilroc_blended_freight_rate harcar_blended_freight_rate "
    "stksgm_blended_freight_rate annser_blended_freight_rate; id: srmc_user_id; flag: rejected_vsp_flag; text: notes reject_comment; "
    "flag: is_exploratory is_implied_rate; rate: default_backhaul_pallet_rate default_crossdock_pallet_rate; text: ibl_notes; "
    "id: fp_ff_freight_change_reason_id; rate: ucs_backhaul_pallet_rate ucs_crossdock_pallet_rate ucs_tool_pff_pfh_upcharge "
    "ucs_tool_cooler_freezer_upcharge ucs_tool_margin_target ucs_tool_fuel_surcharge; id: ucs_remit_number",
    ("fp_freight_form_id",),
)

FREIGHT_FORM_VENDOR = _schema(
    "id: fp_freight_form_vendor_id fp_freight_form_id tms_vendor_id tms_whs_id fp_ff_pickup_locations_id cr_rate_id "
    "fp_ff_crossdock_stops_id fp_ff_method_id crossdock_whs_id; money: total_pos total_margin total_allowance total_booked_freight "
    "offered_pickup_allowance average_po_weight average_po_units average_pallets_per_po proposed_total_expense projected_load_weight; "
    "per_lb: proposed_allowance_per_lb proposed_freight_per_lb; money: proposed_total_allowance proposed_booked_freight "
    "proposed_projected_margin; per_lb: booked_freight_per_lb allowance_per_lb letter_freight_per_lb landed_expense_per_lb; "
    "money: calc_rate calc_all_in_rate; time: created_date; id: created_by; time: modified_date; id: modified_by; flag: is_deleted "
    "booked_freight_override projected_load_weight_override; id: current_allowance_type_id; rate: current_allowance; flag: processed_flag; "
    "time: effective_date; per_lb: current_freight_rate; money: current_expense; flag: use_east_blended_freight_rate; money: average_po_cubes",
    ("fp_freight_form_vendor_id", "fp_freight_form_id"),
)

PURCHASE_ORDERS = _schema(
    "id: lo_purchase_order_id; text: po_number; id: tms_status_id; text: source_system; id: sales_region_id tms_vendor_id "
    "tms_vendor_facility_id tms_buyer dis_whs_id commodity_code_id order_type_id; text: revenue_type; time: rec_date expect_date request_date "
    "original_eta_date original_pickup_date; money: total_weight total_units total_pallets total_cubes frz_units chl_units dry_units rpk_units "
    "prod_frt allowance po_dollar_value; text: d_rte alt_rte_1",
    ("lo_purchase_order_id",),
)
PO_LOADS = _schema("id: lo_po_loads_id lo_purchase_order_id lo_load_number; flag: is_deleted", ("lo_po_loads_id",))
LOADS = _schema(
    "id: lo_load_number cr_carrier_id source_whs_id destination_whs_id tms_status_id tms_master_route_id created_by", ("lo_load_number",)
)
BILL_POS = _schema("id: lo_purchase_order_id bl_billing_id lo_load_number; flag: is_deleted")
BILLING = _schema("id: bl_billing_id cr_carrier_id lo_load_number; money: invoice_amount", ("bl_billing_id",))
CARRIERS = _schema(
    "id: cr_carrier_id; text: name; flag: shuttle_carrier ltl_carrier include_in_freight_pricing is_deleted", ("cr_carrier_id",)
)
FISCAL_CALENDAR = _schema("int: fiscal_year period quarter week; date: week_start week_end")
PALLET_HANDLING_RATE = _schema("int: fiscal_year; text: source_system; rate: backhaul_rate cross_dock_rate")

BY_NAME = {
    "fp_default_config": DEFAULT_CONFIG,
    "fp_freight_form": FREIGHT_FORM,
    "fp_freight_form_vendor": FREIGHT_FORM_VENDOR,
    "lo_purchase_orders": PURCHASE_ORDERS,
    "lo_po_loads": PO_LOADS,
    "lo_loads": LOADS,
    "bl_bill_pos": BILL_POS,
    "bl_billing": BILLING,
    "cr_carriers": CARRIERS,
    "fiscal_calendar": FISCAL_CALENDAR,
    "pallet_handling_rate": PALLET_HANDLING_RATE,
}
