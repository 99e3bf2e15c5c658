"""Outbound prices, listings and audit snapshots of the pricing forms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark import constants as K
from haulmark.functions.numbers import dec, or_zero, ratio
from haulmark.functions.predicates import (
    ci,
    code_list,
    contains_text,
    dollars,
    moment,
    not_deleted,
    optional_in,
    pickup_day_number,
    short_date,
)
from haulmark.operators.rates import blended_rate_code, blended_rate_of
from haulmark.operators.shared import live, lowest, sort_by

FORM, ROW = "fp_freight_form_id", "fp_freight_form_vendor_id"
Tables = Mapping[str, DataFrame]
BLEND_COLUMNS = [f"{b}_blended_freight_rate" for b in K.BLENDS]


def _forms(df: DataFrame, form_ids) -> DataFrame:
    """Rows of the wanted forms: all of them, a short list, or a DataFrame of ids."""
    if form_ids is None:
        return df
    if isinstance(form_ids, DataFrame):
        return df.join(form_ids.select(FORM).distinct(), FORM, "left_semi")
    return df.filter(F.col(FORM).isin(list(form_ids)))


def pricing_dataset(t: Tables, form_ids=None, source_systems=None) -> DataFrame:
    """The vendor rows of the forms as the host systems need them.

    ``source_systems`` is a list for all forms, or a DataFrame of form and system.
    """
    per_form = source_systems if isinstance(source_systems, DataFrame) else None
    systems = None if per_form is not None else code_list(source_systems)
    forms = _forms(t["fp_freight_form"], form_ids).filter(not_deleted(F.col("is_implied_rate")))
    vsp = F.col("fp_ff_method_id") == K.VSP
    kind = or_zero(F.col("fp_ff_allowance_type_id"))
    no_allowance = kind.isin(0, K.NO_ALLOWANCE) | F.coalesce(vsp, F.lit(False))
    offered = F.col("offered_pickup_allowance")
    whs = (
        t["tms_whs"]
        .select("tms_whs_id", "source_system")
        .filter(optional_in(F.col("source_system"), systems) & F.col("source_system").isNotNull())
    )
    hosts = t["whs_reference_data"].select(
        "tms_whs_id", "source_system", F.col("whs_number").alias("host_warehouse")
    )
    rows = (
        forms.select(FORM, "fp_ff_allowance_type_id", *BLEND_COLUMNS)
        .join(live(t["fp_freight_form_vendor"]), FORM)
        .join(
            live(t["tms_vendor"]).select("tms_vendor_id", "tms_whs_id", "vendor_number"),
            ["tms_vendor_id", "tms_whs_id"],
        )
        .join(whs, "tms_whs_id")
        .join(hosts, ["tms_whs_id", "source_system"])
        .join(
            live(t["fp_ff_pickup_locations"]).select("fp_ff_pickup_locations_id", "d_rte", "pickup_day"),
            "fp_ff_pickup_locations_id",
            "left",
        )
    )
    if per_form is not None:
        wanted = per_form.select(FORM, ci(F.col("source_system")).alias("_system")).distinct()
        rows = rows.withColumn("_system", ci(F.col("source_system"))).join(wanted, [FORM, "_system"], "left_semi")
    rate = blended_rate_of(
        F.col("source_system"), F.col("tms_whs_id"), F.col("proposed_freight_per_lb"), vsp, F.lit(0)
    )
    priced = rows.select(
        FORM,
        "effective_date",
        "tms_vendor_id",
        "vendor_number",
        "host_warehouse",
        F.when(no_allowance, 0).otherwise(1).alias("is_allowance_flag_on"),
        F.when(no_allowance, F.lit(K.NO_ALLOWANCE)).otherwise(F.col("fp_ff_allowance_type_id")).alias("tms_allowance_type_id"),
        F.when(vsp, 0)
        .otherwise(F.when(F.col("fp_ff_allowance_type_id") == K.PERCENT_ALLOWANCE, offered * 100).otherwise(offered))
        .cast(dec(18, 6))
        .alias("allowance"),
        rate.cast(dec(18, 6)).alias("booked_freight_per_lb"),
        F.when(vsp, "VSP").otherwise(F.col("d_rte")).alias("d_rte"),
        pickup_day_number(F.col("pickup_day")).alias("pickup_day"),
        "source_system",
        "tms_whs_id",
        F.when(F.col("tms_whs_id") == K.YORK_WAREHOUSE, or_zero(F.col("proposed_freight_per_lb"))).alias("true_york"),
    )
    # Equal rows are rare: they meet in small parts, not before the shuffle in the few tasks that read the tables.
    return priced.repartition(FORM, "vendor_number").distinct()


def missing_dc_rows(dataset: DataFrame, warehouses: DataFrame, vendors: DataFrame, whs_ref: DataFrame) -> DataFrame:
    """Priced East warehouses a form leaves out, filled from a row it has.

    A sibling is the same vendor number at another warehouse. The filling row
    is the one at the lowest warehouse with that number on the form.
    """
    priced = warehouses.filter("include_in_freight_pricing").filter(
        ci(F.col("source_system")) == K.EAST_SYSTEM
    ).select("tms_whs_id")
    east = dataset.filter(ci(F.col("source_system")) == K.EAST_SYSTEM)
    values = ["effective_date", "is_allowance_flag_on", "tms_allowance_type_id", "booked_freight_per_lb", "true_york"]
    donors = east.groupBy(FORM, "vendor_number").agg(
        lowest({c: F.col(c) for c in values}, F.col("tms_whs_id")).alias("_row")
    )
    present = east.join(priced, "tms_whs_id", "left_semi").select(FORM, "vendor_number").distinct()
    hosts = whs_ref.filter(ci(F.col("source_system")) == K.EAST_SYSTEM).select(
        "tms_whs_id", F.col("whs_number").alias("host_warehouse")
    )
    siblings = vendors.select("tms_vendor_id", "tms_whs_id", "vendor_number").join(priced, "tms_whs_id").join(hosts, "tms_whs_id")
    return (
        present.join(siblings, "vendor_number")
        .join(east.select(FORM, "tms_whs_id").distinct(), [FORM, "tms_whs_id"], "left_anti")
        .join(donors, [FORM, "vendor_number"])
        .select(
            FORM,
            F.col("_row.effective_date").alias("effective_date"),
            "tms_vendor_id",
            "vendor_number",
            "host_warehouse",
            *[F.col(f"_row.{c}").alias(c) for c in values[1:]],
            F.lit(K.EAST_SYSTEM).alias("source_system"),
            "tms_whs_id",
        )
        .distinct()
    )


def pricing_out(t: Tables, form_ids=None, source_systems=None, as_of=None) -> DataFrame:
    """Outbound queue rows: allowance, freight and York records, status N."""
    rows = pricing_dataset(t, form_ids, source_systems)
    missing = missing_dc_rows(rows, t["tms_whs"], t["tms_vendor"], t["whs_reference_data"])
    nothing = F.lit(None)

    added = missing.select(
        F.lit("FRT").alias("identifier"),
        FORM,
        "vendor_number",
        "host_warehouse",
        "effective_date",
        nothing.cast("int").alias("is_allowance_flag_on"),
        nothing.cast("bigint").alias("tms_allowance_type_id"),
        F.col("booked_freight_per_lb").alias("value"),
        nothing.cast("string").alias("d_rte"),
        nothing.cast("int").alias("pickup_day"),
        "source_system",
    )
    # Every record kind of a vendor row leaves in one pass over the dataset.
    both = rows.withColumn("identifier", F.explode(F.array(F.lit("ALW"), F.lit("FRT"), F.lit("MKF")))).filter(
        (F.col("identifier") != "MKF") | (F.col("tms_whs_id") == K.YORK_WAREHOUSE)
    )
    alw = F.col("identifier") == "ALW"
    records = both.select(
        "identifier",
        FORM,
        "vendor_number",
        "host_warehouse",
        "effective_date",
        F.when(alw, F.col("is_allowance_flag_on")).cast("int").alias("is_allowance_flag_on"),
        F.when(alw, F.col("tms_allowance_type_id")).cast("bigint").alias("tms_allowance_type_id"),
        F.when(alw, F.col("allowance"))
        .when(F.col("identifier") == "FRT", F.col("booked_freight_per_lb"))
        .otherwise(F.col("true_york"))
        .cast(dec(18, 6))
        .alias("value"),
        "d_rte",
        F.col("pickup_day").cast("int").alias("pickup_day"),
        "source_system",
    ).unionByName(added)
    stamp = F.current_timestamp().cast("timestamp_ntz") if as_of is None else moment(as_of)
    return records.withColumns(
        {
            "created_date": stamp,
            "process_status": F.lit("N"),
            "processed_datetime": nothing.cast("timestamp_ntz"),
        }
    )


ALLOWANCE_SORTS = (
    "warehouse_name", "source_system", "vendor_name", "vendor_number", "average_po_weight", "average_pallets_per_po",
    "proposed_allowance_per_lb", "booked_freight_per_lb", "current_allowance_type_description", "current_allowance",
)


def allowance_list(
    t: Tables, form_ids=None, source_system: str | None = None, sort: str | None = "WAREHOUSE_NAME", direction: str = "ASC"
) -> DataFrame:
    """Vendor rows with the rate as shown, current allowance and warehouse list.

    ``sort=None`` leaves the rows unordered, for callers that only join them.
    """
    rows = _forms(live(t["fp_freight_form_vendor"]), form_ids)
    lists = rows.groupBy(FORM).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_set("tms_whs_id")), lambda x: x.cast("string")), ","
        ).alias("warehouse_list")
    )
    whs = t["tms_whs"].select(
        "tms_whs_id", "whs_number", F.col("name").alias("whs_name"), F.col("source_system").alias("whs_system")
    )
    if source_system:
        whs = whs.filter(ci(F.col("whs_system")) == source_system.upper().rstrip())
    vendors = t["tms_vendor"].select(
        "tms_vendor_id", F.lit(True).alias("known"), F.col("name").alias("vendor_name"), "vendor_number",
        "tms_allowance_type_id", F.col("source_system").alias("vendor_system"),
    )
    kinds = t["fp_ff_allowance_type"].select(
        F.col("fp_ff_allowance_type_id").alias("current_allowance_type_id"),
        F.col("description").alias("current_allowance_type_description"),
    )
    wide = (
        rows.join(t["fp_freight_form"].select(FORM, "is_implied_rate", "rejected_vsp_flag", *BLEND_COLUMNS), FORM)
        .join(whs, "tms_whs_id")
        .join(vendors, "tms_vendor_id", "left")
        .join(kinds, "current_allowance_type_id", "left")
        .join(lists, FORM, "left")
    )
    rate = blended_rate_of(F.col("whs_system"), F.col("tms_whs_id"), F.col("proposed_freight_per_lb"))
    vsp = F.col("rejected_vsp_flag") | (F.col("fp_ff_method_id") == K.VSP)
    out = wide.select(
        ROW,
        "tms_whs_id",
        "offered_pickup_allowance",
        F.when(F.col("is_implied_rate"), "(Delivered - FOB) / Case Weight").when(vsp, "VSP").otherwise(dollars(rate)).alias("booked_freight_per_lb"),
        F.when(F.col("known"), F.col("tms_vendor_id")).alias("tms_vendor_id"),
        "vendor_name",
        "vendor_number",
        F.concat("whs_number", F.lit(" - "), "whs_name").alias("warehouse_name"),
        "fp_ff_pickup_locations_id",
        "tms_allowance_type_id",
        "average_po_weight",
        "average_pallets_per_po",
        "proposed_allowance_per_lb",
        F.when(F.col("known"), F.col("vendor_system")).otherwise(F.col("whs_system")).alias("source_system"),
        "current_allowance_type_description",
        "current_allowance",
        short_date(F.col("effective_date")).alias("effective_date"),
        "processed_flag",
        "warehouse_list",
        "current_freight_rate",
    )
    return out if sort is None else sort_by(out, sort, direction, ALLOWANCE_SORTS, ROW)


def linked_form_rollup(links: DataFrame, vendors: DataFrame) -> DataFrame:
    """Order count and order-weighted sums of the vendor rows linked to each main row."""
    orders = F.col("total_pos")
    rows = live(links).select("main_form_id", F.col("linked_form_id").alias(ROW)).join(live(vendors), ROW)

    def weighted(name: str) -> Column:
        return F.sum((F.col(name) * orders).cast(dec(28, 6))).cast(dec(28, 6))

    return rows.groupBy("main_form_id").agg(
        F.sum(orders).cast(dec(28, 3)).alias("total_pos"),
        weighted("average_po_weight").alias("avg_po_weight"),
        weighted("average_po_units").alias("avg_po_cases"),
        weighted("average_po_cubes").alias("avg_po_cubes"),
        weighted("average_pallets_per_po").alias("avg_pallets_po"),
    )


LIST_SORTS = (
    "whs_number", "vendor_name", "pickup_name", "method", "crossdock_whs_name", "destination_whs_name", "source_system",
    "total_pos", "average_po_weight", "proposed_freight_per_lb", "effective_date",
)


def vendor_warehouse_list(
    t: Tables, form_ids=None, pickup=None, destination=None, crossdock=None, method=None, sort: str | None = "WHS_NUMBER", direction: str = "ASC"
) -> DataFrame:
    """Vendor rows with lane names, linked-row averages and blend code."""
    rollup = linked_form_rollup(t["fp_ff_linked_forms"], t["fp_freight_form_vendor"])
    linked = rollup.select(F.col("main_form_id").alias(ROW), *[F.col(c).alias(f"l_{c}") for c in rollup.columns[1:]])

    def whs(prefix: str, key: str, *extra: str) -> DataFrame:
        return t["tms_whs"].select(
            F.col("tms_whs_id").alias(key),
            F.lit(True).alias(f"{prefix}_known"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in ("whs_number", "name", "address1", "city", "zip", *extra)],
        )

    pickups = t["fp_ff_pickup_locations"].select(
        "fp_ff_pickup_locations_id", "pickup_name", F.col("address").alias("origin_address"),
        F.col("city").alias("origin_city"), F.col("zip").alias("origin_zip"), F.lit(True).alias("p_known"),
    )
    wide = (
        _forms(live(t["fp_freight_form_vendor"]), form_ids)
        .join(t["fp_freight_form"].select(FORM, *BLEND_COLUMNS), FORM)
        .join(t["fp_ff_method"].select("fp_ff_method_id", F.col("description").alias("method")), "fp_ff_method_id", "left")
        .join(t["tms_vendor"].select("tms_vendor_id", F.col("name").alias("vendor_name")), "tms_vendor_id", "left")
        .join(pickups, "fp_ff_pickup_locations_id", "left")
        .join(whs("cw", "crossdock_whs_id"), "crossdock_whs_id", "left")
        .join(whs("dw", "tms_whs_id", "source_system"), "tms_whs_id", "left")
        .join(t["cr_rate"].select("cr_rate_id", "rate"), "cr_rate_id", "left")
        .join(linked, ROW, "left")
    )
    crossdock_name = F.concat("cw_whs_number", F.lit(" "), "cw_name")
    for column, part in (
        (F.col("pickup_name"), pickup),
        (F.col("dw_name"), destination),
        (crossdock_name, crossdock),
        (F.col("method"), method),
    ):
        if part:
            wide = wide.filter(contains_text(column, part))
    orders = F.col("total_pos") + or_zero(F.col("l_total_pos"))

    def blended_mean(own: str, other: str) -> Column:
        total = F.col(own) * F.col("total_pos") + or_zero(F.col(other))
        return ratio(total, orders, 6)

    group_rate = F
    for name, ids in K.BLEND_WAREHOUSES.items():
        group_rate = group_rate.when(F.col("tms_whs_id").isin(*ids), F.col(f"{name}_blended_freight_rate"))
    code = F.when(F.col("dw_known"), blended_rate_code(F.col("dw_source_system"), F.col("tms_whs_id"))).otherwise(0)
    east = F.coalesce(ci(F.col("dw_source_system")) == K.EAST_SYSTEM, F.lit(False))
    zeroed = (
        "calc_rate", "calc_all_in_rate", "allowance_per_lb", "booked_freight_per_lb", "landed_expense_per_lb", "proposed_booked_freight",
        "proposed_projected_margin", "proposed_total_allowance", "total_margin", "total_allowance", "total_booked_freight", "proposed_total_expense",
    )
    out = wide.select(
        FORM,
        ROW,
        F.when(F.col("method").isNotNull(), F.col("fp_ff_method_id")).alias("fp_ff_method_id"),
        "method",
        F.when(F.col("vendor_name").isNotNull(), F.col("tms_vendor_id")).alias("tms_vendor_id"),
        "vendor_name",
        F.when(F.col("p_known"), F.col("fp_ff_pickup_locations_id")).alias("fp_ff_pickup_locations_id"),
        "pickup_name",
        "origin_address",
        "origin_city",
        "origin_zip",
        F.when(F.col("cw_known"), F.col("crossdock_whs_id")).alias("crossdock_whs_id"),
        F.col("cw_address1").alias("crossdock_address"),
        F.col("cw_city").alias("crossdock_city"),
        F.col("cw_zip").alias("crossdock_zip"),
        crossdock_name.alias("crossdock_whs_name"),
        F.when(F.col("dw_known"), F.col("tms_whs_id")).alias("destination_whs_id"),
        F.col("dw_address1").alias("destination_whs_address"),
        F.col("dw_city").alias("destination_whs_city"),
        F.col("dw_zip").alias("destination_zip"),
        F.concat("dw_whs_number", F.lit(" "), "dw_name").alias("destination_whs_name"),
        F.col("dw_whs_number").alias("whs_number"),
        *[or_zero(F.col(c)).alias(c) for c in zeroed],
        "rate",
        "average_pallets_per_po",
        "average_po_units",
        blended_mean("average_po_weight", "l_avg_po_weight").alias("average_po_weight"),
        blended_mean("average_po_units", "l_avg_po_cases").alias("average_po_cases"),
        blended_mean("average_po_cubes", "l_avg_po_cubes").alias("avg_po_cubes"),
        blended_mean("average_pallets_per_po", "l_avg_pallets_po").alias("avg_pallets_per_po"),
        "offered_pickup_allowance",
        "projected_load_weight",
        "proposed_allowance_per_lb",
        "proposed_freight_per_lb",
        orders.cast(dec(28, 3)).alias("total_pos"),
        F.coalesce("booked_freight_override", F.lit(False)).alias("booked_freight_override"),
        F.coalesce("projected_load_weight_override", F.lit(False)).alias("projected_load_weight_override"),
        "east_blended_freight_rate",
        east.alias("locked_east_blended_freight_rate"),
        "use_east_blended_freight_rate",
        "gilroc_blended_freight_rate",
        F.coalesce(F.col("dw_known") & F.col("tms_whs_id").isin(*K.BLEND_WAREHOUSES["gilroc"]), F.lit(False)).alias("display_gilroc_blended_freight_rate"),
        F.coalesce("dw_source_system", F.lit("")).alias("source_system"),
        "effective_date",
        "processed_flag",
        F.when(F.col("dw_known"), group_rate).alias("blended_rate"),
        F.when(F.col("dw_known"), group_rate).cast(dec(18, 0)).alias("blended_rate_rounded"),
        code.alias("blended_rate_code"),
    )
    return out if sort is None else sort_by(out, sort, direction, LIST_SORTS, ROW)


def form_summary(t: Tables, form_ids=None) -> DataFrame:
    """Forms with their lookup texts and whether any row has a current allowance."""
    flagged = t["fp_freight_form_vendor"].groupBy(FORM).agg(
        F.max(F.col("current_allowance").isNotNull()).alias("is_current_allowance")
    )

    def lookup(table: str, key: str, **names: str) -> DataFrame:
        return t[table].select(key, *[F.col(c).alias(n) for n, c in names.items()])

    analysts = t["sec_users"].select(
        F.col("sec_users_id").alias("freight_analyst_user_id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("freight_analyst_name"),
    )
    wide = (
        _forms(t["fp_freight_form"], form_ids)
        .join(lookup("tms_status", "tms_status_id", form_status="status"), "tms_status_id", "left")
        .join(lookup("fp_ff_type", "fp_ff_type_id", form_type="description"), "fp_ff_type_id", "left")
        .join(lookup("fp_ff_allowance_type", "fp_ff_allowance_type_id", form_allowance="description"), "fp_ff_allowance_type_id", "left")
        .join(lookup("fp_ff_temperature", "fp_ff_temperature_id", form_temp="description"), "fp_ff_temperature_id", "left")
        .join(lookup("fp_ff_temperature_protection", "fp_ff_temperature_protection_id", form_temp_protection="description"), "fp_ff_temperature_protection_id", "left")
        .join(
            lookup("lo_load_temperatures", "lo_load_temperatures_id", load_temp="temperature", load_protection_level="protection_level"),
            "lo_load_temperatures_id",
            "left",
        )
        .join(analysts, "freight_analyst_user_id", "left")
        .join(flagged, FORM, "left")
    )

    def known(key: str, text: str) -> Column:
        return F.when(F.col(text).isNotNull(), F.col(key))

    rates = [
        f"{side}_{name}"
        for side in ("default", "ucs")
        for name in (
            "crossdock_pallet_rate", "backhaul_pallet_rate", "tool_cooler_freezer_upcharge", "tool_margin_target",
            "tool_pff_pfh_upcharge", "tool_fuel_surcharge",
        )
    ]
    return wide.select(
        FORM,
        known("tms_status_id", "form_status").alias("form_status_id"),
        "form_status",
        known("fp_ff_type_id", "form_type").alias("fp_ff_type_id"),
        "form_type",
        "fp_ff_allowance_type_id",
        "form_allowance",
        known("fp_ff_temperature_id", "form_temp").alias("form_temp_id"),
        "form_temp",
        known("fp_ff_temperature_protection_id", "form_temp_protection").alias("fp_ff_temperature_protection_id"),
        "form_temp_protection",
        known("lo_load_temperatures_id", "load_temp").alias("lo_load_temperatures_id"),
        "load_temp",
        "load_protection_level",
        "freight_analyst_user_id",
        "freight_analyst_name",
        "submit_date",
        "remit_number",
        "is_hub_and_spoke",
        "is_hub_and_spoke_vsp",
        "is_vsp_crossdock",
        "is_price_list_submitted",
        *rates,
        F.coalesce("is_current_allowance", F.lit(False)).alias("is_current_allowance"),
        F.coalesce("is_implied_rate", F.lit(False)).alias("is_implied_rate"),
    )


def pickup_list(pickups: DataFrame, form_ids=None) -> DataFrame:
    return _forms(live(pickups), form_ids).select(
        FORM, "fp_ff_pickup_locations_id", "address", "city", "zip", "pickup_name"
    )


FORM_LOG_COLUMNS = [
    FORM, "fp_ff_type_id", "submit_date", "tms_status_id", "margin_target", "pff_pfh_up_charge",
    *[f"default_tool_{c}" for c in ("cooler_freezer_upcharge", "margin_target", "pff_pfh_upcharge", "fuel_surcharge")],
    *BLEND_COLUMNS,
    *[f"ucs_tool_{c}" for c in ("cooler_freezer_upcharge", "margin_target", "pff_pfh_upcharge", "fuel_surcharge")],
]
ROW_LOG_COLUMNS = [
    ROW, FORM, "tms_vendor_id", "tms_whs_id", "fp_ff_pickup_locations_id", "cr_rate_id", "fp_ff_crossdock_stops_id", "fp_ff_method_id",
    "crossdock_whs_id", "total_pos", "proposed_total_expense", "total_allowance", "total_booked_freight", "offered_pickup_allowance",
    "average_po_weight", "average_po_units", "average_pallets_per_po", "projected_load_weight", "use_east_blended_freight_rate",
    "proposed_allowance_per_lb", "proposed_freight_per_lb", "proposed_total_allowance", "proposed_booked_freight", "total_margin",
    "proposed_projected_margin", "booked_freight_per_lb", "allowance_per_lb", "letter_freight_per_lb", "landed_expense_per_lb",
    "calc_rate", "calc_all_in_rate", "effective_date", "processed_flag", "current_expense", "average_po_cubes",
]


def snapshot_forms(forms: DataFrame, vendors: DataFrame, who: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """Log rows of the forms in ``who`` (form id, user id, comment) and of their live rows."""
    stamp = {"created_date": moment(as_of), "created_by": F.col("_user")}
    people = who.select(FORM, F.col("user_id").alias("_user"), F.col("comment").alias("_comment"))
    form_log = (
        forms.select(*FORM_LOG_COLUMNS)
        .join(people, FORM)
        .withColumns(stamp)
        .withColumnRenamed("_comment", "next_stage_comment")
        .drop("_user")
    )
    row_log = live(vendors).select(*ROW_LOG_COLUMNS).join(people.drop("_comment"), FORM).withColumns(stamp).drop("_user")
    return form_log, row_log
