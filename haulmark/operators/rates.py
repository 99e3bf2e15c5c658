"""The rate calculator: every vendor row of every pricing form at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark import constants as K
from haulmark.functions.numbers import dec, mean_zero, or_zero, ratio
from haulmark.functions.predicates import ci
from haulmark.operators.intervals import join_periods
from haulmark.operators.shared import join_by_code_or_default, live, lowest

CONFIG_COLUMNS = [
    "crossdock_pallet_rate",
    "backhaul_pallet_rate",
    "shuttle_rate_per_mile",
    "estimated_lumper_expense",
    "estimated_accessorial_expense",
    "anticipated_crossdock_load_weight",
    "anticipated_tl_load_weight",
    "anticipated_backhaul_load_weight",
]
FORM_RATES = [
    "backhaul_pallet_rate",
    "crossdock_pallet_rate",
    "tool_fuel_surcharge",
    "tool_cooler_freezer_upcharge",
    "tool_margin_target",
    "tool_pff_pfh_upcharge",
]
RESET_MEASURES = [
    "proposed_booked_freight",
    "cr_rate_id",
    "proposed_total_allowance",
    "landed_expense_per_lb",
    "proposed_total_expense",
    "calc_rate",
    "calc_all_in_rate",
    "proposed_projected_margin",
]


def blended_rate_of(
    system: Column,
    warehouse: Column,
    fallback: Column,
    vsp: Column | None = None,
    vsp_value: Column | None = None,
    vsp_first: bool = False,
) -> Column:
    """The form's group rate for a warehouse, else the vendor row's own rate.

    ``vsp`` marks vendor-shipped rows: they take ``vsp_value`` ahead of every
    group when ``vsp_first`` is set, otherwise only where no group applies.
    """
    rules = [(ci(system) == K.EAST_SYSTEM, F.col("east_blended_freight_rate"))]
    rules += [
        (warehouse.isin(*ids), F.col(f"{name}_blended_freight_rate"))
        for name, ids in K.BLEND_WAREHOUSES.items()
    ]
    if vsp is not None:
        rules.insert(0 if vsp_first else len(rules), (vsp, vsp_value))
    chain = F
    for test, value in rules:
        chain = chain.when(test, value)
    return chain.otherwise(fallback)


def blended_rate_code(system: Column, warehouse: Column) -> Column:
    """1-4 for the warehouse groups, 5 for the East system, else 0."""
    chain = F
    for name, ids in K.BLEND_WAREHOUSES.items():
        chain = chain.when(warehouse.isin(*ids), K.BLEND_CODES[name])
    return chain.when(ci(system) == K.EAST_SYSTEM, K.BLEND_CODES["east"]).otherwise(0)


def resolve_config(df: DataFrame, config: DataFrame, system_col: str = "source_system") -> DataFrame:
    """Adds the config columns of the row's source system, else of DEFAULT."""
    wanted = [c for c in CONFIG_COLUMNS if c in config.columns]
    renamed = config.select("source_system", *[F.col(c).alias(f"cfg_{c}") for c in wanted])
    return join_by_code_or_default(df, renamed, system_col, [f"cfg_{c}" for c in wanted])


def form_rate(name: str, system: Column) -> Column:
    """The form's default rate, or its conventional-division rate (also when the system is NULL)."""
    return F.when(ci(system) != K.CONVENTIONAL_SYSTEM, F.col(f"default_{name}")).otherwise(
        F.col(f"ucs_{name}")
    )


def lane_lookup(rows: DataFrame, miles: DataFrame, stops: DataFrame) -> DataFrame:
    """Adds ``lane_miles`` and ``lane_stops`` between cross-dock and warehouse.

    Both lookups keep one row per lane: the lowest value.
    """
    lane = ["crossdock_whs_id", "tms_whs_id"]
    named = {"origin_whs_id": "crossdock_whs_id", "destination_whs_id": "tms_whs_id"}
    length = miles.withColumnsRenamed(named).groupBy(*lane).agg(F.min("miles").alias("_miles"))
    count = stops.withColumnsRenamed(named).groupBy(*lane).agg(F.min("number_of_stops").alias("_stops"))
    method = F.col("fp_ff_method_id")
    crossing = method.isin(K.BACKHAUL_CROSSDOCK, K.DIRECT_CROSSDOCK)
    return (
        rows.join(length, lane, "left")
        .join(count, lane, "left")
        .withColumn(
            "lane_miles",
            F.when(method == K.BACKHAUL, F.lit(0).cast(dec(10, 4))).when(crossing, F.col("_miles")),
        )
        .withColumn("lane_stops", F.when(crossing, F.coalesce(F.col("_stops"), F.lit(0))).otherwise(0))
        .drop("_miles", "_stops")
    )


def pick_carrier_rate(
    rows: DataFrame, pickups: DataFrame, rates: DataFrame, carriers: DataFrame
) -> DataFrame:
    """Adds the picked rate of each direct row: id, miles, carrier and price.

    Rates are reduced to one row per lane first (lowest id wins), so a lane with
    many rates cannot multiply vendor rows. The primary rate wins over the
    cheapest for id, miles and carrier; the price comes from the primary rate
    only, else 0. A lane whose every cheapest (or primary) rate has the wrong
    protection yields nothing at all.
    """
    eligible = live(rates).join(
        live(carriers).filter("include_in_freight_pricing").select("cr_carrier_id"), "cr_carrier_id"
    )
    facts = {c: F.col(c) for c in ("cr_rate_id", "mileage", "cr_carrier_id", "rate", "rate_unit")}
    dry = F.coalesce(F.col("protection_level") == "Dry", F.lit(True))
    lanes = eligible.groupBy("destination_whs_id", "origin_city", "origin_state").agg(
        *[
            lowest(facts, F.col("cr_rate_id"), where=F.col(flag) & ok).alias(f"{kind}_{level}")
            for flag, kind in (("is_cheapest_rate", "cheap"), ("primary_rate", "main"))
            for level, ok in (("any", F.lit(True)), ("dry", dry))
        ]
    )
    stops = pickups.select(
        "fp_ff_pickup_locations_id", F.col("city").alias("_city"), F.col("state").alias("_state")
    )
    joined = rows.join(stops, "fp_ff_pickup_locations_id", "left")
    lanes = lanes.withColumnsRenamed(
        {"destination_whs_id": "_whs", "origin_city": "_lane_city", "origin_state": "_lane_state"}
    )
    joined = joined.join(
        lanes,
        (joined["tms_whs_id"] == lanes["_whs"])
        & (joined["_city"] == lanes["_lane_city"])
        & (joined["_state"] == lanes["_lane_state"]),
        "left",
    )
    is_dry = F.coalesce(F.col("fp_ff_temperature_id") == K.DRY_TEMPERATURE, F.lit(False))
    out = joined
    for kind in ("cheap", "main"):
        out = out.withColumn(
            f"_{kind}", F.when(is_dry, F.col(f"{kind}_dry")).otherwise(F.col(f"{kind}_any"))
        )
    blocked = (F.col("cheap_any").isNotNull() & F.col("_cheap").isNull()) | (
        F.col("main_any").isNotNull() & F.col("_main").isNull()
    )
    usable = (F.col("fp_ff_method_id") == K.DIRECT) & ~blocked & F.col("has_warehouse")
    priced = F.col("_main.rate").isNotNull()

    def pick(field: str) -> Column:
        return F.when(usable, F.when(priced, F.col(f"_main.{field}")).otherwise(F.col(f"_cheap.{field}")))

    unit = F.col("_main.rate_unit")
    price = F.when(unit == "Flat", F.col("_main.rate")).when(
        unit == "Per Mile", F.col("_main.rate") * F.col("_main.mileage")
    )
    out = out.withColumns(
        {
            "picked_rate_id": pick("cr_rate_id"),
            "picked_miles": pick("mileage"),
            "picked_carrier_id": pick("cr_carrier_id"),
            "picked_price": F.when(usable, or_zero(price.cast(dec(10, 3)))),
        }
    )
    return out.select(
        *rows.columns, "picked_rate_id", "picked_miles", "picked_carrier_id", "picked_price"
    )


def calc_rate(rows: DataFrame) -> DataFrame:
    """Step 1: the load's base rate and its projected weight, by method."""
    method, system = F.col("fp_ff_method_id"), F.col("whs_system")
    pallets = F.col("average_pallets_per_po")
    shuttle = F.col("miles") * F.col("cfg_shuttle_rate_per_mile")
    crossdock = form_rate("crossdock_pallet_rate", system)
    backhaul = form_rate("backhaul_pallet_rate", system)
    base = (
        F.when(method == K.BACKHAUL, pallets * backhaul)
        .when(method == K.BACKHAUL_CROSSDOCK, pallets * (crossdock + backhaul) + shuttle)
        .when(method == K.DIRECT, F.col("picked_price"))
        .when(method == K.DIRECT_CROSSDOCK, pallets * crossdock + shuttle)
    )
    crossing = method.isin(K.BACKHAUL_CROSSDOCK, K.DIRECT_CROSSDOCK)
    planned = (
        F.when(method == K.BACKHAUL, F.col("cfg_anticipated_backhaul_load_weight"))
        .when(crossing, F.col("cfg_anticipated_crossdock_load_weight"))
        .otherwise(F.col("cfg_anticipated_tl_load_weight"))
    )
    own = F.coalesce(F.col("projected_load_weight_override"), F.lit(False)) | ~F.col("has_warehouse")
    return rows.withColumns(
        {
            "calc_rate": F.when(F.col("has_warehouse"), base).cast(dec()),
            "projected_load_weight": F.when(own, F.col("projected_load_weight"))
            .otherwise(planned)
            .cast(dec()),
        }
    )


def price_steps(rows: DataFrame, per_lb_scale: int = 3) -> DataFrame:
    """Steps 2-6: all-in rate, landed cost per pound, freight, expense, margin."""
    method, system = F.col("fp_ff_method_id"), F.col("whs_system")
    weight, orders = F.col("average_po_weight"), F.col("total_pos")
    per_lb = dec(18, per_lb_scale)
    known = F.col("has_warehouse")
    rows = rows.withColumns(
        {
            "calc_all_in_rate": F.when(
                known, F.col("calc_rate") + F.col("miles") * form_rate("tool_fuel_surcharge", system)
            ).cast(dec()),
            "proposed_total_allowance": F.when(
                known, or_zero(F.col("proposed_allowance_per_lb")) * or_zero(weight) * orders
            ).cast(dec()),
        }
    )
    all_in = F.col("calc_all_in_rate")
    load = F.coalesce(F.nullif(F.col("projected_load_weight"), F.lit(0)), F.lit(1))
    lumper, extra = F.col("cfg_estimated_lumper_expense"), F.col("cfg_estimated_accessorial_expense")
    pallets = or_zero(F.col("average_pallets_per_po"))
    per_load = ratio(all_in, load, 9)
    crossdock, backhaul = F.col("cfg_crossdock_pallet_rate"), F.col("cfg_backhaul_pallet_rate")

    def via_dock(handling: Column) -> Column:
        return ratio(handling * pallets, weight, 9) + per_load + lumper * F.col("lane_stops") + extra

    landed = (
        F.when(method == K.BACKHAUL, ratio(all_in, weight, 9) + lumper + extra)
        .when(method == K.BACKHAUL_CROSSDOCK, via_dock(crossdock + backhaul))
        .when(method == K.DIRECT, per_load + lumper + extra)
        .when(method == K.DIRECT_CROSSDOCK, via_dock(crossdock))
    )
    rows = rows.withColumn(
        "landed_expense_per_lb",
        F.when(known & (or_zero(weight) != 0) & (or_zero(all_in) != 0), landed).cast(per_lb),
    )
    cost = F.col("landed_expense_per_lb")
    asked = (
        cost * (or_zero(form_rate("tool_cooler_freezer_upcharge", system)) + 1)
        + or_zero(form_rate("tool_margin_target", system))
        + or_zero(form_rate("tool_pff_pfh_upcharge", system))
    )
    rows = rows.withColumns(
        {
            "proposed_total_expense": (cost * weight * orders).cast(dec()),
            "proposed_freight_per_lb": F.when(
                F.coalesce(F.col("booked_freight_override"), F.lit(False)),
                F.col("proposed_freight_per_lb"),
            )
            .otherwise(F.when(known, asked))
            .cast(per_lb),
        }
    )
    rows = rows.withColumn(
        "proposed_booked_freight", (F.col("proposed_freight_per_lb") * weight * orders).cast(dec())
    )
    return rows.withColumn(
        "proposed_projected_margin",
        (
            F.col("proposed_total_allowance")
            + F.col("proposed_booked_freight")
            - F.col("proposed_total_expense")
        ).cast(dec()),
    )


def vsp_reset(rows: DataFrame) -> DataFrame:
    """Vendor-shipped rows (and rows without a method) keep only overridden values."""
    priced = F.coalesce(F.col("fp_ff_method_id") != K.VSP, F.lit(False))
    changes = {
        c: F.when(priced, F.col(c)) for c in RESET_MEASURES if c in rows.columns
    }
    for value, flag in (
        ("projected_load_weight", "projected_load_weight_override"),
        ("proposed_freight_per_lb", "booked_freight_override"),
    ):
        changes[value] = F.when(priced | F.coalesce(F.col(flag), F.lit(False)), F.col(value))
    return rows.withColumns(changes)


def reprice(
    vendors: DataFrame,
    forms: DataFrame,
    warehouses: DataFrame,
    config: DataFrame,
    pickups: DataFrame,
    rates: DataFrame,
    carriers: DataFrame,
    miles: DataFrame,
    stops: DataFrame,
    per_lb_scale: int = 3,
) -> DataFrame:
    """All price measures of every live vendor row; feed to ``apply_updates``."""
    form_columns = [f"{side}_{name}" for side in ("default", "ucs") for name in FORM_RATES]
    rows = (
        live(vendors)
        .join(forms.select("fp_freight_form_id", "fp_ff_temperature_id", *form_columns), "fp_freight_form_id")
        .join(
            warehouses.select(
                "tms_whs_id", F.col("source_system").alias("whs_system"), F.lit(True).alias("has_warehouse")
            ),
            "tms_whs_id",
            "left",
        )
        .withColumn("has_warehouse", F.coalesce(F.col("has_warehouse"), F.lit(False)))
    )
    rows = resolve_config(rows, config, "whs_system")
    rows = pick_carrier_rate(lane_lookup(rows, miles, stops), pickups, rates, carriers)
    direct = F.col("fp_ff_method_id") == K.DIRECT
    rows = rows.withColumns(
        {
            "miles": F.when(direct, F.col("picked_miles")).otherwise(F.col("lane_miles")),
            "cr_rate_id": F.when(direct, F.col("picked_rate_id")),
        }
    )
    return vsp_reset(price_steps(calc_rate(rows), per_lb_scale)).select(*vendors.columns)


def blended_rates(forms: DataFrame, vendors: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Five group averages per form from one aggregate; a group without rows is NULL.

    The East group takes its own system's rows and rows opted into it, without
    vendor-shipped ones. The warehouse groups take their warehouses' rows that
    did not opt out, vendor-shipped ones included.
    """
    rows = live(vendors).join(
        warehouses.select("tms_whs_id", F.col("source_system").alias("whs_system")), "tms_whs_id"
    )
    opted = F.col("use_east_blended_freight_rate")
    in_group = {
        "east": ((ci(F.col("whs_system")) == K.EAST_SYSTEM) | opted)
        & (F.col("fp_ff_method_id") != K.VSP)
    }
    for name, ids in K.BLEND_WAREHOUSES.items():
        in_group[name] = F.col("tms_whs_id").isin(*ids) & ~opted
    rate = or_zero(F.col("proposed_freight_per_lb"))

    def average(test: Column) -> Column:
        picked = F.when(test, rate)
        return ratio(F.sum(picked), F.count(picked), 6).cast(dec(10, 3))

    groups = rows.groupBy("fp_freight_form_id").agg(
        *[average(test).alias(f"{name}_blended_freight_rate") for name, test in in_group.items()]
    )
    return forms.select("fp_freight_form_id").join(groups, "fp_freight_form_id", "left")


def quick_set(
    vendors: DataFrame,
    form_ids=None,
    pickup_location_id=None,
    method_id=None,
    crossdock_whs_id=None,
    projected_load_weight=None,
) -> DataFrame:
    """Live rows of the forms with every given value set; others keep theirs."""
    rows = live(vendors)
    if form_ids is not None:
        rows = rows.filter(F.col("fp_freight_form_id").isin(list(form_ids)))
    given = {
        "fp_ff_pickup_locations_id": pickup_location_id,
        "fp_ff_method_id": method_id,
        "crossdock_whs_id": crossdock_whs_id,
        "projected_load_weight": projected_load_weight,
    }
    kinds = dict(vendors.dtypes)
    return rows.withColumns(
        {c: F.coalesce(F.lit(v).cast(kinds[c]), F.col(c)) for c, v in given.items()}
    )


def no_rate_errors(rows: DataFrame, warehouses: DataFrame) -> DataFrame:
    """One error per direct row for which no carrier rate was found."""
    return (
        rows.filter((F.col("fp_ff_method_id") == K.DIRECT) & F.col("cr_rate_id").isNull())
        .join(warehouses.select("tms_whs_id", "whs_number", "name"), "tms_whs_id")
        .select(
            F.lit("No Rate").alias("title"),
            F.concat(
                F.lit("No Rate found for this Warehouse "), F.col("whs_number"), F.lit(" "), F.col("name")
            ).alias("detail"),
            F.lit("CR_RATE_ID").alias("field_name"),
            F.col("fp_freight_form_id").alias("form_id"),
            F.col("fp_freight_form_vendor_id").alias("form_vendor_id"),
        )
    )


def clear_allowance(vendors: DataFrame, forms: DataFrame) -> DataFrame:
    """Live rows of no-allowance forms lose their offered allowance."""
    none = forms.filter(F.col("fp_ff_allowance_type_id") == K.NO_ALLOWANCE).select(
        "fp_freight_form_id", F.lit(True).alias("_none")
    )
    return (
        live(vendors)
        .join(none, "fp_freight_form_id", "left")
        .withColumn(
            "offered_pickup_allowance",
            F.when(F.col("_none").isNull(), F.col("offered_pickup_allowance")),
        )
        .select(*vendors.columns)
    )


def fuel_price_at(form_log: DataFrame, fuel_prices: DataFrame) -> DataFrame:
    """Fuel price on the day each form first reached initial analysis."""
    first = (
        form_log.filter(F.col("tms_status_id") == K.IBL_INITIAL_ANALYSIS)
        .groupBy("fp_freight_form_id")
        .agg(F.to_date(F.min("created_date")).alias("fuel_date"))
    )
    prices = live(fuel_prices).select("start_date", "end_date", "price")
    held = join_periods(
        first, prices, "fuel_date", "start_date", "end_date", ids=["fp_freight_form_id"], how="left", open_ends=False
    )
    return held.groupBy("fp_freight_form_id", "fuel_date").agg(F.min("price").alias("fuel_price"))
