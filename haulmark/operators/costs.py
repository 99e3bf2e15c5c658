"""Freight cost facts: allocated invoices, billing gaps, pallets, backhauls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark import constants as K
from haulmark.functions.classify import fpa_pallets_of, is_backhaul, per_lb
from haulmark.functions.classify import po_revenue as revenue_of
from haulmark.functions.numbers import dec, or_zero, share
from haulmark.functions.predicates import ci, in_dates, switch_filter
from haulmark.operators.shared import fiscal_days, live, lowest
from haulmark.operators.spread import hot_keys, join_dealt, join_spread, part_of

PO, LOAD, BILL = "lo_purchase_order_id", "lo_load_number", "bl_billing_id"


def received_rows(pos: DataFrame, start, end) -> DataFrame:
    """Received orders of the window, whole rows, of any source system."""
    return pos.filter((F.col("tms_status_id") == K.PO_RECEIVED) & in_dates("rec_date", start, end))


def allocate_invoices(
    pos: DataFrame,
    bill_pos: DataFrame,
    bills: DataFrame,
    start,
    end,
    source_system: str | None = None,
    skip_carriers=K.NEVER_ALLOCATED_CARRIERS,
    received: DataFrame | None = None,
    narrow: bool = False,
    numbered: bool = True,
) -> DataFrame:
    """Each order's weight share of every bill it is on.

    A bill counts when any of its orders was received in the window; then all
    its orders that are not excluded (and match the source system, if given)
    share the invoice. Lines meet the window's orders and their own in one shuffle
    by order, and go to their bills in a second one.
    ``received`` may hand over the ids of the window's orders, as read from facts
    stored by month; the dates are not needed then. With ``narrow`` (few of all
    orders) lines are cut to the bills of these before they meet all orders.
    Callers that add up per order leave out the order number (``numbered``).
    """
    hot = hot_keys(live(bill_pos), [BILL])
    sharing = (F.col("tms_status_id") != K.PO_EXCLUDED) & switch_filter(F.col("source_system"), source_system)
    inside = F.lit(False) if received is not None else F.coalesce(in_dates("rec_date", start, end), F.lit(False))
    number = ["po_number"] if numbered else []
    orders = pos.select(
        PO, *number, "total_weight", F.coalesce(sharing, F.lit(False)).alias("sharing"), inside.alias("inside")
    )
    payable = bills.filter(~F.col("cr_carrier_id").isin(*skip_carriers)).select(BILL, "invoice_amount")
    lines = lines_of(bill_pos)
    if received is not None:
        orders = orders.drop("inside")
    if received is not None and narrow:
        touched = lines.select(PO, BILL).join(received.select(PO), PO, "left_semi").select(BILL).distinct()
        lines = join_spread(lines, touched, [BILL], [PO, LOAD], "left_semi", hot).withColumn("inside", F.lit(True))
    elif received is not None:
        named = received.select(PO).distinct().withColumn("inside", F.lit(True))
        lines = lines.join(named, PO, "left")
    # Equal lines count in the weights and are listed once. Weights and lines group the same rows, so that Spark shuffles
    # those once for both, by bill.
    linked = (
        lines.join(orders, PO, "left")
        .withColumn("_part", part_of([BILL], [PO, LOAD], hot))
        .repartition(BILL, "_part")
        .groupBy(PO, LOAD, BILL, "_part", *number, "total_weight", "inside")
        .agg(F.count_if("sharing").cast(dec(10, 0)).alias("sharing_lines"))
    )
    weights = (
        linked.groupBy(BILL, "_part")
        .agg(_shared_weight().alias("bill_weight"), F.max("inside").alias("inside"))
        .groupBy(BILL)
        .agg(F.sum("bill_weight").cast(dec(28, 3)).alias("bill_weight"), F.max("inside").alias("inside"))
        .filter("inside")
        .drop("inside")
    )
    mine = linked.filter("sharing_lines > 0").select(PO, LOAD, BILL, "_part", *number, "total_weight")
    return (
        join_dealt(mine, payable.join(weights, BILL), [BILL], hot)
        .select(
            share(F.col("total_weight"), F.col("bill_weight"), F.col("invoice_amount")).alias(
                "freight_paid_po"
            ),
            PO,
            LOAD,
            BILL,
            *number,
            "_part",
        )
        .distinct()
        .drop("_part")
    )


def lines_of(bill_pos: DataFrame) -> DataFrame:
    """Live lines with an order and a bill; one filter for all who join them, so that Spark does not filter some only."""
    return live(bill_pos).select(PO, LOAD, BILL).filter(F.col(PO).isNotNull() & F.col(BILL).isNotNull())


def _shared_weight() -> Column:
    return F.sum(F.when(F.col("sharing_lines") > 0, F.col("total_weight") * F.col("sharing_lines")))


def allocate_invoices_by_system(
    pos: DataFrame,
    bill_pos: DataFrame,
    bills: DataFrame,
    as_of,
    skip_carriers=K.NEVER_ALLOCATED_CARRIERS,
    numbered: bool = True,
) -> DataFrame:
    """The allocation run once per source system, each with its own start date.

    ``pos`` carries ``window_start`` of its source system; every window ends on
    ``as_of``, so a bill is inside a system's window when its latest receipt up
    to that day is, whatever system that order has. Shares are taken among the
    system's own orders only. Lines meet their orders in one shuffle by order and
    their bills, with a weight for each of its few systems, in a second one.
    ``numbered`` as in ``allocate_invoices``.
    """
    hot = hot_keys(live(bill_pos), [BILL])
    received = F.to_date("rec_date")
    sharing = (F.col("tms_status_id") != K.PO_EXCLUDED) & F.col("source_system").isNotNull()
    number = ["po_number"] if numbered else []
    orders = pos.select(
        PO, *number, "total_weight", ci(F.col("source_system")).alias("system"),
        F.col("window_start").alias("opens"),
        F.when(received <= F.lit(as_of), received).alias("latest"),
        F.coalesce(sharing, F.lit(False)).alias("sharing"),
    )
    payable = bills.filter(~F.col("cr_carrier_id").isin(*skip_carriers)).select(BILL, "invoice_amount")
    # As in allocate_invoices: equal lines are grouped once, and weights and lines group the same rows.
    linked = (
        lines_of(bill_pos)
        .join(orders, PO)
        .withColumn("_part", part_of([BILL], [PO, LOAD], hot))
        .repartition(BILL, "_part")
        .groupBy(PO, LOAD, BILL, "_part", *number, "total_weight", "system", "opens", "latest")
        .agg(F.count_if("sharing").cast(dec(10, 0)).alias("sharing_lines"))
    )
    # One row per bill, part and system first, then one per bill with its few systems.
    per_system = (
        linked.groupBy(BILL, "_part", "system")
        .agg(_shared_weight().alias("bill_weight"), F.max("opens").alias("opens"), F.max("latest").alias("latest"))
        .repartition(BILL)
        .groupBy(BILL, "system")
        .agg(F.sum("bill_weight").cast(dec(28, 3)).alias("bill_weight"), F.max("opens").alias("opens"), F.max("latest").alias("latest"))
    )
    own = F.filter("shares", lambda s: F.col("latest") >= s["opens"])
    priced = (
        per_system.groupBy(BILL)
        .agg(
            F.max("latest").alias("latest"),
            F.collect_list(
                F.when(F.col("system").isNotNull(), F.struct("system", "bill_weight", "opens"))
            ).alias("shares"),
        )
        .select(BILL, own.alias("shares"))
        .filter(F.size("shares") > 0)
        .join(payable, BILL)
    )
    mine = linked.filter("sharing_lines > 0").select(PO, LOAD, BILL, "_part", *number, "total_weight", "system")
    shares = F.filter("shares", lambda s: s["system"] == F.col("system"))
    return (
        join_dealt(mine, priced, [BILL], hot)
        .withColumn("_share", F.get(shares, F.lit(0)))
        .filter(F.col("_share").isNotNull())
        .select(
            share(F.col("total_weight"), F.col("_share.bill_weight"), F.col("invoice_amount")).alias(
                "freight_paid_po"
            ),
            PO,
            LOAD,
            BILL,
            *number,
            "_part",
        )
        .distinct()
        .drop("_part")
    )


def unbilled_links(
    po_loads: DataFrame,
    loads: DataFrame,
    bill_pos: DataFrame,
    bills: DataFrame,
    carriers: DataFrame,
    skip_carriers=K.NEVER_UNBILLED_CARRIERS,
) -> DataFrame:
    """Order/load pairs without a positive bill by the load's carrier, of orders in any state; equal links count once.

    For callers whose window holds most orders: links go to their loads and lines to their bills at once,
    which saves a shuffle of each by order.
    """
    hauled = known_links(po_loads).join(must_be_billed(loads, carriers, skip_carriers), LOAD)
    positive = bills.filter("invoice_amount > 0").select(BILL, "cr_carrier_id")
    paid = lines_of(bill_pos).join(positive, BILL).select(PO, LOAD, "cr_carrier_id")
    # One shuffle by order, as the callers go on by order.
    both = hauled.select(PO, LOAD, "cr_carrier_id", F.lit(False).alias("paid")).unionByName(paid.withColumn("paid", F.lit(True)))
    asked = both.repartition(PO).groupBy(PO, LOAD, "cr_carrier_id").agg(
        F.max("paid").alias("paid"), F.max(~F.col("paid")).alias("hauled")
    )
    return asked.filter(F.col("hauled") & ~F.col("paid")).select(PO, LOAD)


def must_be_billed(loads: DataFrame, carriers: DataFrame, skip_carriers) -> DataFrame:
    """Loads that count, of carriers that bill."""
    counted = loads.filter((F.col("tms_status_id") != K.LOAD_EXCLUDED) & ~F.col("cr_carrier_id").isin(*skip_carriers))
    billing = carriers.filter(~F.col("shuttle_carrier")).select("cr_carrier_id")
    return counted.select(LOAD, "cr_carrier_id").join(billing, "cr_carrier_id").select(LOAD, "cr_carrier_id")


def known_links(po_loads: DataFrame) -> DataFrame:
    """Live links with an order and a load; one filter for all who join them by load, so that Spark shuffles them once."""
    return live(po_loads).select(PO, LOAD).filter(F.col(PO).isNotNull() & F.col(LOAD).isNotNull())


def backhaul_trips(po_loads: DataFrame, loads: DataFrame) -> DataFrame:
    """Per order on a backhaul load: how many such links it has, and where the load with the lowest number goes."""
    trips = loads.filter(is_backhaul(F.col("cr_carrier_id"), F.col("source_whs_id"))).select(LOAD, "destination_whs_id")
    first = lowest({"destination_whs_id": F.col("destination_whs_id")}, F.col(LOAD))
    return known_links(po_loads).join(trips, LOAD).groupBy(PO).agg(
        first["destination_whs_id"].alias("backhaul_whs_id"), F.count(F.lit(1)).alias("backhaul_loads")
    )


def billing_gaps(
    received: DataFrame,
    po_loads: DataFrame,
    loads: DataFrame,
    bill_pos: DataFrame,
    bills: DataFrame,
    carriers: DataFrame,
    skip_carriers=K.NEVER_UNBILLED_CARRIERS,
) -> DataFrame:
    """Order/load pairs of ``received`` orders without a positive bill by the load's carrier.

    The received orders lead: links and bill lines are cut to them before they
    meet loads, carriers and bills.
    """
    orders = received.select(PO, "po_number")
    counted = must_be_billed(loads, carriers, skip_carriers)
    hauled = live(po_loads).select(PO, LOAD).join(orders, PO).join(counted, LOAD)
    positive = bills.filter("invoice_amount > 0").select(BILL, "cr_carrier_id")
    paid = (
        lines_of(bill_pos)
        .join(orders, PO, "left_semi")
        .join(positive, BILL)
        .select(PO, LOAD, "cr_carrier_id")
    )
    return hauled.join(paid, [PO, LOAD, "cr_carrier_id"], "left_anti").select("po_number", PO, LOAD)


def received_in(pos: DataFrame, start, end, source_system: str | None = None) -> DataFrame:
    return pos.filter(
        (F.col("tms_status_id") == K.PO_RECEIVED)
        & in_dates("rec_date", start, end)
        & switch_filter(F.col("source_system"), source_system)
    )


def not_fully_billed(
    pos, po_loads, loads, bill_pos, bills, carriers, start, end, source_system: str | None = None
) -> DataFrame:
    received = received_in(pos, start, end, source_system)
    return billing_gaps(received, po_loads, loads, bill_pos, bills, carriers)


def sized_pallets(received: DataFrame) -> DataFrame:
    return received.select(
        PO,
        fpa_pallets_of(F.col("total_pallets"), F.col("total_weight"), F.col("total_cubes")).alias(
            "max_26pallets_final_calc"
        ),
    )


def fpa_pallets(pos: DataFrame, start, end, source_system: str | None = None) -> DataFrame:
    return sized_pallets(received_in(pos, start, end, source_system))


def backhaul_expense(
    pos: DataFrame,
    po_loads: DataFrame,
    loads: DataFrame,
    calendar: DataFrame,
    pallet_rates: DataFrame,
    pallets: Column,
    *,
    pick: str = "sum",
    only_positive: bool = True,
    system_col: str = "source_system",
) -> DataFrame:
    """Per order on a backhaul load: pallets times the fiscal year's handling rate.

    The direct rate applies when order and load go to the same warehouse, the
    cross-dock rate otherwise. ``pick='sum'`` adds all backhaul loads of the
    order; ``pick='one'`` takes the load with the lowest number.
    """
    trips = loads.filter(is_backhaul(F.col("cr_carrier_id"), F.col("source_whs_id"))).select(LOAD, "destination_whs_id")
    orders = pos.select(
        PO,
        "dis_whs_id",
        F.to_date("rec_date").alias("fiscal_day"),
        ci(F.col(system_col)).alias("system"),
        pallets.alias("pallets"),
    )
    rates = pallet_rates.select(
        "fiscal_year", ci(F.col("source_system")).alias("system"), "backhaul_rate", "cross_dock_rate"
    )
    days = fiscal_days(calendar).select("fiscal_day", "fiscal_year")
    charged = (
        live(po_loads)
        .select(PO, LOAD)
        .join(orders, PO)
        .join(trips, LOAD)
        .join(days, "fiscal_day", "left")
        .join(rates, ["fiscal_year", "system"], "left")
    )
    rate = F.when(
        F.col("dis_whs_id") == F.col("destination_whs_id"), F.col("backhaul_rate")
    ).otherwise(F.col("cross_dock_rate"))
    cost = (F.col("pallets") * rate).cast(dec(27, 3))
    if only_positive:
        cost = F.when(F.col("pallets") > 0, cost)
    charged = charged.withColumn("cost", cost)
    if pick == "sum":
        value = F.sum("cost")
    else:
        value = lowest({"cost": F.col("cost")}, F.col(LOAD))["cost"]
    return charged.groupBy(PO).agg(
        value.alias("backhaul_expense_po"), F.count(F.lit(1)).alias("backhaul_loads")
    )


def with_handling_rates(orders: DataFrame, date_col: str, calendar: DataFrame, pallet_rates: DataFrame) -> DataFrame:
    """Adds the pallet handling rates of each order's fiscal year and source system."""
    days = fiscal_days(calendar).groupBy("fiscal_day").agg(F.min("fiscal_year").alias("_year"))
    rates = pallet_rates.groupBy(F.col("fiscal_year").alias("_year"), ci(F.col("source_system")).alias("_system")).agg(
        F.min("backhaul_rate").alias("backhaul_rate"), F.min("cross_dock_rate").alias("cross_dock_rate")
    )
    return (
        orders.withColumns({"_system": ci(F.col("source_system")), "fiscal_day": F.to_date(date_col)})
        .join(days, "fiscal_day", "left")
        .join(rates, ["_year", "_system"], "left")
        .drop("_year", "_system", "fiscal_day")
    )


def handling_rate() -> Column:
    """The direct rate when the backhaul goes to the order's own warehouse, the cross-dock rate otherwise."""
    return F.when(F.col("dis_whs_id") == F.col("backhaul_whs_id"), F.col("backhaul_rate")).otherwise(F.col("cross_dock_rate"))


def po_freight(allocated: DataFrame, keys=(PO,), scale: int = 6, round_each: int | None = None) -> DataFrame:
    """Freight paid per order (or order and load); an unshared bill counts zero."""
    paid = or_zero(F.col("freight_paid_po"))
    if round_each is not None:
        paid = paid.cast(dec(18, round_each))
    return allocated.groupBy(*keys).agg(F.sum(paid).cast(dec(18, scale)).alias("freight_paid_po"))


def po_revenue(pos: DataFrame) -> DataFrame:
    total = revenue_of(F.col("prod_frt"), F.col("allowance"))
    return pos.select(
        PO,
        total.alias("total_revenue"),
        per_lb(total, F.col("total_weight")).alias("total_revenue_lb"),
    )


def bill_status(totals: DataFrame, gaps: DataFrame) -> DataFrame:
    """Tags the totals of orders that still have an unbilled load."""
    open_pos = gaps.select(PO).distinct().withColumn("bill_status", F.lit("Not Fully Billed"))
    return totals.join(open_pos, PO, "left")


def load_and_bill_counts(
    pos: DataFrame, po_loads: DataFrame, loads: DataFrame, bill_pos: DataFrame
) -> DataFrame:
    """Adds distinct non-backhaul loads and distinct bills; NULL when there is none."""
    hauled = loads.filter(F.col("cr_carrier_id") != K.BACKHAUL_CARRIER).select(LOAD)
    per_load = (
        live(po_loads)
        .select(PO, LOAD)
        .join(hauled, LOAD)
        .groupBy(PO)
        .agg(F.count_distinct(LOAD).cast("int").alias("load_count"))
    )
    per_bill = live(bill_pos).groupBy(PO).agg(F.count_distinct(BILL).cast("int").alias("bill_count"))
    return pos.join(per_load, PO, "left").join(per_bill, PO, "left")


def unbilled_loads(
    gaps: list[DataFrame], bill_pos: DataFrame, po_loads: DataFrame, bills: DataFrame
) -> DataFrame:
    """Loads of the gap lists without any positive bill by a real carrier."""
    candidates = gaps[0].select(LOAD)
    for more in gaps[1:]:
        candidates = candidates.unionByName(more.select(LOAD))
    real = bills.filter(
        (F.col("cr_carrier_id") != K.NOT_A_REAL_BILL_CARRIER) & (F.col("invoice_amount") > 0)
    ).select(BILL)
    open_loads = candidates.distinct()
    billed = (
        live(bill_pos)
        .select(PO, LOAD, BILL)
        .join(open_loads, LOAD, "left_semi")
        .join(real, BILL)
        .join(live(po_loads).select(PO, LOAD), [PO, LOAD], "left_semi")
        .select(LOAD)
    )
    return open_loads.join(billed, LOAD, "left_anti")


def unbilled_expense(
    unbilled: DataFrame, bill_pos: DataFrame, pos: DataFrame, agreements: DataFrame
) -> DataFrame:
    """One row: agreed totals of unbilled loads, shared by weight and summed.

    The shares of a load add up to its weighted agreement total, so each load
    is aggregated without listing its orders. No unbilled load gives zero.
    """
    per_load = (
        live(bill_pos)
        .select(PO, LOAD)
        .join(unbilled.select(LOAD), LOAD)
        .join(agreements.select(LOAD, "total"), LOAD)
        .join(pos.select(PO, "total_weight"), PO)
        .groupBy(LOAD)
        .agg(
            F.sum("total_weight").alias("load_weight"),
            F.sum(F.col("total_weight") * F.col("total")).cast(dec(38, 6)).alias("weighted"),
        )
    )
    cost = F.when(
        F.col("load_weight") > 0,
        F.try_divide(F.col("weighted"), F.col("load_weight")),
    ).otherwise(0)
    return per_load.agg(
        F.coalesce(F.sum(cost.cast(dec(28, 6))), F.lit(0)).cast(dec(38, 6)).alias("unbilled_expense")
    )
