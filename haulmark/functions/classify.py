"""Classification columns of purchase orders, loads and appointments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark import constants as K
from haulmark.functions.numbers import dec, or_zero, row_ratio
from haulmark.functions.predicates import days_between, minutes_between


def protection_level(frozen: Column, chilled: Column) -> Column:
    return F.when(frozen > 0, "F").when(chilled > 0, "C").otherwise("D")


def protection_levels(chilled: Column, dry: Column, frozen: Column, repack: Column) -> Column:
    """Comma list of every level present; repack units travel dry."""
    return F.array_join(
        F.array_compact(
            F.array(
                F.when(chilled > 0, "C"),
                F.when((dry > 0) | (repack > 0), "D"),
                F.when(frozen > 0, "F"),
            )
        ),
        ",",
    )


def po_type(has_load: Column) -> Column:
    return F.when(has_load, "COLLECT").otherwise("VSP")


def is_backhaul(carrier: Column, source_whs: Column) -> Column:
    return F.coalesce((carrier == K.BACKHAUL_CARRIER) & source_whs.isNull(), F.lit(False))


def shipping_mode(
    load: Column,
    carrier: Column,
    ltl: Column,
    source_name: Column,
    rate_id: Column,
    rate_mode: Column,
    destination: Column,
    shuttles=K.CROSSDOCK_SHUTTLE_CARRIERS,
    consolidators=K.CONSOLIDATION_WAREHOUSES,
) -> Column:
    """First rule that holds, in this order."""
    return (
        F.when(
            source_name.isNotNull() & rate_id.isNotNull(),
            F.concat(rate_mode, F.lit(" CROSS DOCK")),
        )
        .when(source_name.isNull() & rate_id.isNotNull(), rate_mode)
        .when(F.coalesce(ltl, F.lit(False)), "LTL")
        .when(carrier.isin(*shuttles), "CROSS DOCK SHUTTLE")
        .when(destination.isin(*consolidators), "CONSOLIDATED")
        .when(carrier == K.BACKHAUL_CARRIER, "BACKHAUL")
        .when(load.isNull(), "VSP")
        .otherwise("TL")
    )


def landed_status(original_eta: Column, landed: Column) -> Column:
    return F.when(days_between(original_eta, landed) > 0, "LATE").otherwise("ON TIME")


def appointment_status(appointment: Column, landed: Column, grace: int = 30) -> Column:
    on_time = (minutes_between(appointment, landed) <= grace) | (landed <= appointment)
    return F.when(on_time, "ON TIME").otherwise("LATE")


def on_time_flags(df: DataFrame) -> DataFrame:
    """Adds ``need_by_date``, ``landed``, ``landed_vs_needby`` and ``appointment_status``."""
    need_by = F.coalesce(F.col("calculated_eta"), F.col("expect_date"))
    landed = F.col("datetimelanded")
    return df.withColumns(
        {
            "need_by_date": F.to_date(need_by),
            "landed": landed_status(F.col("original_eta_date"), landed),
            "landed_vs_needby": landed_status(need_by, landed),
            "appointment_status": appointment_status(F.col("appointment_date"), landed),
        }
    )


def po_revenue(freight: Column, allowance: Column) -> Column:
    return or_zero(freight) + F.abs(or_zero(allowance))


def per_lb(amount: Column, weight: Column) -> Column:
    """Amount per pound; 0 when the weight is not above zero."""
    return F.when(weight > 0, row_ratio(amount, weight)).otherwise(F.lit(0).cast(dec(20, 6)))


def fpa_pallets_of(pallets: Column, weight: Column, cubes: Column) -> Column:
    """Resized pallet count: one per 50 cubes when both densities look wrong, at most 26.

    The density tests multiply instead of dividing, so no boundary is rounded.
    """
    count = F.ceil(pallets).cast(dec(18, 0))

    def within(value: Column, limits: tuple[int, int]) -> Column:
        low, high = limits
        return F.coalesce(
            (count > 0) & (value >= count * low) & (value <= count * high), F.lit(False)
        )

    by_cube = F.ceil(cubes / F.lit(K.CUBES_PER_PALLET)).cast(dec(18, 0))
    odd = ~within(weight, K.PALLET_WEIGHT_RANGE) & ~within(cubes, K.PALLET_CUBE_RANGE)
    sized = F.when(odd & (by_cube < count), by_cube).otherwise(count)
    return F.when(sized > K.MAX_PALLETS, F.lit(K.MAX_PALLETS)).otherwise(sized).cast(dec(10, 3))
