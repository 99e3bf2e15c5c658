"""Writes and table versions: append, refresh, reload, keyed update, delete, schema change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.predicates import moment
from haulmark.sources.keyed import once_per_key


def append_audited(df: DataFrame, path: str, as_of=None, created_by: int | None = None) -> None:
    """Append rows with their creation time (and user)."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if as_of is None else moment(as_of)
    out = df if "created_date" in df.columns else df.withColumn("created_date", stamp)
    if created_by is not None:
        out = out.withColumn("created_by", F.lit(created_by).cast("bigint"))
    out.write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str = "report_date") -> None:
    """Reload only the partitions present in ``df``; a second run changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def apply_updates(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A new version of ``base``: matched rows take the changes' values, NULLs too.

    Two changes for one key are refused at run time; columns that ``base`` lacks
    are ignored.
    """
    keys = list(keys)
    kinds = dict(base.dtypes)
    values = [c for c in changes.columns if c in kinds and c not in keys]
    new = once_per_key(changes.select(*keys, *values), keys).select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).cast(kinds[c]).alias(f"_new_{c}") for c in values]
    )
    joined = base.join(new, keys, "left")
    picked: list[Column] = [
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in base.columns
    ]
    return joined.select(*picked)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def delete_matching(base: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.join(doomed.select(*keys), list(keys), "left_anti")


Step = tuple


def migrate(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply schema steps in order.

    A step is ("rename", old, new), ("add", name, type), ("fill", name, value)
    or ("drop", name, type); the type of a drop lets it be rolled back.
    """
    for kind, name, arg in steps:
        if kind == "rename":
            df = df.withColumnRenamed(name, arg)
        elif kind == "add":
            df = df.withColumn(name, F.lit(None).cast(arg))
        elif kind == "fill":
            df = df.withColumn(name, F.lit(arg).cast(df.schema[name].dataType))
        elif kind == "drop":
            df = df.drop(name)
        else:
            raise ValueError(f"unknown step {kind!r}")
    return df


def rollback(steps: Sequence[Step]) -> list[Step]:
    """The steps that undo ``steps``; filled values need no undoing."""
    undo = {"rename": lambda n, a: ("rename", a, n), "add": lambda n, a: ("drop", n, a), "drop": lambda n, a: ("add", n, a)}
    return [undo[kind](name, arg) for kind, name, arg in reversed(steps) if kind in undo]


FORM_RATE_NAMES = (
    "backhaul_pallet_rate", "crossdock_pallet_rate", "tool_pff_pfh_upcharge", "tool_cooler_freezer_upcharge",
    "tool_margin_target", "tool_fuel_surcharge",
)
# Marker constants written to the new rate columns, so a mix-up of two shows.
UCS_MARKERS = {
    "ucs_tool_fuel_surcharge": 1,
    "ucs_crossdock_pallet_rate": 2,
    "ucs_backhaul_pallet_rate": 3,
    "ucs_tool_cooler_freezer_upcharge": 4,
    "ucs_tool_margin_target": 5,
    "ucs_tool_pff_pfh_upcharge": 6,
}
SPLIT_FORM_RATES: list[Step] = (
    [("rename", n, f"default_{n}") for n in FORM_RATE_NAMES]
    + [("add", f"ucs_{n}", "decimal(10,3)") for n in FORM_RATE_NAMES]
    + [("fill", n, v) for n, v in UCS_MARKERS.items()]
)
ADD_ROW_COLUMNS: list[Step] = [
    ("add", "use_east_blended_freight_rate", "boolean"),
    ("fill", "use_east_blended_freight_rate", False),
    ("add", "average_po_cubes", "decimal(18,3)"),
    ("fill", "average_po_cubes", 0),
]
ADD_BLEND_GROUPS: list[Step] = [
    ("add", f"{n}_blended_freight_rate", "decimal(10,3)") for n in ("harcar", "stksgm", "annser")
]
ADD_CONFIG_SYSTEM: list[Step] = [("add", "source_system", "string")]
