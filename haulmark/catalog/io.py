"""Source and sink queries: write, read back, and compare with the source rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.base import query
from haulmark.functions.predicates import ci
from haulmark.session import fresh_folder
from haulmark.sources import readers, schemas, sinks


def _folder(t) -> str:
    """A fresh folder on the session's shared storage."""
    return fresh_folder(t._spark)


@query("s1_read_table", "SELECT bl_billing_id, cr_carrier_id, lo_load_number, invoice_amount FROM bl_billing", "invoice_amount")
def _(t):
    folder = _folder(t)
    sinks.full_refresh(t["bl_billing"], f"{folder}/bl_billing")
    return readers.read_table(t._spark, folder, "bl_billing")


_CONFIG = [f.name for f in schemas.DEFAULT_CONFIG.fields]
@query(
    "s2_config_csv",
    """SELECT po.lo_purchase_order_id, c.shuttle_rate_per_mile, c.fuel_surcharge, c.margin_target, c.margin_loss_report_months_back
    FROM lo_purchase_orders po LEFT JOIN (SELECT *, CAST(NULL AS DECIMAL(10, 3)) AS margin_target FROM fp_default_config) c ON UPPER(RTRIM(c.source_system)) = po.source_system""",
    "shuttle_rate_per_mile fuel_surcharge margin_target",
)
def _(t):
    path = f"{_folder(t)}/config"
    config = t["fp_default_config"]
    kinds = {f.name: f.dataType for f in schemas.DEFAULT_CONFIG.fields}
    full = config.select(*[F.col(c) if c in config.columns else F.lit(None).cast(kinds[c]).alias(c) for c in _CONFIG])
    # rates below one are written with a leading dot
    text = [F.regexp_replace(F.col(c).cast("string"), r"^0\.", ".").alias(c) for c in _CONFIG]
    full.select(*text).write.csv(path, header=True, emptyValue="", nullValue="")
    read = readers.read_config_csv(t._spark, path).withColumn("system", ci(F.col("source_system"))).drop("source_system")
    orders = t["lo_purchase_orders"].select("lo_purchase_order_id", F.col("source_system").alias("system"))
    return orders.join(read, "system", "left").select(
        "lo_purchase_order_id", "shuttle_rate_per_mile", "fuel_surcharge", "margin_target", "margin_loss_report_months_back"
    )


@query(
    "s4_append_audited",
    "SELECT bl_billing_id, cr_carrier_id, TIMESTAMP '2001-12-31 08:00:00' AS created_date, CAST(7 AS BIGINT) AS created_by FROM bl_billing UNION ALL "
    "SELECT bl_billing_id, cr_carrier_id, TIMESTAMP '2002-01-07 08:00:00', CAST(7 AS BIGINT) FROM bl_billing",
)
def _(t):
    path = f"{_folder(t)}/queue"
    rows = t["bl_billing"].select("bl_billing_id", "cr_carrier_id")
    for stamp in ("2001-12-31 08:00:00", "2002-01-07 08:00:00"):
        sinks.append_audited(rows, path, stamp, 7)
    return t._spark.read.parquet(path)


@query("s5_full_refresh", "SELECT lo_load_number, cr_carrier_id FROM lo_loads")
def _(t):
    path = f"{_folder(t)}/loads"
    for _ in range(2):
        sinks.full_refresh(t["lo_loads"].select("lo_load_number", "cr_carrier_id"), path)
    return t._spark.read.parquet(path)


@query(
    "s6_replace_partitions",
    "SELECT tms_vendor_id, CASE WHEN d = DATE '2001-12-24' THEN 0 ELSE remit_vendor END AS remit_vendor, d AS report_date FROM tms_vendor, "
    "(SELECT unnest([DATE '2001-12-24', DATE '2001-12-31']) AS d) days",
)
def _(t):
    path = f"{_folder(t)}/weekly"
    rows = t["tms_vendor"].select("tms_vendor_id", "remit_vendor")
    for day, value in (("2001-12-24", F.col("remit_vendor")), ("2001-12-31", F.col("remit_vendor")), ("2001-12-24", F.lit(0))):
        week = rows.withColumn("remit_vendor", value.cast("bigint")).withColumn("report_date", F.lit(day).cast("date"))
        sinks.replace_partitions(week, path)
    return t._spark.read.parquet(path)


@query(
    "s7_apply_updates",
    """SELECT lo_load_number, CASE WHEN tms_status_id = 32 THEN NULL ELSE cr_carrier_id END AS cr_carrier_id, tms_status_id FROM lo_loads""",
)
def _(t):
    base = t["lo_loads"].select("lo_load_number", "cr_carrier_id", "tms_status_id")
    changes = base.filter("tms_status_id = 32").select("lo_load_number", F.lit(None).cast("bigint").alias("cr_carrier_id"))
    return sinks.apply_updates(base, changes, ["lo_load_number"])


@query("s8_delete_matching", "SELECT lo_load_number FROM lo_loads WHERE lo_load_number NOT IN (SELECT lo_load_number FROM bl_billing)")
def _(t):
    return sinks.delete_matching(t["lo_loads"].select("lo_load_number"), t["bl_billing"], ["lo_load_number"])


@query(
    "s9_migrate",
    "SELECT fp_freight_form_id, default_backhaul_pallet_rate, CAST(3 AS DECIMAL(10, 3)) AS ucs_backhaul_pallet_rate, CAST(6 AS DECIMAL(10, 3)) AS ucs_tool_pff_pfh_upcharge FROM fp_freight_form",
    "default_backhaul_pallet_rate ucs_backhaul_pallet_rate ucs_tool_pff_pfh_upcharge",
)
def _(t):
    old = t["fp_freight_form"].select(
        "fp_freight_form_id", *[F.col(f"default_{n}").alias(n) for n in sinks.FORM_RATE_NAMES]
    )
    return sinks.migrate(old, sinks.SPLIT_FORM_RATES).select(
        "fp_freight_form_id", "default_backhaul_pallet_rate", "ucs_backhaul_pallet_rate", "ucs_tool_pff_pfh_upcharge"
    )
