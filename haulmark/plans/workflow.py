"""The form workflow: checks, stage changes, closing and backhaul requests.

Every function works on all submitted forms at once. A submission is a row:
form id, user id, the backhaul choice, a comma list of vendor ids, a remit
number, a ``SYSTEM_date`` comma list and a comment.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark import constants as K
from haulmark.functions.numbers import dec, or_zero
from haulmark.functions.predicates import ci, date_of, moment, not_deleted
from haulmark.operators.rates import blended_rate_of
from haulmark.operators.shared import live, lowest
from haulmark.plans.feeds import pricing_out, snapshot_forms
from haulmark.session import cut_lineage
from haulmark.sources.sinks import apply_updates

FORM, ROW = "fp_freight_form_id", "fp_freight_form_vendor_id"
Tables = Mapping[str, DataFrame]
ERROR_SCHEMA = "title string, detail string, field_name string"


@dataclass(frozen=True)
class Rule:
    """An error that a form has at some stages when the named flag is set."""

    flag: str
    stages: tuple[int, ...] | None
    title: str
    detail: str
    field: str | None


# Error texts and fields, and the stages that check each of them.
BASE_CHAIN = (
    Rule("no_location", None, "Pickup Location missing", "This Freight Form requires at least 1 pickup location ", "PICKUP_LOCATION_ID"),
    Rule("no_contact", None, "SM Name or UCS Merchandisers is missing", "This Freight Form requires a SM Name or UCS Merchandisers", "TMS_SRM_ID"),
    Rule("no_supplier", None, "Supplier Name is missing", "This Freight Form requires a Supplier Name ", "SUPPLIER_NAME"),
    Rule("no_rows", None, "At least 1 Vendor or WHS is required to next stage", "This Freight Form requires a Vendor or WHS", "FP_FREIGHT_FORM_VENDOR_ID"),
)
YORK = Rule("no_york", None, "York Warehouse required", "This Freight Form requires the York Warehouse to be added", "SUPPLIER_NAME")
STAGE_RULES = (
    Rule("no_analyst", (55, 58, 59, 60, 61, 62, 67), "Freight Analyst is missing", "This Freight Form requires a Freight Analyst ", "FREIGHT_ANALYST_USER_ID"),
    Rule("no_reason", (55, 58, 59, 60, 62), "Freight Change Reason is missing", "This Freight Form requires a Freight Change Reason", "FP_FF_FREIGHT_CHANGE_REASON_ID"),
    Rule("no_allowance_type", (55, 58, 59, 60, 61, 62, 67), "Allowance Type is missing", "This Freight Form requires an Allowance Type ", None),
    Rule("row_without_pickup", (55, 58, 59, 60, 61, 62, 67), "Missing Pickup Location", "All Collect warehouses require a selected Pick Up Location", "FP_FF_PICKUP_LOCATIONS_ID"),
    Rule("pickup_unscheduled", (55, 59, 60, 61, 62, 67), "Missing D-Route/Pickup Day", "This Freight Form requires D-Route and Pickup Day", "PICKUP_LOCATION_ID"),
    Rule("row_without_freight", (59, 60), "Proposed Booked Freight Per Pound required", "All warehouses require a Proposed Booked Freight Per Pound", "PROPOSED_FREIGHT_PER_LB"),
)
CLOSING_RULES = (
    Rule("date_missing", (62,), "Effective Date Required", "The effective date is required before processing the form to the next stage", ""),
    Rule("date_past", (62,), "Valid Effective Date Required", "The effective date must be greater than today", ""),
    Rule("already_processed", (62,), "Source System has already been processed", "A selected Source System or Vendor has already been processed", "FP_FF_PICKUP_LOCATIONS_ID"),
    Rule("other_remit", (62,), "Remit Number", "Only one remit number can be added to a form", ""),
    Rule("row_without_whs", (62,), "Vendor numbers required", "Not all Form Vendors have a warehouse assigned to them", ""),
    Rule("whs_twice", (62,), "Duplicate warehouses", "Two or more vendors share the same warehouse", ""),
)
# Asked only when nothing above failed.
LATER_RULES = (
    Rule("undecided", (58,), "Unable to proceed", "User needs to select if Form is to be sent to Backhaul", ""),
    Rule("direct_without_freight", (58,), "Proposed Booked Freight Per Pound required", "All warehouses require a Proposed Booked Freight Per Pound", "PROPOSED_FREIGHT_PER_LB"),
    Rule("direct_unscheduled", (58,), "Missing D-Route/Pickup Day", "This Freight Form requires D-Route and Pickup Day", "PICKUP_LOCATION_ID"),
    Rule("two_east_numbers", (62,), "Different UBS vendor numbers", "Two or more UBS vendors have different vendor numbers", ""),
)
# The roles that may move a form on, by stage, and their names.
CLEARANCE = {53: ("is_srm", "is_ibl"), 54: ("is_srm",), 55: ("is_srm",), 56: ("is_srm",), 62: ("is_costing",)}
CLEARANCE |= {stage: ("is_ibl",) for stage in (57, 58, 59, 60, 61, 67)}
ROLE_NAMES = {("is_srm", "is_ibl"): "SRM or IBL", ("is_srm",): "SRM", ("is_ibl",): "IBL", ("is_costing",): "Costing or Coding"}
# The next state of a form without errors, where only the state decides.
NEXT_STATE = {54: 58, 55: 62, 56: 58, 57: 56, 59: 55, 60: 55, 61: 60, 67: 65}
SUBMITTING_STATES = (54, 56)


def user_roles(users: DataFrame, user_role_rows: DataFrame, roles: DataFrame, escalation: DataFrame) -> DataFrame:
    """Super-admin flag and role classes A, B and C of every user."""
    classes = (
        live(user_role_rows)
        .select("sec_users_id", "sec_roles_id")
        .join(live(roles).select("sec_roles_id"), "sec_roles_id")
        .join(escalation.select("sec_roles_id", "fp_escalation_class"), "sec_roles_id")
        .groupBy("sec_users_id")
        .agg(
            *[
                F.max(F.col("fp_escalation_class") == letter).alias(name)
                for letter, name in (("A", "is_srm"), ("B", "is_ibl"), ("C", "is_costing"))
            ]
        )
    )
    return users.join(classes, "sec_users_id", "left").select(
        "sec_users_id",
        F.coalesce("super_admin", F.lit(False)).alias("super_admin"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("is_srm", "is_ibl", "is_costing")],
    )


def parse_effective_dates(submissions: DataFrame, text: str = "source_system_dates") -> DataFrame:
    """One row per ``SYSTEM_date`` entry; a date that is empty, missing or not readable is NULL."""
    entry = F.explode(F.split(F.col(text), ",")).alias("entry")
    parts = submissions.select(FORM, entry).filter(F.trim("entry") != "")
    date = F.try_element_at(F.split("entry", "_"), F.lit(2))
    return parts.select(
        FORM,
        F.trim(F.substring_index("entry", "_", 1)).alias("source_system"),
        date_of(date).alias("effective_date"),
    )


def _chosen_vendors(t: Tables, submissions: DataFrame) -> DataFrame:
    """The live vendors a submission names; a vendor named twice may stand twice."""
    ids = submissions.select(
        FORM, F.explode(F.array_distinct(F.split("vendor_numbers", ","))).alias("text")
    ).select(FORM, F.trim("text").try_cast("bigint").alias("tms_vendor_id"))
    vendors = live(t["tms_vendor"]).select(
        "tms_vendor_id", "tms_whs_id", "vendor_number", F.col("source_system").alias("vendor_system")
    )
    return ids.join(vendors, "tms_vendor_id")


def _pickups_with_use(t: Tables) -> DataFrame:
    """One row per live pickup location: its form and whether a vendor row uses it unscheduled."""
    scheduled = F.col("d_rte").isNotNull() & F.col("pickup_day").isNotNull()
    places = live(t["fp_ff_pickup_locations"]).select(
        "fp_ff_pickup_locations_id", FORM, (~scheduled).alias("bare"), F.lit(False).alias("used")
    )
    uses = live(t["fp_freight_form_vendor"]).select("fp_ff_pickup_locations_id", F.lit(True).alias("used"))
    both = places.unionByName(uses.filter("fp_ff_pickup_locations_id is not null"), allowMissingColumns=True)
    return (
        both.groupBy("fp_ff_pickup_locations_id")
        .agg(F.max(FORM).alias(FORM), F.max("bare").alias("bare"), F.max("used").alias("used"))
        .filter(F.col(FORM).isNotNull())
        .select(FORM, F.struct((F.col("used") & F.col("bare")).alias("unscheduled")).alias("pickup"))
    )


def _parts_of_forms(t: Tables, submissions: DataFrame) -> DataFrame:
    """Everything a rule looks at, as one table of (form, part): the form, its pickups, rows and approvals, and what was submitted.

    Each row fills one part and leaves the others NULL, so a single grouping by
    form sees all of them.
    """
    alive, method = not_deleted(), F.col("fp_ff_method_id")
    forms = t["fp_freight_form"].select(
        FORM,
        F.struct(
            "tms_status_id",
            "fp_ff_type_id",
            F.col("remit_number").alias("saved_remit"),
            (alive & F.col("tms_srm_id").isNotNull()).alias("contact"),
            (alive & F.col("supplier_name").isNotNull()).alias("supplier"),
            (alive & F.col("freight_analyst_user_id").isNull()).alias("no_analyst"),
            (alive & F.col("fp_ff_freight_change_reason_id").isNull()).alias("no_reason"),
            (alive & F.col("fp_ff_allowance_type_id").isNull()).alias("no_allowance_type"),
        ).alias("form"),
    )
    whs = t["tms_whs"].select(
        "tms_whs_id", "whs_number", "name", ci(F.col("source_system")).alias("system"), not_deleted().alias("whs_live"), F.lit(True).alias("known")
    )
    rows = live(t["fp_freight_form_vendor"]).join(whs, "tms_whs_id", "left").select(
        FORM,
        F.struct(
            ROW,
            "tms_whs_id",
            "whs_number",
            "name",
            "system",
            F.coalesce("whs_live", F.lit(False)).alias("whs_live"),
            F.coalesce("known", F.lit(False)).alias("known"),
            F.coalesce("processed_flag", F.lit(False)).alias("processed"),
            F.coalesce(F.col("system") == K.EAST_SYSTEM, F.lit(False)).alias("east"),
            F.coalesce(F.col("tms_whs_id") == K.YORK_WAREHOUSE, F.lit(False)).alias("york"),
            F.coalesce(F.col("fp_ff_pickup_locations_id").isNull() & (method != K.VSP), F.lit(False)).alias("without_pickup"),
            (F.col("proposed_freight_per_lb").isNull() & F.coalesce(method != K.VSP, F.lit(True))).alias("without_freight"),
            method.isNull().alias("without_method"),
        ).alias("row"),
    )
    approved = live(t["fp_ff_approval_status"]).select(FORM, F.lit(True).alias("approved"))
    dates = parse_effective_dates(submissions).select(
        FORM, F.struct(ci(F.col("source_system")).alias("system"), "effective_date").alias("date")
    )
    live_whs = t["tms_whs"].select("tms_whs_id", not_deleted().alias("whs_live"))
    vendors = _chosen_vendors(t, submissions).join(live_whs, "tms_whs_id", "left").select(
        FORM,
        F.struct(
            "tms_vendor_id", "tms_whs_id", "vendor_number", ci(F.col("vendor_system")).alias("system"), F.coalesce("whs_live", F.lit(False)).alias("whs_live")
        ).alias("vendor"),
    )
    asked = submissions.select(FORM, F.struct("send_to_backhaul", F.col("remit_number").alias("asked_remit"), "user_id").alias("asked"))
    every = forms
    for part in (_pickups_with_use(t), rows, approved, dates, vendors, asked):
        every = every.unionByName(part, allowMissingColumns=True)
    return every


def form_facts(t: Tables, submissions: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per submission with a flag for every rule, and the rows that fail on their own.

    All child tables meet in one grouping by form and every flag is a conditional
    aggregate of it. The arrays are as short as a form's list of warehouses.
    """

    def any_of(part: str, test: Column) -> Column:
        return F.coalesce(F.max(F.when(F.col(part).isNotNull(), test)), F.lit(False))

    def count_of(part: str) -> Column:
        return F.count(F.when(F.col(part).isNotNull(), 1))

    date = F.col("date.effective_date")
    grouped = _parts_of_forms(t, submissions).groupBy(FORM).agg(
        F.first("form", ignorenulls=True).alias("form"),
        F.collect_list("asked").alias("asked"),
        (count_of("pickup") == 0).alias("no_location"),
        any_of("pickup", F.col("pickup.unscheduled")).alias("pickup_unscheduled"),
        any_of("approved", F.col("approved")).alias("approved"),
        (count_of("row") == 0).alias("no_rows"),
        *[any_of("row", F.col(f"row.{c}")).alias(f"row_{c}") for c in ("east", "york", "without_pickup", "without_freight")],
        any_of("row", F.col("row.without_method") & F.col("row.known")).alias("row_without_method"),
        any_of("row", ~F.col("row.known")).alias("row_without_whs"),
        F.collect_list(F.when(F.col("row.known"), F.col("row"))).alias("rows"),
        F.max(F.when(F.col("date").isNotNull(), date.isNull())).alias("date_missing"),
        F.max(F.when(F.col("date").isNotNull(), F.coalesce(date <= F.lit(as_of), F.lit(False)))).alias("date_past"),
        F.max(F.col("date.system") == K.EAST_SYSTEM).alias("east_asked"),
        F.collect_set("date.system").alias("systems"),
        F.collect_set("vendor").alias("vendors"),
    )
    homes = F.transform(F.filter("vendors", lambda v: v["whs_live"]), lambda v: v["tms_whs_id"])
    numbers = F.transform(F.filter("vendors", lambda v: v["system"] == K.EAST_SYSTEM), lambda v: v["vendor_number"])
    redone = F.transform(F.filter("rows", lambda r: r["processed"]), lambda r: r["system"])
    covered = F.transform("vendors", lambda v: v["tms_whs_id"])
    return grouped.filter("form is not null").select(
        FORM,
        "form.*",
        F.explode("asked").alias("asked"),
        "no_location",
        (~F.col("form.contact") & ~F.col("approved")).alias("no_contact"),
        (~F.col("form.supplier")).alias("no_supplier"),
        "no_rows",
        (F.col("row_east") & ~F.col("row_york")).alias("no_york"),
        "pickup_unscheduled",
        "row_without_pickup",
        "row_without_freight",
        "row_without_method",
        "row_without_whs",
        "date_missing",
        "date_past",
        "east_asked",
        F.arrays_overlap(F.array_compact(redone), "systems").alias("already_processed"),
        (F.size(homes) > F.size(F.array_distinct(homes))).alias("whs_twice"),
        (F.array_min(numbers) != F.array_max(numbers)).alias("east_numbers_differ"),
        F.filter("rows", lambda r: r["without_method"]).alias("rows_without_method"),
        F.when(
            F.col("form.fp_ff_type_id") == 1,
            F.filter(
                "rows",
                lambda r: r["whs_live"] & F.coalesce(F.array_contains("systems", r["system"]), F.lit(False)) & ~F.array_contains(covered, r["tms_whs_id"]),
            ),
        ).alias("rows_without_vendor"),
    ).select("*", "asked.*").drop("asked")


def _failed(rule: Rule) -> Column:
    error = F.struct(
        F.lit(rule.title).alias("title"),
        F.lit(rule.detail).alias("detail"),
        F.lit(rule.field).cast("string").alias("field_name"),
    )
    test = F.coalesce(F.col(rule.flag), F.lit(False))
    if rule.stages is not None:
        test = test & F.col("tms_status_id").isin(*rule.stages) & F.col("cleared")
    return F.when(test, error)


def _all_failed(rules) -> Column:
    return F.array_compact(F.array(*[_failed(r) for r in rules]))


def validate_forms(t: Tables, submissions: DataFrame, as_of: dt.date) -> DataFrame:
    """Error rows of every submitted form at its stage.

    The base checks always run; the stage's own checks run when the user has
    clearance, and the later ones only when nothing failed before them.
    """
    roles = user_roles(t["sec_users"], t["sec_user_roles"], t["sec_roles"], t["fp_escalation_roles"])
    status = F.col("tms_status_id")
    held = F
    refused = F
    for stage, names in CLEARANCE.items():
        test = F.col("super_admin")
        for name in names:
            test = test | F.col(name)
        held = held.when(status == stage, F.coalesce(test, F.lit(False)))
        refused = refused.when(status == stage, ROLE_NAMES[names])
    submitted = (
        form_facts(t, submissions, as_of)
        .join(roles, F.col("user_id") == F.col("sec_users_id"), "left")
        .withColumn("cleared", held.otherwise(False))
        .withColumn("refused_role", refused)
    )
    new_form = F.col("fp_ff_type_id") == 1
    asked = F.col("send_to_backhaul")
    submitted = submitted.withColumns(
        {
            "other_remit": new_form & (F.col("asked_remit") != F.col("saved_remit")),
            "undecided": asked.isNull(),
            "direct_without_freight": ~asked & F.col("row_without_freight"),
            "direct_unscheduled": ~asked & F.col("pickup_unscheduled"),
            "two_east_numbers": new_form & F.col("east_asked") & F.col("east_numbers_differ"),
        }
    )
    base = F
    for rule in BASE_CHAIN:
        base = base.when(F.col(rule.flag), _failed(rule))
    clearance = F.when(
        F.col("refused_role").isNotNull() & ~F.col("cleared"),
        F.struct(
            F.lit("Insufficient Clearance").alias("title"),
            F.concat(
                F.lit("Only "), F.col("refused_role"), F.lit(" security roles are able to process this form into the next stage")
            ).alias("detail"),
            F.lit("").alias("field_name"),
        ),
    )
    rows_without_method = F.col("row_without_method") & (status == K.IBL_INITIAL_ANALYSIS) & F.col("cleared")
    checked = submitted.select(
        FORM,
        status,
        "cleared",
        rows_without_method.alias("row_errors"),
        "rows_without_method",
        "rows_without_vendor",
        F.concat(
            F.array_compact(F.array(base, _failed(YORK), clearance)), _all_failed(STAGE_RULES + CLOSING_RULES)
        ).alias("first"),
        _all_failed(LATER_RULES).alias("later"),
    ).withColumn("clean", (F.size("first") == 0) & ~F.col("row_errors"))

    def of_form(e: Column) -> Column:
        none = F.lit(None).cast("bigint").alias("form_vendor_id")
        return F.struct(e["title"].alias("title"), e["detail"].alias("detail"), e["field_name"].alias("field_name"), none)

    def of_row(title: str, end: str):
        text = F.lit(None).cast("string").alias("field_name")
        return lambda r: F.struct(
            F.lit(title).alias("title"),
            F.concat(F.lit("Warehouse "), r["whs_number"], F.lit(" "), r["name"], F.lit(end)).alias("detail"),
            text,
            r[ROW].alias("form_vendor_id"),
        )

    form_errors = F.transform(F.when(F.col("clean"), F.col("later")).otherwise(F.col("first")), of_form)
    no_method = F.transform(
        F.when(F.col("row_errors"), F.col("rows_without_method")),
        of_row("All warehouses require a selected method", " has no selected method"),
    )
    no_vendor = F.transform(
        F.when((status == K.CLOSING) & F.col("cleared") & F.col("clean"), F.col("rows_without_vendor")),
        of_row("Warehouse has no vendor assigned to it", " has no associated vendor from the list you have provided"),
    )
    found = [F.coalesce(e, F.slice(form_errors, 1, 0)) for e in (form_errors, no_method, no_vendor)]
    return checked.select(F.col(FORM).alias("form_id"), F.explode(F.concat(*found)).alias("e")).select(
        "e.title", "e.detail", "e.field_name", "form_id", "e.form_vendor_id"
    )


def closing_checks(t: Tables, submissions: DataFrame, as_of: dt.date) -> DataFrame:
    """The closing flags of every submitted form, whatever its stage."""
    new_form = F.col("fp_ff_type_id") == 1
    return form_facts(t, submissions, as_of).select(
        FORM,
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("date_missing", "date_past", "already_processed", "row_without_whs", "whs_twice")],
        F.coalesce(new_form & (F.col("asked_remit") != F.col("saved_remit")), F.lit(False)).alias("other_remit"),
        F.coalesce(new_form & F.col("east_asked") & F.col("east_numbers_differ"), F.lit(False)).alias("two_east_numbers"),
        F.greatest(F.coalesce(F.size("rows_without_vendor"), F.lit(0)), F.lit(0)).cast("bigint").alias("rows_without_vendor"),
    )


def _closable(t: Tables, submissions: DataFrame, errors: DataFrame) -> DataFrame:
    """Submissions of forms in the closing state without any error."""
    closing = t["fp_freight_form"].filter(F.col("tms_status_id") == K.CLOSING).select(FORM, "fp_ff_type_id")
    failed = errors.select(F.col("form_id").alias(FORM)).distinct()
    return submissions.join(closing, FORM).join(failed, FORM, "left_anti")


def closed_vendor_rows(t: Tables, submissions: DataFrame, errors: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Vendor-row changes of closing forms: vendor id, effective date, processed flag."""
    asked = _closable(t, submissions, errors)
    dates = parse_effective_dates(asked)
    per_system = dates.groupBy(FORM, ci(F.col("source_system")).alias("system")).agg(
        F.min("effective_date").alias("asked_date")
    )
    chosen = _chosen_vendors(t, asked.filter("fp_ff_type_id = 1")).groupBy(FORM, "tms_whs_id").agg(
        F.min("tms_vendor_id").alias("chosen_vendor")
    )
    whs = t["tms_whs"].select("tms_whs_id", ci(F.col("source_system")).alias("system"))
    return (
        t["fp_freight_form_vendor"]
        .select(FORM, ROW, "tms_whs_id", "tms_vendor_id", "effective_date", "processed_flag")
        .join(asked.select(FORM, "user_id"), FORM)
        .join(whs, "tms_whs_id", "left")
        .join(per_system, [FORM, "system"], "left")
        .join(chosen, [FORM, "tms_whs_id"], "left")
        .filter(F.col("chosen_vendor").isNotNull() | F.col("asked_date").isNotNull())
        .select(
            FORM,
            ROW,
            F.coalesce("chosen_vendor", "tms_vendor_id").alias("tms_vendor_id"),
            F.coalesce("asked_date", "effective_date").alias("effective_date"),
            F.when(F.col("asked_date").isNotNull(), True).otherwise(F.col("processed_flag")).alias("processed_flag"),
            F.col("user_id").alias("modified_by"),
            moment(as_of).alias("modified_date"),
        )
    )


def closed_forms(t: Tables, submissions: DataFrame, errors: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Form changes of closing forms: new forms take the submitted remit number."""
    asked = _closable(t, submissions, errors).withColumnRenamed("remit_number", "asked_remit")
    return t["fp_freight_form"].select(FORM, "remit_number").join(asked, FORM).select(
        FORM,
        F.when((F.col("fp_ff_type_id") == 1) & F.col("asked_remit").isNotNull(), F.col("asked_remit"))
        .otherwise(F.col("remit_number"))
        .alias("remit_number"),
        F.col("user_id").alias("modified_by"),
        moment(as_of).alias("modified_date"),
    )


def closed_vendor_rates(t: Tables, submissions: DataFrame, errors: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Vendor-master changes: the blended or own rate of the closing forms' rows.

    A vendor on several rows takes the row with the lowest form and row id.
    """
    changed = closed_vendor_rows(t, submissions, errors, as_of).select(ROW, F.col("tms_vendor_id").alias("new_vendor"))
    asked = _closable(t, submissions, errors).select(FORM, "user_id")
    forms = t["fp_freight_form"].select(FORM, *[f"{b}_blended_freight_rate" for b in K.BLENDS])
    whs = t["tms_whs"].select("tms_whs_id", F.col("source_system").alias("whs_system"))
    rows = (
        live(t["fp_freight_form_vendor"])
        .join(asked, FORM)
        .join(forms, FORM)
        .join(whs, "tms_whs_id")
        .join(changed, ROW, "left")
        .withColumn("tms_vendor_id", F.coalesce("new_vendor", "tms_vendor_id"))
    )
    rate = blended_rate_of(F.col("whs_system"), F.col("tms_whs_id"), F.col("proposed_freight_per_lb"))
    return (
        rows.withColumn("rate", rate.cast(dec(18, 6)))
        .groupBy("tms_vendor_id")
        .agg(lowest({"rate": F.col("rate"), "user": F.col("user_id")}, F.col(FORM), F.col(ROW)).alias("row"))
        .join(t["tms_vendor"].select("tms_vendor_id"), "tms_vendor_id", "left_semi")
        .select(
            "tms_vendor_id",
            F.col("row.rate").alias("booked_freight_per_lb"),
            F.col("row.user").alias("modified_by"),
            moment(as_of).alias("modified_date"),
        )
    )


def advance_stage(t: Tables, submissions: DataFrame, errors: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The next state of every submitted form without errors.

    A closing form is completed when all its live rows are processed, counting
    the ones this submission processes; otherwise it stays.
    """
    failed = errors.select(F.col("form_id").alias(FORM)).distinct()
    now = closed_vendor_rows(t, submissions, errors, as_of).select(ROW, F.col("processed_flag").alias("now"))
    left_over = (
        live(t["fp_freight_form_vendor"])
        .select(FORM, ROW, "processed_flag")
        .join(now, ROW, "left")
        .groupBy(FORM)
        .agg(F.max(~F.coalesce("now", "processed_flag", F.lit(False))).alias("left_over"))
    )
    status, kind = F.col("tms_status_id"), F.col("fp_ff_type_id")
    step = F.when(status == K.NEW, F.when(kind.isin(3, 4), K.IBL_SUBMIT).otherwise(K.SRM_SUBMIT)).when(
        status == K.IBL_INITIAL_ANALYSIS,
        F.when(F.col("send_to_backhaul"), K.BACKHAUL_ANALYSIS).when(~F.col("send_to_backhaul"), K.SRM_VENDOR_CONFIRMATION),
    )
    step = step.when(
        status == K.CLOSING,
        F.when(~F.coalesce("left_over", F.lit(False)), K.COMPLETED).otherwise(K.CLOSING),
    )
    for before, after in NEXT_STATE.items():
        step = step.when(status == before, after)
    stamp = moment(as_of)
    forms = t["fp_freight_form"].select(FORM, "tms_status_id", "fp_ff_type_id", "submit_date")
    return (
        forms.join(submissions.select(FORM, "user_id", "send_to_backhaul"), FORM)
        .join(failed, FORM, "left_anti")
        .join(left_over, FORM, "left")
        .withColumn("next_status_id", step.cast("bigint"))
        .filter(F.col("next_status_id").isNotNull())
        .select(
            FORM,
            "tms_status_id",
            "next_status_id",
            F.when(status.isin(*SUBMITTING_STATES), stamp).otherwise(F.col("submit_date").cast("timestamp_ntz")).alias("submit_date"),
            F.col("user_id").alias("modified_by"),
            stamp.alias("modified_date"),
        )
    )


def backhaul_requests(t: Tables, form_ids: DataFrame | None = None) -> DataFrame:
    """Weight and pallets to offer each warehouse contact, per pickup address."""
    forms = t["fp_freight_form"].select(FORM, "fp_ff_temperature_id")
    if form_ids is not None:
        forms = forms.join(form_ids.select(FORM).distinct(), FORM, "left_semi")
    temperatures = t["fp_ff_temperature"].select("fp_ff_temperature_id", F.col("description").alias("temperature"))
    pickups = t["fp_ff_pickup_locations"].select(
        "fp_ff_pickup_locations_id", *[F.trim(c).alias(c) for c in ("address", "city", "state", "zip")]
    )

    def whs(prefix: str, key: str) -> DataFrame:
        return t["tms_whs"].select(
            F.col("tms_whs_id").alias(key), F.col("tms_whs_id").alias(f"{prefix}_whs"), F.col("backhaul_email").alias(f"{prefix}_email")
        )

    direct = F.col("fp_ff_method_id") == K.BACKHAUL
    offers = (
        live(t["fp_freight_form_vendor"])
        .filter(F.col("fp_ff_method_id").isin(K.BACKHAUL, K.BACKHAUL_CROSSDOCK))
        .join(forms, FORM)
        .join(pickups, "fp_ff_pickup_locations_id")
        .join(whs("own", "tms_whs_id"), "tms_whs_id")
        .join(whs("dock", "crossdock_whs_id"), "crossdock_whs_id", "left")
        .join(temperatures, "fp_ff_temperature_id", "left")
        .select(
            FORM,
            F.when(direct, F.col("own_email")).otherwise(F.col("dock_email")).alias("email_to"),
            F.when(direct, F.col("own_whs")).otherwise(F.col("dock_whs")).alias("contact_whs_id"),
            "address",
            "city",
            "state",
            "zip",
            "temperature",
            "average_po_weight",
            "average_pallets_per_po",
        )
    )
    # A group has few rows: they meet in small parts, not before the shuffle in the few tasks that read the tables.
    return (
        offers.repartition(FORM, "contact_whs_id", "address")
        .groupBy(FORM, "email_to", "contact_whs_id", "address", "city", "state", "zip", "temperature")
        .agg(
            F.sum(or_zero(F.col("average_po_weight"))).cast(dec(28, 3)).alias("total_weight"),
            F.sum(or_zero(F.col("average_pallets_per_po"))).cast(dec(28, 3)).alias("total_pallets"),
        )
        .withColumn("volume_text", F.concat(F.format_number("total_weight", 3), F.lit(" LBS, "), F.format_number("total_pallets", 0), F.lit(" Pallets")))
    )


def submit_forms(t: Tables, submissions: DataFrame, as_of: dt.datetime) -> dict[str, DataFrame]:
    """Everything a batch of submissions leads to.

    ``errors``, the new versions of the three changed tables (``forms``,
    ``vendor_rows``, ``vendors``), the log rows (``form_log``, ``row_log``) of
    forms that moved on, and the outbound records of closed forms
    (``pricing_out``; new forms are not sent). The errors decide every other
    result, so they are written once and read back.
    """
    errors = cut_lineage(validate_forms(t, submissions, as_of.date()))
    moves = advance_stage(t, submissions, errors, as_of)
    rows = apply_updates(
        t["fp_freight_form_vendor"], closed_vendor_rows(t, submissions, errors, as_of), [ROW]
    )
    forms = apply_updates(t["fp_freight_form"], closed_forms(t, submissions, errors, as_of), [FORM])
    steps = moves.select(FORM, F.col("next_status_id").alias("tms_status_id"), "submit_date", "modified_by", "modified_date")
    forms = apply_updates(forms, steps, [FORM])
    vendors = apply_updates(
        t["tms_vendor"], closed_vendor_rates(t, submissions, errors, as_of), ["tms_vendor_id"]
    )
    moved = submissions.join(
        moves.filter(F.col("next_status_id") != F.col("tms_status_id")).select(FORM), FORM, "left_semi"
    )
    form_log, row_log = snapshot_forms(forms, rows, moved, as_of)
    sent = _closable(t, submissions, errors).filter("fp_ff_type_id <> 1")
    after = ChainMap({"fp_freight_form": forms, "fp_freight_form_vendor": rows, "tms_vendor": vendors}, t)
    return {
        "errors": errors,
        "forms": forms,
        "vendor_rows": rows,
        "vendors": vendors,
        "form_log": form_log,
        "row_log": row_log,
        "pricing_out": pricing_out(after, sent, parse_effective_dates(sent), as_of),
    }
