"""Form-workflow queries and their checks."""

from __future__ import annotations

import datetime as dt

from haulmark.catalog.base import query
from haulmark.plans import workflow as W
from haulmark.session import cut_lineage

TODAY = dt.date(2001, 12, 31)
NOW = dt.datetime(2001, 12, 31, 9, 30)
LIVE = "COALESCE({}.is_deleted, FALSE) = FALSE"

ROLES = f"""SELECT u.sec_users_id, COALESCE(u.super_admin, FALSE) AS super_admin,
  {', '.join(f"COALESCE(SUM(CASE WHEN e.fp_escalation_class = '{c}' THEN 1 ELSE 0 END) > 0, FALSE) AS {n}" for c, n in (('A', 'is_srm'), ('B', 'is_ibl'), ('C', 'is_costing')))}
FROM sec_users u LEFT JOIN sec_user_roles ur ON u.sec_users_id = ur.sec_users_id AND {LIVE.format('ur')}
LEFT JOIN sec_roles r ON ur.sec_roles_id = r.sec_roles_id AND {LIVE.format('r')} LEFT JOIN fp_escalation_roles e ON r.sec_roles_id = e.sec_roles_id GROUP BY 1, 2"""

DATES = """SELECT fp_freight_form_id, split_part(entry, '_', 1) AS source_system, CAST(NULLIF(split_part(entry, '_', 2), '') AS DATE) AS effective_date
FROM (SELECT fp_freight_form_id, unnest(string_split(source_system_dates, ',')) AS entry FROM submissions) e"""

CHOSEN = f"""SELECT DISTINCT c.fp_freight_form_id, v.tms_vendor_id, v.tms_whs_id, v.vendor_number, v.source_system
FROM (SELECT fp_freight_form_id, CAST(unnest(string_split(vendor_numbers, ',')) AS BIGINT) AS id FROM submissions) c JOIN tms_vendor v ON v.tms_vendor_id = c.id AND {LIVE.format('v')}"""


def _count(sql: str) -> str:
    return f"(SELECT COUNT(*) FROM {sql})"


_rows = f"fp_freight_form_vendor v WHERE v.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('v')}"
_used = f"""fp_ff_pickup_locations k WHERE k.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('k')} AND k.fp_ff_pickup_locations_id IN
  (SELECT v.fp_ff_pickup_locations_id FROM fp_freight_form_vendor v WHERE {LIVE.format('v')})"""

# The long way: counts per form, then one SELECT per rule.
BASE = f"""roles AS ({ROLES}), dates AS ({DATES}), chosen AS ({CHOSEN}),
c AS (SELECT f.fp_freight_form_id AS id, f.tms_status_id AS st, f.fp_ff_type_id AS kind, s.send_to_backhaul AS bh, s.user_id, s.remit_number AS asked, f.remit_number AS saved, s.comment,
    {_count(f"fp_ff_pickup_locations k WHERE k.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('k')}")} AS locations,
    CASE WHEN {LIVE.format('f')} AND f.tms_srm_id IS NOT NULL THEN 1 ELSE 0 END AS sm,
    {_count(f"fp_ff_approval_status a WHERE a.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('a')}")} AS ucs,
    CASE WHEN {LIVE.format('f')} AND f.supplier_name IS NOT NULL THEN 1 ELSE 0 END AS supplier,
    {_count(_rows)} AS n_rows,
    {_count(f"fp_freight_form_vendor v JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id WHERE v.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('v')} AND w.source_system = 'UBS'")} AS east,
    {_count(_rows + ' AND v.tms_whs_id = 12')} AS york,
    CASE WHEN {LIVE.format('f')} AND f.freight_analyst_user_id IS NULL THEN 1 ELSE 0 END AS analyst, CASE WHEN {LIVE.format('f')} AND f.fp_ff_freight_change_reason_id IS NULL THEN 1 ELSE 0 END AS reason,
    CASE WHEN {LIVE.format('f')} AND f.fp_ff_allowance_type_id IS NULL THEN 1 ELSE 0 END AS kindless,
    {_count(_rows + ' AND v.fp_ff_pickup_locations_id IS NULL AND v.fp_ff_method_id <> 4')} AS no_pickup,
    {_count(_used)} AS used, {_count(_used + ' AND k.d_rte IS NOT NULL AND k.pickup_day IS NOT NULL')} AS droute,
    {_count(_rows + ' AND v.proposed_freight_per_lb IS NULL AND (v.fp_ff_method_id IS NULL OR v.fp_ff_method_id <> 4)')} AS no_freight,
    {_count(f"fp_freight_form_vendor v JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id WHERE v.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('v')} AND v.fp_ff_method_id IS NULL")} AS no_method,
    {_count('dates d WHERE d.fp_freight_form_id = f.fp_freight_form_id AND d.effective_date IS NULL')} AS undated,
    {_count(f"dates d WHERE d.fp_freight_form_id = f.fp_freight_form_id AND d.effective_date <= DATE '{TODAY}'")} AS late,
    {_count(f"fp_freight_form_vendor v JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id JOIN dates d ON d.source_system = w.source_system AND d.fp_freight_form_id = v.fp_freight_form_id WHERE v.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('v')} AND v.processed_flag")} AS redone,
    {_count(f"fp_freight_form_vendor v LEFT JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id WHERE v.fp_freight_form_id = f.fp_freight_form_id AND {LIVE.format('v')} AND w.tms_whs_id IS NULL")} AS no_whs,
    {_count(f"(SELECT x.fp_freight_form_id, x.tms_whs_id FROM chosen x JOIN tms_whs w ON x.tms_whs_id = w.tms_whs_id AND {LIVE.format('w')} GROUP BY 1, 2 HAVING COUNT(*) > 1) q WHERE q.fp_freight_form_id = f.fp_freight_form_id")} AS twice,
    (SELECT COUNT(DISTINCT x.vendor_number) FROM chosen x WHERE x.fp_freight_form_id = f.fp_freight_form_id AND x.source_system = 'UBS') AS numbers,
    {_count("dates d WHERE d.fp_freight_form_id = f.fp_freight_form_id AND d.source_system = 'UBS'")} AS east_asked
  FROM fp_freight_form f JOIN submissions s ON f.fp_freight_form_id = s.fp_freight_form_id),
k AS (SELECT c.*, COALESCE(CASE WHEN st = 53 THEN super_admin OR is_srm OR is_ibl WHEN st IN (54, 55, 56) THEN super_admin OR is_srm WHEN st IN (57, 58, 59, 60, 61, 67) THEN super_admin OR is_ibl
    WHEN st = 62 THEN super_admin OR is_costing END, FALSE) AS ok,
    CASE WHEN st = 53 THEN 'SRM or IBL' WHEN st IN (54, 55, 56) THEN 'SRM' WHEN st IN (57, 58, 59, 60, 61, 67) THEN 'IBL' WHEN st = 62 THEN 'Costing or Coding' END AS role
  FROM c LEFT JOIN roles r ON c.user_id = r.sec_users_id),
nov AS (SELECT v.fp_freight_form_id AS id, v.fp_freight_form_vendor_id AS vid, w.whs_number, w.name FROM fp_freight_form_vendor v JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id AND {LIVE.format('w')}
    JOIN (SELECT DISTINCT fp_freight_form_id, source_system FROM dates) d ON w.source_system = d.source_system AND d.fp_freight_form_id = v.fp_freight_form_id
    JOIN fp_freight_form f ON f.fp_freight_form_id = v.fp_freight_form_id AND f.fp_ff_type_id = 1
  WHERE {LIVE.format('v')} AND NOT EXISTS (SELECT 1 FROM chosen x WHERE x.fp_freight_form_id = v.fp_freight_form_id AND x.tms_whs_id = v.tms_whs_id))"""


def _rule(title: str, detail: str, field: str | None, where: str) -> str:
    shown = "CAST(NULL AS VARCHAR)" if field is None else f"'{field}'"
    return f"SELECT '{title}' AS title, '{detail}' AS detail, {shown} AS field_name, id AS form_id, CAST(NULL AS BIGINT) AS form_vendor_id FROM k WHERE {where}"


_texts = {r.flag: (r.title, r.detail, r.field) for r in W.BASE_CHAIN + (W.YORK,) + W.STAGE_RULES + W.CLOSING_RULES + W.LATER_RULES}
_FIRST = [
    _rule(*_texts["no_location"], "locations = 0"),
    _rule(*_texts["no_contact"], "locations > 0 AND sm = 0 AND ucs = 0"),
    _rule(*_texts["no_supplier"], "locations > 0 AND NOT (sm = 0 AND ucs = 0) AND supplier = 0"),
    _rule(*_texts["no_rows"], "locations > 0 AND NOT (sm = 0 AND ucs = 0) AND supplier > 0 AND n_rows = 0"),
    _rule(*_texts["no_york"], "east > 0 AND york = 0"),
    "SELECT 'Insufficient Clearance', 'Only ' || role || ' security roles are able to process this form into the next stage', '', id, CAST(NULL AS BIGINT) FROM k WHERE role IS NOT NULL AND NOT ok",
    _rule(*_texts["no_analyst"], "ok AND analyst > 0 AND st IN (55, 58, 59, 60, 61, 62, 67)"),
    _rule(*_texts["no_reason"], "ok AND reason > 0 AND st IN (55, 58, 59, 60, 62)"),
    _rule(*_texts["no_allowance_type"], "ok AND kindless > 0 AND st IN (55, 58, 59, 60, 61, 62, 67)"),
    _rule(*_texts["row_without_pickup"], "ok AND no_pickup > 0 AND st IN (55, 58, 59, 60, 61, 62, 67)"),
    _rule(*_texts["pickup_unscheduled"], "ok AND droute <> used AND st IN (55, 59, 60, 61, 62, 67)"),
    _rule(*_texts["row_without_freight"], "ok AND no_freight > 0 AND st IN (59, 60)"),
    _rule(*_texts["date_missing"], "ok AND undated > 0 AND st = 62"),
    _rule(*_texts["date_past"], "ok AND late > 0 AND st = 62"),
    _rule(*_texts["already_processed"], "ok AND redone > 0 AND st = 62"),
    _rule(*_texts["other_remit"], "ok AND kind = 1 AND saved IS NOT NULL AND asked <> saved AND st = 62"),
    _rule(*_texts["row_without_whs"], "ok AND no_whs > 0 AND st = 62"),
    _rule(*_texts["whs_twice"], "ok AND twice > 0 AND st = 62"),
    f"""SELECT 'All warehouses require a selected method', 'Warehouse ' || w.whs_number || ' ' || w.name || ' has no selected method', CAST(NULL AS VARCHAR), k.id, v.fp_freight_form_vendor_id
    FROM k JOIN fp_freight_form_vendor v ON v.fp_freight_form_id = k.id JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id WHERE ok AND st = 58 AND {LIVE.format('v')} AND v.fp_ff_method_id IS NULL""",
]
_LATER = [
    _rule(*_texts["undecided"], "clean AND ok AND st = 58 AND bh IS NULL"),
    _rule(*_texts["direct_without_freight"], "clean AND ok AND st = 58 AND bh = FALSE AND no_freight > 0"),
    _rule(*_texts["direct_unscheduled"], "clean AND ok AND st = 58 AND bh = FALSE AND droute <> used"),
    _rule(*_texts["two_east_numbers"], "clean AND ok AND st = 62 AND kind = 1 AND east_asked > 0 AND numbers > 1"),
    """SELECT 'Warehouse has no vendor assigned to it', 'Warehouse ' || whs_number || ' ' || name || ' has no associated vendor from the list you have provided', CAST(NULL AS VARCHAR), k.id, nov.vid
    FROM k JOIN nov ON k.id = nov.id WHERE clean AND ok AND st = 62""",
]
ERRORS = f"""{BASE}, first_errors AS ({' UNION ALL '.join(_FIRST)}),
k2 AS (SELECT k.*, id NOT IN (SELECT form_id FROM first_errors) AS clean FROM k),
errors AS (SELECT * FROM first_errors UNION ALL {' UNION ALL '.join(q.replace('FROM k ', 'FROM k2 k ') for q in _LATER)})"""

CLOSE = f"""{ERRORS}, good AS (SELECT * FROM k WHERE st = 62 AND id NOT IN (SELECT form_id FROM errors)),
vrows AS (SELECT * FROM (SELECT v.fp_freight_form_id, v.fp_freight_form_vendor_id, v.is_deleted,
    COALESCE(CASE WHEN g.kind = 1 THEN (SELECT MIN(x.tms_vendor_id) FROM chosen x WHERE x.fp_freight_form_id = v.fp_freight_form_id AND x.tms_whs_id = v.tms_whs_id) END, NULL) AS picked,
    v.tms_vendor_id AS old_vendor, (SELECT MIN(d.effective_date) FROM dates d JOIN tms_whs w ON w.source_system = d.source_system WHERE w.tms_whs_id = v.tms_whs_id AND d.fp_freight_form_id = v.fp_freight_form_id) AS asked_date,
    v.effective_date AS old_date, v.processed_flag AS old_flag, g.user_id, v.tms_whs_id, v.proposed_freight_per_lb
  FROM fp_freight_form_vendor v JOIN good g ON v.fp_freight_form_id = g.id) z)"""
_NOW = f"TIMESTAMP '{NOW}' AS modified_date"


def _errors(t):
    return W.validate_forms(t, t["submissions"], TODAY)


def _fixed_errors(t):
    """Errors written once: the change sets below read them several times."""
    return cut_lineage(_errors(t))


@query("user_roles", ROLES)
def _(t):
    return W.user_roles(t["sec_users"], t["sec_user_roles"], t["sec_roles"], t["fp_escalation_roles"])


@query("parse_effective_dates", DATES)
def _(t):
    return W.parse_effective_dates(t["submissions"])


@query("validate_forms", f"WITH {ERRORS} SELECT * FROM errors")
def _(t):
    return _errors(t)


@query(
    "closing_checks",
    f"""WITH {BASE} SELECT id AS fp_freight_form_id, undated > 0 AS date_missing, late > 0 AS date_past, redone > 0 AS already_processed, no_whs > 0 AS row_without_whs, twice > 0 AS whs_twice,
      COALESCE(kind = 1 AND saved IS NOT NULL AND asked <> saved, FALSE) AS other_remit, kind = 1 AND east_asked > 0 AND numbers > 1 AS two_east_numbers,
      (SELECT COUNT(*) FROM nov WHERE nov.id = k.id) AS rows_without_vendor FROM k""",
)
def _(t):
    return W.closing_checks(t, t["submissions"], TODAY)


@query(
    "close_forms_vendor_rows",
    f"""WITH {CLOSE} SELECT fp_freight_form_id, fp_freight_form_vendor_id, COALESCE(picked, old_vendor) AS tms_vendor_id, COALESCE(asked_date, old_date) AS effective_date,
      CASE WHEN asked_date IS NOT NULL THEN TRUE ELSE old_flag END AS processed_flag, user_id AS modified_by, {_NOW} FROM vrows WHERE picked IS NOT NULL OR asked_date IS NOT NULL""",
)
def _(t):
    return W.closed_vendor_rows(t, t["submissions"], _fixed_errors(t), NOW)


@query(
    "close_forms",
    f"WITH {CLOSE} SELECT id AS fp_freight_form_id, CASE WHEN kind = 1 AND asked IS NOT NULL THEN asked ELSE saved END AS remit_number, user_id AS modified_by, {_NOW} FROM good",
)
def _(t):
    return W.closed_forms(t, t["submissions"], _fixed_errors(t), NOW)


@query(
    "close_forms_vendor_rates",
    f"""WITH {CLOSE} SELECT tms_vendor_id, booked_freight_per_lb, user_id AS modified_by, {_NOW} FROM (
      SELECT tv.tms_vendor_id, r.user_id, ROW_NUMBER() OVER (PARTITION BY tv.tms_vendor_id ORDER BY r.fp_freight_form_id, r.fp_freight_form_vendor_id) AS rn,
        CAST(CASE WHEN w.source_system = 'UBS' THEN f.east_blended_freight_rate WHEN w.tms_whs_id IN (1, 114) THEN f.gilroc_blended_freight_rate
          WHEN w.tms_whs_id IN (168, 169) THEN f.harcar_blended_freight_rate WHEN w.tms_whs_id IN (160, 214) THEN f.stksgm_blended_freight_rate
          WHEN w.tms_whs_id IN (178, 186) THEN f.annser_blended_freight_rate ELSE r.proposed_freight_per_lb END AS DECIMAL(18, 6)) AS booked_freight_per_lb
      FROM vrows r JOIN fp_freight_form f ON r.fp_freight_form_id = f.fp_freight_form_id JOIN tms_vendor tv ON tv.tms_vendor_id = COALESCE(r.picked, r.old_vendor)
      JOIN tms_whs w ON r.tms_whs_id = w.tms_whs_id WHERE {LIVE.format('r')}) q WHERE rn = 1""",
    "booked_freight_per_lb",
)
def _(t):
    return W.closed_vendor_rates(t, t["submissions"], _fixed_errors(t), NOW)


@query(
    "advance_stage",
    f"""WITH {CLOSE} SELECT * FROM (SELECT id AS fp_freight_form_id, st AS tms_status_id, CAST(CASE st WHEN 53 THEN CASE WHEN kind IN (3, 4) THEN 57 ELSE 54 END WHEN 54 THEN 58 WHEN 55 THEN 62 WHEN 56 THEN 58
        WHEN 57 THEN 56 WHEN 58 THEN CASE WHEN bh THEN 61 WHEN NOT bh THEN 55 END WHEN 59 THEN 55 WHEN 60 THEN 55 WHEN 61 THEN 60 WHEN 67 THEN 65
        WHEN 62 THEN CASE WHEN EXISTS (SELECT 1 FROM vrows r WHERE r.fp_freight_form_id = k.id AND {LIVE.format('r')} AND asked_date IS NULL AND COALESCE(old_flag, FALSE) = FALSE) THEN 62 ELSE 66 END
      END AS BIGINT) AS next_status_id,
      CASE WHEN st IN (54, 56) THEN TIMESTAMP '{NOW}' ELSE CAST(f.submit_date AS TIMESTAMP) END AS submit_date, user_id AS modified_by, {_NOW}
    FROM k JOIN fp_freight_form f ON f.fp_freight_form_id = k.id WHERE id NOT IN (SELECT form_id FROM errors)) z WHERE next_status_id IS NOT NULL""",
)
def _(t):
    return W.advance_stage(t, t["submissions"], _fixed_errors(t), NOW)


@query(
    "backhaul_requests",
    f"""SELECT *, format('{{:,.3f}}', CAST(total_weight AS DOUBLE)) || ' LBS, ' || format('{{:,.0f}}', CAST(total_pallets AS DOUBLE)) || ' Pallets' AS volume_text FROM (
      SELECT f.fp_freight_form_id, CASE WHEN v.fp_ff_method_id = 1 THEN w.backhaul_email ELSE x.backhaul_email END AS email_to,
        CASE WHEN v.fp_ff_method_id = 1 THEN w.tms_whs_id ELSE x.tms_whs_id END AS contact_whs_id, TRIM(k.address) AS address, TRIM(k.city) AS city, TRIM(k.state) AS state, TRIM(k.zip) AS zip,
        tp.description AS temperature, SUM(COALESCE(v.average_po_weight, 0)) AS total_weight, SUM(COALESCE(v.average_pallets_per_po, 0)) AS total_pallets
      FROM fp_freight_form f JOIN fp_freight_form_vendor v ON f.fp_freight_form_id = v.fp_freight_form_id JOIN fp_ff_pickup_locations k ON v.fp_ff_pickup_locations_id = k.fp_ff_pickup_locations_id
      JOIN tms_whs w ON v.tms_whs_id = w.tms_whs_id LEFT JOIN tms_whs x ON v.crossdock_whs_id = x.tms_whs_id LEFT JOIN fp_ff_temperature tp ON f.fp_ff_temperature_id = tp.fp_ff_temperature_id
      WHERE v.fp_ff_method_id IN (1, 2) AND {LIVE.format('v')} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) g""",
    "total_weight total_pallets",
)
def _(t):
    return W.backhaul_requests(t)


@query(
    "submit_forms",
    f"""WITH {CLOSE} SELECT f.fp_freight_form_id, CAST(CASE WHEN e.form_id IS NOT NULL THEN f.tms_status_id ELSE COALESCE(CASE st WHEN 53 THEN CASE WHEN kind IN (3, 4) THEN 57 ELSE 54 END WHEN 54 THEN 58
        WHEN 55 THEN 62 WHEN 56 THEN 58 WHEN 57 THEN 56 WHEN 58 THEN CASE WHEN bh THEN 61 WHEN NOT bh THEN 55 END WHEN 59 THEN 55 WHEN 60 THEN 55 WHEN 61 THEN 60 WHEN 67 THEN 65
        WHEN 62 THEN CASE WHEN EXISTS (SELECT 1 FROM vrows r WHERE r.fp_freight_form_id = k.id AND {LIVE.format('r')} AND asked_date IS NULL AND COALESCE(old_flag, FALSE) = FALSE) THEN 62 ELSE 66 END
      END, f.tms_status_id) END AS BIGINT) AS tms_status_id,
      CASE WHEN g.gid IS NOT NULL AND gkind = 1 AND gasked IS NOT NULL THEN gasked ELSE f.remit_number END AS remit_number
    FROM fp_freight_form f JOIN k ON f.fp_freight_form_id = k.id LEFT JOIN (SELECT DISTINCT form_id FROM errors) e ON e.form_id = k.id LEFT JOIN (SELECT id AS gid, kind AS gkind, asked AS gasked FROM good) g ON g.gid = k.id""",
)
def _(t):
    return W.submit_forms(t, t["submissions"], NOW)["forms"].select("fp_freight_form_id", "tms_status_id", "remit_number")
