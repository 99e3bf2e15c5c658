"""Row-multiset comparison of a Spark result with a SQL result."""
from collections import Counter
from decimal import Decimal
import datetime as dt


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def compare(df, con, sql, show=3):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    rel = con.sql(sql)
    names = list(rel.columns)
    if sorted(names) != cols:
        return f"COLUMNS {sorted(set(names) ^ set(cols))}"
    types = dict(zip(names, [str(t) for t in rel.types]))
    order = [names.index(c) for c in cols]
    other = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    simple = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    bad = [(c, t, types[c]) for c, t in df.dtypes
           if (simple.get(t) or t.upper().replace("DECIMAL", "DECIMAL")).replace(" ", "") != types[c].replace(" ", "")]
    a, b = Counter(rows), Counter(other)
    note = f" TYPES {bad}" if bad else ""
    if a == b:
        return f"ok rows={len(rows)}{note}"
    ab, ba = list((a - b).elements()), list((b - a).elements())
    out = f"DIFF spark={len(rows)} sql={len(other)} only_spark={len(ab)} only_sql={len(ba)}{note}"
    for x, y in list(zip(sorted(ab, key=str), sorted(ba, key=str)))[:show]:
        out += "\n   " + str([(c, p, q) for c, p, q in zip(cols, x, y) if p != q])
    if not (ab and ba):
        out += "\n   " + str((ab or ba)[:1])
    return out
