"""Facts by month, keyed merges, the outbox, states by the day, joins of moments and periods, and joins on hot keys."""

import datetime as dt
import json
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from haulmark.catalog import storage
from haulmark.operators import costs as C
from haulmark.operators import history as H
from haulmark.operators.intervals import join_periods
from haulmark.operators.spread import hot_keys, join_spread, with_totals
from haulmark.sources import facts, keyed, outbox


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- facts by month


def test_window_from_a_table_prunes_months(spark, bed):
    path = storage.stored_orders(bed)
    window = storage.period_window(bed)
    found = facts.read_windows(spark, path, window, "start_date", "end_date", "rec_date")
    assert "dynamicpruning" in plan_of(found)
    first, last = window.first()
    rows = bed["lo_purchase_orders"].filter(F.to_date("rec_date").between(first, last)).count()
    assert 0 < found.count() == rows
    months = {str(p.name) for p in Path(path.removeprefix("file:")).glob("receive_month=*")}
    opened = {Path(f).parent.name for f in spark.read.parquet(path).filter(F.to_date("rec_date").between(first, last)).select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert opened < months


def test_windows_overlap_or_lack_a_bound(spark, tmp_path):
    day = dt.date(2020, 1, 1)
    rows = [(i, day + dt.timedelta(days=i)) for i in range(200)] + [(999, None)]
    facts.store_by_month(spark.createDataFrame(rows, "id long, d date"), str(tmp_path / "f"), "d")
    spans = [(dt.date(2020, 1, 30), dt.date(2020, 2, 2)), (dt.date(2020, 2, 1), dt.date(2020, 2, 4)), (None, day), (dt.date(2020, 5, 1), dt.date(2020, 4, 1))]
    windows = spark.createDataFrame(spans, "a date, b date")
    found = facts.read_windows(spark, str(tmp_path / "f"), windows, "a", "b", "d")
    assert sorted(r.id for r in found.collect()) == [29, 30, 31, 32, 33, 34] and found.columns == ["id", "d"]


@pytest.mark.parametrize("name", ["allocate_invoices", "not_fully_billed", "supplier_billing_report", "supplier_performance", "supplier_scorecard", "supplier_expense_by_mode"])
def test_a_window_reaches_every_order_scan_that_it_governs(spark, bed, name):
    from haulmark.plans import reports as R

    start, end = "1997-03-01", "1997-03-28"
    runs = {
        "allocate_invoices": lambda: C.allocate_invoices(bed["lo_purchase_orders"], bed["bl_bill_pos"], bed["bl_billing"], start, end),
        "not_fully_billed": lambda: R._gaps(bed, start, end),
        "supplier_billing_report": lambda: R.supplier_billing_report(bed, start, end),
        "supplier_performance": lambda: R.supplier_performance(bed, start, end, remit="ALL"),
        "supplier_scorecard": lambda: R.supplier_scorecard(bed, start, end),
        "supplier_expense_by_mode": lambda: R.supplier_expense_by_mode(bed, start, end),
    }
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(runs[name]())
    assert "GreaterThanOrEqual(l_shipdate,1997-03-01" in plan and "LessThan(l_shipdate,1997-03-29" in plan


# --- keyed merge


def _files(path):
    return {p.parent.name: {q.name for q in p.parent.glob("*.parquet")} for p in Path(path).rglob("*.parquet")}


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(i, f"v{i}", i * 2) for i in range(300)], "k long, v string, n long")
    keyed.store(base, path, ["k"], 12)
    before = _files(path)
    changes = spark.createDataFrame([(5, None, "x"), (77, "new", "y"), (9999, "unknown", "z")], "k int, v string, extra string")
    keyed.merge(spark, path, changes, ["k"], 12)
    after = _files(path)
    touched = {b for b in before if before[b] != after[b]}
    assert 1 <= len(touched) <= 3 and len(before) == 12
    got = {r.k: (r.v, r.n) for r in keyed.load(spark, path).collect()}
    want = {i: (f"v{i}", i * 2) for i in range(300)} | {5: (None, 10), 77: ("new", 154)}
    assert got == want
    keyed.merge(spark, path, changes, ["k"], 12, insert=True)
    keyed.merge(spark, path, changes, ["k"], 12, insert=True)
    assert {r.k: (r.v, r.n) for r in keyed.load(spark, path).collect()} == want | {9999: ("unknown", None)}


def test_two_changes_for_one_key_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.store(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), path, ["k"], 4)
    doubled = spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")
    with pytest.raises(Exception, match="two changes for one key: 1"):
        keyed.merge(spark, path, doubled, ["k"], 4)
    assert sorted(map(tuple, keyed.load(spark, path).collect())) == [(1, "a"), (2, "b")]
    keyed.merge(spark, path, doubled.limit(0), ["k"], 4)
    assert keyed.load(spark, path).count() == 2


# --- outbox


def test_a_retried_batch_replaces_itself_and_moves_follow_the_order(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = spark.range(10).withColumnRenamed("id", "form")
    outbox.put(rows, path, "a", "2002-01-07 08:00:00", 3)
    outbox.put(rows, path, "b", "2002-01-08 08:00:00")
    outbox.put(rows, path, "a", "2002-01-07 08:00:00", 3)
    assert {tuple(r) for r in outbox.counts(spark, path).collect()} == {("a", "N", 10), ("b", "N", 10)}
    outbox.move(spark, path, "a", "P", "2002-01-07 09:00:00")  # new records are not processed before they are taken
    assert {tuple(r) for r in outbox.counts(spark, path).collect()} == {("a", "N", 10), ("b", "N", 10)}
    outbox.move(spark, path, "a", "Z", "2002-01-07 09:00:00", F.col("form") < 6)
    outbox.move(spark, path, "a", "E", "2002-01-07 10:00:00", F.col("form") < 2)
    for _ in range(2):
        outbox.move(spark, path, "a", "P", "2002-01-07 11:00:00", F.col("form") >= 2)
    assert {tuple(r) for r in outbox.counts(spark, path).collect()} == {("a", "N", 4), ("a", "E", 2), ("a", "P", 4), ("b", "N", 10)}
    done = {(r.process_status, str(r.processed_datetime)) for r in outbox.queue(spark, path).filter("batch_id = 'a'").collect()}
    assert done == {("N", "None"), ("E", "2002-01-07 10:00:00"), ("P", "2002-01-07 11:00:00")}
    with pytest.raises(ValueError):
        outbox.move(spark, path, "a", "N", "2002-01-07 11:00:00")


# --- states of the order log


def test_log_states_by_the_day_equal_the_whole(spark, bed, tmp_path):
    log, path = bed["purchaseorderslog"], str(tmp_path / "s")
    H.store_log_states(log.filter("purchaseorderlogid % 5 = 1"), path, 6)
    for day in (3, 0, 4, 0, 2):
        H.add_to_log_states(log.filter(F.col("purchaseorderlogid") % 5 == day), path, 6)
    got = H.units_of_log(keyed.load(spark, path))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, H.first_last_order_log(log).select(*got.columns).collect()))
    H.add_to_log_states(log.limit(0), path, 6)
    assert keyed.load(spark, path).count() == got.count()


def test_a_day_of_the_log_reads_its_orders_only(spark, bed, tmp_path):
    path = str(tmp_path / "s")
    H.store_log_states(bed["purchaseorderslog"], path, 8)
    before = _files(path)
    few = bed["purchaseorderslog"].filter("po_number = 'PO100'")
    assert "dynamicpruning" in plan_of(keyed.load_touched(spark, path, H.order_log_states(few), ["po_number"], 8))
    H.add_to_log_states(few, path, 8)
    after = _files(path)
    assert sum(before[b] != after[b] for b in before) <= 1


# --- moments and periods


def _moment(draw):
    return dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=draw.randrange(10**6 * 86400 * 400))


@pytest.mark.parametrize("open_ends", [True, False])
def test_periods_match_a_comparison_of_all(spark, open_ends):
    draw = random.Random(7)
    moments = [(i, draw.randrange(4) if i % 9 else None, None if i % 17 == 0 else _moment(draw)) for i in range(400)]
    periods = []
    for j in range(150):
        a = _moment(draw)
        b = a + dt.timedelta(seconds=draw.choice([0, 1, 59, 3600, 86400, 86400 * 40, 86400 * 900, -5]))
        periods.append((draw.randrange(4) if j % 11 else None, j, None if j % 7 == 0 else a, None if j % 5 == 0 else b))
    periods.append((1, 900, moments[1][2], moments[1][2]))
    m = spark.createDataFrame(moments, "id long, k long, t timestamp_ntz")
    p = spark.createDataFrame(periods, "k long, name long, opens timestamp_ntz, closes timestamp_ntz")
    for keys in ((), ("k",)):
        q = p if keys else p.drop("k")
        want, whole = set(), defaultdict(set)
        for i, k, t in moments:
            for k2, name, a, b in periods:
                known = open_ends or (a is not None and b is not None)
                if t is not None and known and (not keys or (k is not None and k == k2)) and (a is None or a <= t) and (b is None or t <= b):
                    want.add((i, name))
                    whole[i].add(name)
        inner = join_periods(m, q, "t", "opens", "closes", keys, open_ends=open_ends)
        got = [(r.id, r["name"]) for r in inner.collect()]
        assert set(got) == want and len(got) == len(want)
        left = join_periods(m, q, "t", "opens", "closes", keys, ids=["id"], how="left", open_ends=open_ends)
        assert Counter((r.id, r["name"]) for r in left.collect()) == Counter([*want, *((i, None) for i, _, _ in moments if not whole[i])])
        plan = plan_of(inner)
        assert "NestedLoopJoin" not in plan and "Cartesian" not in plan


def test_periods_of_dates_and_of_nothing(spark):
    m = spark.createDataFrame([(1, dt.date(2020, 2, 29)), (2, dt.date(2021, 1, 1))], "id long, t date")
    p = spark.createDataFrame([(dt.date(2020, 2, 1), dt.date(2020, 2, 29), "x")], "a date, b date, v string")
    left = join_periods(m, p, "t", "a", "b", ids=["id"], how="left")
    assert {(r.id, r.v) for r in left.collect()} == {(1, "x"), (2, None)}
    assert join_periods(m.limit(0), p, "t", "a", "b").count() == 0
    assert {r.v for r in join_periods(m, p.limit(0), "t", "a", "b", ids=["id"], how="left").collect()} == {None}
    with pytest.raises(ValueError):
        join_periods(m, p, "t", "a", "b", how="left")


# --- hot keys


def test_hot_keys_are_few_and_found(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, 8).otherwise(F.col("id")).alias("k"))
    assert sorted(rows.select(hot_keys(rows, ["k"]).alias("h")).first().h) == [7, 8]
    assert rows.limit(0).agg(F.count("k"), hot_keys(rows.limit(0), ["k"]).alias("h")).first().h == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_a_plain_one(spark, how):
    draw = random.Random(3)
    rows = spark.createDataFrame([(i, draw.choice([1, 1, 1, None, draw.randrange(500)])) for i in range(3000)], "id long, k long")
    per = spark.createDataFrame([(k, f"v{k}") for k in range(0, 500, 3)] + [(1, "hot"), (None, "none")], "k long, v string")
    got = join_spread(rows, per, ["k"], ["id"], how)
    plain = rows.join(per, ["k"], how)
    assert Counter(tuple(r[c] for c in plain.columns) for r in got.collect()) == Counter(map(tuple, plain.collect()))


def test_no_part_of_a_join_holds_the_rows_of_a_hot_bill(spark, tmp_path, monkeypatch):
    """Half of the lines lie on one bill and a third have no load; no partition after a join gets over a fifth of the rows."""
    rows = spark.range(40_000).select(
        F.col("id").alias("po"), F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("bill"), F.lit(1).alias("w")
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    kept = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = with_totals(rows, ["bill"], ["po"], weight=F.sum("w"))
        assert "SortMergeJoin" in plan_of(out)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 8_000
        assert out.filter("bill = 1").select("weight").distinct().collect() == [(20_001,)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_tasks_of_an_allocation_with_a_hot_bill(tmp_path):
    """The same from Spark's event log, over the whole allocation and in a session of its own."""
    import subprocess
    import sys

    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).parent.parent)!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", {str(tmp_path)!r}).config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1").config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    .config("spark.sql.shuffle.partitions", "32").config("spark.sql.session.timeZone", "UTC").getOrCreate())
from haulmark.operators import costs as C
n = 30000
pos = spark.range(n, numPartitions=8).select(F.col("id").alias(C.PO), F.concat(F.lit("P"), F.col("id")).alias("po_number"), F.lit(2).cast("decimal(18,3)").alias("total_weight"),
    F.to_date(F.lit("2020-01-05")).alias("rec_date"), F.lit(9).cast("long").alias("tms_status_id"), F.lit("UBS").alias("source_system"))
lines = spark.range(n, numPartitions=8).select(F.col("id").alias(C.PO), (F.col("id") * 3).alias(C.LOAD), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias(C.BILL), F.lit(False).alias("is_deleted"))
bills = spark.range(1, n, numPartitions=8).select(F.col("id").alias(C.BILL), F.lit(500).cast("long").alias("cr_carrier_id"), F.lit(30000).cast("decimal(18,3)").alias("invoice_amount"))
out = C.allocate_invoices(pos, lines, bills, "2020-01-01", "2020-01-31")
print("SUM", out.agg(F.sum("freight_paid_po").cast("decimal(28,0)")).first()[0], out.count())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "SUM 450000000 30000" in done.stdout
    read = defaultdict(list)
    for file in tmp_path.iterdir():
        for line in file.read_text().splitlines():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read[event["Stage ID"]].append(event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"])
    heavy = {stage: max(r) / sum(r) for stage, r in read.items() if sum(r) >= 20_000 and len(r) > 1}
    assert heavy and max(heavy.values()) < 0.2, heavy


# --- weekly jobs from stored days


def test_stored_days_follow_late_rows_over_three_weeks(spark, bed, tmp_path):
    """Three runs a week apart, each with bills that came in late; every run equals the job over all history, and untouched months keep their files."""
    from haulmark.plans import daily, jobs

    path, lines = str(tmp_path / "days"), bed["bl_bill_pos"]
    late = F.col(C.BILL) % 29
    known = lines.filter(late > 2)
    days = daily.whole_months(C.received_rows(bed["lo_purchase_orders"], "1990-01-01", "2005-12-31").select(F.to_date("rec_date").alias(daily.DAY)))
    daily.store_days(daily.vendor_days(storage._Known(bed, bl_bill_pos=known), days), path)
    for week, as_of in enumerate(("2001-12-17", "2001-12-24", "2001-12-31")):
        now = storage._Known(bed, bl_bill_pos=lines.filter((late > 2) | (late <= week)))
        came = lines.filter((late == week) & (F.col(C.BILL) < 600)) if week == 0 else lines.filter(late == week)
        if week == 0:
            now = storage._Known(bed, bl_bill_pos=lines.filter((late > 2) | ((late == 0) & (F.col(C.BILL) < 600))))
        before = _files(path)
        daily.store_days(daily.vendor_days(now, daily.touched_days(now, came.select(C.PO).distinct())), path)
        after = _files(path)
        if week == 0:
            assert 0 < sum(before[m] != after[m] for m in before) < len(before)
            lines = lines.filter((late != 0) | (F.col(C.BILL) < 600))
        got = daily.metrics_of_days(daily.load_days(spark, path), bed["fp_default_config"], as_of)
        want = jobs.weekly_vendor_metrics(now, as_of)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select(*got.columns).collect()))


# --- foreign lookup


def test_a_lookup_asks_for_two_columns_and_the_wanted_keys(spark, tmp_path):
    from haulmark.sources.lookup import FolderReader, KeyRange, values_for
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

    path = str(tmp_path / "foreign")
    spark.range(5000).select((F.col("id") * 3).alias("vendor"), F.concat(F.lit("n"), F.col("id")).alias("name"), F.lit("wide").alias("other")).write.parquet(path)
    few = spark.createDataFrame([(3,), (4,), (None,), (3000,), (3,)], "remit int")
    found = values_for(few, "remit", path, "name", "vendor")
    assert sorted(map(tuple, found.collect())) == [(3, "n1"), (3000, "n1000")] and found.columns == ["vendor", "name"]
    many = spark.range(0, 15_000, 2).withColumnRenamed("id", "vendor")
    assert values_for(many, "vendor", path, "name").count() == 2500
    assert values_for(few.limit(0), "remit", path, "name", "vendor").count() == 0

    reader = FolderReader({"path": path, "key": "vendor", "value": "name", "first": "0", "last": "999", "partitions": "4"})
    assert reader.partitions() == [KeyRange(0, 249), KeyRange(250, 499), KeyRange(500, 749), KeyRange(750, 999)]
    left = list(reader.pushFilters([In(("vendor",), (3, 5, 600, 2000)), EqualTo(("name",), "n1"), GreaterThan(("vendor",), 3), LessThanOrEqual(("vendor",), 700)]))
    assert left == [EqualTo(("name",), "n1")]
    ranges = reader.partitions()
    assert [k for r in ranges for k in r.keys] == [5, 600]
    batches = [b for r in ranges for b in reader.read(r)]
    assert [b.column_names for b in batches] == [["vendor", "name"]] and batches[0].to_pydict() == {"vendor": [600], "name": ["n200"]}


def test_named_keys_reach_the_reader(spark, tmp_path):
    from haulmark.sources.lookup import values_for

    path = str(tmp_path / "foreign")
    spark.range(100).select(F.col("id").alias("vendor"), F.col("id").cast("string").alias("name")).write.parquet(path)
    found = values_for(spark.createDataFrame([(7,), (70,)], "vendor long"), "vendor", path, "name")
    assert found.rdd.getNumPartitions() == 2  # two of eight ranges hold a wanted key
    assert sorted(r.vendor for r in found.collect()) == [7, 70]


# --- schema versions


def test_versions_read_as_one_and_back(spark, tmp_path):
    from haulmark.sources import sinks, versions

    path = str(tmp_path / "t")
    steps = [[("rename", "rate", "default_rate"), ("add", "ucs_rate", "int"), ("fill", "ucs_rate", 5)], [("drop", "note", "string")]]
    v0 = spark.createDataFrame([(1, 10, "a")], "id long, rate int, note string")
    versions.write_version(v0, path, 0)
    versions.write_version(sinks.migrate(spark.createDataFrame([(2, 20, "b")], "id long, rate int, note string"), steps[0]), path, 1)
    versions.write_version(spark.createDataFrame([(3, 30, 7)], "id long, default_rate int, ucs_rate int"), path, 2)
    now = versions.read_as(spark, path, steps, 2).orderBy("id")
    assert now.columns == ["id", "default_rate", "ucs_rate"] and [tuple(r) for r in now.collect()] == [(1, 10, 5), (2, 20, 5), (3, 30, 7)]
    back = versions.read_as(spark, path, steps, 0).orderBy("id")
    assert [tuple(r) for r in back.select("id", "rate", "note").collect()] == [(1, 10, "a"), (2, 20, "b"), (3, 30, None)]
    assert "GreaterThan(default_rate,15)" in plan_of(versions.read_as(spark, path, steps, 2).filter("default_rate > 15"))
    versions.write_version(v0, path, 0)  # rows of an old writer are still welcome
    assert versions.read_as(spark, path, steps, 2).count() == 4
    with pytest.raises(FileNotFoundError):
        versions.read_as(spark, str(tmp_path / "none"), steps, 1)
