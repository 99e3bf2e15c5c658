"""Line dedup by site-relative frequency, in DataFrame operations only.

Method. Pages are grouped by the host of their url. Each page names each of its
lines once; the pages of a host that hold a line are counted and divided by all
pages of the host, and a line in more than ``percent`` of them is boilerplate
there and is dropped from every page of the host. Counts are partially
aggregated by (host, hash of the line), so neither a host with a third of all
pages nor a line that stands on all of them is gathered in a task; page texts
are never shuffled but to be cleaned.

Defined cases. Lines end at a line feed and are compared without blanks, tabs
and carriage returns at their ends; blank lines are neither counted nor
dropped. A null url, or one without a host, is the host ''. A host of fewer than
``least`` pages keeps all its lines, since a share says little there. A null
text has no lines and stays null; page ids must be numbers. Repeated rows count as pages of their own.
Empty tables give no rows. Extra columns are ignored by ``report`` and kept by
``clean``; lines are told apart by a 64-bit hash within their host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import meet, small
from haulmark.session import written

PERCENT, LEAST = 50, 3
BROADCAST_ROWS = 200_000
_PAGE = ["__id", "__hash"]


def host(url: Column) -> Column:
    """The authority of a url in lower case; '' where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _keyed(pages: DataFrame, text: str) -> DataFrame:
    own = F.xxhash64(F.coalesce(F.xxhash64(F.col(text)), F.lit(0)), host(F.col("url")))
    return pages.withColumns({"__id": F.col("page_id").cast("long"), "__hash": own})


def boilerplate(pages: DataFrame, text: str = "html", percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """(host, line): hashes of the lines on more than ``percent`` of a host's pages."""
    site = host(F.col("url")).alias("host")
    totals = pages.groupBy(site).agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= least)
    named = F.filter(F.split(F.col(text), "\n"), lambda x: _bare(x) != "")
    lines = pages.select(site, F.explode(F.array_distinct(F.transform(named, lambda x: F.xxhash64(_bare(x))))).alias("line"))
    seen = written(lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    met = seen.join(small(totals, BROADCAST_ROWS), "host")
    return met.where(F.col("times") * 100 > F.col("total") * percent).select("host", "line")


def _dropped(pages: DataFrame, text: str, percent: int, least: int) -> DataFrame:
    """``pages`` with __drop, the hashes of the lines that go; the array is one page's own."""
    bad = written(boilerplate(pages, text, percent, least))
    keyed = _keyed(pages, text)
    lines = keyed.select(*_PAGE, host(F.col("url")).alias("host"), F.explode(F.array_distinct(F.transform(F.split(F.col(text), "\n"), lambda x: F.xxhash64(_bare(x))))).alias("line"))
    mine = lines.join(small(bad, BROADCAST_ROWS), ["host", "line"]).groupBy(*_PAGE).agg(F.collect_set("line").alias("__drop"))
    return meet(keyed, written(mine), _PAGE, "left")


def _kept(text: str) -> Column:
    rows = F.split(F.col(text), "\n")
    return F.when(F.col("__drop").isNull(), rows).otherwise(F.filter(rows, lambda x: (_bare(x) == "") | ~F.array_contains(F.col("__drop"), F.xxhash64(_bare(x)))))


def clean(pages: DataFrame, text: str = "html", percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """``pages`` without the boilerplate lines of their host in ``text``; all columns stay."""
    marked = _dropped(pages, text, percent, least)
    return marked.withColumn(text, F.array_join(_kept(text), "\n")).select(*pages.columns)


def report(pages: DataFrame, text: str = "html", percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """Per page row: page_id, host, n_lines, n_dropped, kept_sha256 (of the text that stays; null for a null text)."""
    marked = _dropped(pages, text, percent, least)
    before = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n")))
    after = F.when(F.col(text).isNull(), 0).otherwise(F.size(_kept(text)))
    return marked.select(
        "page_id",
        host(F.col("url")).alias("host"),
        before.cast("long").alias("n_lines"),
        (before - after).cast("long").alias("n_dropped"),
        F.sha2(F.array_join(_kept(text), "\n"), 256).alias("kept_sha256"),
    )
