"""Registration of a query together with its outside check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.sources.testbed import TestBed, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# The derived orders lie within these days, so every row is in the window.
FIRST_DAY, LAST_DAY = "1995-01-01", "2002-12-31"


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which both engines hand over alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None, money: str = ""):
    """Register ``fn(tables) -> DataFrame``; ``money`` names its decimal columns."""

    def wrap(fn: Callable[[TestBed], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(TestBed(spark, sf_dir)))
        if sql is not None:
            body = with_tables(sql)
            cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money.split())
            CHECKS[name] = f"SELECT * REPLACE ({cols}) FROM ({body}) checked" if cols else body
        return fn

    return wrap


def exact_ratio(top: str, bottom: str, scale: int = 6, top_scale: int = 3, bottom_scale: int = 3) -> str:
    """Whole-number division rounded half up, since the checking engine divides in floating point."""
    n = f"CAST(CAST({top} AS DECIMAL(38, {top_scale})) * CAST({10 ** top_scale} AS DECIMAL({top_scale + 1}, 0)) AS HUGEINT)"
    d = f"CAST(CAST({bottom} AS DECIMAL(38, {bottom_scale})) * CAST({10 ** bottom_scale} AS DECIMAL({bottom_scale + 1}, 0)) AS HUGEINT)"
    power = scale + bottom_scale - top_scale
    up, down = 10 ** max(power, 0), 10 ** max(-power, 0)
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    q = f"(2 * abs({n}) * CAST({up} AS HUGEINT) + abs({d}) * {down}) // (2 * abs(nullif({d}, 0)) * {down})"
    return (
        f"(CAST(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END * ({q}) AS DECIMAL({38 - scale - 1}, 0))"
        f" * CAST({unit} AS DECIMAL({scale + 1}, {scale})))"
    )


def share_of(part: str, whole: str, amount: str) -> str:
    top = f"(CAST({part} AS DECIMAL(18, 3)) * CAST({amount} AS DECIMAL(18, 3)))"
    return f"CASE WHEN {whole} > 0 THEN {exact_ratio(top, whole, 6, 6, 3)} END"


def mean_of(value: str, value_scale: int = 3) -> str:
    return exact_ratio(f"SUM({value})", f"COUNT({value})", 6, value_scale, 0)
