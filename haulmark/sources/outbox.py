"""An outbound queue whose batches can be sent again without doubling.

Each batch is one folder. Putting a batch replaces the folder, so a retry leaves
what the first try left. A record is new (N), taken (Z), processed (P) or failed
(E); a move rewrites the folder of its batch only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.predicates import moment

BATCH = "batch_id"
#: Which status may follow which.
MOVES = {"N": ("Z",), "Z": ("P", "E"), "E": ("Z",), "P": ()}


def put(records: DataFrame, path: str, batch: str, as_of, created_by: int | None = None) -> None:
    """Write ``records`` as the batch ``batch``, all new; the same batch again replaces itself."""
    out = records.withColumns(
        {
            "created_date": moment(as_of),
            "created_by": F.lit(created_by).cast("bigint"),
            "process_status": F.lit("N"),
            "processed_datetime": F.lit(None).cast("timestamp_ntz"),
            BATCH: F.lit(batch),
        }
    )
    _replace(out, path)


def _replace(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
    rows.sparkSession.catalog.refreshByPath(path)


def queue(spark: SparkSession, path: str) -> DataFrame:
    spark.catalog.refreshByPath(path)
    stored = spark.read.parquet(path)
    return stored.withColumn(BATCH, F.col(BATCH).cast("string"))


def move(spark: SparkSession, path: str, batch: str, to: str, as_of, which=None) -> None:
    """Move the records of a batch that meet ``which`` (all by default) to the status ``to``.

    Only records whose status allows it move, so moving twice changes nothing.
    Records that are done, well or not, get the time.
    """
    before = [a for a, b in MOVES.items() if to in b]
    if not before:
        raise ValueError(f"nothing becomes {to!r}")
    rows = queue(spark, path).filter(F.col(BATCH) == batch)
    chosen = F.col("process_status").isin(before) & (F.lit(True) if which is None else F.coalesce(which, F.lit(False)))
    done = F.when(chosen, moment(as_of) if to in "PE" else F.lit(None).cast("timestamp_ntz")).otherwise(F.col("processed_datetime"))
    status = F.when(chosen, F.lit(to)).otherwise(F.col("process_status"))
    _replace(rows.withColumns({"process_status": status, "processed_datetime": done}), path)


def counts(spark: SparkSession, path: str) -> DataFrame:
    """Records of each batch by status."""
    return queue(spark, path).groupBy(BATCH, "process_status").agg(F.count(F.lit(1)).alias("records"))
