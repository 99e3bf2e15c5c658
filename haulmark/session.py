"""Session defaults for local runs, and the rule for shared intermediate folders."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "haulmark", shuffle: int = 8, shared: str | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own. ``shared`` becomes its checkpoint folder."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
    )
    return (builder.config("spark.checkpoint.dir", shared) if shared else builder).getOrCreate()


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """A folder that the driver and all executors see: ``folder``, else the session's ``spark.checkpoint.dir``.

    Where neither is given, a local session (tests) uses its own warehouse
    folder; on a cluster that is an error, since a folder of one machine would
    lose data with that machine.
    """
    named = folder or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("name a shared folder: set spark.checkpoint.dir or pass one")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"


def fresh_folder(spark: SparkSession, folder: str | None = None) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_folder(spark, folder)}/run-{os.urandom(8).hex()}"


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to a fresh shared folder and read it back: what follows no longer depends on its plan."""
    path = fresh_folder(df.sparkSession, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Checkpoint ``df`` in the shared folder and read it back."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession, folder))
    return df.checkpoint(eager=True)
