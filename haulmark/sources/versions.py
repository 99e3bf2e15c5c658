"""Tables whose rows were written under different schemas, read as one.

Every schema version has its own folder. A reader asks for a version; rows of
older versions take the migration steps up to it, rows of newer ones the steps
back, column by column at read time, so neither a migration nor its roll-back
rewrites what is stored, and filters still reach the files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from haulmark.sources.sinks import Step, migrate, rollback

VERSION = "schema_version"


def write_version(df: DataFrame, path: str, version: int, mode: str = "append") -> None:
    """Add rows under the schema of ``version``."""
    df.write.mode(mode).parquet(f"{path.rstrip('/')}/{VERSION}={version}")


def stored_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that have a folder, ascending; one listing, no data is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder) if status.isDirectory()]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{VERSION}="))


def read_as(spark: SparkSession, path: str, steps: Sequence[Sequence[Step]], version: int) -> DataFrame:
    """All rows as of schema ``version``; ``steps[v]`` leads from version v to v + 1.

    A column that a version dropped or never had is NULL, as after a roll-back,
    unless the steps fill it.
    """
    found = stored_versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no versions below {path}")
    parts = []
    for v in found:
        rows = spark.read.parquet(f"{path.rstrip('/')}/{VERSION}={v}")
        for up in range(v, version):
            rows = migrate(rows, steps[up])
        for down in range(v - 1, version - 1, -1):
            rows = migrate(rows, rollback(steps[down]))
        parts.append(rows)
    return reduce(lambda a, b: a.unionByName(b), parts)
