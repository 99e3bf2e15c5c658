"""Table scans: parquet folders and the config CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from haulmark.sources import schemas


def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A named base table; a declared schema is used when there is one."""
    schema = schema or schemas.BY_NAME.get(name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}")


class ParquetTables(Mapping):
    """Lazy name → DataFrame mapping over a folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str, names: tuple[str, ...]):
        self._spark, self._folder, self._names = spark, folder, names

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return read_table(self._spark, self._folder, name)

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


def read_config_csv(spark: SparkSession, path: str) -> DataFrame:
    """The default-config file: header row, ``.630`` decimals, empty field = NULL."""
    return spark.read.csv(
        path, header=True, schema=schemas.DEFAULT_CONFIG, nullValue="", ignoreLeadingWhiteSpace=True, enforceSchema=True
    )
