"""A lookup in a foreign system as a Spark source: two columns, the keys asked for, by ranges of the key.

The foreign side is reached through a reader for one range of keys, given by the
caller; ``FolderSource`` reads Parquet files and stands for a database here. Each
range is one partition of the scan, so the lookup is spread over the workers, and
keys that a filter names are handed to the reader instead of being read and
thrown away. ``values_for`` asks for the keys that some rows need and for no
others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

FORMAT = "foreign_lookup"
#: Up to so many wanted keys are named one by one; beyond, ranges are asked for and the join drops the rest.
NAMED = 1000


@dataclass
class KeyRange(InputPartition):
    first: int
    last: int
    keys: tuple[int, ...] | None = field(default=None)


class FolderSource(DataSource):
    """Options: path, key and value (column names), first, last (bounds of the key), partitions."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{self.options['key']} long, {self.options['value']} string"

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(dict(self.options))


class FolderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.first, self.last = int(options["first"]), int(options["last"])
        self.keys: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 (Spark's name)
        """Bounds and lists of the key are taken over; what is not understood goes back to Spark."""
        for one in filters:
            if getattr(one, "attribute", None) != (self.options["key"],):
                yield one
            elif isinstance(one, In):
                self._only({int(v) for v in one.value if v is not None})
            elif isinstance(one, EqualTo):
                self._only({int(one.value)})
            elif isinstance(one, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, int(one.value) + isinstance(one, GreaterThan))
            elif isinstance(one, (LessThan, LessThanOrEqual)):
                self.last = min(self.last, int(one.value) - isinstance(one, LessThan))
            else:
                yield one

    def _only(self, keys: set[int]) -> None:
        self.keys = keys if self.keys is None else self.keys & keys

    def partitions(self) -> list[KeyRange]:
        """Ranges of equal width; with named keys, only ranges that hold some."""
        if self.last < self.first:
            return [KeyRange(0, -1)]
        width = -(-(self.last - self.first + 1) // int(self.options.get("partitions", 1)))
        starts = range(self.first, self.last + 1, width)
        ranges = [(a, min(a + width - 1, self.last)) for a in starts]
        if self.keys is None:
            return [KeyRange(a, b) for a, b in ranges]
        named = [KeyRange(a, b, tuple(sorted(k for k in self.keys if a <= k <= b))) for a, b in ranges]
        return [r for r in named if r.keys] or [KeyRange(0, -1)]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        key, value = self.options["key"], self.options["value"]
        if partition.last < partition.first:
            return
        field_ = pc.field(key)
        wanted = (field_ >= partition.first) & (field_ <= partition.last)
        if partition.keys is not None:
            wanted = field_.isin(list(partition.keys))
        table = ds.dataset(self.options["path"].removeprefix("file://").removeprefix("file:"), format="parquet")
        schema = pa.schema([(key, pa.int64()), (value, pa.string())])
        for batch in table.scanner(columns=[key, value], filter=wanted).to_batches():
            if batch.num_rows:
                yield batch.cast(schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FolderSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def values_for(rows: DataFrame, key: str, path: str, value: str, foreign_key: str | None = None, partitions: int = 8) -> DataFrame:
    """(key, value) of the foreign rows for the keys that ``rows`` hold.

    The bounds of the wanted keys, and up to ``NAMED`` of the keys themselves,
    come to the driver and go to the foreign side; the rest is decided by a join.
    """
    spark = rows.sparkSession
    register(spark)
    foreign_key = foreign_key or key
    wanted = rows.select(F.col(key).cast("long").alias(foreign_key)).filter(F.col(foreign_key).isNotNull()).distinct()
    bounds = wanted.agg(F.min(foreign_key).alias("a"), F.max(foreign_key).alias("b"), F.count(F.lit(1)).alias("n")).first()
    first, last = (bounds["a"], bounds["b"]) if bounds["n"] else (0, -1)
    options = {"path": path, "key": foreign_key, "value": value, "first": str(first), "last": str(last), "partitions": str(partitions)}
    found = spark.read.format(FORMAT).options(**options).load()
    if bounds["n"] <= NAMED:
        return found.filter(F.col(foreign_key).isin([r[0] for r in wanted.limit(NAMED).collect()]))
    return found.join(wanted, foreign_key, "left_semi")
