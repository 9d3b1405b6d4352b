"""Parallel segmented scan of an external key-value store as a Spark source.

Key-value stores are usually scanned in ``N`` independent segments.  This
Python data source turns each segment into one input partition, so the
executors scan the segments in parallel and rows go straight into the
DataFrame; nothing is gathered on the driver.

The scan itself is user code, named by import path in the ``scan`` option:
``module:function(segment, total_segments, options) -> iterable of tuples``
matching the schema (default: the identity layout).  It must be importable
on the executors.

    spark.dataSource.register(SegmentedScan)
    df = (spark.read.format("segmented_scan")
          .option("scan", "mystore.client:scan_segment")
          .option("segments", 64)
          .load())
"""

from __future__ import annotations

import importlib

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import IDENTITY_COLUMNS


class SegmentedScan(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segmented_scan"

    def schema(self) -> str:
        return self.options.get(
            "schema", ", ".join(f"{c} string" for c in IDENTITY_COLUMNS))

    def reader(self, schema) -> DataSourceReader:
        return _SegmentReader(dict(self.options))


class _SegmentReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options
        self.segments = int(options.get("segments", "8"))
        if self.segments < 1:
            raise ValueError("segments must be >= 1")
        if ":" not in options.get("scan", ""):
            raise ValueError("option 'scan' must be 'module:function'")

    def partitions(self):
        return [InputPartition(i) for i in range(self.segments)]

    def read(self, partition):
        module, func = self.options["scan"].split(":", 1)
        scan = getattr(importlib.import_module(module), func)
        yield from scan(partition.value, self.segments, self.options)


def read_segmented(spark, scan: str, segments: int, **options):
    """Register the source (idempotent) and read ``segments`` segments in parallel."""
    spark.dataSource.register(SegmentedScan)
    r = spark.read.format("segmented_scan").option("scan", scan).option("segments", segments)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()
