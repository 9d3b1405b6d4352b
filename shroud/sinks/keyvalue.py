"""Batched writes to an external key-value store from the executors.

The store client is user code: ``put_batch(rows)`` receives lists of at most
``batch_size`` rows (dicts) and must be idempotent per key (a retried task
puts the same rows again).  Data never passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame


def put_partitions(df: DataFrame, put_batch: Callable[[list[dict]], None],
                   batch_size: int = 25, num_partitions: int | None = None) -> None:
    """Send every row of ``df`` to ``put_batch`` in batches, partition by partition."""
    src = df.repartition(num_partitions) if num_partitions else df

    def run(rows: Iterable) -> None:
        batch: list[dict] = []
        for r in rows:
            batch.append(r.asDict())
            if len(batch) >= batch_size:
                put_batch(batch)
                batch = []
        if batch:
            put_batch(batch)

    src.foreachPartition(run)
