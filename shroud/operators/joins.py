"""Join helpers that stay exact and skew-safe at scale.

Outer and anti joins keep rows whose key is NULL.  Hash partitioning sends
every NULL key to the same reducer, so a table where a third of the ids are
missing would put a third of its rows into one task.  ``spread_nulls``
replaces a NULL key by a deterministic per-row value before the shuffle and
adds ``key IS NOT NULL`` to the join condition, so those rows still never
match but are spread over all partitions.  Hot non-NULL keys are split by
AQE's skew-join handling; the broadcast decision is AQE's size-checked
runtime conversion (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD_PREFIX = "\u0000null:"


def spread_nulls(key: Column, *salt: Column) -> Column:
    """``key`` or, when NULL, a per-row value that is deterministic across retries."""
    return F.coalesce(key, F.concat(F.lit(_SPREAD_PREFIX), F.xxhash64(*salt).cast("string")))


def keyed_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: str,
               how: str, salt_cols: list[str]) -> DataFrame:
    """Equi-join ``left_key = right[right_key]`` for ``how`` in left/left_anti/left_semi/inner.

    ``right`` must already carry the normalised key column ``right_key`` with
    NULLs removed.  For joins that keep unmatched left rows the NULL keys of
    the left side are spread (see module doc).
    """
    lk = "__shroud_lk"
    if how in ("left", "left_outer", "left_anti"):
        lhs = left.withColumn(lk, left_key).withColumn(
            "__shroud_lks", spread_nulls(F.col(lk), *[F.col(c) for c in salt_cols]))
        cond = (lhs["__shroud_lks"] == right[right_key]) & lhs[lk].isNotNull()
        out = lhs.join(right, cond, how)
        return out.drop(lk, "__shroud_lks")
    lhs = left.withColumn(lk, left_key)
    out = lhs.join(right, lhs[lk] == right[right_key], how)
    return out.drop(lk)
