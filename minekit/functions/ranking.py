"""Exact ranks and running sums over orders too long for one task.

A window over a whole order puts every row of a group into one task. Here the rows are range
partitioned first; each range (``_chunk``) is summed on its own, the few range totals are summed up
in order, and each row adds the total of the ranges before its own. No task sees more than one range
of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minekit.functions.storage import partitions_for, settle

RANGE_BYTES = 64 << 20


def chunked(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """Stored copy of ``df`` with ``_chunk``, the number of its range in ``order``.

    The number of ranges follows the size of ``df``. It is stored because the range number must stay the same for all its readers.
    """
    ranges = partitions_for(df, RANGE_BYTES)
    ranged = df.repartitionByRange(ranges, *order).withColumn("_chunk", F.spark_partition_id())
    return settle(ranged, label)


def running_totals(chunks: DataFrame, group: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add ``before_<name>`` and ``all_<name>`` for each ``name: expression`` of ``sums``.

    ``before`` is the total over the rows of the group that come earlier in ``order``, which must be
    unique in the group; ``all`` is the total of the group.
    """
    per_chunk = chunks.groupBy(*group, "_chunk").agg(
        *[F.sum(F.expr(expr)).alias(f"_sum_{name}") for name, expr in sums.items()]
    )
    # one row per group and range: short windows
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        *group,
        "_chunk",
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"all_{n}") for n in sums],
    )
    inside = (
        Window.partitionBy(*group, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = chunks.select(
        "*",
        *[
            F.coalesce(F.sum(F.expr(expr)).over(inside), F.lit(0)).alias(f"_in_{name}")
            for name, expr in sums.items()
        ],
    )
    return local.join(offsets, [*group, "_chunk"]).select(
        *[c for c in chunks.columns if c != "_chunk"],
        *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(f"before_{n}") for n in sums],
        *[f"all_{n}" for n in sums],
    )


def dense_index(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number the rows from 0 in the order of the unique column ``key``."""
    ranked = running_totals(chunked(df, [key], "index"), [], [key], {"rows": "1"})
    return ranked.select(F.col("before_rows").cast("bigint").alias(name), *df.columns)
