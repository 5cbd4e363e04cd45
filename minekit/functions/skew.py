"""Equi joins that stay balanced when single keys hold a large share of the rows.

The work of a key with ``l`` rows on the left and ``r`` on the right is taken as ``l*r + l + r``. A
key is *hot* when its work exceeds both ``block_cost`` and ``total work / MAX_HOT``. The second rule
proves that there are fewer than ``MAX_HOT`` hot keys, so the table of hot keys may be broadcast
whatever the data; and every key that is not hot does less than ``1/MAX_HOT`` of the total work, so
it may stay in one task. A hot key is cut into a grid of blocks: each left row goes to one grid row
and is repeated along it, each right row goes to one grid column and is repeated along that, and
every pair of rows meets in exactly one block. No row is dropped and no result changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT = 100_000
BLOCK_COST = 1 << 22


def row_counts(df: DataFrame, on: list[str], name: str, rows: str = "1") -> DataFrame:
    """Rows per key hash, each row of ``df`` standing for ``rows`` of them.

    A partial aggregate keeps the shuffle to one row per key and task.
    """
    return df.groupBy(F.xxhash64(*on).alias("_key")).agg(F.sum(F.expr(rows).cast("bigint")).alias(name))


def hot_keys(counts: DataFrame, block_cost: int = BLOCK_COST) -> DataFrame:
    """``_key, _rows, _cols``: the grid of each hot key of ``counts`` (``_key, _left, _right``)."""
    left, right = F.col("_left").cast("double"), F.col("_right").cast("double")
    costed = counts.select("_key", "_left", "_right", (left * right + left + right).alias("_cost"))
    limit = costed.agg(
        F.greatest(F.lit(float(block_cost)), F.coalesce(F.sum("_cost"), F.lit(0.0)) / MAX_HOT)
    ).scalar()
    # blocks of somewhat over half the limit, as rows fall into them by chance
    blocks = F.ceil(1.75 * F.col("_cost") / F.col("_limit"))
    # shared between the sides by their sizes: a side of one row is never cut
    share = F.sqrt(blocks * F.col("_right") / F.greatest("_left", F.lit(1)))
    cols = F.least(F.greatest(F.ceil(share), F.lit(1)), F.greatest("_right", F.lit(1)), F.col("_blocks"))
    rows = F.least(F.ceil(F.col("_blocks") / F.col("_cols")), F.greatest("_left", F.lit(1)))
    return (
        costed.withColumn("_limit", limit)
        .where("_cost > _limit")
        .withColumn("_blocks", blocks)
        .withColumn("_cols", cols)
        .select("_key", rows.cast("int").alias("_rows"), F.col("_cols").cast("int").alias("_cols"))
    )


def _place(spreads: list[str], n_blocks: str) -> Column:
    """The block of a row, chosen by the columns that tell rows of one key apart."""
    return F.pmod(F.xxhash64(*spreads), F.coalesce(F.col(n_blocks), F.lit(1))).cast("int")


def _along(n_blocks: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n_blocks), F.lit(1)) - 1))


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_spread: list[str],
    right_spread: list[str] | None = None,
    block_cost: int = BLOCK_COST,
    left_counts: DataFrame | None = None,
    right_counts: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``on``; give no ``right_spread`` when the right side has one row per key.

    Both inputs are read twice, once for the counts. When they are costly, settle them first or
    give the ``row_counts`` of a cheaper table with the same keys and no fewer rows.
    """
    counts = row_counts(left, on, "_left") if left_counts is None else left_counts
    if right_spread is None:
        counts = counts.withColumn("_right", F.lit(1))
    else:
        other = row_counts(right, on, "_right") if right_counts is None else right_counts
        counts = counts.join(other, "_key", "full_outer").select(
            "_key",
            F.coalesce("_left", F.lit(0)).alias("_left"),
            F.coalesce("_right", F.lit(0)).alias("_right"),
        )
    hot = F.broadcast(hot_keys(counts, block_cost))

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", F.xxhash64(*on)).join(hot, "_key", "left")

    rows = left.columns
    lhs = keyed(left).select(*rows, _place(left_spread, "_rows").alias("_r"), _along("_cols").alias("_c"))
    place = _place(right_spread, "_cols") if right_spread else F.lit(0)
    rhs = keyed(right).select(*right.columns, place.alias("_c"), _along("_rows").alias("_r"))
    return lhs.join(rhs, [*on, "_r", "_c"]).drop("_r", "_c")


def balanced_pairs(
    rows: DataFrame, on: list[str], item: str, block_cost: int = BLOCK_COST
) -> DataFrame:
    """``on, a, b`` for every two items ``a < b`` that share the key ``on``.

    Keys of ordinary size meet in one plain self join whose two sides share a single shuffle. A hot
    key is cut into blocks; the pairs of blocks (only one of the two orders) are spread over tasks.
    """
    counts = row_counts(rows, on, "_left").where("_left > 1").withColumn("_right", F.col("_left"))
    hot = F.broadcast(hot_keys(counts, block_cost))
    keyed = rows.select(*on, item, F.xxhash64(*on).alias("_key"))

    cold = keyed.join(hot, "_key", "left_anti").select(*on, item)
    plain = (
        cold.withColumnRenamed(item, "a")
        .join(cold.withColumnRenamed(item, "b"), on)
        .where("a < b")
    )

    placed = keyed.join(hot, "_key").withColumn("_at", _place([item], "_rows"))
    lhs = placed.select(
        *on,
        F.col(item).alias("_x"),
        F.col("_at").alias("_r"),
        F.explode(F.sequence(F.col("_at"), F.col("_rows") - 1)).alias("_c"),
    )
    rhs = placed.select(
        *on,
        F.col(item).alias("_y"),
        F.explode(F.sequence(F.lit(0), F.col("_at"))).alias("_r"),
        F.col("_at").alias("_c"),
    )
    blocks = (
        lhs.join(rhs, [*on, "_r", "_c"])
        .where("_r < _c or _x < _y")
        .select(*on, F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"))
    )
    return plain.unionByName(blocks)
