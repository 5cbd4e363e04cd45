"""Sparse matrices in coordinate form: ``name, i, j, v``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.skew import BLOCK_COST, balanced_join, row_counts


def select_matrix(entries: DataFrame, name: str) -> DataFrame:
    """Entries ``i, j, v`` of one matrix."""
    return entries.where(F.col("name") == name).select("i", "j", "v")


def matrix_product(m: DataFrame, n: DataFrame, block_cost: int = BLOCK_COST) -> DataFrame:
    """Cells ``i, k, v`` of M times N; cells without a shared index are absent, zero sums stay.

    Repeated entries of one cell are summed before the join, which changes no result and means that
    a shared index never yields more products than the result has cells. A shared index with very
    many entries on both sides is cut into blocks. Cast ``v`` to ``decimal(38,0)`` for sums beyond
    64 bits; Spark raises on overflow.
    """
    rows = m.groupBy("i", "j").agg(F.sum("v").alias("m_v"))
    columns = n.select(F.col("i").alias("j"), F.col("j").alias("k"), "v")
    columns = columns.groupBy("j", "k").agg(F.sum("v").alias("n_v"))
    products = balanced_join(
        rows,
        columns,
        ["j"],
        ["i"],
        ["k"],
        block_cost,
        left_counts=row_counts(m, ["j"], "_left"),
        right_counts=row_counts(n, ["i"], "_right"),
    )
    return products.groupBy("i", "k").agg(F.sum(F.col("m_v") * F.col("n_v")).alias("v"))


def ordered_cells(product: DataFrame) -> DataFrame:
    """Cells in ascending order of row and column, by a range-partitioned sort."""
    return product.select("i", "k", "v").orderBy("i", "k")
