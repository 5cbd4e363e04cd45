"""Column expressions shared by the operators; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l1_distance(x: Column, y: Column) -> Column:
    """Sum of absolute differences of two arrays."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.abs(p - q)), F.lit(0.0), lambda s, d: s + d)


def l2_squared(x: Column, y: Column) -> Column:
    """Sum of squared differences of two arrays."""
    return F.aggregate(
        F.zip_with(x, y, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d
    )


def equal_positions(x: Column, y: Column) -> Column:
    """Number of positions at which two arrays agree."""
    return F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda same: same))


def binary_entropy(n: Column, n_pos: Column) -> Column:
    """Entropy in bits of ``n_pos`` positives among ``n``; 0 for a pure or empty set."""
    p = n_pos / n
    return F.when((n_pos == 0) | (n_pos == n), F.lit(0.0)).otherwise(
        -p * F.log2(p) - (1 - p) * F.log2(1 - p)
    )


def majority(n: Column, n_pos: Column) -> Column:
    """1 when at least half of the rows are positive, else 0."""
    return F.when(2 * n_pos >= n, F.lit(1)).otherwise(F.lit(0))


def to_number(text: Column) -> Column:
    """A numeric field of a text row; ``?`` marks a missing value and counts as 0."""
    return F.when(text == "?", F.lit(0.0)).otherwise(text.cast("double"))


def gram_hash(gram: Column, method: str = "xxhash64") -> Column:
    """Non-random id of a text: ``xxhash64``, or the leading 60 bits of ``md5``."""
    if method == "xxhash64":
        return F.xxhash64(gram)
    if method == "md5":
        return F.conv(F.substring(F.md5(gram), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method {method!r}")
