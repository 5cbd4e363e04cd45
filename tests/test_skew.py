import pytest
from pyspark.sql import functions as F

from minekit.functions.ranking import chunked, dense_index, running_totals
from minekit.functions.skew import balanced_join, balanced_pairs, hot_keys, row_counts


def skewed(spark, n, name):
    """A third of the rows has key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17)
    return spark.range(n).select(key.alias("k"), F.col("id").alias(name))


def test_hot_keys_are_found_and_cut(spark):
    counts = row_counts(skewed(spark, 900, "x"), ["k"], "_left").withColumn("_right", F.lit(10))
    hot = hot_keys(counts, block_cost=1000).collect()
    assert len(hot) == 1 and hot[0]["_rows"] > 1


def test_balanced_join_equals_plain_join(spark):
    left, right = skewed(spark, 900, "x"), skewed(spark, 300, "y")
    plain = left.join(right, "k").select("k", "x", "y")
    for cost in (50, 1000, 1 << 22):
        cut = balanced_join(left, right, ["k"], ["x"], ["y"], cost).select("k", "x", "y")
        assert cut.count() == plain.count()
        assert cut.exceptAll(plain).isEmpty()


def test_balanced_join_with_unique_right_side(spark):
    left = skewed(spark, 900, "x")
    right = left.select("k").distinct().withColumn("name", F.concat(F.lit("n"), "k"))
    cut = balanced_join(left, right, ["k"], ["x"], block_cost=50)
    assert cut.count() == 900
    assert cut.where("name != concat('n', k)").isEmpty()


def test_hot_key_work_is_spread_over_blocks(spark):
    """No block of a hot key keeps more than a small part of its rows."""
    left = spark.range(3000).select(F.lit(7).alias("k"), F.col("id").alias("x"))
    counts = row_counts(left, ["k"], "_left").withColumn("_right", F.lit(1))
    grid = hot_keys(counts, block_cost=100).first()
    assert grid["_rows"] >= 100


def test_blocks_follow_the_work_and_the_sides(spark):
    sizes = [(1, 10**10, 1), (2, 1, 10**10), (3, 10**5, 10**5), (4, 10**6, 10)]
    counts = spark.createDataFrame(sizes, "_key bigint, _left bigint, _right bigint")
    cost = 1 << 30
    for r in hot_keys(counts, block_cost=cost).collect():
        _, n_left, n_right = sizes[r["_key"] - 1]
        work = n_left * n_right + n_left + n_right
        assert r["_rows"] * r["_cols"] <= 2 * work / cost + 2
        assert r["_rows"] <= n_left and r["_cols"] <= n_right
    grid = {r["_key"]: (r["_rows"], r["_cols"]) for r in hot_keys(counts, block_cost=1 << 22).collect()}
    assert grid[1][1] == 1 and grid[2][0] == 1
    assert abs(grid[3][0] - grid[3][1]) <= 2


def test_balanced_pairs_equal_brute_force(spark):
    rows = skewed(spark, 240, "doc")
    other = rows.withColumnsRenamed({"doc": "b"})
    brute = rows.withColumnRenamed("doc", "a").join(other, "k").where("a < b").select("k", "a", "b")
    for cost in (20, 400, 1 << 22):
        pairs = balanced_pairs(rows, ["k"], "doc", cost)
        assert pairs.count() == brute.count()
        assert pairs.exceptAll(brute).isEmpty()


@pytest.fixture
def uncoalesced(spark):
    """Keep small ranges apart."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.set(setting, "true")


def test_running_totals_over_many_ranges(spark, uncoalesced):
    rows = spark.range(2000).select(
        (F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"), F.lit(2).alias("w")
    ).dropDuplicates(["g", "v"])
    chunks = chunked(rows.repartition(8), ["g", "v"], "test")
    assert chunks.select("_chunk").distinct().count() > 1
    got = running_totals(chunks, ["g"], ["v"], {"rows": "1", "w": "w"})
    assert got.where("before_w != 2 * before_rows or all_w != 2 * all_rows").isEmpty()
    plain = {}
    for g, v in sorted((r.g, r.v) for r in rows.collect()):
        plain.setdefault(g, []).append(v)
    for r in got.collect():
        assert plain[r.g][r.before_rows] == r.v and r.all_rows == len(plain[r.g])


def test_dense_index(spark, uncoalesced):
    rows = spark.range(500).select((F.col("id") * 7 + 3).alias("key"), F.lit("x").alias("v"))
    indexed = dense_index(rows.repartition(8, "key"), "key", "id").orderBy("id").collect()
    assert [r.id for r in indexed] == list(range(500))
    assert [r.key for r in indexed] == [7 * i + 3 for i in range(500)]
