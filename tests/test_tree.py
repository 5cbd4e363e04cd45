import math

import pytest
from pyspark.sql import functions as F

from minekit.operators import features
from minekit.operators.splits import BLOCK, coded_candidates, split_candidates, split_gains, value_counts
from minekit.operators.codes import code_values
from minekit.operators.tree import ROOT, accuracy, leaf_predictions, tree_listing, tree_predictions
from minekit.plans.decision_tree import DecisionTree, search_splits


def rows(spark, data):
    listed = [(i, [float(x) for x in f], float(y)) for i, (f, y) in enumerate(data)]
    return spark.createDataFrame(listed, "row_id bigint, features array<double>, label double")


def at_root(df):
    return df.withColumn("node_id", F.lit(ROOT))


def entropy(n, pos):
    if pos in (0, n):
        return 0.0
    p = pos / n
    return -p * math.log2(p) - (1 - p) * math.log2(1 - p)


def brute(data, wanted):
    """Best (gain, split, feature) over every feature."""
    best = []
    for f in range(len(data[0][0])):
        values = sorted({x[f] for x, _ in data})
        stride = len(values) // wanted if 0 < wanted < len(values) else 1
        for split in values[::stride]:
            left = [y for x, y in data if x[f] < split]
            right = [y for x, y in data if x[f] >= split]
            gain = entropy(len(data), sum(y for _, y in data))
            for side in (left, right):
                gain -= len(side) / len(data) * (entropy(len(side), sum(side)) if side else 0.0)
            best.append((round(gain, 12) + 0.0, split, f))
    return max(best)


def grow(data, min_leaf, wanted, depth=0, node=1, max_depth=None):
    n, pos = len(data), sum(y for _, y in data)
    leaf = {node: (None, None, n, pos, int(2 * pos >= n))}
    if n <= min_leaf or depth == max_depth or pos in (0, n):
        return leaf
    gain, split, f = brute(data, wanted)
    if gain <= 0:
        return leaf
    tree = {node: (f, split, n, pos, int(2 * pos >= n))}
    tree |= grow([d for d in data if d[0][f] < split], min_leaf, wanted, depth + 1, 2 * node, max_depth)
    return tree | grow([d for d in data if d[0][f] >= split], min_leaf, wanted, depth + 1, 2 * node + 1, max_depth)


DATA = [((i % 13, (i * 7) % 31, i % 2), int((i % 13 > 5) != (i % 5 == 0))) for i in range(200)]


@pytest.mark.parametrize("wanted", [0, 3, 10])
def test_best_split_equals_brute_force(spark, wanted):
    best = search_splits(at_root(rows(spark, DATA)), wanted).first()
    assert (best.gain, best.split, best.feature) == pytest.approx(brute(DATA, wanted))


@pytest.mark.parametrize("max_depth", [0, 2, None])
def test_tree_equals_recursive_tree(spark, max_depth):
    nodes = DecisionTree(min_leaf=20, candidates=10, max_depth=max_depth).fit(rows(spark, DATA))
    got = {int(r.node_id, 2): (r.feature, r.split, r.n, r.n_pos, r.prediction) for r in nodes.collect()}
    assert got == grow(DATA, 20, 10, max_depth=max_depth)


def test_rows_are_routed_without_broadcast_too(spark, monkeypatch):
    monkeypatch.setattr("minekit.operators.features.BROADCAST_ROWS", 0)
    nodes = DecisionTree(min_leaf=20, max_depth=3).fit(rows(spark, DATA))
    got = {int(r.node_id, 2): (r.feature, r.split, r.n, r.n_pos, r.prediction) for r in nodes.collect()}
    assert got == grow(DATA, 20, 10, max_depth=3)


@pytest.mark.parametrize("packed", [True, False])
def test_predictions_walk_the_tree(spark, monkeypatch, packed):
    if not packed:
        monkeypatch.setattr("minekit.operators.tree.PACKED_NODES", 0)
        monkeypatch.setattr("minekit.operators.tree.CHUNK_LEVELS", 2)
    tree = grow(DATA, 20, 10)
    nodes = DecisionTree(min_leaf=20).fit(rows(spark, DATA))
    found = tree_predictions(rows(spark, DATA), nodes).collect()
    assert len(found) == len(DATA)
    for r in found:
        node = 1
        while tree[node][0] is not None:
            node = 2 * node + int(DATA[r.row_id][0][tree[node][0]] >= tree[node][1])
        assert (int(r.node_id, 2), r.prediction) == (node, tree[node][4])


def test_stride_keeps_all_nineteen_values(spark):
    data = rows(spark, [((v,), v % 2) for v in range(19)])
    assert split_candidates(value_counts(at_root(data)), 10).count() == 19
    data = rows(spark, [((v,), v % 2) for v in range(20)])
    got = split_candidates(value_counts(at_root(data)), 10).orderBy("value").collect()
    assert [r.value for r in got] == [float(v) for v in range(0, 20, 2)]
    assert [r.left_n for r in got] == list(range(0, 20, 2))


def test_smallest_value_has_no_gain(spark):
    gains = split_gains(split_candidates(value_counts(at_root(rows(spark, DATA))), 10))
    assert gains.where("left_n = 0").count() == 3
    assert gains.where("left_n = 0 and gain != 0").isEmpty()
    assert gains.where("gain < 0").isEmpty()


def test_pure_and_constant_nodes_stay_leaves(spark):
    pure = DecisionTree(min_leaf=2).fit(rows(spark, [((i,), 1) for i in range(9)]))
    assert [(r.feature, r.prediction) for r in pure.collect()] == [(None, 1)]
    constant = DecisionTree(min_leaf=2).fit(rows(spark, [((1, 2), i % 2) for i in range(8)]))
    assert [(r.feature, r.n, r.prediction) for r in constant.collect()] == [(None, 8, 1)]


def test_listing_is_in_pre_order(spark):
    nodes = DecisionTree(min_leaf=1, candidates=0).fit(rows(spark, [((0,), 0), ((1,), 1), ((2,), 0), ((3,), 0)]))
    lines = [r.line for r in tree_listing(nodes).collect()]
    assert lines == ["(0, 2.000000)", "left", "\t(0, 1.000000)", "\tleft", "\t\t0", "\tright", "\t\t1", "right", "\t0"]
    assert leaf_predictions(nodes).count() == 3


def test_accuracy(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (0, 0.0), (1, 1.0)], "prediction int, label double")
    assert tuple(accuracy(df).first()) == (4, 75.0)


def test_features_and_missing_values(spark):
    data = spark.createDataFrame(
        [(1, "b", ["1.5", "?"], 1.0), (2, "a", ["0", "2"], 0.0)],
        "row_id bigint, category string, numbers array<string>, label double",
    )
    index = features.category_index(data)
    assert {(r.category, r.position) for r in index.collect()} == {("a", 0), ("b", 1)}
    got = {r.row_id: r.features for r in features.feature_vectors(data, index).collect()}
    assert got == {1: [0.0, 1.0, 1.5, 0.0], 2: [1.0, 0.0, 0.0, 2.0]}


def test_split_is_repeatable_and_near_its_weights(spark):
    data = spark.range(5000).withColumnRenamed("id", "row_id")
    one = features.train_test_split(data, "row_id", (9, 1), seed=4)
    assert one.exceptAll(features.train_test_split(data.repartition(5), "row_id", (9, 1), seed=4)).isEmpty()
    assert 4350 < one.where("part = 'train'").count() < 4650


def test_seventy_levels(spark):
    """Alternating classes on one feature with two candidates a level: a tree far deeper than a 64-bit number has digits."""
    fresh = [((2.0**-i,), i % 2) for i in range(150)]
    nodes = DecisionTree(min_leaf=1, candidates=1, max_depth=70).fit(rows(spark, fresh))
    got = {r.node_id: (r.feature, r.split, r.n, r.n_pos) for r in nodes.collect()}
    want = {bin(k)[2:]: v[:4] for k, v in grow(fresh, 1, 1, max_depth=70).items()}
    assert got == want
    found = {r.row_id: r.prediction for r in tree_predictions(rows(spark, fresh), nodes).collect()}
    assert len(found) == 150


def test_candidates_of_many_values_in_several_blocks(spark):
    n = 3 * BLOCK + 77
    data = spark.range(n).selectExpr("id as row_id", "array(cast(id as double), cast(id % 5 as double)) as features", "cast(id % 3 = 0 as double) as label")
    coded = code_values(data)
    assert coded.widest == n
    for wanted in (1, 10):
        found = coded_candidates(coded.rows.withColumn("node_id", F.lit(ROOT)), wanted, coded.widest).collect()
        stride = n // wanted
        assert sorted((r.code, r.left_n, r.left_pos) for r in found if r.feature == 0) == [(c, c, (c + 2) // 3) for c in range(0, n, stride)]
        assert {(r.n, r.n_pos) for r in found} == {(n, (n + 2) // 3)}
        assert sorted(r.code for r in found if r.feature == 1) == ([0, 1, 2, 3, 4] if wanted > 4 else [0])


def test_no_level_is_sorted(spark):
    coded = code_values(rows(spark, DATA))
    found = coded_candidates(coded.rows.withColumn("node_id", F.lit(ROOT)), 10, coded.widest)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "SortMergeJoin" not in plan


def test_codes_by_a_join_equal_those_by_search(spark, monkeypatch):
    data = rows(spark, [((i % 7 - 3, float("nan") if i % 5 == 0 else 0.5 * i), i % 2) for i in range(60)])
    ragged = data.withColumn("features", F.when(F.col("row_id") % 4 == 0, F.array(F.lit(None).cast("double"))).otherwise(F.col("features")))
    for df in (data, ragged):
        near = code_values(df)
        monkeypatch.setattr("minekit.operators.codes.BROADCAST_VALUES", 0)
        far = code_values(df)
        monkeypatch.undo()
        assert sorted(map(tuple, near.rows.collect())) == sorted(map(tuple, far.rows.collect()))
        assert near.with_values(near.values.select("feature", "code")).count() == far.with_values(far.values.select("feature", "code")).count()
        assert near.widest == far.widest


def test_candidates_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr("minekit.operators.splits.BROADCAST_CANDIDATES", 0)
    assert (best := search_splits(at_root(rows(spark, DATA)), 10).first()) and (best.gain, best.split, best.feature) == pytest.approx(brute(DATA, 10))


def sparse(df):
    entries = F.filter(
        F.transform("features", lambda x, at: F.struct(at.cast("int").alias("feature"), x.alias("value"))), lambda e: e["value"] != 0
    )
    return df.select("row_id", entries.alias("entries"), "label")


@pytest.mark.parametrize("bound", [4_000_000, 0])
def test_sparse_rows_give_the_same_tree(spark, monkeypatch, bound):
    monkeypatch.setattr("minekit.operators.codes.BROADCAST_VALUES", bound)
    monkeypatch.setattr("minekit.operators.splits.BROADCAST_CANDIDATES", bound)
    data = [((i % 13 - 6, (i * 7) % 31 if i % 3 else 0, i % 2, 0), y) for i, (_, y) in enumerate(DATA)]
    df = rows(spark, data)
    fit = DecisionTree(min_leaf=20, candidates=10)
    dense, thin = fit.fit(df), fit.fit(sparse(df))
    assert sorted(map(tuple, dense.collect()), key=str) == sorted(map(tuple, thin.collect()), key=str)
    assert dense.count() > 5
    want = sorted(map(tuple, tree_predictions(df, dense).collect()))
    assert sorted(map(tuple, tree_predictions(sparse(df), thin).collect())) == want
    monkeypatch.setattr("minekit.operators.tree.PACKED_NODES", 0)
    assert sorted(map(tuple, tree_predictions(sparse(df), thin).collect())) == want


def test_a_hundred_thousand_categories(spark):
    n = 100_000
    data = spark.range(2 * n).selectExpr(
        "id as row_id", "concat('c', id % 100000) as category", "array(cast(id % 10 as string)) as numbers", "cast(id % 10 < 3 or id % 100000 = 77 as double) as label"
    )
    thin = features.sparse_features(data, features.category_index(data))
    assert thin.agg(F.max(F.size("entries"))).first()[0] == 2
    nodes = DecisionTree(min_leaf=10, max_depth=2).fit(thin).orderBy("node_id").collect()
    # the number first; then the one category that departs from it
    assert [(r.node_id, r.feature, r.split) for r in nodes if r.feature is not None][0] == ("1", n, 3.0)
    index = {r.category: r.position for r in features.category_index(data).where("category = 'c77'").collect()}
    assert ("11", index["c77"], 1.0) in [(r.node_id, r.feature, r.split) for r in nodes]
