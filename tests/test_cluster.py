import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators.cluster import assignments, centroid_update, clustering_cost, nearest_centroid, pairwise_distance
from minekit.plans.kmeans import KMeans, cost_changes


def points(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v array<double>")


def centroids(spark, rows):
    return spark.createDataFrame(rows, "cid bigint, v array<double>")


@pytest.fixture(scope="module")
def cloud(spark):
    rows = [(i, [float(i % 7), float(i % 5) * 1.5, float(i % 3) - 1]) for i in range(90)]
    return points(spark, rows), centroids(spark, [(c, [float(c), 1.0 + c, 0.5 * c]) for c in range(6)])


def test_distances(spark):
    got = pairwise_distance(points(spark, [(1, [0.0, 3.0])]), centroids(spark, [(0, [1.0, 1.0])])).collect()
    assert [tuple(r) for r in got] == [(1, 0, 3.0, 5.0)]


def test_ties_go_to_the_smallest_centroid(spark):
    near = assignments(points(spark, [(1, [0.0])]), centroids(spark, [(5, [1.0]), (2, [-1.0]), (9, [1.0])]))
    assert nearest_centroid(near, "l1").first()["cid"] == 2
    assert nearest_centroid(near, "l2").first()["cid"] == 2


@pytest.mark.parametrize("n_packs", [2, 5])
def test_packs_give_the_same_result(cloud, n_packs):
    key = lambda df: sorted(tuple(r) for r in df.drop("v").collect())
    assert key(assignments(*cloud, n_packs=n_packs)) == key(assignments(*cloud))
    assert key(pairwise_distance(*cloud, n_packs=n_packs)) == key(pairwise_distance(*cloud))


def test_vectors_move_once_whatever_the_number_of_packs(cloud):
    for n_packs in (2, 9):
        plan = assignments(*cloud, n_packs=n_packs)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_nearest_of_many_centroids_equals_brute_force(spark, monkeypatch):
    """Norms of very different size, so that many centroids are left out, equal distances, and several blocks of points."""
    monkeypatch.setattr("minekit.operators.cluster.BLOCK_NUMBERS", 64)
    draw = np.random.default_rng(4)
    data = (draw.normal(size=(120, 4)) * np.exp(draw.uniform(-3, 4, (120, 1)))).round(1)
    table = np.concatenate((data[::3] + 0.5, draw.normal(size=(60, 4)) * 30, data[:5] - 0.5, data[:5] + 0.5)).round(1)
    far = {"l1": np.abs(data[:, None] - table).sum(2), "l2sq": np.square(data[:, None] - table).sum(2)}
    want = {m: d.min(1) for m, d in far.items()}
    for n_packs in (1, 4):
        near = assignments(
            points(spark, [(i, v) for i, v in enumerate(data.tolist())]), centroids(spark, list(enumerate(table.tolist()))), n_packs=n_packs
        ).collect()
        assert len(near) == 120
        for r in near:
            assert r.l1 == pytest.approx(want["l1"][r.id]) and r.l2sq == pytest.approx(want["l2sq"][r.id])
            assert far["l1"][r.id][r.cid_l1] == pytest.approx(r.l1) and far["l2sq"][r.id][r.cid_l2] == pytest.approx(r.l2sq)


def test_one_state_is_left_and_both_ways_agree(cloud, tmp_path, monkeypatch):
    spark = cloud[0].sparkSession
    near = KMeans("l2", 6).fit(*cloud)
    monkeypatch.setattr("minekit.functions.storage.work_dir", lambda session: str(tmp_path))
    far = KMeans("l2", 6, packed_numbers=4).fit(*cloud)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["centroids"]
    assert [tuple(r) for r in near.history.orderBy("iteration").collect()] == [
        pytest.approx(tuple(r)) for r in far.history.orderBy("iteration").collect()
    ]
    rows = lambda fit: {r.cid: pytest.approx(r.v) for r in fit.centroids.collect()}
    assert rows(near) == {r.cid: r.v for r in far.centroids.collect()}
    assert spark.range(1).count() == 1


def test_long_vectors_give_the_same_result(cloud, monkeypatch):
    wanted = sorted(tuple(r) for r in assignments(*cloud).drop("v").collect())
    monkeypatch.setattr("minekit.operators.cluster.BATCH_NUMBERS", 1)
    assert sorted(tuple(r) for r in assignments(*cloud).drop("v").collect()) == wanted


@pytest.mark.parametrize("n_packs", [1, 2])
def test_undefined_distances_and_repeated_ids(spark, n_packs):
    data = points(spark, [(1, [0.0]), (1, [4.0]), (1, [4.0]), (2, [float("nan")])])
    near = assignments(data, centroids(spark, [(0, [float("nan")]), (1, [2.0])]), n_packs=n_packs)
    got = sorted((r.id, r.cid_l1, r.l1, r.cid_l2, r.l2sq) for r in near.where("id = 1").collect())
    assert got == [(1, 1, 2.0, 1, 4.0)] * 3
    assert [tuple(r) for r in near.where("id = 2").drop("v").collect()] == [(2, None, None, None, None)]


def test_many_centroids_in_bounded_memory(spark):
    cents = spark.range(20_000).selectExpr("id AS cid", "array(double(id), 0.0D) AS v")
    data = spark.range(50).selectExpr("id", "array(id * 7 + 0.2D, 1.0D) AS v")
    got = nearest_centroid(assignments(data, cents), "l2").collect()
    assert all(r.cid == r.id * 7 for r in got) and len(got) == 50


@pytest.mark.parametrize("wide", [1, 256])
def test_vectors_of_another_length_are_refused(spark, monkeypatch, wide):
    monkeypatch.setattr("minekit.operators.cluster.WIDE_DIMENSION", wide)
    near = points(spark, [(1, [0.0, 1.0]), (2, [1.0])]).selectExpr("id", "v", "0L AS cid_l2", "0D AS l1", "0D AS l2sq")
    with pytest.raises(Exception, match="a vector has 1 numbers instead of 2"):
        centroid_update(near, "l2", 2).collect()


def test_long_and_wide_update_agree(cloud, monkeypatch):
    near = assignments(*cloud)
    wide = {r.cid: r for r in centroid_update(near, "l2", 3).collect()}
    monkeypatch.setattr("minekit.operators.cluster.WIDE_DIMENSION", 1)
    long = {r.cid: r for r in centroid_update(near, "l2", 3).collect()}
    assert wide.keys() == long.keys()
    for cid, row in wide.items():
        assert row.v == pytest.approx(long[cid].v) and row.n == long[cid].n


def test_lonely_centroid_disappears(spark):
    data = points(spark, [(1, [0.0]), (2, [1.0])])
    fit = KMeans("l2", 2).fit(data, centroids(spark, [(0, [0.5]), (1, [100.0])]))
    assert [tuple(r) for r in fit.centroids.collect()] == [(0, [0.5])]
    assert [r.k for r in fit.history.orderBy("iteration").collect()] == [1, 1]


def test_first_history_row_is_the_initial_cost(cloud):
    history = KMeans("l1", 3).fit(*cloud).history.orderBy("iteration").collect()
    start = clustering_cost(assignments(*cloud)).first()
    assert len(history) == 3
    assert history[0].cost_l1 == pytest.approx(start.cost_l1)
    assert history[0].cost_l2sq == pytest.approx(start.cost_l2sq)


def test_l2_cost_never_rises(cloud):
    history = KMeans("l2", 6).fit(*cloud).history.withColumn("run", F.lit("x"))
    changes = [r.change_l2sq for r in cost_changes(history).orderBy("iteration").collect()]
    assert changes[0] is None
    assert all(c <= 1e-12 for c in changes[1:])


def test_python_holds_a_bounded_piece_of_a_batch(spark, monkeypatch):
    """Vectors stay in Arrow until they are measured, in pieces of bounded size."""
    import pandas as pd
    import pyarrow as pa

    from minekit.operators import cluster

    sizes = []
    plain = cluster._Nearest

    def watched(batch):
        sizes.append(batch.size)
        return plain(batch)

    monkeypatch.setattr(cluster, "_Nearest", watched)
    vectors = np.random.default_rng(1).normal(size=(10_000, 64))
    near = cluster._nearest_of(np.arange(3), vectors[:3]).func(pa.array(vectors.tolist()))
    assert len(near) == 10_000 and max(sizes) <= 1 << 17
    far = np.abs(vectors[:, None] - vectors[:3]).sum(2)
    assert near.field("cid_l1").to_pylist() == far.argmin(1).tolist()
    assert not isinstance(near, pd.DataFrame)


def test_results_at_hand_start_no_python(cloud):
    fit = KMeans("l2", 2).fit(*cloud)
    for table in (fit.history, fit.centroids):
        assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()
    assert KMeans("l2", 0).fit(*cloud).history.count() == 0
