"""Neighbours: recall against brute force, exact scores and ties, copies, awkward tables."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.llm.neighbours import LearnedPartitions, Nested, Router, balanced_parts

SCHEMA = "vec_id bigint, embedding array<float>, label int, entry bigint, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([np.array(v, np.float32) for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
        out[ids[q]] = [(int(ids[i]), score[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_recall_and_scores(spark, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.4 * draw.normal(size=16)).tolist()) for i in range(3000)]
    got = found(LearnedPartitions(k=10, block_rows=150, query_rows=40).search(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert recall(got, brute(rows, 10)) >= 0.95
    for q, own in got.items():
        assert len(own) == 10 and q not in {i for i, _ in own}
        assert all(a[1] >= b[1] for a, b in zip(own, own[1:]))


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="test tables are not present")
def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert recall(found(LearnedPartitions(k=20).search(df, F.col("vec_id") % 20 == 0)), brute(rows, 20)) >= 0.95


def test_queries_that_find_too_few_visit_all_parts(spark, monkeypatch):
    """Far clusters of 30 vectors and one visited part: 40 neighbours need other parts."""
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(40, 24)) * 5
    rows = [(i, (centres[i % 40] + 0.1 * draw.normal(size=24)).tolist()) for i in range(1200)]
    monkeypatch.setattr(LearnedPartitions, "_visits", lambda *_: 1)
    got = found(LearnedPartitions(k=40, per_part=25).search(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert {len(x) for x in got.values()} == {40}


def clustered(n):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(60, 16))
    return [(i, (centres[i % 60] + 0.3 * draw.normal(size=16)).tolist()) for i in range(n)]


def test_large_parts_get_a_second_level(spark):
    """9,000 vectors, parts of about 900: recall holds, and a query meets a fraction of what whole parts hold."""
    rows = clustered(9000)
    operator = LearnedPartitions(k=10, sample_rows=1500, per_part=100, split_rows=300, block_rows=100, recall=0.95)
    df = vectors(spark, rows)
    router = operator.fit(operator.entries(df).cache())
    assert isinstance(router, Nested) and router.n_parts > 3 * router.outer.n_parts and router.visits < router.n_parts
    x = np.array([np.array(v, np.float32) for _, v in rows], float)
    home = router.filed(x)
    flat = router.outer.filed(x)
    assert (np.searchsorted(router.first, home, "right") - 1 == flat).all()
    sizes, outer_sizes = np.bincount(home, minlength=router.n_parts), np.bincount(flat)
    asked = x[::20]
    met = sizes[router.parts(asked, router.visits)].sum(1).mean()
    router.outer.visits = operator._visits(router.outer, asked, operator._graph(asked, 2)[1])
    assert met < outer_sizes[router.outer.parts(asked, router.outer.visits)].sum(1).mean()
    got = found(operator.search(df, F.col("vec_id") % 20 == 0))
    assert recall(got, brute(rows, 10)) >= 0.95
    assert {len(v) for v in got.values()} == {10}


def test_parts_of_two_levels_are_ranked_by_both_probabilities():
    draw = np.random.default_rng(6)
    router = lambda n: Router(draw.normal(size=(4, 8)), draw.normal(size=8), draw.normal(size=(8, n)), draw.normal(size=n), 1, 4)
    nested = Nested(router(3), {0: router(2), 2: router(4)})
    x = draw.normal(size=(600, 4))
    share = lambda r: np.exp(r.logits(x)) / np.exp(r.logits(x)).sum(1, keepdims=True)
    outer, low, high = share(nested.outer), share(nested.inner[0]), share(nested.inner[2])
    want = np.concatenate((outer[:, :1] * low, outer[:, 1:2], outer[:, 2:] * high), axis=1)
    assert nested.n_parts == 7 and (nested.parts(x, 7) == np.argsort(-want, axis=1)).all()


def test_copies_and_ties_go_to_the_smaller_id(spark):
    draw = np.random.default_rng(2)
    same = draw.normal(size=8).tolist()
    rows = [(i, same if i % 3 else draw.normal(size=8).tolist()) for i in range(200)]
    assert_equal(found(LearnedPartitions(k=20).search(vectors(spark, rows), F.col("vec_id") % 20 == 0)), brute(rows, 20))


def assert_equal(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [None, 1.0]), (100, [1.0]),
        (None, [1.0, 1.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (120, [float("inf"), 0.0]),
    ]
    got = found(LearnedPartitions(k=20).search(vectors(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == {0: [(1, 2.0), (2, 0.0)]}
    assert LearnedPartitions().search(vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def test_parts_are_balanced():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1000, 8))
    near = np.argsort(-(x @ x.T), axis=1)[:, 1:6]
    sizes = np.bincount(balanced_parts(x, near, 10), minlength=10)
    assert sizes.min() >= 90 and sizes.max() <= 110
