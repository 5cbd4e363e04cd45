"""The metric-space join against brute force over all pairs, its recursion forced on small tables, and awkward tables."""

import random

import numpy as np
import pytest
from edges import edge_docs, no_docs
from test_neardup import brute, family, near_group

from minekit.functions.storage import settle
from minekit.llm.jaccardjoin import JaccardJoin, small_join

SCHEMA = "doc_id bigint, text string"


def components(spark, rows, operator):
    got = operator.components(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def crowd(seed, n=120):
    """Texts around one source with edits of all strengths, a shared passage with tails, shortened and lengthened texts."""
    draw = random.Random(seed)
    words = [f"w{draw.randint(0, 5000)}" for _ in range(90)]
    rows = []
    for i in range(n):
        own = list(words)
        for at in draw.sample(range(90), draw.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            own[at] = f"e{i}x{at}"
        if draw.random() < 0.3:
            own = own[: draw.randint(60, 90)]
        if draw.random() < 0.3:
            own += [f"t{i}x{j}" for j in range(draw.randint(1, 20))]
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize(
    ("rows", "operator"),
    [
        (family(5), JaccardJoin()),
        (family(8), JaccardJoin(shingle=2, leaf_rows=4, pivots=3)),
        (crowd(1), JaccardJoin(leaf_rows=2, pivots=2)),
        (crowd(2), JaccardJoin(leaf_rows=6, pivots=4, shrink=1.0)),
        (crowd(3), JaccardJoin(shingle=3, leaf_rows=3, pivots=5, depth=1)),
        (crowd(4), JaccardJoin(shingle=1, percent=60, leaf_items=200)),
    ],
)
def test_components_equal_brute_force(spark, rows, operator):
    want = brute(rows, operator.shingle, operator.percent)
    assert components(spark, rows, operator) == want


def test_groups_just_below_and_just_above_the_threshold(spark):
    for own, linked in ((17, False), (16, True)):
        rows = near_group(own, 120)
        got = components(spark, rows, JaccardJoin(shingle=2, leaf_rows=16))
        assert got == brute(rows, 2)
        assert all((c == 0) == linked for d, (_, c) in got.items() if d)


def test_cells_of_the_voronoi_split_keep_all_pairs_within_the_radius(spark):
    rows, operator = crowd(5), JaccardJoin(shingle=2, pivots=4)
    docs = spark.createDataFrame(rows, SCHEMA)
    classes, whole = operator._classes(settle(operator._read(docs), "read"))
    sets = operator._sets(docs, whole)
    known = {r.id: set(r["items"]) for r in sets.collect()}
    region = sets.selectExpr("1L as region", "id", "id as part").crossJoin(sets.selectExpr("count(*) as rows"))
    cells, links = operator._split(settle(region, "region"), sets, 0)
    homes = {}
    for r in cells.collect():
        homes.setdefault(r.id, set()).add(r.region)
    assert set(homes) == set(known) and len({c for x in homes.values() for c in x}) == 4

    def near(a, b):
        return 100 * len(known[a] & known[b]) >= 80 * len(known[a] | known[b])

    for a in known:
        for b in known:
            if a < b and near(a, b):
                assert homes[a] & homes[b]
    assert all(near(r.a, r.b) for r in links.collect())


def test_small_join_connects_all_similar_sets():
    draw = np.random.default_rng(2)
    items = [np.unique(draw.integers(0, 60, draw.integers(1, 40))) for _ in range(50)]
    ids, parts = np.arange(50) * 3, np.arange(50) // 2
    a, b = small_join(ids, parts, items, 50)
    root = {int(p): int(p) for p in parts}

    def find(p):
        return p if root[p] == p else find(root[p])

    for x, y in zip(a, b):
        s, t = set(items[x // 3].tolist()), set(items[y // 3].tolist())
        assert x < y and 100 * len(s & t) >= 50 * len(s | t) and find(int(parts[x // 3])) != find(int(parts[y // 3]))
        root[find(int(parts[x // 3]))] = find(int(parts[y // 3]))
    for i in range(50):
        for j in range(i):
            s, t = set(items[i].tolist()), set(items[j].tolist())
            if 100 * len(s & t) >= 50 * len(s | t):
                assert find(int(parts[i])) == find(int(parts[j]))


def test_one_id_with_unlike_texts_is_one_node(spark):
    first, other = "a b c d e f g h", "k l m n o p q r"
    rows = [(5, first), (5, other), (7, first), (9, other), (11, "x y z")]
    got = JaccardJoin().components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 5), (9, 5), (11, 11)]


def test_awkward_rows(spark):
    got = JaccardJoin(shingle=2).components(edge_docs(spark)).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert by[4].component_id == by[5].component_id == 4 and by[9].component_id == 3
    assert all(by[i].n_shingles == 0 and by[i].component_id == i for i in (1, 2, 6)) and by[7].n_shingles == 1
    assert by[None].component_id is None
    assert JaccardJoin().components(no_docs(spark)).collect() == []
