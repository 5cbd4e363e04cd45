import itertools
import random

import pytest
from pyspark.sql import functions as F

from minekit.operators import setjoin
from minekit.operators.setjoin import able_sets, counted_pairs, packed_prefixes, picked, prefix_candidates, rare_prefixes, similar_sets

SCHEMA = "id bigint, items array<bigint>"


def brute(sets, percent):
    out = set()
    for (a, x), (b, y) in itertools.combinations(sorted(sets.items()), 2):
        shared = len(x & y)
        if x and y and 100 * shared >= percent * len(x | y):
            out.add((a, b, len(x), len(y), shared))
    return out


def frame(spark, sets):
    return spark.createDataFrame([(i, sorted(x)) for i, x in sets.items()], SCHEMA)


def edited(rng, base, fresh, gone, new):
    """``base`` without ``gone`` of its items and with ``new`` items that no other set holds."""
    kept = set(rng.sample(sorted(base), len(base) - gone))
    return kept | {next(fresh) for _ in range(new)}


def mixed_sets(seed):
    rng, fresh, sets = random.Random(seed), itertools.count(10_000), {}
    for group in range(6):
        base = set(rng.sample(range(2000), rng.choice((5, 20, 90))))
        sets[len(sets)] = base
        for _ in range(12):
            sets[len(sets)] = edited(rng, base, fresh, rng.randrange(len(base) // 3 + 1), rng.randrange(len(base) // 3 + 1))
    passage = set(range(50_000, 50_040))
    for _ in range(20):
        sets[len(sets)] = passage | {next(fresh) for _ in range(rng.choice((3, 8, 12, 60)))}
    sets[len(sets)] = set()
    sets[len(sets)] = {7}
    sets[len(sets)] = {8, 7}
    return sets


@pytest.mark.parametrize(("percent", "seed"), [(80, 1), (80, 2), (60, 3), (95, 4), (100, 5), (1, 6)])
def test_pairs_equal_brute_force(spark, percent, seed):
    sets = mixed_sets(seed)
    got = similar_sets(frame(spark, sets), percent, block_cost=200)
    assert got.columns == ["a", "b", "n_a", "n_b", "shared"]
    assert {tuple(r) for r in got.collect()} == brute(sets, percent)


def test_copies_just_below_the_threshold_meet_nobody(spark):
    rng, fresh = random.Random(9), itertools.count(10_000)
    base = set(range(200))
    # 177 of 200 kept and 23 new: 177 / 223 = 0.794 with the source, less among each other
    sets = {0: base} | {i: edited(rng, base, fresh, 23, 23) for i in range(1, 401)}
    df = frame(spark, sets)
    assert similar_sets(df, 80).count() == 0 == len(brute(sets, 80))
    parted = df.withColumn("part", F.col("id"))
    assert prefix_candidates(parted, 80).count() == 0
    assert rare_prefixes(parted, 80).count() <= 401 * 41


def test_copies_just_above_the_threshold_are_found(spark):
    rng, fresh = random.Random(9), itertools.count(10_000)
    base = set(range(200))
    # 178 of 200 kept: 178 / 222 = 0.802 with the source
    sets = {0: base} | {i: edited(rng, base, fresh, 22, 22) for i in range(1, 101)}
    got = {(r.a, r.b) for r in similar_sets(frame(spark, sets), 80).collect()}
    assert got == {(a, b) for a, b, *_ in brute(sets, 80)} and len(got) >= 100


def test_pairs_inside_a_part_are_left_out(spark):
    sets = mixed_sets(7)
    parts = {i: i % 3 for i in sets}
    df = frame(spark, sets).withColumn("part", F.col("id") % 3)
    got = {(r.a, r.b) for r in counted_pairs(prefix_candidates(df, 80), df, 80).collect()}
    assert got == {(a, b) for a, b, *_ in brute(sets, 80) if parts[a] != parts[b]}


def test_empty_table(spark):
    assert similar_sets(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("packed_items", [60])
def test_packed_prefixes_are_the_rare_prefixes(spark, monkeypatch, packed_items):
    monkeypatch.setattr(setjoin, "PACKED_ITEMS", packed_items)
    df = frame(spark, mixed_sets(8)).repartition(3).cache()
    wanted = rare_prefixes(df.withColumn("part", F.col("id")), 80)
    got = packed_prefixes(df, 80).select(*wanted.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


@pytest.mark.parametrize("packed_items", [60])
def test_only_sets_that_hold_items_of_others_are_moved(spark, monkeypatch, packed_items):
    monkeypatch.setattr(setjoin, "PACKED_ITEMS", packed_items)
    sets = mixed_sets(9) | {1000 + i: {100_000 + 50 * i + j for j in range(50)} | {1, 2} for i in range(200)}
    df = frame(spark, sets).union(spark.createDataFrame([(5000, None)], SCHEMA)).repartition(3).cache()
    able = able_sets(df, 80)
    ids = {r.id for r in able.collect()}
    assert ids >= {i for a, b, *_ in brute(sets, 80) for i in (a, b)} and not any(i >= 1000 for i in ids)
    monkeypatch.setattr(setjoin, "BROADCAST_ROWS", 50)
    assert sorted(r.id for r in picked(df, able.cache()).collect()) == sorted(ids)


def test_sets_of_near_copies_travel_to_few_cells(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "CELL_SETS", 4)
    sets = mixed_sets(10)
    assert {tuple(r) for r in similar_sets(frame(spark, sets), 60).collect()} == brute(sets, 60)
    kept = []
    monkeypatch.setattr(setjoin, "CELL_SETS", 256)
    settle = setjoin.settle
    monkeypatch.setattr(setjoin, "settle", lambda df, name: kept.append((name, settle(df, name))) or kept[-1][1])
    # 40 copies with one item of their own: 780 pairs
    copies = {i: set(range(100)) | {1000 + i} for i in range(40)}
    assert similar_sets(frame(spark, copies), 80).count() == 780
    assert dict(kept)["members"].count() == 40
