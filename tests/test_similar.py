import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.functions.storage import settle
from minekit.operators.minhash import MinHash, lsh_buckets, lsh_rows, minhash_signatures
from minekit.operators.pairs import bucket_places, group_members, met_groups, similarity_bound, smallest_pairs, strongest_pairs, top_pairs
from minekit.operators.text import doc_shingles, doc_tokens, shingle_id_lists, shingle_ids
from minekit.plans.similar import SimilarDocuments

SEARCH = SimilarDocuments(block_cost=200)


def corpus():
    """Three base texts, near copies of each, 30 exact copies of the first, short and empty texts."""
    rng = random.Random(5)
    word = lambda: "w%d" % rng.randrange(400)
    texts = {}
    for base in range(3):
        words = [word() for _ in range(120)]
        texts[10 * base] = " ".join(words)
        for copy, changes in enumerate((2, 8, 25), start=1):
            near = list(words)
            for at in rng.sample(range(120), changes):
                near[at] = word()
            texts[10 * base + copy] = " ".join(near)
    for copy in range(100, 130):
        texts[copy] = texts[0]
    texts[200], texts[201], texts[202] = "two words", "", 'Only-three "words,".'
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(corpus().items()), "doc_id bigint, text string")


def shingle_sets():
    """The texts of the corpus are made of plain words but for one, whose words are given."""
    lists = {doc: text.split() for doc, text in corpus().items()} | {202: ["only", "three", "words"]}
    return {doc: {tuple(words[i : i + 3]) for i in range(len(words) - 2)} for doc, words in lists.items()}


def jaccard(x, y):
    return len(x & y) / len(x | y)


def test_tokens(spark):
    df = spark.createDataFrame([(1, 'One-two\nTHREE, "four." five;  six')], "doc_id bigint, text string")
    assert doc_tokens(df).first()["tokens"] == ["one", "two", "three", "four", "five;", "six"]


def test_shingles_are_distinct_and_honour_k(spark):
    df = spark.createDataFrame([(1, "a b a b a b"), (2, "a b")], "doc_id bigint, text string")
    got = {(r.doc_id, r.shingle) for r in doc_shingles(doc_tokens(df), 3).collect()}
    assert got == {(1, "a b a"), (1, "b a b")}
    assert doc_shingles(doc_tokens(df), 2).count() == 3
    assert doc_shingles(doc_tokens(df), 2).where("doc_id = 2 and shingle = 'a b'").count() == 1


def test_family_is_seeded_and_never_constant():
    family = MinHash(200, seed=3)
    assert family.parameters() == MinHash(200, seed=3).parameters()
    assert all(1 <= a <= 10_000 and 0 <= b <= 10_000 for a, b in family.parameters())


def test_too_many_bands_are_refused():
    with pytest.raises(ValueError):
        SimilarDocuments(family=MinHash(10), bands=6, rows=2)


@pytest.mark.parametrize("family", [MinHash(7), MinHash(7, seed=2, prime=554_747, modulus=12_901)])
def test_both_ways_to_signatures_agree(docs, family):
    search = SimilarDocuments(family=family, bands=3)
    by_rows = minhash_signatures(search.shingle_ids(docs), family)
    by_lists = search.signatures(docs)
    assert by_rows.count() == by_lists.count() == 43
    assert by_rows.exceptAll(by_lists).isEmpty()


def test_signatures_estimate_jaccard(docs):
    sets = shingle_sets()
    rows = SEARCH.similarities(SEARCH.groups(SEARCH.signatures(docs))).collect()
    assert rows
    for r in rows:
        exact = jaccard(sets[r.a], sets[r.b]) if r.a != r.b else 1.0
        spread = 4 * (exact * (1 - exact) / 100) ** 0.5
        assert abs(r.similarity - exact) <= spread + 1e-9
        assert r.shared_bands >= 1
    inside = [r for r in rows if r.a == r.b]
    assert [(r.a, r.n_pairs) for r in inside] == [(0, 31 * 30 // 2)]


def test_compact_pairs_stand_for_all_document_pairs(docs):
    signatures = settle(SEARCH.signatures(docs), "signatures")
    groups = SEARCH.groups(signatures)
    members = {}
    for r in group_members(signatures, groups, block_cost=5).collect():
        members.setdefault(r.group_doc, []).append(r.doc_id)
    listed = set()
    for r in SEARCH.candidates(groups).collect():
        pairs = itertools.combinations(members[r.a], 2) if r.a == r.b else itertools.product(members[r.a], members[r.b])
        listed |= {tuple(sorted(p)) for p in pairs}
    rows = lsh_rows(signatures, 50, 2)
    brute = rows.withColumnRenamed("doc_id", "a").join(rows.withColumnRenamed("doc_id", "b"), ["band", "bucket"])
    assert listed == {(r.a, r.b) for r in brute.where("a < b").select("a", "b").distinct().collect()}


@pytest.mark.parametrize("k", [1, 10, 400, 600, 1500, 2000])
def test_top_pairs_equal_brute_force(docs, k):
    signatures = settle(SEARCH.signatures(docs), "signatures")
    sig = {r.doc_id: r.sig for r in signatures.collect()}

    def meet(x, y):
        return any(x[2 * b : 2 * b + 2] == y[2 * b : 2 * b + 2] for b in range(50))

    brute = [
        (-sum(p == q for p, q in zip(sig[a], sig[b])) / 100, a, b)
        for a, b in itertools.combinations(sorted(sig), 2)
        if meet(sig[a], sig[b])
    ]
    wanted = [(a, b, -s) for s, a, b in sorted(brute)[:k]]
    best = top_pairs(SEARCH.similarities(SEARCH.groups(signatures)), signatures, k)
    assert [tuple(r) for r in best.collect()] == wanted
    assert "Window" not in best._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in SEARCH.top(docs, k).collect()] == wanted


def test_pairs_that_cannot_be_among_the_best_are_not_measured(docs):
    groups = SEARCH.groups(SEARCH.signatures(docs))
    pairs = settle(SEARCH.candidates(groups), "pairs")
    measured = strongest_pairs(pairs, groups, 2, 100, 50, 2, block_cost=200)
    whole = {(r.a, r.b): r.similarity for r in SEARCH.similarities(groups).collect()}
    got = {(r.a, r.b): r.similarity for r in measured.collect()}
    assert got.items() <= whole.items() and len(got) < len(whole)
    second = sorted(whole.values())[-2]
    assert {p for p, s in whole.items() if s >= second} <= set(got)
    for r in pairs.collect():
        assert whole[(r.a, r.b)] <= similarity_bound(r.shared_bands, 100, 50, 2)
    assert strongest_pairs(pairs.limit(0), groups, 2, 100, 50, 2).isEmpty()


def test_smallest_pairs():
    draw = random.Random(3)
    for k in (1, 3, 20, 1000):
        x, y = draw.sample(range(60), 12), draw.sample(range(100, 160), 9) + draw.sample(range(60, 70), 4)
        every = sorted((min(p, q), max(p, q)) for p in x for q in y)
        assert list(zip(*(side.tolist() for side in smallest_pairs(np.array(x), np.array(y), False, k)))) == every[:k]
        inside = sorted((p, q) for p in x for q in x if p < q)
        assert list(zip(*(side.tolist() for side in smallest_pairs(np.array(x), np.array(x), True, k)))) == inside[:k]


def test_buckets_count_members(docs):
    rows = lsh_rows(SEARCH.signatures(docs), 50, 2)
    buckets = lsh_buckets(rows).collect()
    assert all(r.n_docs > 1 for r in buckets)
    assert max(r.n_docs for r in buckets) >= 31
    assert rows.groupBy("band").agg(F.count("*").alias("n")).where("n != 43").isEmpty()


@pytest.mark.parametrize("block_cost", [4, 200, 1 << 22])
def test_pairs_are_counted_where_they_meet(spark, block_cost):
    draw = random.Random(7)
    common = [draw.randrange(1000) for _ in range(100)]
    # most share many buckets with all others
    sig = {d: [v if draw.random() < 0.6 else draw.randrange(1000) for v in common] for d in range(90)}
    sig[90] = [5000 + i for i in range(100)]
    groups = settle(spark.createDataFrame([(d, s, d % 3 + 1) for d, s in sig.items()], "doc_id bigint, sig array<bigint>, n_docs bigint"), "groups")
    wanted = {}
    for a, b in itertools.combinations(sig, 2):
        shared = sum(sig[a][i : i + 2] == sig[b][i : i + 2] for i in range(0, 100, 2))
        equal = sum(p == q for p, q in zip(sig[a], sig[b]))
        wanted[a, b] = (shared, equal / 100, (a % 3 + 1) * (b % 3 + 1))
    places = bucket_places(groups, 50, 2, block_cost)
    for least in (1, 5, 12, 50):
        met = met_groups(groups, 50, 2, block_cost, least, places)
        got = [tuple(r) for r in met.select("a", "b", "shared_bands", "similarity", "n_pairs").collect()]
        assert sorted(got) == sorted((*p, *v) for p, v in wanted.items() if v[0] >= least)
    plan = met_groups(groups, 50, 2, block_cost, 1, places)._jdf.queryExecution().executedPlan().toString()
    # no aggregate of pairs follows the measuring
    assert "HashAggregate" not in plan.split("MapInArrow")[0]


def test_groups_of_one_name_are_summed_up(spark):
    sig = [list(range(100)), [*range(50), *range(200, 250)], list(range(300, 400)), [*range(300, 320), *range(20, 50), *range(200, 250)]]
    groups = settle(spark.createDataFrame(list(zip([1, 2, 2, 3], sig, [1] * 4)), "doc_id bigint, sig array<bigint>, n_docs bigint"), "groups")
    assert {tuple(r) for r in SEARCH.candidates(groups).collect()} == {(1, 2, 25), (1, 3, 15), (2, 3, 50)}


@pytest.mark.parametrize("distinct", [False, True])
def test_ids_of_runs_are_leading_bits_of_their_md5(spark, distinct):
    rows = [(1, "a b a b a b"), (2, "a b"), (3, None), (4, ""), (5, "\u00e9 x\u0130 y  z - t\tu"), (None, "n u l l"), (6, "a b c")]
    tokens = doc_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"))
    listed = shingle_id_lists(tokens, 3, "md5", distinct)
    assert listed.where("ids is null").count() == 3
    found = listed.select("doc_id", F.explode("ids"))
    wanted = shingle_ids(doc_shingles(tokens, 3), "md5")
    assert found.count() == wanted.count() + (0 if distinct else 2)
    assert (found if distinct else found.distinct()).exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_minima_of_long_documents_pass_through_pieces(spark):
    family = MinHash(5)
    ids = spark.range(40_000).select((F.col("id") % 3).alias("doc_id"), F.xxhash64("id").alias("shingle_id")).repartition(4).sortWithinPartitions("doc_id")
    got = {r.doc_id: r.sig for r in minhash_signatures(ids, family).collect()}
    rows = [(r.doc_id, r.shingle_id % family.prime) for r in ids.collect()]
    for doc in range(3):
        assert got[doc] == [min((x * a + b) % family.prime for d, x in rows if d == doc) for a, b in family.parameters()]


def test_a_task_counts_the_buckets_of_a_bounded_part(spark, monkeypatch):
    """Partitions of the count follow the size of the stored groups, not the number of files or cores."""
    from minekit.operators import pairs

    monkeypatch.setattr(pairs, "COUNTED_BYTES", 1 << 10, raising=False)
    asked = []
    plain = pairs.lsh_buckets

    def watched(rows):
        asked.append(rows.rdd.getNumPartitions())
        return plain(rows)

    monkeypatch.setattr(pairs, "lsh_buckets", watched)
    draw = random.Random(9)
    sig = [(d, [draw.randrange(50) for _ in range(100)], 1) for d in range(200)]
    groups = settle(spark.createDataFrame(sig, "doc_id bigint, sig array<bigint>, n_docs bigint").coalesce(1), "groups")
    places = bucket_places(groups, 50, 2)
    assert asked[0] > spark.sparkContext.defaultParallelism
    held = {}
    for d, s, _ in sig:
        for b in range(50):
            held.setdefault((b, *s[2 * b : 2 * b + 2]), []).append(d)
    wanted = sorted((d, k[0] + 1, len(ds)) for k, ds in held.items() if len(ds) > 1 for d in ds)
    assert sorted((r.doc_id, r.band, r.n_docs) for r in places.collect()) == wanted


def test_places_of_two_are_listed_once_for_each_size(spark):
    """Small cells, which are nearly all, take their pairs from a list made once; they meet as brute force has it."""
    import pyarrow as pa

    from minekit.operators import pairs

    draw = np.random.default_rng(2)
    sizes = [2, 3, 5, 64, 65, 2, 3]
    n = sum(sizes)
    cell = np.repeat(np.arange(len(sizes)), sizes)
    sig = draw.integers(0, 3, (n, 6)).astype(np.int32)
    sig[:, :2] = cell[:, None]
    zero = np.zeros(n, np.int32)
    cells = pa.table({
        "bucket_no": pa.array(cell), "_r": pa.array(zero), "_c": pa.array(zero), "_at": pa.array(zero), "band": pa.array(zero + 1),
        "doc_id": pa.array(np.arange(n)), "_docs": pa.array(zero.astype(np.int64) + 1), "_sig": pa.array(list(sig), pa.list_(pa.int32())),
    })
    pairs.two_of.cache_clear()
    got = [tuple(p) for b in pairs.compared(cells, 3, 2, 1) for p in zip(*(b.column(c).to_pylist() for c in ("_x", "_y", "shared_bands", "similarity")))]
    wanted = [
        (a, b, sum((sig[a][i : i + 2] == sig[b][i : i + 2]).all() for i in (0, 2, 4)), (sig[a] == sig[b]).mean())
        for a, b in itertools.combinations(range(n), 2) if cell[a] == cell[b]
    ]
    assert sorted(got) == sorted(wanted)
    assert pairs.two_of.cache_info().misses == 4
