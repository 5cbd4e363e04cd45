"""Near-duplicates against brute force over all pairs, and awkward tables."""

import random
import re

from edges import edge_docs, no_docs

from minekit.llm.neardup import NearDuplicates

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, k, percent=80):
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def family(seed):
    """A base text with copies, light and heavy edits, and other texts."""
    draw = random.Random(seed)
    words = [f"w{draw.randint(0, 400)}" for _ in range(120)]
    rows = []
    for i in range(60):
        own = list(words)
        for _ in range(draw.choice([0, 0, 2, 4, 6, 9, 14])):
            own[draw.randrange(len(own))] = f"x{draw.randint(0, 9)}"
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join(f"w{draw.randint(0, 400)}" for _ in range(draw.randint(1, 60)))) for i in range(40)]
    rows += [(200 + i, t) for i, t in enumerate(["a", "A", "a b", "a  B", "a b c", "", " ", "é É", "É é"])]
    draw.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    for k in (2, 5):
        rows = family(k)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in NearDuplicates(shingle=k).components(docs).collect()}
        assert got == brute(rows, k)


def test_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 8 : i * 8 + 100])) for i in range(12)]
    got = NearDuplicates(shingle=2).components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: c for d, (_, c) in brute(rows, 2).items()}


def test_awkward_rows(spark):
    got = NearDuplicates(shingle=2).components(edge_docs(spark)).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert by[5].component_id == 4 and not by[5].kept and by[4].kept
    assert by[9].component_id == 3
    assert all(by[i].n_shingles == 0 and by[i].component_id == i and by[i].kept for i in (1, 2, 6))
    assert by[None].component_id is None and by[None].kept
    kept = NearDuplicates(shingle=2).deduplicated(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert kept.where("doc_id is null").count() == 1


def test_no_rows(spark):
    assert NearDuplicates().components(no_docs(spark)).collect() == []
    assert NearDuplicates().deduplicated(no_docs(spark)).collect() == []


def test_one_id_with_unlike_texts_loses_none(spark):
    first, other = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(2, first), (5, first), (5, other), (5, other), (7, None)], "doc_id bigint, text string")
    kept = NearDuplicates(shingle=2).deduplicated(docs).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(2, first), (5, other), (7, "")]


def near_group(own, copies, seed=3):
    """A text of 150 words and copies of it, each with ``own`` words at its end that nobody else has."""
    draw = random.Random(seed)
    words = [f"w{draw.randint(0, 10_000)}" for _ in range(150)]
    return [(0, " ".join(words))] + [
        (i, " ".join(words[: 150 - own] + [f"own{i}x{j}" for j in range(own)])) for i in range(1, copies + 1)
    ]


def test_groups_just_below_and_just_above_the_threshold(spark):
    # 149 pairs of words: 132 shared of 166 are 79.5 %, 133 of 165 are 80.6 %
    for own, linked in ((17, False), (16, True)):
        rows = near_group(own, 120)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in NearDuplicates(shingle=2).components(docs).collect()}
        assert got == brute(rows, 2)
        assert all((c == 0) == linked for d, (_, c) in got.items() if d)
