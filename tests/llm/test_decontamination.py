"""Edited passages against brute-force edit distance over all windows, and awkward tables."""

import random
import re

from edges import edge_docs, no_docs

from minekit.llm.decontamination import Decontamination


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def from_start(a, b):
    """The smallest distance of a beginning of ``a`` to ``b``."""
    row = list(range(len(b) + 1))
    best = row[-1]
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def brute(docs, items):
    out = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            limit = len(v) * 20 // 100
            near = [(from_start(w[s : s + len(v) + limit], v), s) for s in range(len(w))] if v else []
            good = [x for x in near if x[0] <= limit]
            if good:
                out[d, i] = (*min(good), len(good))
    return out


def test_matches_equal_brute_force(spark):
    draw = random.Random(4)
    items = [(i, " ".join(f"{draw.choice('abcdefgh')}{draw.randint(0, 40)}" for _ in range(n))) for i, n in enumerate([1, 4, 8, 15, 15, 22, 30])]
    docs = []
    for d in range(120):
        w = words(items[d % len(items)][1])
        for _ in range(draw.randint(0, max(1, len(w) // 4))):
            kind, at = draw.random(), draw.randrange(max(1, len(w)))
            if kind < 0.4:
                w[at : at + 1] = ["other"]
            elif kind < 0.7:
                w.insert(at, "The")
            elif len(w) > 1:
                del w[at]
        around = [f"n{draw.randint(0, 99)}" for _ in range(draw.randint(0, 12))]
        docs.append((d, ", ".join([*around, *w, *around]).upper()))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.start) for r in Decontamination().matches(table, bench).collect()}
    want = {k: v[:2] for k, v in brute(docs, items).items()}
    by_pass = {(r.doc_id, r.item_id): (r.distance, r.start) for r in Decontamination(max_items=3).matches(table, bench).collect()}
    assert set(by_pass) <= set(want) and len(by_pass) >= 0.98 * len(want)
    assert len(want) > 60
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want)
    assert all(got[k] == want[k] for k in got)
    left = {r.doc_id for r in Decontamination().clean(table, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in got}


def test_edits_of_one_kind_count_once(spark):
    draw = random.Random(6)
    item = [f"v{draw.randint(0, 9999)}" for _ in range(30)]
    docs = []
    for n in range(9):
        for d in range(20):
            more, less = list(item), list(item)
            for _ in range(n):
                more.insert(draw.randrange(1, len(more)), f"z{draw.randint(0, 99)}")
                del less[draw.randrange(1, len(less) - 1)]
            around = [f"n{draw.randint(0, 999)}" for _ in range(draw.randint(0, 40))]
            docs += [((n, 2 * d), [*around, *more, *around]), ((n, 2 * d + 1), [*around, *less])]
    rows = [(100 * n + d, " ".join(w)) for (n, d), w in docs]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = {r.doc_id: r.distance for r in Decontamination().matches(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    want = {d: v[0] for (d, _), v in brute(rows, [(1, " ".join(item))]).items()}
    assert all(want[i] == d for i, d in got.items())
    for n in range(7):
        assert sum(i // 100 == n for i in got) >= 39  # of 40


def test_long_items(spark):
    """Items of 400, 1,500 and 4,000 words, edited just within and just beyond a fifth."""
    draw = random.Random(8)
    items = {n: [f"v{draw.randint(0, 3000)}" for _ in range(n)] for n in (400, 1500, 4000)}
    rows, want = [], set()
    for n, item in items.items():
        for share in (0.0, 0.1, 0.19, 0.26):
            w, left = list(item), int(n * share)
            while left:
                kind, at = draw.randrange(3), draw.randrange(1, len(w) - 1)
                w[at : at + (kind != 1)] = [f"z{draw.randint(0, 99)}"] * (kind != 2)
                left -= 1
            around = [f"n{draw.randint(0, 99)}" for _ in range(100)]
            if share < 0.2:
                want.add((len(rows), n))
            rows.append((len(rows), " ".join([*around, *w, *around])))
        rows.append((len(rows), " ".join(item[: n // 2])))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id bigint, text string")
    got = Decontamination().matches(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    for r in got:
        assert r.distance <= r.item_id // 5 and abs(r.start - 100) <= 2
        v, w = items[r.item_id], rows[r.doc_id][1].split()
        if r.item_id == 400:
            assert r.distance == min(from_start(w[s : s + 480], v) for s in range(95, 106))


def test_windows_are_measured_where_hashes_do_not_suffice(spark):
    draw = random.Random(9)
    items = [(i, " ".join(f"{draw.choice('abcd')}{draw.randint(0, 9)}" for _ in range(20))) for i in range(3)]
    docs = []
    for d in range(60):
        w = words(items[d % 3][1])
        for _ in range(draw.randint(0, 5)):
            w[draw.randrange(20)] = "other"
        docs.append((d, " ".join(["x", *w, "y"])))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = Decontamination(walks=0).matches(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()
    assert {(r.doc_id, r.item_id): (r.distance, r.start) for r in got} == {k: v[:2] for k, v in brute(docs, items).items()}


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "the water of the river"), (2, None), (None, "word"), (3, ""), (4, "!!"), (1, "the water of the river")], "item_id bigint, text string")
    rows = Decontamination().matches(edge_docs(spark), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in rows) == [(0, 1, 0), (4, 1, 0), (4, 1, 0), (5, 1, 0)]
    clean = Decontamination().clean(edge_docs(spark), bench)
    assert clean.columns == edge_docs(spark).columns and clean.count() == 7
    assert Decontamination().matches(no_docs(spark), bench).collect() == []
    assert Decontamination().matches(edge_docs(spark), bench.where("false")).collect() == []
