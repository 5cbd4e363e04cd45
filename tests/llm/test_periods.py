"""Periodic runs against a brute-force search, and awkward tables."""

import random
import zlib

import numpy as np
import pytest
from edges import LONG, edge_docs, no_docs
from pyspark.sql import functions as F

from minekit.llm.periods import PeriodicRuns, _squared_differences
from minekit.llm.queries import planted_repetitions, runs_digest


def brute(words, least=6, repeats=4):
    """Every period tried at every place; the smallest period of each maximal stretch."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(draw, n):
    words = []
    while len(words) < n:
        kind = draw.random()
        if kind < 0.5:
            words += [draw.choice("abcdefghij") for _ in range(draw.randint(1, 12))]
        elif kind < 0.9:
            base = [draw.choice("abcd") for _ in range(draw.choice((1, 2, 3, 5, 8, 13, 31)))]
            times = draw.choice((3, 4, 5, 9))
            words += (base * times)[: len(base) * times - draw.randint(0, len(base) - 1)]
        else:
            words += ["z"] * draw.randint(1, 30)
    return words[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    for n in (0, 1, 5, 6, 7, 24, 100, 400):
        words = repetitive(draw, n)
        ids = {w: i + 1 for i, w in enumerate(dict.fromkeys(words))}
        starts, lengths, periods = PeriodicRuns().find(np.array([ids[w] for w in words], np.int64))
        assert list(zip(starts.tolist(), lengths.tolist(), periods.tolist())) == brute(words)


@pytest.mark.parametrize("block", [1, 2, 8, 64])
def test_convolution_is_exact(block):
    draw = np.random.default_rng(block)
    x, y = draw.integers(1, 1 << 20, (5, block)), draw.integers(1, 1 << 20, (5, 2 * block - 1))
    want = np.array([[int(((x[r] - y[r, d : d + block]).astype(object) ** 2).sum()) for d in range(block)] for r in range(5)], object)
    for prime, root in ((998244353, 3), (469762049, 3), (167772161, 3)):
        assert (_squared_differences(x, y, prime, root).astype(object) == want % prime).all()


def test_many_large_numbers_take_more_primes():
    base = np.arange(1, 4001, dtype=np.int64) * 10_000_000
    starts, lengths, periods = PeriodicRuns().find(np.concatenate(([5], np.tile(base, 5), [7])))
    assert (starts.tolist(), lengths.tolist(), periods.tolist()) == ([1], [20_000], [4000])


def test_fewer_than_three_repetitions_are_refused():
    with pytest.raises(ValueError):
        PeriodicRuns(repeats=2)


def test_documents_equal_brute_force(spark):
    draw = random.Random(1)
    rows = [(i, " \t\n".join(repetitive(draw, draw.randint(0, 300)))) for i in range(80)]
    got = PeriodicRuns().run(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert len(got) == 80
    texts = dict(rows)
    for r in got:
        words = texts[r.doc_id].split()
        runs = brute(words)
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(words)
        assert r.collapsed == collapsed(words, runs)


def test_other_lengths_and_repetitions(spark):
    words = "a b a b a b c c c c c x y x y x y x y x y".split()
    for least, repeats in ((3, 3), (10, 5), (4, 4)):
        (row,) = PeriodicRuns(least, repeats).run(spark.createDataFrame([(1, " ".join(words))], "doc_id bigint, text string")).collect()
        assert [tuple(x) for x in row.runs] == brute(words, least, repeats)


def test_planted_repetitions(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(300)] + [(None, "a b c")]
    got = planted_repetitions(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for r in got:
        words = dict(rows)[r.doc_id].split()
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if r.doc_id is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert r.text.split() == words


def test_digest(spark):
    import hashlib

    text = "k a b a b a b a b a b z z z z z z z z z z"
    rows = [(1, text), (2, None), (3, "")]
    got = {r.doc_id: r for r in runs_digest(PeriodicRuns().run(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period, got[1].exponent_milli) == (2, 1, 10, 2, 5000)
    assert got[1].runs_sha256 == hashlib.sha256(b"1,10,2\n11,10,1\n").hexdigest()
    assert got[1].collapsed_sha256 == hashlib.sha256(b"k a b z").hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    for i in (2, 3):
        assert (got[i].n_runs, got[i].start, got[i].length, got[i].period, got[i].exponent_milli) == (0, None, None, None, None)
        assert got[i].runs_sha256 == got[i].collapsed_sha256 == empty


def test_awkward_rows(spark):
    got = PeriodicRuns().run(edge_docs(spark)).collect()
    assert len(got) == 11
    (long,) = [r for r in got if r.doc_id == 3]
    assert [tuple(x) for x in long.runs] and long.n_words == len(LONG.split())
    assert [tuple(x) for x in long.runs] == [(0, 40_000, 14 * 97)]
    assert len(long.collapsed.split()) == 14 * 97
    assert all(r.collapsed == "" and not r.runs for r in got if r.doc_id in (1, 2, 6))
    assert PeriodicRuns().run(no_docs(spark)).collect() == []
    assert planted_repetitions(edge_docs(spark)).select(F.count("*")).first()[0] == 11
