"""Collocations against a plain count of all phrases, and the counting quotient filters by round trips."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from edges import edge_docs, no_docs

from minekit.llm import collocations
from minekit.llm.collocations import Collocations
from minekit.llm.quotient import Permutation, decode, encode, mask, summed

SCHEMA = "doc_id bigint, lang string, text string"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, least, top, longest=5, percent=100):
    f, n = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if len(p) >= 2 and c >= least}
        covered = set()
        for p, c in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * c >= percent * counts[p[i : i + k]]:
                        covered.add(p[i : i + k])
        found = []
        for p, a in often.items():
            if p in covered:
                continue
            low = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            phrase = " ".join(p)
            found.append((-low[0], -a, phrase.encode(), phrase, counts[p[: low[1]]], counts[p[low[1] :]]))
        for rank, (score, a, _, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase, -a, l, r, n[lang], -score))
    return sorted(out)


def texts(seed, n=150):
    draw = random.Random(seed)
    fixed = ["in spite of the", "new York city", "as well as", "a b a b a", "öl und Élan", "x\x01y z"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, 30)):
            parts.append(draw.choice(fixed) if draw.random() < 0.4 else draw.choice("the of a water b stone".split()))
            if draw.random() < 0.2:
                parts[-1] += draw.choice(".,;:!?\n\r")
        rows.append((i, draw.choice(["en", "en", "de", None, "und"]), draw.choice([" ", "  ", "\t"]).join(parts)))
    return [*rows, (n, "en", None), (n + 1, None, ""), (n + 2, "fr", "rare words only")]


def found(spark, operator, rows):
    got = operator.run(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got)


def test_equal_to_a_plain_count(spark):
    rows = texts(1)
    assert brute(rows, 12, 2000)
    assert found(spark, Collocations(min_count=12), rows) == brute(rows, 12, 2000)


def test_other_settings_and_the_join_instead_of_the_broadcast(spark, monkeypatch):
    rows = texts(2)
    # filters that are flushed early, a short list, and words joined
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 10)
    monkeypatch.setattr(collocations, "FLUSH_KEYS", 50)
    got = found(spark, Collocations(max_words=4, min_count=9, top=7, covered_percent=80, broadcast_words=0), rows)
    assert got == brute(rows, 9, 7, longest=4, percent=80)


@pytest.mark.parametrize("bits", [1, 2, 7, 16, 34, 51, 63, 64, 96, 100, 128, 160, 170, 192])
def test_filters_give_all_keys_and_counts_back(bits):
    draw = np.random.default_rng(bits)

    def numbers(width):
        top = draw.integers(0, 1 << min(width, 32), 2000, dtype=np.uint64)
        return top if width <= 32 else (top << np.uint64(width - 32)) | draw.integers(0, 1 << (width - 32), 2000, dtype=np.uint64)

    permutation = Permutation(bits)
    widths = [permutation.upper_bits] + [64] * (permutation.lanes - 1)
    keys = [numbers(w) for w in widths]
    permuted = permutation.forward(keys)
    assert all((x == y).all() for x, y in zip(keys, permutation.backward(permuted)))
    assert all((x <= mask(w)).all() for x, w in zip(permuted, widths))
    for shard_bits in {0, min(bits, 1), min(bits, 5)}:
        lanes, counts = summed(permuted, draw.integers(1, 300_000, 2000))
        shards = permutation.leading(lanes, shard_bits)
        for shard in range(1 << shard_bits):
            own = shards == shard
            data = encode([x[own] for x in lanes], counts[own], bits, shard_bits)
            back, n = decode(data, shard, bits, shard_bits)
            assert (n == counts[own]).all() and all((x == y[own]).all() for x, y in zip(back, lanes))


@pytest.mark.parametrize("words, bits, lanes", [(5, 24, 2), (5, 31, 3), (7, 31, 4)])
def test_wide_keys_pack_and_unpack(words, bits, lanes):
    grams = collocations._Grams(words, bits)
    numbers = np.random.default_rng(0).integers(1, 1 << bits, 500).astype(np.int32)
    keys = grams.keys(numbers, None, None)
    assert len(keys) == lanes
    assert (grams.numbers(keys) == np.lib.stride_tricks.sliding_window_view(numbers, words)).all()


def test_more_numbered_words_than_two_lanes_hold(spark, monkeypatch):
    """Keys as wide as those of a billion words give the same phrases."""
    rows = texts(3)
    frequent = Collocations.frequent
    monkeypatch.setattr(Collocations, "frequent", lambda self, lists, k, bits, *rest: frequent(self, lists, k, 30, *rest))
    assert found(spark, Collocations(min_count=12), rows) == brute(rows, 12, 2000)


def test_awkward_rows(spark):
    rows = [(r.doc_id, r.lang, r.text) for r in edge_docs(spark).collect()]
    got = Collocations(min_count=300, top=5).run(edge_docs(spark)).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute(rows, 300, 5)
    assert Collocations().run(no_docs(spark)).collect() == []
