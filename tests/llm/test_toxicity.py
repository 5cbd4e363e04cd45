"""Toxicity: the automaton against brute-force edit distance, held-out accuracy, context, awkward tables."""

import random

import numpy as np
from edges import edge_docs, no_docs

from minekit.llm.toxicity import Automaton, Toxicity, ToxicityModel, spelled


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    draw = random.Random(1)
    terms = {"abcab": 1, "bacbacbac": 2, "cab": 0, "abcabba": 1}
    own = Automaton(terms, ("aaab",))
    for _ in range(6000):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(0, 11)))
        near = {t: distance(word, t) for t in terms}
        good = {t: d for t, d in near.items() if d <= terms[t]}
        found = own.find(word)
        if word.startswith("aaab"):
            assert found == ("aaab", 0)
        elif good:
            assert found and found[1] == min(good.values()) and good[found[0]] == found[1]
        else:
            assert found is None


def test_signs_are_read_as_letters():
    assert spelled("l0s3r") == ("loser", True)
    assert spelled("2024") == ("2024", False)
    assert spelled("loser") == ("loser", False)


def corpus(n):
    draw = random.Random(5)
    plain = [f"{a}{b}{c}" for a in ("ran", "tel", "mor") for b in ("di", "vo", "ke", "ta") for c in ("", "n", "s", "la")]
    bad = ["vileword", "dumbhead", "trashman"]
    rows = []
    for i in range(n):
        toxic = i % 6 == 0
        words = [draw.choice(plain) for _ in range(draw.randint(20, 80))]
        if toxic:
            for _ in range(draw.randint(2, 4)):
                words.insert(draw.randrange(len(words)), draw.choice([*bad, f"zork{draw.choice(plain)}"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_misspelled_terms(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    operator = Toxicity()
    model = operator.fit(docs, labels)
    assert {"vileword", "dumbhead", "trashman"} <= set(model.words) and "zork" in model.stems
    truth = {r[0]: r[2] for r in rows}
    got = operator.score(docs, model).collect()
    assert len(got) == 900 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert 150 < len(held) < 300
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.98
    clean, told, wrong = model.scores(["tandin randin telvon " * 9, "you vileword and dumbhead", "you v1leword and dumbhaed dumbhea"])
    assert clean < 0.1 < 0.3 < told and wrong > clean
    left = operator.accepted(docs, model)
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in got if not r.predicted}


def test_quotation_lowers_a_hit():
    model = ToxicityModel({"vileword": 1}, (), terms={"vileword": 0.9})
    plain, quoted = model.hits(["that is a vileword again", 'that is a "vileword" again'])
    assert model.hit_probability(*quoted[1][0]) < model.hit_probability(*plain[1][0])


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (7, 1), (7, 0), (99, 1)], "doc_id bigint, toxic int")
    operator = Toxicity()
    for known in (labels, labels.where("false")):
        model = operator.fit(edge_docs(spark), known)
        got = operator.score(edge_docs(spark), model).collect()
        assert len(got) == 11 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        assert operator.accepted(edge_docs(spark), model).columns == edge_docs(spark).columns
    assert operator.score(no_docs(spark), operator.fit(no_docs(spark), labels)).collect() == []
