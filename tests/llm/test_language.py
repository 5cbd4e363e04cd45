"""Language: held-out agreement, evidence that decides unclear texts, awkward tables."""

import random

import numpy as np
import pytest
from edges import edge_docs, no_docs
from pyspark.sql import functions as F

from minekit.llm.language import LanguageEvidence, page_evidence

WORDS = {
    "en": "the and with that from which their would about house street water always never people".split(),
    "de": "der und mit dass von welche ihre würde über haus straße wasser immer niemals menschen".split(),
    "fr": "les et avec que depuis laquelle leurs serait maison rue eau toujours jamais peuple être".split(),
}


def rows(n, seed=1):
    draw = random.Random(seed)
    for i in range(n):
        lang = draw.choice(list(WORDS))
        yield i, " ".join(draw.choice(WORDS[lang]) for _ in range(draw.randint(3, 40))), lang


def table(spark, data):
    return spark.createDataFrame(data, "doc_id bigint, text string, declared string, suffix string, host string")


def test_held_out_texts(spark):
    operator = LanguageEvidence()
    train = spark.createDataFrame(list(rows(600)), "doc_id bigint, text string, declared string")
    model = operator.fit(train)
    assert model.classes == ["de", "en", "fr", "und"]
    fresh = list(rows(200, seed=2))
    got = operator.judge(table(spark, [(i, t, None, None, None) for i, t, _ in fresh]), model).collect()
    truth = {i: lang for i, _, lang in fresh}
    assert sum(r.lang == truth[r.doc_id] and r.kept for r in got) >= 196


def test_host_and_declared_language_decide_unclear_texts(spark):
    operator = LanguageEvidence()
    model = operator.fit(spark.createDataFrame(list(rows(600)), "doc_id bigint, text string, declared string"))
    data = [(i, t, lang, None, f"{lang}.example.org") for i, t, lang in rows(300, seed=3)]
    unclear = [(1000, "xq", None, None, "de.example.org"), (1001, "xq", None, None, "fr.example.org"), (1002, "xq", "en", None, None)]
    got = {r.doc_id: r.lang for r in operator.judge(table(spark, data + unclear), model).where("doc_id >= 1000").collect()}
    assert got == {1000: "de", 1001: "fr", 1002: "en"}


def test_text_in_no_known_language_is_rejected(spark):
    operator = LanguageEvidence()
    model = operator.fit(spark.createDataFrame(list(rows(600)), "doc_id bigint, text string, declared string"))
    foreign = " ".join("зщжфыэъюяцчшщ"[i % 9 : i % 9 + 4] for i in range(60))
    kept = operator.judge(table(spark, [(1, foreign, None, None, None)]), model).first()
    assert kept.lang == "und" and not kept.kept


def test_rare_languages_are_not_lost(spark):
    common = [(i, t, lang) for i, t, lang in rows(3000)]
    rare = [(9000 + i, " ".join("зщжфыэъюяцчшщ"[(i + j) % 9 : (i + j) % 9 + 4] for j in range(20)), "ru") for i in range(3)]
    docs = spark.createDataFrame(common + rare, "doc_id bigint, text string, declared string")
    known = docs.withColumn("suffix", F.lit(None).cast("string")).withColumn("host", F.lit(None).cast("string"))
    sampled = LanguageEvidence(sample_rows=100)
    model = sampled.fit(docs)
    assert model.classes == ["de", "en", "fr", "ru", "und"] and not model.unmodelled
    got = sampled.judge(known, model).where("doc_id >= 9000").collect()
    assert len(got) == 3 and all(r.lang == "ru" and r.kept for r in got)
    few = LanguageEvidence(max_classes=3)
    model = few.fit(docs)
    assert model.classes == ["de", "en", "fr", "und"] and model.unmodelled == {"ru"}
    got = few.judge(known, model).where("doc_id >= 9000").collect()
    assert len(got) == 3 and all(r.lang == "ru" and r.kept for r in got)


def test_pages_give_evidence(spark):
    pages = spark.createDataFrame(
        [
            (2, "https://a.example.org/fr/12?x=1", '<html class=x lang="FR">'),
            (1, "http://b.example.org/en/12.html#t", "<html>"),
            (3, "https://c.example.org/about", "<html lang=en>"),
            (4, None, None),
            (5, "http://d.example.org/5/", None),
        ],
        "page_id bigint, url string, html string",
    )
    got = {r.doc_id: (r.declared, r.suffix, r.host) for r in page_evidence(pages).collect()}
    assert got == {12: (None, "org/en", "b.example.org"), 5: (None, "org/", "d.example.org")}


def test_awkward_rows(spark):
    operator = LanguageEvidence()
    docs = edge_docs(spark)
    model = operator.fit(docs.select("text", F.col("lang").alias("declared")))
    evidence = docs.select("doc_id", "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))
    got = operator.judge(evidence, model).collect()
    assert len(got) == 11
    assert all(r.lang is None and not r.kept for r in got if r.doc_id in (1, 2, 6, 8))
    assert all(r.lang == "en" and r.kept for r in got if r.doc_id in (3, 4, 5))
    left = operator.accepted(docs, evidence, model)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got)
    empty = no_docs(spark)
    none = operator.fit(empty.select("text", F.col("lang").alias("declared")))
    assert none.classes == ["und"]
    seen = evidence.where("false")
    assert operator.judge(seen, model).collect() == [] and operator.judge(seen, none).collect() == []
    assert all(r.kept for r in operator.judge(evidence, none).collect())


def test_posterior_equals_a_plain_bayes_rule(spark):
    """All evidence multiplied out in plain Python, from the model's table and counts over the judged rows."""
    operator = LanguageEvidence()
    model = operator.fit(spark.createDataFrame(list(rows(400)), "doc_id bigint, text string, declared string"))
    draw = random.Random(5)
    data = []
    for i, text, lang in rows(200, seed=6):
        told = draw.choice([lang, lang, None, "en", "xx"])
        data.append((i, text, told, draw.choice([None, lang, "org"]), draw.choice([None, f"{lang}.a.org", "b.org", "c.b.org"])))
    data += [(900, "xq", "de", "org", "b.org"), (901, None, "fr", None, "de.a.org"), (902, "12 3", None, None, None)]
    n = len(model.classes)
    likelihood, best = {}, {}
    for i, text, *_ in data:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        sums, count = model.likelihoods(raw, np.array([0, len(raw)]))
        likelihood[i], best[i] = sums[0], int(sums[0].argmax()) if count[0] else -1
    counts = {"all": np.zeros(n)}
    domain = lambda h: ".".join(h.split(".")[-2:])
    for i, _, _, suffix, host in data:
        if best[i] >= 0:
            for key in ["all"] + [("s", suffix)] * (suffix is not None) + ([("h", host), ("d", domain(host))] if host else []):
                counts.setdefault(key, np.zeros(n))[best[i]] += 1
    prior = (counts["all"] + 1) / (counts["all"].sum() + n)
    prior[-1] = operator.unknown_prior
    prior /= prior.sum()
    told = [(model.classes.index(d) if d in model.classes[:-1] else -1, best[i]) for i, _, d, *_ in data if d and 0 <= best[i] < n - 1]
    trust = (sum(a == b for a, b in told) + 9) / (len(told) + 10)
    w, none = operator.host_weight, np.zeros(n)
    got = {r.doc_id: r for r in operator.judge(table(spark, data), model).collect()}
    for i, _, declared, suffix, host in data:
        if best[i] < 0:
            assert got[i].lang is None and got[i].posterior is None
            continue
        d = counts.get(("d", domain(host)), none) if host else none
        h = counts.get(("h", host), none)
        in_domain = (d + w * prior) / (d.sum() + w)
        score = np.exp((likelihood[i] - likelihood[i].max()) * operator.temper) * (h + w * in_domain) / (h.sum() + w)
        s = counts.get(("s", suffix), none)
        if s.sum():
            score *= (s + w * prior) / (s.sum() + w) / prior
        if declared in model.classes[:-1]:
            factor = np.full(n, (1 - trust) / (n - 2))
            factor[model.classes.index(declared)], factor[-1] = trust, 1 / (n - 1)
            score *= factor
        score /= score.sum()
        assert got[i].lang == model.classes[int(score.argmax())]
        assert got[i].posterior == pytest.approx(score.max())


def test_pages_override_what_documents_declare(spark):
    operator = LanguageEvidence()
    model = operator.fit(spark.createDataFrame(list(rows(400)), "doc_id bigint, text string, declared string"))
    data = [(i, t, "xx", None, None) for i, t, _ in rows(50, seed=8)]
    pages = [(i, lang, lang, f"{lang}.org") for i, _, lang in rows(50, seed=8) if i % 2]
    both = [(i, t, *next(((d, s, h) for j, d, s, h in pages if j == i), ("xx", None, None))) for i, t, *_ in data]
    evidence = spark.createDataFrame(pages, "doc_id bigint, declared string, suffix string, host string")
    by_pages = operator.judge(table(spark, data), model, evidence).collect()
    assert sorted(map(tuple, by_pages), key=str) == sorted(map(tuple, operator.judge(table(spark, both), model).collect()), key=str)
