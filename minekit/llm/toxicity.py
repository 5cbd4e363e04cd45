"""Toxicity by a mined lexicon, fuzzy matching with Levenshtein automata, and context windows.

*Lexicon.* From labelled texts, words (and stems that several words share) that occur in toxic texts much
more often than chance allows. Copies of one text count once: occurrences are counted by a MinHash sample of the
text, not by document.

*Matching.* The Levenshtein automata of all terms are run on the lexicon trie at once: a state is a
set of (trie node, edits so far), made into one state and kept the first time it is met. Words of a text
die after two or three letters unless they are near a term. Stems match exactly; words of five letters and
more may be one edit away, of nine and more two. Digits and signs that stand for letters are read as such.

*Weights.* What a spelling says is its excess probability of a toxic text over the base rate, shrunk towards
that of its term, or, for inexact hits, towards the rate of rare spellings at the same distance. A toxic text
with an exact term does not count as evidence for its inexact hits.

*Context.* Each hit is judged in a window of words: inside quotation marks, near words of reporting, near words
that address a reader, near another hit. The weights are a logistic fit whose prior means say that
quotation lowers and address raises, so they hold where the labels show no such case.

*Score.* The hits of a text give their sum, their density and their largest value; a logistic fit over
these turns them into a probability.

Cases: null and empty texts are texts without hits; null ``doc_id`` counts as not held out. Without any
label of either class the score is next to 0 for all. Repeated rows are all scored. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.storage import settle
from minekit.llm.batches import SPACES, Words, filter_batches, map_batches, text_slices

WORD = re.compile(r"[^\W_](?:[\w@$]*[^\W_])?")
# fixed values: signs that stand for letters, marks of quotation, words of reporting and of address
LETTER_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
QUOTES = '"“”„«»'
REPORTING = frozenset(
    "said says say called quote quoted term word slur wrote sagte sagt nannte wort dit appelé mot dijo dice llamó palabra".split()
)
ADDRESS = frozenset("you your youre ye du dich dein ihr euch tu toi vous tes eres tú usted ustedes".split())
CONTEXT_PRIOR = np.array([0.0, -2.0, -1.0, 0.5, 1.0])  # bias, quoted, reported, addressed, with another hit
TEXT_PRIOR = np.array([-4.0, 1.0, 0.5, 4.0, 0.0])  # bias, sum, hits per 1000 words, largest, words
CACHE_WORDS = 200_000


@dataclass
class Automaton:
    """All terms within their edits at once; ``find`` gives ``(term, edits)`` of a word or None."""

    words: dict[str, int]
    stems: tuple[str, ...]

    def __post_init__(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[bool] = [False]
        self.limit = [0]
        for text, edits in [*self.words.items(), *((s, 0) for s in self.stems)]:
            node = 0
            self.limit[0] = max(self.limit[0], edits)
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.stem.append(False)
                    self.limit.append(0)
                node = self.children[node][letter]
                self.limit[node] = max(self.limit[node], edits)
            self.term[node] = text
            self.stem[node] = self.stem[node] or text in self.stems
        self._restart()

    def _restart(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[str, int] | None] = []
        self.stops: list[bool] = []
        self.start = self._state({(0, 0)})

    def _state(self, places: set[tuple[int, int]]) -> int:
        best: dict[int, int] = {}
        todo = sorted(places, key=lambda x: x[1])
        while todo:  # a letter of the term may be missing in the word
            node, edits = todo.pop(0)
            if edits > self.limit[node] or best.get(node, 99) <= edits:
                continue
            best[node] = edits
            todo += [(c, edits + 1) for c in self.children[node].values()]
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(e, -len(self.term[n]), self.term[n]) for n, e in best.items() if self.term[n] and e <= self._allowed(n)]
            stops = [(0, 0, self.term[n]) for n, e in best.items() if self.stem[n] and e == 0]
            found = min(stops or ends, default=None)
            self.ends.append(found and (found[2], found[0]))
            self.stops.append(bool(stops))
        return self.states[key]

    def _allowed(self, node: int) -> int:
        return self.words.get(self.term[node], 0)

    def _move(self, state: int, letter: str) -> int:
        """The state after ``letter``; -1 when no term is within reach."""
        places: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            places.add((node, edits + 1))
            for own, child in self.children[node].items():
                places.add((child, edits + (own != letter)))
        places = {(n, e) for n, e in places if e <= self.limit[n]}
        after = self._state(places) if places else -1
        self.moves[state][letter] = after
        return after

    def find(self, word: str) -> tuple[str, int] | None:
        state = self.start
        for letter in word:
            after = self.moves[state].get(letter)
            state = self._move(state, letter) if after is None else after
            if state < 0:
                return None
            if self.stops[state]:
                break
        found = self.ends[state]
        if len(self.sets) > 200_000:
            self._restart()
        return found


def spelled(word: str) -> tuple[str, bool]:
    """A word with its signs read as letters, and whether there were any; plain numbers stay."""
    if word.isalpha():
        return word, False
    read = word.translate(LETTER_SIGNS)
    return (read, True) if read.isalpha() and not word.isdigit() else (word, False)


@dataclass
class ToxicityModel:
    """What the labels taught; small enough to travel with every task."""

    words: dict[str, int]
    stems: tuple[str, ...]
    spellings: dict[str, float] = field(default_factory=dict)
    rates: dict[tuple[int, bool], float] = field(default_factory=dict)
    context: np.ndarray = field(default_factory=lambda: CONTEXT_PRIOR.copy())
    text: np.ndarray = field(default_factory=lambda: TEXT_PRIOR.copy())
    terms: dict[str, float] = field(default_factory=dict)
    base: float = 0.1
    reach: int = 6

    def __post_init__(self) -> None:
        self._open()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._open()

    def _open(self) -> None:
        self._automaton = Automaton(self.words, self.stems)
        self._hot: dict[str, tuple[str, int, bool]] = {}
        self._seen: set[str] = set()

    def hits(self, texts: list[str]) -> list[tuple[int, list[tuple[str, str, int, bool, np.ndarray]]]]:
        """For each text its number of words, and ``spelling, term, edits, signs, context`` of every hit."""
        lowered = [t.lower() for t in texts]
        split = [WORD.findall(t) for t in lowered]
        if len(self._seen) > CACHE_WORDS:
            self._seen.clear()
        new = set().union(*split).difference(self._seen)
        for word in new:
            read, signs = spelled(word)
            found = self._automaton.find(read)
            if found:
                self._hot[word] = (*found, signs)
        self._seen |= new
        hot = self._hot.keys()
        return [(len(w), [] if hot.isdisjoint(w) else self._hits(t, w)) for t, w in zip(lowered, split)]

    def _hits(self, text: str, words: list[str]):
        at = [i for i, w in enumerate(words) if w in self._hot]
        exact = [i for i in at if self._hot[words[i]][1] == 0]
        spans = [m.start() for m in WORD.finditer(text)]
        quotes = [m.start() for m in re.finditer(f"[{QUOTES}]", text)]
        inside = np.searchsorted(np.array(quotes, np.int64), np.array([spans[i] for i in at])) % 2 if quotes else [0] * len(at)
        firm = np.array(exact, np.int64)
        out = []
        for i, quoted in zip(at, inside):
            near = words[max(0, i - self.reach) : i] + words[i + 1 : i + 1 + self.reach]
            low, high = np.searchsorted(firm, (i - self.reach, i + self.reach + 1))
            others = high - low - (self._hot[words[i]][1] == 0)
            context = np.array([
                1.0,
                float(quoted),
                float(not REPORTING.isdisjoint(near)),
                float(not ADDRESS.isdisjoint(near)),
                float(others > 0),
            ])
            out.append((words[i], *self._hot[words[i]], context))
        return out

    def hit_probability(self, spelling: str, term: str, edits: int, signs: bool, context: np.ndarray) -> float:
        """How much one hit raises the probability that a text is toxic."""
        p = self.spellings.get(spelling)
        if p is None:
            p = self.terms.get(term, 0.5) if edits == 0 else self.rates.get((edits, signs), 0.5)
        p = min(max((p - self.base) / (1 - self.base), 0.0), 0.999)
        if not p:
            return 0.0
        return 1 / (1 + math.exp(-(math.log(p / (1 - p)) + float(context @ self.context))))

    def features(self, texts: list[str]) -> np.ndarray:
        """One row per text: bias, sum of hits, hits per 1000 words, largest hit, number of words."""
        out = np.zeros((len(texts), 5))
        for row, (n, hits) in zip(out, self.hits(texts)):
            found = [self.hit_probability(*h) for h in hits]
            total = sum(found)
            row[:] = 1, math.log1p(total), math.log1p(1000 * total / max(n, 1)), max(found, default=0.0), math.log1p(n)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        """The score of each text."""
        return 1 / (1 + np.exp(-(self.features(texts) @ self.text)))


def fitted(x: np.ndarray, y: np.ndarray, offset: np.ndarray, prior: np.ndarray, weight: float) -> np.ndarray:
    """Newton steps for logistic weights with Gaussian priors around ``prior``."""
    w = prior.copy()
    for _ in range(25):
        mean = 1 / (1 + np.exp(-np.clip(offset + x @ w, -30, 30)))
        slope = x.T @ (y - mean) - weight * (w - prior)
        curve = (x * (mean * (1 - mean))[:, None]).T @ x + weight * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 2 / max(np.abs(step).max(), 1e-9))  # shorter, never turned aside
    return w


@dataclass(frozen=True)
class Toxicity:
    """``sample_rows`` bounds the labelled texts of the fit; ``threshold`` is the score of a toxic text."""

    sample_rows: int = 20_000
    threshold: float = 0.3
    precision: float = 0.5
    stem_length: int = 4

    def fit(self, docs: DataFrame, labels: DataFrame) -> ToxicityModel:
        """Learn from texts with a label, without those held out."""
        known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out("doc_id"))
        known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
        n = known.count()
        share = min(1.0, self.sample_rows / n) if n else 0.0
        picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
        texts = docs.select(F.col("doc_id").cast("bigint"), "text").where("text is not null")
        texts = texts.join(F.broadcast(picked), "doc_id")  # about ``sample_rows`` rows
        def split(batches: Iterator[pa.RecordBatch]):
            words = Words(SPACES)
            for batch in batches:
                toxic = batch.column("toxic").to_pylist()
                text = batch.column("text").to_pylist()
                for first, _, raw, offsets in text_slices(batch.column("text")):
                    hashes, _, _, bounds = words(raw, offsets)
                    rows = []
                    for i in range(len(bounds) - 1):
                        own = hashes[bounds[i] : bounds[i + 1]]
                        kind = int((own[:-1] * np.uint64(3) + own[1:]).min() >> np.uint64(1)) if len(own) > 1 else 0
                        own_words = {spelled(w)[0] for w in WORD.findall(text[first + i].lower())}
                        rows += [(w, kind, toxic[first + i]) for w in own_words if len(w) >= 3]
                    columns = zip(*rows) if rows else [[]] * 3
                    yield dict(zip(("word", "kind", "toxic"), map(list, columns)))

        rows = map_batches(texts.select("text", "toxic"), split, "word string, kind bigint, toxic int")
        seen = rows.groupBy("word", "kind").agg(F.max("toxic").alias("toxic"))
        counts = settle(
            seen.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")), "words"
        )
        rate = picked.agg(F.avg("toxic")).first()[0]
        if not rate or rate == 1:
            return ToxicityModel({}, (), text=np.array([-30.0, 0, 0, 0, 0]))
        terms, stems = self._terms(counts, rate)
        words = {w: self._edits(w) for w in terms if w not in stems}
        model = ToxicityModel(words, stems, terms=terms, base=rate)
        return self._weigh(model, texts)

    @staticmethod
    def _edits(word: str) -> int:
        return 0 if len(word) < 5 else 1 if len(word) < 9 else 2

    def _terms(self, counts: DataFrame, base: float) -> tuple[dict[str, float], tuple[str, ...]]:
        """Terms with their share of toxic texts, high and no chance find among all tested; and which are stems."""
        bad, good = F.col("bad"), F.col("good")
        share = bad / (bad + good)
        gain = bad * F.log(share / base) + good * F.when(share < 1, F.log((1 - share) / (1 - base))).otherwise(0.0)
        sizes = F.sequence(F.lit(self.stem_length), F.least(F.length("word") - 1, F.lit(8)))
        longer = counts.where(F.length("word") > self.stem_length).select(
            F.explode(F.transform(sizes, lambda n: F.substring("word", F.lit(1), n))).alias("stem"), "bad", "good"
        )
        n_words = F.sum((F.col("bad") > 0).cast("int"))
        stems = longer.groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), n_words.alias("n"))

        def firm(table: DataFrame, name: str) -> list:
            tested = table.where("bad > 0").count()
            found = table.where((share >= self.precision) & (gain >= math.log(tested + 1) + 2))
            # each find takes its share of the bounded sample, so the list is bounded as well
            return found.select(F.col(name).alias("term"), share.alias("share"), gain.alias("gain")).collect()

        terms: dict[str, float] = {}
        for r in sorted(firm(stems.where("n >= 3"), "stem"), key=lambda r: (-r.gain, -len(r.term), r.term)):
            if not any(r.term.startswith(k) or k.startswith(r.term) for k in terms):
                terms[r.term] = r.share
        stem_terms = tuple(terms)
        for r in firm(counts, "word"):
            if not r.term.startswith(stem_terms):
                terms[r.term] = r.share
        return terms, stem_terms

    def _weigh(self, model: ToxicityModel, texts: DataFrame) -> ToxicityModel:
        """Rates of spellings, weights of contexts and of texts from the sampled texts."""
        shared = texts.sparkSession.sparkContext.broadcast(model)

        def read(batches: Iterator[pa.RecordBatch]):
            own = shared.value
            for batch in batches:
                rows = []
                for y, (_, hits) in zip(batch.column("toxic").to_pylist(), own.hits(batch.column("text").to_pylist())):
                    exact = any(h[2] == 0 for h in hits)
                    rows += [(*h[:4], h[4].tolist(), y) for h in hits if h[2] == 0 or not exact]
                columns = zip(*rows) if rows else [[]] * 6
                yield dict(zip(("spelling", "term", "edits", "signs", "context", "toxic"), map(list, columns)))

        schema = "spelling string, term string, edits int, signs boolean, context array<double>, toxic int"
        own = settle(map_batches(texts.select("text", "toxic"), read, schema), "hits")
        per = own.groupBy("spelling", "term", "edits", "signs").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
        rare: Counter = Counter()
        rare_bad: Counter = Counter()
        for r in per:
            if r.n == 1:
                rare[r.edits, r.signs] += 1
                rare_bad[r.edits, r.signs] += r.bad
        for edits in (1, 2):
            for signs in (False, True):
                model.rates[edits, signs] = (rare_bad[edits, signs] + 2) / (rare[edits, signs] + 4)
        for r in per:
            prior = model.terms.get(r.term, 0.5) if r.edits == 0 else model.rates[r.edits, r.signs]
            model.spellings[r.spelling] = (r.bad + 4 * prior) / (r.n + 4)
        hits = own.where("edits = 0").select("spelling", "context", "toxic")
        sample = hits.orderBy(F.xxhash64("spelling", "context", "toxic")).limit(self.sample_rows).collect()
        if sample:
            p = np.clip([model.spellings[r.spelling] for r in sample], 0.001, 0.999)
            x, y = np.array([r.context for r in sample]), np.array([r.toxic for r in sample], float)
            model.context = fitted(x, y, np.log(p / (1 - p)), CONTEXT_PRIOR, 25.0)
        return self._calibrate(model, texts)

    def _calibrate(self, model: ToxicityModel, texts: DataFrame) -> ToxicityModel:
        shared = texts.sparkSession.sparkContext.broadcast(model)

        def read(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                x = shared.value.features(batch.column("text").to_pylist())
                yield {"x": pa.array(list(x), pa.list_(pa.float64())), "toxic": batch.column("toxic")}

        rows = map_batches(texts.select("text", "toxic"), read, "x array<double>, toxic int").collect()  # a sample
        if rows:
            x, y = np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)
            model.text = fitted(x, y, np.zeros(len(y)), TEXT_PRIOR, 1.0)
        return model

    def score(self, docs: DataFrame, model: ToxicityModel) -> DataFrame:
        """``doc_id, held_out, score, predicted`` of every row."""
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def read(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                found = shared.value.scores(batch.column("text").fill_null("").to_pylist())
                yield {"doc_id": batch.column("doc_id"), "score": found}

        scored = map_batches(
            docs.select(F.col("doc_id").cast("bigint"), "text"), read, "doc_id bigint, score double"
        )
        return scored.select(
            "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= self.threshold).cast("int").alias("predicted")
        )

    def accepted(self, docs: DataFrame, model: ToxicityModel) -> DataFrame:
        """The rows of ``docs`` that are not toxic, with all their columns."""
        shared, limit = docs.sparkSession.sparkContext.broadcast(model), self.threshold

        return filter_batches(
            docs, lambda batch: shared.value.scores(batch.column("text").fill_null("").to_pylist()) < limit
        )


def held_out(doc_id: str):
    """Whether a row is kept from learning: its checksum modulo 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
