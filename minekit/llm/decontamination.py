"""Benchmark passages in documents by edit distance: CGK embedding, bit sampling, exact check.

Texts are word sequences: maximal runs of ASCII letters, digits and bytes beyond ASCII, A-Z
lower-cased. A document is contaminated by an item of ``L`` words when one of its *stretches* of words, however long, has a
word edit distance of at most ``percent`` of ``L``, rounded down. Where a stretch begins, its *window* of ``L`` words is searched.

The random-walk embedding reads a sequence with a pointer: step ``j`` copies the symbol under the pointer
and then moves it by the random bit ``r(j, symbol)``. Two sequences within a small edit
distance walk in step most of the time, so their embeddings have a small Hamming distance. Bit-sampling
hashing draws a few steps per repetition; a window and an item whose symbols agree on
them are candidates, and every candidate is measured by exact edit distance with a free end.

How many repetitions are needed is computed, not guessed: edited copies of the items at the largest allowed
distance are embedded, and repetitions are added until the share of copies that is found reaches
``recall``. Where that takes more than ``walks`` walks, all windows that share enough words are measured instead. The walks and samples
depend on the benchmark and the seed alone.

Before the walk a window must hold enough words of the items of its length: within distance ``d`` it
shares at least ``L - d`` words with the item, counted with repetition. That drops no window that could pass.
Words outside the benchmark share one symbol, which equals no item's word.

An item of more than ``piece`` words is searched by pieces: of the pieces of an item within its distance one is within its own. The whole
item is then measured around each piece found, with both ends free.

Cases: null and empty documents, items without words, and null ids of items take no part; a null
``doc_id`` is reported as null. Repeated rows are all reported. Other columns are ignored. The benchmark is the
broadcast side; one of more than ``max_items`` items is searched in several passes of that many.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.llm.batches import Words, filter_batches, map_batches, mixed, text_slices

SLICE = 2 << 20
SEPARATORS = tuple(b for b in range(128) if not chr(b).isalnum())
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Decontamination:
    """Largest distance in percent of an item's words, sampled steps per hash, target recall, seed."""

    percent: int = 20
    samples: int = 3
    recall: float = 0.99
    walks: int = 64
    per_walk: int = 12
    max_items: int = 10_000
    piece: int = 64
    seed: int = 11

    def matches(self, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
        """``doc_id, item_id, distance, start, n_windows`` for every document and item that match.

        ``start`` is the word at which the first of the nearest stretches begins; ``n_windows`` counts the words at which a matching stretch
        begins (for an item searched by pieces, the places at which one was measured).
        """
        parts = [self._matches(docs, items) for items in self._items(benchmark)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _matches(self, docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(_Index(self, items))

        def search(batches: Iterator[pa.RecordBatch]):
            words, own = Words(SEPARATORS), index.value
            for batch in batches:
                ids = batch.column("doc_id")
                for first, _, raw, offsets in text_slices(batch.column("text"), SLICE):
                    hashes, _, _, bounds = words(raw, offsets)
                    text, item, distance, start, count = own.search(hashes, bounds)
                    yield {
                        "doc_id": ids.take(pa.array(text + first)),
                        "item_id": item,
                        "distance": distance,
                        "start": start,
                        "n_windows": count,
                    }

        schema = "doc_id bigint, item_id bigint, distance int, start bigint, n_windows bigint"
        return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), search, schema)

    def clean(self, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
        """The rows of ``docs`` whose text matches no item, with all their columns."""
        for items in self._items(benchmark):
            docs = self._clean(docs, items)
        return docs

    def _clean(self, docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(_Index(self, items))

        def keep(batch: pa.RecordBatch) -> np.ndarray:
            words, own = Words(SEPARATORS), index.value
            kept = np.ones(len(batch), bool)
            for first, _, raw, offsets in text_slices(batch.column("text"), SLICE):
                hashes, _, _, bounds = words(raw, offsets)
                kept[own.search(hashes, bounds)[0] + first] = False
            return kept

        return filter_batches(docs, keep)

    def _items(self, benchmark: DataFrame) -> list[list[tuple[int, str]]]:
        """The items in runs of ``max_items``, one run at least; all items of a benchmark are held by the driver."""
        rows = (
            benchmark.where("item_id is not null and text is not null")
            .select(F.col("item_id").cast("bigint"), "text")
            .distinct()
            .orderBy("item_id", "text")
        )
        listed = [(r[0], r[1]) for r in rows.toLocalIterator()]
        return [listed[i : i + self.max_items] for i in range(0, len(listed), self.max_items)] or [[]]


class _Index:
    """Hash tables of the embedded items by length, and the search over slices of documents."""

    def __init__(self, settings: Decontamination, items: list[tuple[int, str]]):
        self.settings = settings
        texts = pa.array([t for _, t in items], pa.string())
        words = Words(SEPARATORS)
        names, sequences = [], []
        for first, _, raw, offsets in text_slices(texts):
            hashes, _, _, bounds = words(raw, offsets)
            for i in range(len(bounds) - 1):
                if bounds[i + 1] > bounds[i]:
                    names.append(items[first + i][0])
                    sequences.append(hashes[bounds[i] : bounds[i + 1]])
        self.vocabulary = np.unique(np.concatenate(sequences)) if sequences else np.zeros(0, np.uint64)
        coded = [np.searchsorted(self.vocabulary, s) + 1 for s in sequences]  # 0: any other word
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        draw = np.random.default_rng(settings.seed)
        self.pad = len(self.vocabulary) + 1  # the last symbol pads sequences that end
        self.bits: dict[tuple[int, int], np.ndarray] = {}
        # what is searched: items, and pieces of long items as (item, first word)
        self.names = np.array(names, np.int64)
        self.long: list[np.ndarray | None] = [c if len(c) > settings.piece else None for c in coded]
        searched = []
        for i, c in enumerate(coded):
            cuts = np.linspace(0, len(c), -(-len(c) // settings.piece) + 1).astype(np.int64)
            searched += [(c[a:b], i, a) for a, b in zip(cuts[:-1], cuts[1:])]
        self.owner = np.array([i for _, i, _ in searched], np.int64)
        self.first = np.array([a for *_, a in searched], np.int64)
        self.classes = []
        for length in sorted({len(c) for c, *_ in searched}):
            own = [k for k, (c, *_) in enumerate(searched) if len(c) == length]
            table = np.array([searched[k][0] for k in own], np.int64)
            self.classes.append(_Length(self, table, np.array(own, np.int64), draw))
        self.bits.clear()  # drawn again where they are needed

    def _bits(self, walk: int, block: int) -> np.ndarray:
        """64 steps of a walk for every symbol, a number each."""
        if (walk, block) not in self.bits:
            key = mixed(np.array([(self.settings.seed << 40) + (walk << 20) + block], np.uint64))
            self.bits[walk, block] = mixed(np.arange(self.pad + 1, dtype=np.uint64) * _MULTIPLIER + key)
        return self.bits[walk, block]

    def embed(self, walk: int, rows: np.ndarray, steps: int) -> np.ndarray:
        """The first ``steps`` symbols of the walk over each row; rows end with padding."""
        out = np.empty((steps, len(rows)), np.int64)
        at, line = np.zeros(len(rows), np.int64), np.arange(len(rows))
        for j in range(steps):
            symbol = rows[line, at]
            out[j] = symbol
            if j & 63 == 0:
                bits = self._bits(walk, j >> 6)
            bit = bits[symbol] >> np.uint64(j & 63) & np.uint64(1)
            at = np.minimum(at + bit.astype(np.int64), rows.shape[1] - 1)
        return out

    def search(self, hashes: np.ndarray, bounds: np.ndarray):
        """``text, item, distance, start, windows`` of all matches in one slice."""
        found = [np.zeros(0, np.int64)] * 5
        if not len(hashes) or not self.classes:
            return found
        codes = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.filter[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        codes[maybe] = np.where(self.vocabulary[place] == hashes[maybe], place + 1, 0)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        ends = bounds[1:][owner]
        parts = []
        for group in self.classes:
            hit = group.search(codes, bounds, owner, ends)
            if hit is not None:
                parts.append(hit)
        if not parts:
            return found
        window, place, distance = (np.concatenate(x) for x in zip(*parts))
        which = self.owner[place]
        text = owner[window]
        whole = np.array([self.long[i] is None for i in which], bool)
        more = self._around(codes, bounds, text[~whole], which[~whole], window[~whole] - self.first[place[~whole]])
        text, which, window, distance = (
            np.concatenate((x[whole], y)) for x, y in zip((text, which, window, distance), more)
        )
        if not len(text):
            return found
        item, start = self.names[which], window - bounds[text]
        order = np.lexsort((start, distance, item, text))
        text, item, distance, start = (x[order] for x in (text, item, distance, start))
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
        at = np.flatnonzero(fresh)
        return text[at], item[at], distance[at], start[at], np.diff(np.append(at, len(text)))


    def _around(self, codes, bounds, text, which, begins):
        """``text, item, window, distance`` of long items around the places where one of their pieces was found."""
        out = []
        limits = np.array([len(self.long[i]) * self.settings.percent // 100 for i in which], np.int64)
        # pieces of one stretch point to nearly the same beginning: each run of limits is measured once
        spots = np.unique(np.stack((text, which, begins // np.maximum(limits, 1)), 1), axis=0) if len(text) else np.zeros((0, 3), np.int64)
        for t, i, spot in spots.tolist():
            item = self.long[i]
            limit = len(item) * self.settings.percent // 100
            low = max(int(bounds[t]), (spot - 1) * max(limit, 1))
            high = min(int(bounds[t + 1]), (spot + 2) * max(limit, 1) + len(item) + limit)
            distance, end = nearest_stretch(codes[low:high], item)
            if distance <= limit:
                _, back = nearest_stretch(codes[low : low + end][::-1], item[::-1], free_start=False)
                out.append((t, i, low + end - back, distance))
        found = np.array(sorted(set(out)), np.int64).reshape(-1, 4)
        return found[:, 0], found[:, 1], found[:, 2], found[:, 3]


class _Length:
    """The items and pieces of one length; ``places`` are their numbers in the index."""

    def __init__(self, index: _Index, table: np.ndarray, places: np.ndarray, draw: np.random.Generator):
        self.index, self.places = index, places
        self.length = table.shape[1]
        self.limit = self.length * index.settings.percent // 100
        self.table = table
        self.needed = self.length - self.limit
        self.most = np.zeros(index.pad + 1, np.int64)  # by word: its most occurrences in one item
        for row in table:
            own, n = np.unique(row, return_counts=True)
            self.most[own] = np.maximum(self.most[own], n)
        self.member = self.most > 0
        pad = np.full((len(table), 1), index.pad)
        padded = np.hstack((table, pad))
        steps, settings = 3 * self.length, index.settings
        copies, source, family = self._edited(draw)
        missing = np.ones(len(copies), bool)

        def lacking() -> bool:
            """Whether more copies of some kind are missed than the recall allows."""
            return bool((np.bincount(family[missing], minlength=4) > (1 - settings.recall) * np.bincount(family, minlength=4)).any())

        self.tables = []
        for walk in range(settings.walks):
            if not lacking():
                break
            embedded, walked = index.embed(walk, padded, steps), index.embed(walk, copies, steps)
            repetitions = []
            while lacking() and len(repetitions) < settings.per_walk:
                # steps beyond twice the length mostly read the last words again; early steps are mostly still in step, so they are drawn more often
                reach = max(2 * self.length >> len(repetitions) % 3, 1)
                picked = np.sort(draw.choice(reach, min(settings.samples, reach), replace=False))
                keys = _hashed(embedded[picked])
                missing &= _hashed(walked[picked]) != keys[source]
                repetitions.append((picked, *_sorted(keys)))
            self.tables.append((walk, 1 + max(int(p[-1]) for p, _, _ in repetitions), repetitions))
        self.exhaustive = lacking()

    def _edited(self, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that begin stretches at the largest allowed distance from their items, the items they come from, and the kind of edits.

        Kinds 0, 1, 2 have edits of one sort only, kind 3 mixes them.
        """
        each = 4 * max(1, -(-200 // len(self.table)))
        source = np.repeat(np.arange(len(self.table)), each)
        family = np.arange(len(source)) % 4
        rows = []
        for i, sort in zip(source, family):
            row = self.table[i].tolist()
            for kind in (draw.integers(0, 3, self.limit) if sort == 3 else np.full(self.limit, sort)).tolist():
                at = int(draw.integers(0, len(row)))
                row[at : at + (kind != 1)] = [0] * (kind != 2)  # another word, a word more, a word less
            rows.append([*(row + [0] * 2 * self.limit)[: self.length + self.limit], self.index.pad])
        return np.array(rows, np.int64), source, family

    def search(self, codes, bounds, owner, ends):
        """``window, place, distance`` of the windows that begin a matching stretch; a window is named by its first word."""
        length = self.length
        counted = self.member[codes]
        known = np.zeros(len(codes) + 1, np.int32)
        np.cumsum(counted, out=known[1:])
        full = np.flatnonzero(known[length:] - known[:-length] >= self.needed) if len(codes) >= length else np.zeros(0, np.int64)
        full = full[full + length <= ends[full]]
        # a stretch at the end of a text may be shorter than the item
        late = bounds[1:, None] - np.arange(self.needed, length)
        late = late[late >= bounds[:-1, None]]
        late = late[known[ends[late]] - known[late] >= self.needed]
        windows = np.sort(np.concatenate((full, late)))
        if len(windows):
            windows = windows[self._shared(codes, counted, owner, windows)[windows] >= self.needed]
        if not len(windows):
            return None
        line, item = (np.concatenate(x) for x in zip(*(self._met(codes, ends, windows, i) for i in range(0, len(windows), 20_000))))
        good = self._distances(codes, ends, windows[line], item) <= self.limit
        # the windows around a match are measured too, so that the nearest one is known
        step = np.arange(-self.limit, self.limit + 1)
        around = (line[good][:, None] + step).ravel()
        which, centre = np.repeat(item[good], len(step)), np.repeat(line[good], len(step))
        inside = (around >= 0) & (around < len(windows))
        around, which, centre = around[inside], which[inside], centre[inside]
        near = (np.abs(windows[around] - windows[centre]) <= self.limit) & (owner[windows[around]] == owner[windows[centre]])
        pairs = np.unique(around[near] * len(self.table) + which[near])
        line, item = pairs // len(self.table), pairs % len(self.table)
        distance = self._distances(codes, ends, windows[line], item)
        good = distance <= self.limit
        return windows[line[good]], self.places[item[good]], distance[good]

    def _shared(self, codes, counted, owner, windows) -> np.ndarray:
        """How many words a window starting at each place may share with an item.

        A word counts in a window as often as it occurs in one item at most: an occurrence at ``p`` counts for the
        windows that begin after the occurrence of the same word that lies that many further back.
        """
        texts = np.zeros(owner[-1] + 1, bool)
        texts[owner[windows]] = True
        places = np.flatnonzero(counted & texts[owner])
        order = np.argsort(codes[places], kind="stable")
        places = places[order]
        word = codes[places]
        back = np.arange(len(places)) - self.most[word]
        same = (back >= 0) & (word[back] == word)
        first = np.maximum(np.where(same, places[back] + 1, 0), places - self.length + 1)
        change = np.bincount(np.maximum(first, 0), minlength=len(codes) + 1)
        change -= np.bincount(places + 1, minlength=len(codes) + 1)
        return np.cumsum(change)

    def _rows(self, codes, ends, windows, width):
        """``width`` words from each window on, padded where the text ends, and one more padding."""
        places = windows[:, None] + np.arange(width + 1)
        inside = places < np.minimum(windows + width, ends[windows])[:, None]
        return np.where(inside, codes[np.minimum(places, len(codes) - 1)], self.index.pad)

    def _met(self, codes, ends, windows, low):
        """``line, item``: the windows from ``low`` on that share a hash with an item, or all pairs where hashes do not suffice."""
        windows = windows[low : low + 20_000]
        if self.exhaustive:
            line, item = np.divmod(np.arange(len(windows) * len(self.table)), len(self.table))
            return line + low, item
        rows = self._rows(codes, ends, windows, self.length + self.limit)
        seen = []
        for walk, steps, repetitions in self.tables:
            walked = self.index.embed(walk, rows, steps)
            for picked, keys, items in repetitions:
                value = _hashed(walked[picked])
                first, last = np.searchsorted(keys, value, "left"), np.searchsorted(keys, value, "right")
                hit = np.flatnonzero(last > first)
                n = last[hit] - first[hit]
                line = np.repeat(hit, n)
                rank = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[hit], n)
                seen.append(line * len(self.table) + items[rank])
        pairs = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        return pairs // len(self.table) + low, pairs % len(self.table)

    def _distances(self, codes, ends, windows, item):
        """The smallest distance of a stretch that begins at each window to its item, in runs of bounded size."""
        out = [np.zeros(0, np.int32)]
        for low in range(0, len(windows), 20_000):
            own = slice(low, low + 20_000)
            rows = self._rows(codes, ends, windows[own], self.length + self.limit)
            out.append(edit_distance(rows[:, :-1], self.table[item[own]], self.limit, self.index.pad))
        return np.concatenate(out)


def _hashed(symbols: np.ndarray) -> np.ndarray:
    value = np.zeros(symbols.shape[1], np.uint64)
    for row in symbols:
        value = (value ^ row.astype(np.uint64)) * _MULTIPLIER
        value ^= value >> np.uint64(29)
    return value


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return keys[order], order


def edit_distance(left: np.ndarray, right: np.ndarray, limit: int, pad: int) -> np.ndarray:
    """The smallest edit distance of a beginning of each row of ``left`` to its row of ``right``, exact up to ``limit``.

    Larger ones come out above it. ``left`` may end early, with ``pad``. Only cells within ``limit`` of the diagonal matter.
    """
    n, width = right.shape
    if not n:
        return np.zeros(0, np.int32)
    sizes = (left != pad).sum(1)
    far = np.int32(2 * width + limit + 1)
    result = np.full(n, width if width <= limit else far, np.int32)
    row = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
    for i in range(1, min(left.shape[1], width + limit) + 1):
        new = np.full_like(row, far)
        new[:, 0] = i
        low, high = max(1, i - limit), min(width, i + limit)
        differs = left[:, i - 1 : i] != right[:, low - 1 : high]
        new[:, low : high + 1] = np.minimum(row[:, low - 1 : high] + differs, row[:, low : high + 1] + 1)
        # insertions run along the row: the minimum of value minus place, carried on
        ramp = np.arange(low - 1, high + 1, dtype=np.int32)
        new[:, low - 1 : high + 1] = np.minimum.accumulate(new[:, low - 1 : high + 1] - ramp, axis=1) + ramp
        row = new
        if i + limit >= width:
            result = np.where(sizes >= i, np.minimum(result, row[:, width]), result)
    return result


def nearest_stretch(text: np.ndarray, item: np.ndarray, free_start: bool = True) -> tuple[int, int]:
    """The smallest edit distance of ``item`` to a stretch of ``text``, and the first place at which such a stretch ends.

    Without ``free_start`` the stretch begins with the text, and the longest of the nearest counts.
    """
    ramp = np.arange(len(item) + 1, dtype=np.int64)
    row = ramp.copy()
    best, end = len(item), 0
    for i, symbol in enumerate(text, 1):
        new = row + 1
        new[0] = 0 if free_start else i
        new[1:] = np.minimum(new[1:], row[:-1] + (item != symbol))
        row = np.minimum.accumulate(new - ramp) + ramp
        if row[-1] < best or (row[-1] == best and not free_start):
            best, end = int(row[-1]), i
    return best, end
