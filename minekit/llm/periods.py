"""Periodic runs of words in texts, found by exact block convolution at dyadic scales.

A *run* is a stretch of words whose words ``period`` apart are equal, with the smallest such period, long
enough (``min_length`` words and ``repeats`` periods) and not to be extended on either side.

1. Words become numbers, equal words of one text the same number, words of different texts different numbers, so many
   texts are searched as one sequence.
2. Scale ``B = 1, 2, 4 ..`` is for periods ``B <= d < 2B``. A run of four such periods holds a whole aligned block of ``B`` words
   together with its repetition ``d`` words on. Blocks with a word that does not come again within ``2B`` words are left out; for
   the others the sum of squared differences to the following window is computed at all ``B`` distances at once by number-theoretic
   transforms modulo primes whose product exceeds any such sum. It is zero exactly where the block occurs.
3. Each distance with no mismatch is a seed. Neighbouring blocks with the same distance are one seed, which therefore ends within the
   next block on either side; extending it there gives the maximal stretch of that period. A stretch found with a multiple of its
   smallest period has the same ends, so the smallest period of each stretch is kept.

Nothing is shuffled and nothing is sampled; a text is searched whole, in ``n log n`` steps.

Cases: words are maximal runs of bytes other than blank, tab and line ends, compared as they are. Null and empty texts and texts without
words have no run and an empty collapsed text. Rows are independent: repeated rows, null ids and equal ids are all returned; other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.llm.batches import map_batches, text_slices

# primes with a primitive root, for transforms of up to 2**23 values
PRIMES = ((998244353, 3), (469762049, 3), (167772161, 3))
LARGEST_TRANSFORM = 1 << 23
CELLS = 1 << 18  # numbers in one batch of transforms


@dataclass(frozen=True)
class PeriodicRuns:
    """Least words and least repetitions of a run; the search needs at least three repetitions."""

    min_length: int = 6
    repeats: int = 4

    def __post_init__(self) -> None:
        if self.repeats < 3:
            raise ValueError("runs of fewer than three repetitions need not hold a whole block")

    def run(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_words, runs, collapsed`` of every row of ``docs`` (doc_id, text).

        ``runs`` lists start (word number from 0), length and period by start, then period. ``collapsed`` joins with one blank the words that no
        run holds beyond its first period.
        """

        def search(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                ids = batch.column("doc_id")
                for first, end, raw, offsets in text_slices(batch.column("text")):
                    yield {"doc_id": ids.slice(first, end - first)} | self._slice(raw, offsets)

        schema = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
        return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), search, schema)

    def _slice(self, raw: np.ndarray, offsets: np.ndarray) -> dict:
        data = raw.tobytes()
        texts = [data[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        numbers = np.empty(bounds[-1], np.int64)
        used = 1
        for words, low, high in zip(texts, bounds[:-1], bounds[1:]):
            own: dict[bytes, int] = {}
            numbers[low:high] = [own.setdefault(w, len(own)) for w in words]
            numbers[low:high] += used
            used += len(own)
        longest = int(np.diff(bounds).max(initial=0))
        starts, lengths, periods = self.find(numbers, longest)
        owner = np.searchsorted(bounds, starts, "right") - 1
        keep = np.ones(len(numbers), bool)
        for s, n, q in zip(starts, lengths, periods):
            keep[s + q : s + n] = False
        collapsed = []
        touched = set(owner.tolist())
        for i, words in enumerate(texts):
            if i in touched:
                own = keep[bounds[i] : bounds[i + 1]]
                words = [words[j] for j in np.flatnonzero(own)]
            collapsed.append(b" ".join(words))
        fields = [pa.array(x, pa.int64()) for x in (starts - bounds[owner], lengths, periods)]
        listed = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()),
            pa.StructArray.from_arrays(fields, ["start", "length", "period"]),
        )
        return {"n_words": np.diff(bounds), "runs": listed, "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string())}

    def find(self, numbers: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and period of all runs of a sequence of positive numbers, by start, then period.

        ``longest`` bounds the length of a run where the sequence is made of parts that share no number.
        """
        longest = len(numbers) if longest is None else longest
        found = [np.zeros((0, 3), np.int64)]
        gaps = _gaps(numbers)
        block = 1
        while self.repeats * block <= longest:
            lows, highs, periods = _extended(numbers, block, *_seeds(numbers, gaps, block))
            long = highs - lows >= np.maximum(self.min_length, self.repeats * periods)
            found.append(np.stack((lows, highs, periods), 1)[long])
            block *= 2
        runs = np.concatenate(found)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        fresh = np.ones(len(runs), bool)
        fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
        runs = runs[fresh]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        return runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]


def _gaps(numbers: np.ndarray) -> np.ndarray:
    """How many places on each number comes again; more than all places where it does not."""
    order = np.argsort(numbers, kind="stable")
    out = np.full(len(numbers), 2 * len(numbers) + 2, np.int64)
    again = numbers[order[1:]] == numbers[order[:-1]]
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def _seeds(numbers: np.ndarray, gaps: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks (by number) and the distances ``block <= d < 2 * block`` at which they occur again without mismatch."""
    if 2 * block > LARGEST_TRANSFORM:
        raise ValueError("a text of this length needs larger primes")
    n_blocks = len(numbers) // block
    if n_blocks == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    widest = gaps[: n_blocks * block].reshape(n_blocks, block).max(1)
    candidates = np.flatnonzero(widest < 2 * block)
    padded = np.concatenate((numbers, np.zeros(3 * block, np.int64)))  # no number is 0
    largest = int(numbers.max())
    n_primes = 1
    while np.prod([float(p) for p, _ in PRIMES[:n_primes]]) <= float(block) * largest * largest:
        n_primes += 1
        if n_primes > len(PRIMES):
            raise ValueError("too many different words for the primes")
    rows = max(1, CELLS // (2 * block))
    blocks, distances = [], []
    for low in range(0, len(candidates), rows):
        own = candidates[low : low + rows]
        starts = own[:, None] * block
        x = padded[starts + np.arange(block)]
        y = padded[starts + block + np.arange(2 * block - 1)]
        zero = np.ones((len(own), block), bool)
        for prime, root in PRIMES[:n_primes]:
            zero &= _squared_differences(x, y, prime, root) == 0
        at, distance = np.nonzero(zero)
        blocks.append(own[at])
        distances.append(distance + block)
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(blocks), np.concatenate(distances)


def _squared_differences(x: np.ndarray, y: np.ndarray, prime: int, root: int) -> np.ndarray:
    """For each row the sums of ``(x - y)**2`` modulo ``prime`` with ``x`` laid on ``y`` at 0, 1 .. len(x) - 1."""
    p = np.uint64(prime)
    block = x.shape[1]
    x, y = x.astype(np.uint64) % p, y.astype(np.uint64) % p
    a, b = (np.zeros((len(x), 2 * block), np.uint64) for _ in range(2))
    a[:, :block], b[:, : 2 * block - 1] = x[:, ::-1], y
    # places block - 1 .. 2 * block - 2 of the cyclic product of this length are those of the plain product
    product = _inverse(_forward(a, prime, root) * _forward(b, prime, root) % p, prime, root)[:, block - 1 : 2 * block - 1]
    sums = np.zeros((len(y), 2 * block), np.uint64)
    np.cumsum(y * y % p, axis=1, out=sums[:, 1:])
    y_squares = (sums[:, block : 2 * block] - sums[:, :block]) % p
    x_squares = (x * x % p).sum(1, keepdims=True) % p
    return (x_squares + y_squares + np.uint64(2) * (p - product)) % p


def _twiddles(prime: int, root: int, m: int) -> np.ndarray:
    """Powers 0 .. m / 2 - 1 of an m-th root of one, by doubling."""
    step = pow(root, (prime - 1) // m, prime)
    out = np.ones(1, np.uint64)
    while len(out) < m // 2:
        out = np.concatenate((out, out * np.uint64(pow(step, len(out), prime)) % np.uint64(prime)))
    return out


def _forward(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Number-theoretic transform of each row; the values come in bit-reversed order."""
    p = np.uint64(prime)
    n, m = rows.shape[1], rows.shape[1]
    while m > 1:
        x = rows.reshape(len(rows), n // m, m)
        low, high = x[:, :, : m // 2], x[:, :, m // 2 :]
        total = low + high
        total[total >= p] -= p
        rows = np.concatenate((total, (low + (p - high)) * _twiddles(prime, root, m) % p), axis=2).reshape(len(rows), n)
        m //= 2
    return rows


def _inverse(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The rows whose transforms, in bit-reversed order, are given."""
    p = np.uint64(prime)
    n, m = rows.shape[1], 2
    back = pow(root, prime - 2, prime)
    while m <= n:
        x = rows.reshape(len(rows), n // m, m)
        low, high = x[:, :, : m // 2], x[:, :, m // 2 :] * _twiddles(prime, back, m) % p
        rows = np.concatenate(((low + high) % p, (low + (p - high)) % p), axis=2).reshape(len(rows), n)
        m *= 2
    return rows * np.uint64(pow(n, prime - 2, prime)) % p


def _extended(numbers: np.ndarray, block: int, blocks: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first word, end, period`` of the maximal stretch around each seed."""
    order = np.lexsort((blocks, distances))
    blocks, distances = blocks[order], distances[order]
    head = np.ones(len(blocks), bool)
    head[1:] = (distances[1:] != distances[:-1]) | (blocks[1:] != blocks[:-1] + 1)
    tail = np.append(head[1:], True)[: len(blocks)]
    periods, lows, highs = distances[head], blocks[head] * block, (blocks[tail] + 1) * block
    # beyond the sequence nothing is equal: different fillings before and behind
    around = np.concatenate((np.full(block, -1), numbers, np.full(3 * block, -2)))
    steps = np.arange(block)
    out_low, out_high = lows.copy(), highs.copy()
    rows = max(1, CELLS // block)
    for at in range(0, len(periods), rows):
        own = slice(at, at + rows)
        d = periods[own, None]
        left = block + lows[own, None] - 1 - steps
        differs = (left < block) | (around[left] != around[left + d])
        out_low[own] -= np.where(differs.any(1), differs.argmax(1), block)
        right = block + highs[own, None] + steps
        differs = around[right] != around[np.minimum(right + d, len(around) - 1)]
        differs |= right + d >= block + len(numbers)
        out_high[own] += np.where(differs.any(1), differs.argmax(1), block)
    return out_low, out_high + periods, periods
