"""Packing: every token once, gapless sequences, little padding, awkward tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from edges import ROWS, edge_docs, no_docs

from minekit.llm.packing import Packing, shortest_pack_first
from minekit.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, size):
    seq, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        seq[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for own in seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(seq) == list(range(len(seq)))
    return seq


def test_plan_places_every_piece_once():
    draw = random.Random(1)
    for size in (8, 64, 2048):
        for _ in range(20):
            histogram = Counter(draw.randint(1, size) for _ in range(draw.randint(0, 300)))
            placed = Counter()
            for p in shortest_pack_first(histogram, size):
                assert sum(n for n, _ in p.parts) + p.room == size and p.count > 0
                for length, first in p.parts:
                    placed.update((length, first + i) for i in range(p.count))
            assert placed == Counter((n, i) for n, k in histogram.items() for i in range(k))


def test_pieces_on_awkward_rows(spark):
    got = Packing(PATH, 1, 2048).run(edge_docs(spark)).collect()
    check(got, 2048)
    encode = Encoder(PATH, 1)
    want = Counter()
    for doc_id, text, *_ in ROWS:
        ids = np.frombuffer(encode([text or ""])[0], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want


def test_sequences_hold_the_ids(spark):
    docs = edge_docs(spark).where("doc_id in (3, 7, 9)")
    packing = Packing(PATH, 1, 256)
    placed = packing.run(docs)
    rows = packing.sequences(docs, placed).collect()
    assert sum(r.n_tokens for r in rows) == sum(r.length for r in placed.collect())
    assert all(len(r.ids) == (r.n_tokens if bin(r.n_tokens).count("1") == 1 else 256) for r in rows)


def test_little_padding(spark):
    texts = [(i, " ".join(f"word{j}" for j in range(i * 7 % 900))) for i in range(400)]
    rows = Packing(PATH, 1, 2048).run(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    used = sum(r.length for r in rows)
    assert len(check(rows, 2048)) * 2048 - used <= 0.02 * used


def test_no_rows(spark):
    assert Packing(PATH).run(no_docs(spark)).collect() == []
