"""Record files: exact round trip, checksums, order, and awkward tables."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from edges import ROWS, edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from minekit.functions.storage import fresh_path
from minekit.llm.records import RecordFiles, frame, pack_ids, token_records, unframe, unpack_ids
from minekit.llm.tokens import Encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ENCODERS = {path: Encoder(path, 2) for path in (BYTE, WORD)}


def plain(path, text):
    ids = ENCODERS[path].tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 2], "<u4")


@pytest.mark.parametrize("path", [BYTE, WORD])
@given(st.lists(st.text(alphabet="abZé ßI'sdl12²٣_-.\n\t$ΣİЖ你́|<>", max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_cut_words_give_the_ids_of_the_whole_text(path, texts):
    got = ENCODERS[path]([*texts, "it's <|endoftext|> here", "We'll see, we'd 12 go\nnow"])
    want = [*texts, "it's <|endoftext|> here", "We'll see, we'd 12 go\nnow"]
    assert got == [plain(path, t).tobytes() for t in want]


def test_frames_return_their_payload_and_show_damage():
    data = frame(b"one") + frame(b"")
    first, at = unframe(data, 0)
    assert (first, unframe(data, at)) == (b"one", (b"", len(data)))
    for i in range(at):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            unframe(bytes(bad), 0)


def test_ids_take_two_bytes_where_they_fit():
    for ids in ([1, 65535], [1, 65536], []):
        doc_id, back = unpack_ids(pack_ids(None if not ids else 7, np.array(ids, "<u4").tobytes()))
        assert back.tolist() == ids and doc_id == (7 if ids else None)


def test_digests_equal_brute_force(spark):
    got = [tuple(r) for r in token_records(edge_docs(spark), BYTE, 2).collect()]
    texts = {}
    for doc_id, text, *_ in ROWS:
        texts.setdefault(doc_id, []).append(text)
    assert sorted((r[0] is not None, r[0] or 0) for r in got) == sorted((r[0] is not None, r[0] or 0) for r in ROWS)
    start = 0
    for doc_id, own_start, n, crc in sorted(got, key=lambda r: r[1]):
        ids = [plain(BYTE, t) for t in texts[doc_id]]
        assert (n, crc) in {(len(x), zlib.crc32(x.tobytes())) for x in ids}
        assert own_start == start
        start += n
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda x: (x is not None, x))


def test_records_hold_the_ids(spark):
    files = RecordFiles(BYTE, 2)
    manifest = files.write(edge_docs(spark).where("doc_id in (4, 7)"), fresh_path(spark, "records"))
    got = {(r.doc_id, tuple(r.ids)) for r in files.read(manifest).collect()}
    assert got == {(r[0], tuple(plain(BYTE, r[1]).tolist())) for r in ROWS if r[0] in (4, 7)}


def test_no_rows(spark):
    assert token_records(no_docs(spark), BYTE, 2).collect() == []
