"""Token ids of whole texts from a tokenizer file, with a bounded cache of the words between cuts.

The ids are those that the tokenizers library gives for the whole text. The two supported kinds of
tokenizer first cut a text by a fixed pattern and then encode each cut on its own. For texts over
Latin letters, ASCII digits, marks and single blanks the same cut is made here, and every distinct word is
encoded by the library once per worker. Whether a tokenizer is of such a kind is read from its file;
any other text, and any other tokenizer, is encoded whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from minekit.llm.batches import HELD

CACHE_WORDS = 700_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = r"!-/:-@\[-`{-~"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
# the tokenizers' own patterns, over the characters named above
_LEADING = re.compile(rf"{_ENDINGS}| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|(?<=\S)\n(?=\S)")
_DROPPED = re.compile(rf"{_ENDINGS}|[{_LETTERS}]+|[0-9]|[{_MARKS}]+")
# how the two kinds state their pattern in the file
_DROPPED_FORM = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, followed by ``end_id``."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end_id], "<u4").tobytes()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.kind = _kind_of(spec)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.cache: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each text."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def words(self, text: str) -> list[str] | None:
        """The cuts of a text; None if the pattern here does not cover all of it."""
        if not self.kind or any(s in text for s in self.special):
            return None
        if self.kind == "leading":
            found = _LEADING.findall(text)
            return found if sum(map(len, found)) == len(text) else None
        text = text.lower()
        found = _DROPPED.findall(text)
        return found if sum(map(len, found)) + text.count(" ") + text.count("\n") == len(text) else None

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; an empty text has only the end id."""
        cut = [self.words(x) for x in texts]
        cache = self.cache
        new = list(set().union(*(x for x in cut if x)).difference(cache))
        cache.update(zip(new, self.whole(new)))
        rest = [i for i, x in enumerate(cut) if x is None]
        uncut = dict(zip(rest, self.whole([texts[i] for i in rest])))
        lookup = cache.__getitem__
        out = [(uncut[i] if x is None else b"".join(map(lookup, x))) + self.end for i, x in enumerate(cut)]
        if len(cache) > CACHE_WORDS:  # the words met first are the frequent ones; these stay
            for x in new:
                del cache[x]
        return out


def _kind_of(spec: dict) -> str:
    """``leading``: a blank belongs to the word after it. ``dropped``: blanks yield nothing. Else empty."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if spec.get("truncation") or spec.get("model", {}).get("dropout"):
        return ""
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "leading"
    first = (pre.get("pretokenizers") or [{}])[0]
    lowers = [x.get("type") for x in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    inverted = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    if lowers and inverted and first["pattern"].get("Regex") == _DROPPED_FORM:
        return "dropped"
    return ""


def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this worker for a tokenizer file."""
    key = f"{path}:{end_id}"
    if key not in HELD:
        HELD[key] = Encoder(path, end_id)
    return HELD[key]
