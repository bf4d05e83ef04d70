"""Token ids of whole texts with a public tokenizer, through a cache of words.

A tokenizer of the rules in ``RULES`` splits a text at white space before
anything else, so the ids of a text are those of its words in a row. Words
repeat; each is encoded once per worker. Texts with characters whose handling
could depend on their neighbours go to the tokenizer whole, and so do all texts
if the file has other rules.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable

from tokenizers import Tokenizer

# ASCII and precomposed letters of Latin-1: lower-cased one by one, nothing to compose.
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
# What the tokenizer's own split makes of such a text.
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
# How the tokenizer file normalizes and splits, and its kind of model, where the shortcut is right.
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "truncation": None,
}
# Entries kept per worker: about 200 bytes each.
WORDS_HELD, PARTS_HELD = 500_000, 1_200_000


def _byte_letters() -> dict[int, int]:
    """Letters that stand for bytes in the vocabulary: printable ones for themselves, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in own)}


LETTERS = _byte_letters()

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Encodes with the tokenizer in ``config``, the text of its file."""

    def __init__(self, config: str) -> None:
        self.tokenizer = Tokenizer.from_str(config)
        rules = json.loads(config)
        # marks in a text are found before it is split
        marks = all(t["content"].startswith("<|") for t in rules.get("added_tokens", []))
        self.by_word = marks and all(rules.get(k) == v for k, v in RULES.items()) and rules["model"]["type"] == "BPE"
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    @classmethod
    def shared(cls, name: str, config: Callable[[], str]) -> Encoder:
        """One per worker and tokenizer; it outlives the task. ``name`` is a digest of the file."""
        if name not in _encoders:
            _encoders.clear()
            _encoders[name] = cls(config())
        return _encoders[name]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.by_word or "<|" in text or not PLAIN.fullmatch(text):
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        found, known = text.lower().split(), self.words
        try:
            return b"".join([known[w] for w in found])
        except KeyError:
            self._learn(set(found))
            return b"".join([self.words[w] for w in found])

    def _learn(self, words: set[str]) -> None:
        if len(self.words) > WORDS_HELD:
            self.words = {}
        if len(self.parts) > PARTS_HELD:
            self.parts = {}
        known, tokenize = self.parts, self.tokenizer.model.tokenize
        for word in words:
            if word not in self.words:
                codes = []
                for part in PARTS.findall(word):
                    code = known.get(part)
                    if code is None:
                        spelt = part.encode().decode("latin-1").translate(LETTERS)
                        code = known[part] = self._bytes([t.id for t in tokenize(spelt)])
                    codes.append(code)
                self.words[word] = b"".join(codes)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)
