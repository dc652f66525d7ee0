"""Token ids of whole texts by a tokenizer file of the `tokenizers` library."""

from __future__ import annotations

import re
import struct

import numpy as np

#: Words per generation of a Python worker's memory. It holds two generations (about 150 MB): words that
#: were used since the last change stay.
GENERATION_WORDS = 400_000
TOKENIZER_FILE = "word_bpe_49k.json"
END_OF_DOCUMENT = 2

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[{_LETTERS}]+")
#: Latin letters, ASCII digits and all ASCII punctuation but the apostrophe, and their units.
_LATIN = re.compile(f"[{_LETTERS}0-9!-&(-/:-@\\[-`{{-~]+")
_UNIT = re.compile(f"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
_WORKERS: dict[str, WordEncoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def byte_letters() -> list[str]:
    """The letter of each byte in a byte-level vocabulary: itself if printable, else one above U+00FF."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordEncoder(dict):
    """Encodes blank-separated words once each; maps a word to its ids as 32-bit little-endian bytes.

    Holds for byte-level tokenizers that drop white space, lower-case, and never join letters with
    other characters: the ids of a text then are those of its words, in order. A word of Latin letters
    is one unit, so the merges alone decide. With ASCII digits and punctuation it falls into such
    units: runs of letters, single digits, runs of the rest. Any other word, and any that may hold a
    special token or a contraction, goes through the whole tokenizer. Texts that may hold a special token keep their
    case. Only ASCII blanks separate words; other spaces stay inside them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._letters = byte_letters()
        self._older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        packed = self._older.get(word) or self._encoded(word)
        if len(word) < 64:
            if len(self) >= GENERATION_WORDS:
                self._older = dict(self)
                self.clear()
            self[word] = packed
        return packed

    def _encoded(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text):
            unit = text.lower()
            unit = unit if unit.isascii() else "".join([self._letters[b] for b in unit.encode()])
            return _packed([t.id for t in self._model.tokenize(unit)])
        if "<|" not in text and _LATIN.fullmatch(text) and len(units := _UNIT.findall(text)) > 1:
            return b"".join([self[u.encode()] for u in units])
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        raw = (text or "").encode("utf-8", "replace")
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker."""
    if path not in _WORKERS:
        _WORKERS[path] = WordEncoder(path)
    return _WORKERS[path]


def document_ids(path: str, text: str | None, end: int = END_OF_DOCUMENT) -> np.ndarray:
    """The ids of a text followed by `end`, as unsigned 32-bit numbers; null text has only `end`."""
    return np.frombuffer(encoder(path).encode(text) + end.to_bytes(4, "little"), "<u4")
