"""Token ids of whole texts by the tokenizers library, one distinct word at a time.

A byte-pair encoding never merges across its pre-tokens, so a text's ids are
the ids of its words in order. Words are cut at spaces; a distinct word is cut
into pre-tokens and encoded by the library's model once per worker and kept in
bounded caches. Texts and words where that cut might differ from the library's
(special tokens' strings, runs of white space, unusual white space, letters
beyond U+017F) are encoded whole by the library, so the ids are always its own.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

CACHE_ENTRIES = 500_000
LONG_PIECE = 64
SEGMENT_CHARS = 1 << 20

#: white space and joiners that regex engines class differently
_ODD = "\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2028\u2029\u202f\u205f\u2060\u3000\ufeff" + "".join(
    map(chr, range(0x2000, 0x2010)))
#: letters whose case, class and normal form all regex engines agree on
_PLAIN = re.compile("[\\t\\n\\r -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u017e]+")
_SPACE_RUN = re.compile(r"\s\s")
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_SAFE_CUT = re.compile(r"[!-~](?=[ \n])")
#: fixed values: the pre-token patterns of the two kinds of files
_BYTE_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_WORD_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on."""
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """Encodes texts with the tokenizer file at ``path`` (no special tokens added)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.byte_level = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _token(self, token: str) -> bytes:
        ids = self.tokens.get(token)
        if ids is None:
            letters = token.encode().decode("latin-1").translate(_LETTERS)
            ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(self.tokens) >= CACHE_ENTRIES:
                self.tokens.clear()
            if len(token) <= LONG_PIECE:
                self.tokens[token] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """The ids of a word; for byte-level files it comes with the space before it."""
        if not _PLAIN.fullmatch(word):
            return self.whole([word])[0]
        found = _BYTE_LEVEL.findall(word) if self.byte_level else _WORD_LEVEL.findall(word.lower())
        return b"".join(map(self._token, found))

    def _segment(self, text: str) -> bytes:
        if any(map(text.__contains__, _ODD)) or any(map(text.__contains__, self.special)):
            return self.whole([text])[0]
        lead, words = b"", text.split() if not self.byte_level else text.split(" ")
        if self.byte_level:
            if _SPACE_RUN.search(text):
                return b"".join(map(self._word, _SPACED.findall(text)))
            lead = self._word(words[0]) if words[0] else b""
            del words[0]  # every other word has a space before it
        cache = self.words
        try:
            return lead + b"".join(map(cache.__getitem__, words))
        except KeyError:
            pass
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        space = " " if self.byte_level else ""
        out = []
        for word in words:
            ids = cache.get(word)
            if ids is None:
                ids = self._word(space + word)
                if len(word) <= LONG_PIECE:
                    cache[word] = ids
            out.append(ids)
        return lead + b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if len(text) <= SEGMENT_CHARS:
            return self._segment(text)
        return b"".join(map(self._segment, _segments(text)))


def _segments(text: str) -> Iterator[str]:
    """Cut between a printable ASCII character and a space or line end, where no token spans."""
    at = 0
    while len(text) - at > SEGMENT_CHARS:
        m = _SAFE_CUT.search(text, at + SEGMENT_CHARS)
        if not m:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


_ENCODERS: dict[str, PieceEncoder] = {}


def release() -> None:
    """Drop the worker's encoders; tasks that keep other things in memory call it first."""
    _ENCODERS.clear()


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file; kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
