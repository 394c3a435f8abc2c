"""Word-shingle hashing shared by the document operators of this subpackage.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09``-``\\x0D`` of the
UTF-8 text after lower-casing A-Z. A document's set holds one 64-bit hash per
distinct run of five words; with one to four words the whole sequence is the
only element; without words the set is empty. Work is vectorised per block of
bytes, so the memory needed does not grow with the length of a text beyond
eight bytes per word.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
BLOCK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240531))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(256)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block_word_hashes(raw: np.ndarray) -> np.ndarray:
    space = _SPACE[raw]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    length = end - start
    longest = int(length.max())
    pow_ = _POW if longest <= len(_POW) else _powers(longest)
    # positions inside each word; white space contributes nothing
    keep = ~space
    pos = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    terms = _BYTE[_LOWER[raw[keep]]] * pow_[pos]
    first = np.cumsum(length) - length
    return mix(np.add.reduceat(terms, first) + length.astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word of ``text``, in order."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(raw) <= BLOCK_BYTES:
        return _block_word_hashes(raw)
    out, at = [], 0
    while at < len(raw):
        stop = min(len(raw), at + BLOCK_BYTES)
        while stop < len(raw) and not _SPACE[raw[stop]]:
            step = np.flatnonzero(_SPACE[raw[stop:stop + BLOCK_BYTES]])
            stop = stop + int(step[0]) if len(step) else min(len(raw), stop + BLOCK_BYTES)
        out.append(_block_word_hashes(raw[at:stop]))
        at = stop
    return np.concatenate(out)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words (the whole sequence
    when it is shorter; nothing when it is empty)."""
    n = len(words)
    if n == 0:
        return words
    take = min(n, width)
    acc = np.zeros(n - take + 1, dtype=np.uint64)
    for k in range(take):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[k:n - take + 1 + k]
    return distinct(mix(acc + np.uint64(take * int(_STEP) % (1 << 64))))


def text_shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    return shingle_hashes(word_hashes(text), width)


def text_shingles_batch(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """``text_shingles`` of many texts; short ones are hashed together."""
    out: list[np.ndarray] = [np.empty(0, dtype=np.uint64)] * len(texts)
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        raw = np.frombuffer(b" ".join(b for _, b in held), dtype=np.uint8)
        hashes = _block_word_hashes(raw)
        starts = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[raw])).astype(np.int8)) == -1)
        ends = np.cumsum([len(b) + 1 for _, b in held])
        cuts = np.searchsorted(starts, ends)
        at = 0
        for (i, _), cut in zip(held, cuts):
            out[i] = shingle_hashes(hashes[at:cut], width)
            at = int(cut)

    for i, text in enumerate(texts):
        if not text:
            continue
        b = text.encode("utf-8", "surrogatepass")
        if len(b) > BLOCK_BYTES:
            out[i] = text_shingles(text, width)
            continue
        held.append((i, b))
        size += len(b)
        if size >= BLOCK_BYTES:
            flush()
            held, size = [], 0
    if held:
        flush()
    return out
