"""64-bit hashes of the words of many texts at once, and of runs of words.

A word's hash is a polynomial over its UTF-8 bytes modulo 2**64, from one
running sum over all texts of a chunk, mixed at the end. A run's hash is a
polynomial over the hashes of its words, mixed likewise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
SPACES = b"\t\n\x0b\x0c\r "
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.isin(np.arange(256), list(SPACES))
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers)


def _hash_bytes(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of ``data``."""
    edge = np.empty(len(data) + 2, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = IS_SPACE[data]
    starts = np.flatnonzero(edge[:-2] & ~edge[1:-1])
    ends = np.flatnonzero(~edge[1:-1] & edge[2:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    value = BYTE_VALUES[LOWERED[data] if lower else data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value * _powers(MULTIPLIER, len(data)), out=sums[1:])
    inverse = _powers(INVERSE, len(data))
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts, ends


def _parts(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``CHUNK_BYTES`` that end before white space."""
    at = 0
    while len(data) - at > CHUNK_BYTES:
        cut = max(data.rfind(c, at + 1, at + CHUNK_BYTES) for c in (b" ", b"\n"))
        if cut < 0:
            found = [x for c in (b" ", b"\n") if (x := data.find(c, at + CHUNK_BYTES)) >= 0]
            cut = min(found, default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def hash_words(texts: list[str], lower: bool = False) -> list[np.ndarray]:
    """Word hashes of each text; ``lower`` makes A-Z lower case first."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        data = np.frombuffer(b"\n".join(d for _, d in held), np.uint8)
        hashes, starts, _ = _hash_bytes(data, lower)
        bounds = np.cumsum([0] + [len(d) + 1 for _, d in held])
        cuts = np.searchsorted(starts, bounds)
        for (i, _), a, b in zip(held, cuts[:-1], cuts[1:], strict=True):
            found[i].append(hashes[a:b])

    for i, text in enumerate(texts):
        for part in _parts(text.encode("utf-8", "replace")):
            held.append((i, part))
            size += len(part)
            if size >= CHUNK_BYTES:
                flush()
                held, size = [], 0
    if held:
        flush()
    return [h[0] if len(h) == 1 else np.concatenate(h) for h in found]


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on; empty if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(MULTIPLIER) + words[j : j + n]
    return mixed(total + np.uint64(k))


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``k`` words; all words as one run if there are fewer."""
    if not len(words):
        return words
    return np.unique(runs(words, min(k, len(words))))
