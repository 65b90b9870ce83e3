"""Vectorised word hashing of text batches (numpy, inside tasks).

A word is a maximal run of bytes other than space, \\t, \\n, \\v, \\f, \\r of the
UTF-8 text.  Its hash is a polynomial over its bytes modulo 2**64, taken from
prefix sums over the batch's bytes and then mixed, so no Python code runs per
word.  Polynomials modulo a power of two have equal values for certain long words
whatever the base, so words above ``LONG`` bytes are hashed one by one by XXH3.
Texts are worked through in windows that end between words.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

WINDOW = 1 << 20
LONG = 200
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers, _inverse
    if len(_powers) < n:
        made = []
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, WINDOW + 1), x, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if n > 2 * WINDOW:
            return made[0], made[1]  # a word longer than a window: not kept
        _powers, _inverse = made
    return _powers, _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    word = np.empty(len(raw) + 2, np.bool_)
    word[0] = word[-1] = False
    np.logical_not(is_space(raw), out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def hash_spans(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    power, inverse = _tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=total[1:])
    out = mix((total[end] - total[first]) * inverse[first])
    for k in np.flatnonzero(end - first > LONG):
        out[k] = xxh3_64_intdigest(raw[first[k]:end[k]].tobytes())
    return out


def windows(texts: list[bytes], size: int = WINDOW):
    """Yield (window bytes, index of the text of each part, start of each part); texts are joined by a line end
    and a text longer than the window is cut at white space."""
    parts, who, length = [], [], 0
    for k, t in enumerate(texts):
        at = 0
        while at < len(t):
            stop = len(t)
            if stop - at > size:
                stop = at + size
                while stop < len(t) and t[stop] not in b" \t\n\v\f\r":
                    stop += 1
            piece = t[at:stop]
            if parts and length + len(piece) > size:
                yield parts, who
                parts, who, length = [], [], 0
            parts.append(piece)
            who.append(k)
            length += len(piece) + 1
            at = stop
    if parts:
        yield parts, who


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, number of words of each text)."""
    count = np.zeros(len(texts), np.int64)
    out = []
    for parts, who in windows(texts):
        raw = np.frombuffer(b"\n".join(parts), np.uint8)
        first, end = spans(raw)
        starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        per = np.diff(np.append(np.searchsorted(first, starts), len(first)))
        np.add.at(count, who, per)
        out.append(hash_spans(raw, first, end))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), count


def runs(texts: list, limit: int = 4 << 20):
    """Slices of a batch whose texts have about ``limit`` characters together, so that memory stays bounded."""
    at, chars = 0, 0
    for k, t in enumerate(texts):
        if k > at and chars + len(t or "") > limit:
            yield texts[at:k]
            at, chars = k, 0
        chars += len(t or "")
    if at < len(texts):
        yield texts[at:]


def as_bytes(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]
