"""Words, word hashes and five-word shingles of whole texts.

Word hashes sort, route and pre-select; where texts, shingles or windows count as equal, the
operators compare the words themselves or 128-bit digests of their bytes.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
from xxhash import xxh3_64_intdigest

SHINGLE = 5
#: Words of more bytes get a cryptographic hash.
LONG = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def raw_text(text: str | None, lower: bool) -> bytes:
    """UTF-8; null is empty; lower: A-Z as a-z."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.translate(_LOWER) if lower else raw


def word_hashes(words: list[bytes], starts: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of words; a text's words are raw.split(), which parts at ASCII white space. starts: where they start in the text, if known; it tells which can be long."""
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if starts is None:
        long = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)) > LONG).tolist()
    else:
        far = np.flatnonzero(starts[1:] - starts[:-1] > LONG).tolist()
        long = [k for k in [*far, *([len(words) - 1] if words else [])] if len(words[k]) > LONG]
    for k in long:
        h[k] = int.from_bytes(blake2b(words[k], digest_size=8).digest(), "little")
    return h


def word_starts(b: np.ndarray) -> np.ndarray:
    """Where the words of a text start among its bytes."""
    blank = _BLANK[b]
    start = ~blank
    start[1:] &= blank[:-1]
    return np.flatnonzero(start)


def places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words start and end."""
    edge = np.diff(_BLANK[np.frombuffer(raw, np.uint8)].view(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(33))) * _MIX[1]
    return h ^ (h >> np.uint64(33))


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every width consecutive word hashes; none if there are fewer."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, part = np.zeros(n, np.uint64), 0, h, 1
    # doubling: part consecutive words are folded into power, and the bits of width pick which parts to use; each fold is mixed, so that no pattern of words cancels out
    while True:
        if width & part:
            out = mixed(out * _STEP + power[done : done + n] + np.uint64(part))
            done += part
        if done == width:
            return out
        power = mixed(power[: len(power) - part] * _STEP + power[part:])
        part *= 2


def shingle_set(h: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; fewer words are one shingle, no words none."""
    if 0 < len(h) < SHINGLE:
        return rolling(h, len(h)) ^ np.uint64(len(h))
    return np.unique(rolling(h, SHINGLE))


def shingle_digests(words: list[bytes]) -> np.ndarray:
    """Sorted distinct cryptographic 64-bit digests of the shingles' bytes, under a key of their own."""
    text, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    width = min(SHINGLE, len(words))
    pairs = zip((ends - sizes).tolist(), ends[max(width - 1, 0) :].tolist())
    return np.unique(np.frombuffer(b"".join([blake2b(text[a:b], digest_size=8, key=b"shingle").digest() for a, b in pairs]), np.int64))
