"""Sets of word shingles and their minwise values, vectorised, for use inside tasks."""

from __future__ import annotations

import numpy as np

from orderloom.llm.bytehash import SliceHashes, mixed

#: Minwise values of a set; their lowest bits are its sketch.
MINS = 128
_random = np.random.default_rng(6)
_FLIPS = _random.integers(0, 2**32, MINS, dtype=np.uint32)
_FACTORS = _random.integers(0, 2**32, MINS, dtype=np.uint32) | np.uint32(1)
_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """For each text the ascending distinct 64-bit hashes of its runs of `width` words.

    A-Z are lower-cased; words are runs of anything but blank, tab, LF, VT, FF and CR. A
    text with fewer words has its whole sequence as one shingle, one without words none.
    """
    parts = [text.encode("utf-8", "surrogatepass").lower() for text in texts]
    data = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", dtype=np.uint8)
    blank = _IS_BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    words = SliceHashes(data).of(starts, ends)
    begins = np.cumsum([1, *(len(part) + 1 for part in parts)])
    bounds = np.searchsorted(starts, begins)
    rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for i in range(width):
        rolled = rolled * _STEP + words[i : i + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            value = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for word in words[a:b]:
                    value = value * _STEP + word
            out.append(mixed(np.array([value])))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def minwise(hashes: np.ndarray) -> np.ndarray:
    """MINS minimum values over a set that is not empty, 32 bits each, in bounded memory."""
    least = np.full(MINS, 2**32 - 1, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for begin in range(0, len(short), 4096):
        values = (short[begin : begin + 4096, None] ^ _FLIPS) * _FACTORS
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        values ^= values >> np.uint32(12)
        np.minimum(least, values.min(axis=0), out=least)
    return least


def sketches(mins: np.ndarray) -> np.ndarray:
    """Two 64-bit words per row of minwise values: the lowest bit of each value."""
    return np.packbits((mins & np.uint32(1)).astype(bool), axis=1).view(np.int64)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: two sums of scrambled members."""
    one = int(mixed(hashes).sum(dtype=np.uint64)) if len(hashes) else 0
    two = int(mixed(hashes ^ _STEP).sum(dtype=np.uint64)) if len(hashes) else 0
    return one - 2**64 if one >= 2**63 else one, two - 2**64 if two >= 2**63 else two
