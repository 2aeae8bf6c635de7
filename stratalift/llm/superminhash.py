"""Shingle sets and their SuperMinHash signatures."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

SHINGLE = 5
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.empty(0, np.uint64)
UNSET = np.uint64(2**64 - 1)
ONE, LOW, HALF = np.uint64(1), np.uint64(2**32 - 1), np.uint64(32)
SEEDS = GOLDEN * np.arange(1, 1025, dtype=np.uint64)  # of the ranks


WHITE = np.isin(np.arange(256), [32, *range(9, 14)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    factors = np.full(size, GOLDEN)
    factors[0] = ONE
    return np.cumprod(factors)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, in their order.

    A to Z are lower-cased, words end at space and 9 to 13 alone. A word's hash is
    a polynomial of its bytes, for all words at once.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    black = ~WHITE[raw]
    edges = np.flatnonzero(np.diff(black, prepend=False, append=False))
    lengths = edges[1::2] - edges[::2]
    if not len(lengths):
        return EMPTY
    first = np.cumsum(lengths) - lengths
    letters = raw[black].astype(np.uint64) + ONE
    at = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = _powers(1 << max(10, int(lengths.max()).bit_length()))
    sums = np.add.reduceat(letters * powers[at], first)
    return mix(sums * GOLDEN + lengths.astype(np.uint64))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of ``size`` words, ascending.

    A text of fewer words is one shingle, one without words has none.
    """
    codes = word_hashes(text)
    if not len(codes):
        return EMPTY
    size = min(size, len(codes))
    width = len(codes) - size + 1
    rolled = np.full(width, size, np.uint64)
    for k in range(size):
        rolled = rolled * GOLDEN + codes[k : k + width]
    return np.unique(mix(rolled))


def digest(found: np.ndarray) -> bytes:
    """A name of the set: texts of equal sets have equal digests."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def signature(found: np.ndarray, places: int) -> np.ndarray:
    """The SuperMinHash signature, ``places`` numbers; equal at a share of the places that is
    on average the similarity of the sets.

    Each element visits all places in a random order of its own (a Fisher-Yates
    shuffle) and leaves its rank plus a random fraction; each place keeps the
    least. Elements are taken rank by rank, all at once, so the work stops at the
    first rank after which no place is unset: later ranks cannot be less.
    """
    out = np.full(places, UNSET, np.uint64)
    if not len(found):
        return out
    order = None
    every = np.arange(len(found))
    for rank in range(places):
        random = mix(found + SEEDS[rank])
        # the low half as a fraction of the places that are left
        swap = ((random & LOW) * np.uint64(places - rank) >> HALF).astype(np.intp) + rank
        if order is None:
            place = swap
        else:
            place = order[every, swap]
            order[every, swap] = order[:, rank]
        unset = out[place] > np.uint64(rank << 32)
        fraction = random >> HALF
        np.minimum.at(out, place[unset], fraction[unset] | np.uint64(rank << 32))
        if not (out == UNSET).any():
            break
        if order is None:
            order = np.tile(np.arange(places, dtype=np.int16), (len(found), 1))
            order[every, swap] = 0
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key per band of ``rows`` places; sets that agree in a band share its key."""
    parts = sketch[: bands * rows].reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for row in range(rows):
        keys = mix(keys * GOLDEN + parts[:, row])
    return keys.view(np.int64)
