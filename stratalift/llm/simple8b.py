"""Simple-8b: as many unsigned integers in a 64-bit word as its selector allows.

The top four bits of a word select how many values of which width its other 60
bits hold, lowest bits first. A value of more than 60 bits is an escape: its
word has selector 0 and the value stands in a list of its own, so that every
word is decoded without regard to the others.
"""

from __future__ import annotations

import numpy as np

ESCAPE = 0
# Values per word and bits per value, by selector from 1.
LAYOUTS = [
    (1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8),
    (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1),
]
COUNTS = np.array([1] + [c for c, _ in LAYOUTS])


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words and the escaped values. The last word may hold fewer values than it could."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    selector = np.where(values >> np.uint64(60), ESCAPE, 1).astype(np.int8)
    for s, (count, width) in enumerate(LAYOUTS[1:], 2):
        fits = _runs((values >> np.uint64(width)) == 0, count)
        if not fits.any():
            break  # neither would more values of fewer bits
        selector[fits] = s
    step = COUNTS[selector].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    begin = np.array(starts)
    chosen = selector[begin]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for s, (count, width) in enumerate(LAYOUTS, 1):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            held = padded[begin[mine][:, None] + np.arange(count)]
            shifts = (np.arange(count) * width).astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(held << shifts, axis=1)
    return words, values[begin[chosen == ESCAPE]]


def _runs(small: np.ndarray, count: int) -> np.ndarray:
    """Where ``count`` places in a row are set; places beyond the end count as set."""
    run, length = np.concatenate([small, np.ones(count - 1, bool)]), 1
    while length < count:
        more = min(length, count - length)
        run, length = run[:-more] & run[more:], length + more
    return run


def decode(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of the words; ``escapes`` are those of these words."""
    words = np.asarray(words, np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[chosen])
    begin = ends - COUNTS[chosen]
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s, (count, width) in enumerate(LAYOUTS, 1):
        mine = np.flatnonzero(chosen == s)
        if len(mine):
            shifts = (np.arange(count) * width).astype(np.uint64)
            held = (words[mine][:, None] >> shifts) & np.uint64((1 << width) - 1)
            out[begin[mine][:, None] + np.arange(count)] = held
    out[begin[chosen == ESCAPE]] = escapes
    return out[:n]


def offsets(words: np.ndarray, every: int) -> np.ndarray:
    """How many values stand before each ``every``-th word."""
    counts = COUNTS[(np.asarray(words, np.uint64) >> np.uint64(60)).astype(np.int64)]
    return (np.cumsum(counts) - counts)[::every]


def decode_range(
    words: np.ndarray, escapes: np.ndarray, before: np.ndarray, every: int, start: int, n: int
) -> np.ndarray:
    """Values ``start .. start + n``, from the groups of ``every`` words that hold them."""
    words = np.asarray(words, np.uint64)
    first = max(0, int(np.searchsorted(before, start, "right")) - 1)
    last = int(np.searchsorted(before, start + n, "left"))
    part = words[first * every : last * every]
    skipped = int(((words[: first * every] >> np.uint64(60)) == ESCAPE).sum())
    own = int(((part >> np.uint64(60)) == ESCAPE).sum())
    base = int(before[first]) if len(before) else 0
    return decode(part, escapes[skipped : skipped + own], start - base + n)[start - base :]
