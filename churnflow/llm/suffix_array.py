"""Suffix arrays by induced sorting, a bucket of suffixes at a time, and common prefixes of neighbours.

The text is a row of pieces, each followed by a separator, which is less than every byte. Separators are
ordered by position, so no comparison goes beyond a piece.
"""

from __future__ import annotations

import numpy as np


def classify(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is less than the next one, and whether it is the leftmost of a run of those."""
    n = len(symbols)
    step = np.sign(symbols[1:].astype(np.int32) - symbols[:-1])
    step = np.append(step, 1)  # the last separator is less than what follows
    decided = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    smaller = step[following] > 0
    leftmost = smaller.copy()
    leftmost[0] = False
    leftmost[1:] &= ~smaller[:-1]
    return smaller, leftmost


def _deal(places: np.ndarray, symbols: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Append suffixes to the buckets of their first symbols, in the order given."""
    first = symbols[places]
    order = np.argsort(first, kind="stable")  # a radix sort for 16-bit symbols
    first, places = first[order], places[order]
    ends = np.flatnonzero(np.diff(first)) + 1
    for symbol, part in zip(first[np.concatenate(([0], ends))].tolist() if len(first) else [], np.split(places, ends), strict=False):
        buckets[symbol].append(part)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def induce(symbols: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the sorted leftmost-smaller ones ``seeds``.

    A whole bucket is scanned at once. Suffixes that it induces into itself, by a run of one symbol, are the
    next round, so rounds are as many as the longest run.
    """
    present = np.unique(symbols).tolist()
    top = present[-1] + 1
    seeded: list[list[np.ndarray]] = [[] for _ in range(top)]
    _deal(seeds, symbols, seeded)
    large: list[list[np.ndarray]] = [[] for _ in range(top)]
    larger: dict[int, np.ndarray] = {}
    for symbol in present:
        front, done = _joined(large[symbol]), []
        while len(front):
            done.append(front)
            before = front - 1
            before = before[before >= 0]
            before = before[~smaller[before]]
            same = symbols[before] == symbol
            _deal(before[~same], symbols, large)
            front = before[same]
        larger[symbol] = _joined(done)
        before = _joined(seeded[symbol]) - 1
        _deal(before[before >= 0], symbols, large)
    small: list[list[np.ndarray]] = [[] for _ in range(top)]  # from the end of the bucket on
    out = []
    for symbol in reversed(present[1:]):
        front, done = _joined(small[symbol]), []
        while len(front):
            done.append(front)
            before = front - 1
            before = before[before >= 0]
            before = before[smaller[before]]
            same = symbols[before] == symbol
            _deal(before[~same], symbols, small)
            front = before[same]
        before = larger[symbol][::-1] - 1
        before = before[before >= 0]
        _deal(before[smaller[before]], symbols, small)
        out.append(_joined(done)[::-1])
        out.append(larger[symbol])
    out.append(np.flatnonzero(symbols == 0))
    return np.concatenate(out[::-1])


def _names(symbols: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Equal names for equal substrings, of the given sizes, which are in order; separators are all unequal."""
    equal = (sizes[1:] == sizes[:-1]) & (symbols[places[1:]] != 0)
    active, at = np.flatnonzero(equal), 0
    while len(active):
        same = symbols[places[active] + at] == symbols[places[active + 1] + at]
        equal[active[~same]] = False
        at += 1
        active = active[same & (sizes[active] > at)]
    return np.concatenate(([0], np.cumsum(~equal)))


def _sorted_names(names: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Suffixes of the string of names in order, by doubling the compared length; ``order`` is by first name.

    Names are too many for one bucket at a time. Only suffixes not yet told apart are sorted again.
    """
    n = len(names)
    order = order.copy()
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    by_name = names[order]
    rank[order] = np.searchsorted(by_name, by_name, "left")
    length = 1
    group = rank[order]
    open_ = np.flatnonzero((np.append(group[1:], -1) == group) | (np.insert(group[:-1], 0, -1) == group))
    while len(open_):
        mine = order[open_]
        next_rank = rank[np.minimum(mine + length, n)]
        again = np.lexsort((next_rank, rank[mine]))
        mine, own, next_rank = mine[again], rank[mine][again], next_rank[again]
        order[open_] = mine
        new = np.append(True, (own[1:] != own[:-1]) | (next_rank[1:] != next_rank[:-1]))
        first = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        rank[mine] = first
        several = np.append(~new[1:], False) | ~new
        open_ = open_[several]
        length *= 2
    return order


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of 16-bit ``symbols``: pieces of values from 1 on, each ended by a 0."""
    smaller, leftmost = classify(symbols)
    places = np.flatnonzero(leftmost)
    guess = induce(symbols, smaller, places)
    by_substring = guess[leftmost[guess]]
    number = np.empty(len(symbols), np.int64)
    number[places] = np.arange(len(places))
    ends = np.append(places[1:], len(symbols) - 1)
    index = number[by_substring]
    names = np.empty(len(places), np.int64)
    names[index] = _names(symbols, by_substring, (ends - places + 1)[index])
    return induce(symbols, smaller, places[_sorted_names(names, index)])


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, which starts have a string of ``length`` bytes (8 or more) that starts elsewhere, too."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"\0".join(pieces) + bytes(1 + length + 40), np.uint8)
    total = int(sizes.sum()) + len(pieces)
    ends = np.cumsum(sizes + 1) - 1
    symbols = data[:total].astype(np.uint16) + np.uint16(1)
    symbols[ends] = 0
    order = suffix_array(symbols)
    room = np.repeat(ends, sizes + 1) - np.arange(total)
    before = np.empty(total, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    # Common prefixes in text order: each is at least that of the position before, less one.
    fit = (room >= length) & (before >= 0)
    fit &= room[before] >= length
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(words).view(np.uint64).reshape(-1)
    common = np.zeros(total, np.int32)

    def extend(places: np.ndarray, most: np.ndarray) -> None:
        at = common[places].astype(np.int64)
        while len(places):
            same = words[places + at] == words[before[places] + at]
            at[same] += 8
            common[places] = at
            go = same & (at < most)
            places, at, most = places[go], at[go], most[go]  # counted in whole words: a lower bound

    stride = 32
    sampled = np.arange(0, total, stride)
    sampled = sampled[fit[sampled]]
    # Only as far as both pieces reach, which keeps the comparison inside them.
    reach = np.minimum(room, room[before])
    extend(sampled, np.minimum(length + stride, reach[sampled]))
    common = np.minimum(common, np.where(fit, reach, 0)).astype(np.int32)
    known = np.repeat(common[::stride], stride)[:total] - np.arange(total) % stride
    common = np.where(fit, np.maximum(known, 0), 0).astype(np.int32)
    equal = fit & (common >= length)
    left = np.flatnonzero(fit & ~equal & (reach >= length))
    at = common[left].astype(np.int64)
    while len(left):
        at = np.minimum(at, length - 8)  # the last word ends where the string does
        same = words[left + at] == words[before[left] + at]
        left, at = left[same], at[same] + 8
        equal[left[at >= length]] = True
        left, at = left[at < length], at[at < length]
    found = equal.copy()
    found[before[equal]] = True
    return [found[e - s : max(e - s, e - length + 1)] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
