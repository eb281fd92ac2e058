"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of the bytes in order of their first `depth` bytes (at least).

    Groups of suffixes with equal beginnings start at 8 bytes and are refined, those of one member left
    alone: a group is sorted by the groups of the suffixes that many bytes on, which doubles the bytes known.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    first = np.zeros(n, np.uint64)
    for i in range(8):
        first = (first << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(first)
    head = np.ones(n, bool)
    head[1:] = first[order][1:] != first[order][:-1]
    rank = np.empty(n, np.int64)  # a group's number is the place of its first member
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    known = 8
    while known < depth:
        alone = head.copy()
        alone[:-1] &= head[1:]
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        members = order[places]
        group = rank[members]
        later = members + known
        second = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        by = np.argsort(group * (n + 2) + second)
        members, group, second = members[by], group[by], second[by]
        order[places] = members
        new = np.ones(len(places), bool)
        new[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        head[places] = new
        rank[members] = np.maximum.accumulate(np.where(new, places, 0))
        known *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in `order`, by text position.

    left: bytes from each position to the end of its string; no prefix reaches further. As Kasai found, one
    byte on the shared length is at least one less; it is exactly one less if the byte before differs in
    neither suffix. So only the other positions are compared, eight bytes at a time, and the rest follow.
    """
    n = len(text)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    start = np.ones(n, bool)
    start[1:] = left[1:] != left[:-1] - 1
    other = np.maximum(before, 0)
    follows = (before >= 1) & ~start & ~start[other]
    follows[1:] &= text[:-1][np.arange(n - 1)] == text[np.maximum(before[1:] - 1, 0)]
    # The neighbour must be the same one, a byte on, or the shared length need not be one less.
    follows[1:] &= before[1:] == before[:-1] + 1
    follows[0] = False
    heads = np.flatnonzero(~follows & (before >= 0))
    limit = np.minimum(left[heads], left[other[heads]])
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    shared = np.zeros(len(heads), np.int64)
    active = np.arange(len(heads))
    while len(active):
        a, b = heads[active] + shared[active], other[heads[active]] + shared[active]
        same = np.full(len(active), 8, np.int64)
        for i in range(7, -1, -1):
            same[padded[np.minimum(a + i, n)] != padded[np.minimum(b + i, n)]] = i
        shared[active] += same
        active = active[(same == 8) & (shared[active] < limit[active])]
    out[heads] = np.minimum(shared, limit)
    base = np.maximum.accumulate(np.where(~follows, np.arange(n), 0))
    chained = np.flatnonzero(follows)
    out[chained] = np.maximum(out[base[chained]] - (chained - base[chained]), 0)
    return out


def repeats(text: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, equal): suffixes of `length` bytes or more in order, and whether each shares them with the one before it.

    Shorter ones go first: their order is that of the bytes after their string's end, amid equal ones.
    """
    order = suffix_array(text, length)
    order = order[left[order] >= length]
    return order, common_prefixes(text, order, left)[order] >= length
