"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes.

Both work on one bounded shard inside a task.
"""

from __future__ import annotations

import numpy as np


def pack_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number (zeros past the end)."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(shape=(len(data),), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)


def suffix_array(keys: np.ndarray, depth: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): suffixes sorted by their first ``limit`` symbols, ties by position.

    ``keys`` holds the first ``depth`` symbols of each suffix as a number that
    sorts like them.  Each round sorts only the groups that are still tied, by
    the rank of the suffix that starts ``depth`` symbols later, which doubles
    the depth (the last round stops at ``limit``).  Suffixes that agree in
    ``limit`` symbols share a rank.
    """
    n = len(keys)
    if n == 0:
        return np.zeros(0, np.int32), np.full(1, -1, np.int32)
    order = np.argsort(keys).astype(np.int32)
    ordered = keys[order]
    head = np.empty(n, bool)
    head[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=head[1:])
    begins = np.flatnonzero(head)
    rank = np.empty(n + 1, np.int32)
    rank[order] = np.repeat(begins, np.diff(np.append(begins, n)))
    rank[n] = -1
    tied = _tied(head)
    places = np.flatnonzero(tied)
    while depth < limit and len(places):
        step = min(depth, limit - depth)
        at = order[places]
        key = (rank[at].astype(np.int64) << 32) + (rank[np.minimum(at.astype(np.int64) + step, n)] + 1)
        by = np.argsort(key)
        key, at = key[by], at[by]
        order[places] = at
        head = np.empty(len(key), bool)
        head[0] = True
        np.not_equal(key[1:], key[:-1], out=head[1:])
        begins = np.flatnonzero(head)
        rank[at] = np.repeat(places[begins], np.diff(np.append(begins, len(key))))
        places = places[_tied(head)]
        depth += step
    if len(places):
        at = order[places].astype(np.int64)
        order[places] = np.sort((rank[at].astype(np.int64) << 32) | at) & 0xFFFFFFFF
    return order, rank


def _tied(head: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, given where groups begin."""
    alone = head.copy()
    alone[:-1] &= head[1:]
    return ~alone


def common_prefixes(
    data: np.ndarray, order: np.ndarray, rank: np.ndarray, ends: np.ndarray, limit: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, earlier, length) of every suffix tied with the one before it in the array.

    Suffixes shorter than ``limit`` (up to the end of their document) don't count.

    Kasai's rule: when a suffix and its predecessor share ``l`` symbols, the
    next suffix shares ``l - 1`` with the predecessor's next one.  So lengths
    are compared byte by byte only where a run of such neighbours begins and
    follow by subtraction along it.  ``ends`` gives each position the end of
    its document, which no common prefix passes; ``limit`` is the depth to
    which ``order`` is sorted.
    """
    whole = order[order.astype(np.int64) + limit <= ends[order]] if len(order) else order
    at, before = whole[1:].astype(np.int64), whole[:-1].astype(np.int64)
    same = rank[at] == rank[before]
    at, before = at[same], before[same]
    by = np.argsort(at)
    at, before = at[by], before[by]
    if not len(at):
        return at, before, at
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (before[1:] != before[:-1] + 1)
    begins = np.flatnonzero(fresh)
    runs = np.diff(np.append(begins, len(at)))
    # a run of neighbours shares its own length and the depth of its last member at least
    length = runs - 1 + limit
    most = np.minimum(ends[at[begins]] - at[begins], ends[before[begins]] - before[begins])
    open_ = np.flatnonzero(length < most)
    while len(open_):
        a, b = at[begins[open_]] + length[open_], before[begins[open_]] + length[open_]
        equal = data[a] == data[b]
        open_ = open_[equal]
        length[open_] += 1
        open_ = open_[length[open_] < most[open_]]
    length = np.minimum(length, most)
    return at, before, np.repeat(length + begins, runs) - np.arange(len(at))
