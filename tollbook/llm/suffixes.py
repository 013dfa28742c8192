"""Suffix order of a byte text by two-stage sorting, and common prefixes of neighbours, in numpy.

Only suffixes smaller than their successors are sorted directly. The others follow by one scan over the buckets of first
bytes: a bucket, once complete, puts the suffixes that begin one byte earlier, with a larger byte, behind each other
at the front of their own buckets.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from every place as one big-endian number, with zeros past the end."""
    w = np.r_[text, np.zeros(depth + 16, np.uint8)].astype(np.uint64)
    for n in (1, 2, 4):
        w = (w[:-n] << np.uint64(8 * n)) | w[n:]
    return w


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than the one after it; the last one is not."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def sort_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the `depth` bytes from there; eight more bytes are looked at only among ties."""
    places = places[np.argsort(words[places], kind="stable")]
    tied = np.arange(len(places))
    group = np.cumsum(np.r_[0, words[places][1:] != words[places][:-1]]) if len(places) else tied
    for offset in range(8, depth, 8):
        size = np.bincount(group)
        keep = size[group] > 1
        tied, group = tied[keep], group[keep]
        if not len(tied):
            break
        key = words[places[tied] + offset]
        order = np.lexsort((key, group))
        places[tied] = places[tied][order]
        key, group = key[order], group[order]
        group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
    return places


def suffix_order(text: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """All places of a uint8 text, sorted by the `depth` bytes from there at least."""
    if not len(text):
        return np.zeros(0, np.int64)
    words = words_at(text, depth) if words is None else words
    direct = np.flatnonzero(smaller_than_next(text))
    direct = sort_directly(direct, words, depth)
    direct = direct[np.argsort(text[direct], kind="stable")]
    edge = np.searchsorted(text[direct], np.arange(257))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    front[text[-1]].append(np.array([len(text) - 1]))
    out = []
    for c in range(256):
        found = front[c]
        new = np.concatenate(found) if found else np.zeros(0, np.int64)
        found = [new]
        while len(new):  # runs of one byte
            new = new[new > 0] - 1
            new = new[text[new] == c]
            found.append(new)
        bucket = np.concatenate([*found, direct[edge[c] : edge[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        byte = text[before]
        before, byte = before[byte > c], byte[byte > c]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
        if len(before):
            for part, b in zip(np.split(before, cuts), byte[np.r_[0, cuts]]):
                front[b].append(part)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each place in order shares with the one before it, counted up to `depth`; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for offset in range(0, depth, 8):
        differ = words[order[at] + offset] ^ words[order[at - 1] + offset]
        same = differ == 0
        rest = differ[~same]
        if len(rest):
            shared[at[~same]] = offset + sum((rest < np.uint64(1 << (64 - 8 * j))).astype(np.int64) for j in range(1, 8))
        at = at[same]
        shared[at] = offset + 8
        if not len(at):
            break
    return np.minimum(shared, depth)
