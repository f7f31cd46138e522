"""Deep-shallow ordering of suffixes, vectorised over all open groups at once.

Shallow part: multikey quicksort with 8 bytes as a key letter. Each round orders every open group by its next letter,
and what is alone is done. Deep part: suffixes that still tie after ``SHALLOW`` bytes are hung into blind tries. A
round takes the first suffix of each open group as the path of its trie; every other one branches off at the length of
its common prefix and is filed under (that length, its next byte) without looking at anything else. The branches of
one node are the groups of the next round, so each round goes at least one byte deeper.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32
LETTER = 8


def _letters(text: np.ndarray) -> np.ndarray:
    """At each position the next 8 bytes as a big-endian number; the text must have 8 bytes to spare."""
    return np.ndarray(shape=(len(text) - LETTER,), dtype=">u8", buffer=text, strides=(1,))


def _ranks(keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Dense rank of each row by the keys, the last of which is the most significant."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        own = key[order]
        new[1:] |= own[1:] != own[:-1]
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _open(labels: np.ndarray) -> np.ndarray:
    return np.bincount(labels)[labels] > 1


def order_suffixes(text: np.ndarray, starts: np.ndarray, groups: np.ndarray, depth: int) -> np.ndarray:
    """A number for each suffix: in order of its group and then of its first ``depth`` bytes, equal ones alike."""
    text = np.concatenate((text, np.zeros(2 * LETTER, np.uint8)))
    letters = _letters(text)
    place = _spread(_ranks((groups,)))
    left = np.arange(len(starts))
    at = 0
    while at < min(SHALLOW, depth) and len(left):
        left = left[_tied(place[left])]
        if not len(left):
            break
        own = letters[starts[left] + at].astype(np.uint64)
        if depth - at < LETTER:
            own >>= np.uint64(8 * (LETTER - (depth - at)))
        _refine(place, left, (own, place[left]))
        at += LETTER
    if at < depth:
        _blind_tries(text, letters, starts, place, left, at, depth)
    return place


def _spread(ranks: np.ndarray) -> np.ndarray:
    """Dense ranks as places that leave room for the members of each group."""
    sizes = np.bincount(ranks) if len(ranks) else np.empty(0, np.int64)
    return (np.cumsum(sizes) - sizes)[ranks]


def _tied(places: np.ndarray) -> np.ndarray:
    return _open(np.unique(places, return_inverse=True)[1]) if len(places) else np.empty(0, bool)


def _refine(place: np.ndarray, left: np.ndarray, keys: tuple[np.ndarray, ...]) -> None:
    """New places inside each group; ``keys`` end with the places so far."""
    ranks = _ranks(keys)
    sizes = np.bincount(ranks)
    before = (np.cumsum(sizes) - sizes)[ranks]
    # The first of a group keeps its place; the others follow by as many as come before them in it.
    base = place[left]
    first = np.full(int(base.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, base, before)
    place[left] = base + before - first[base]


def _blind_tries(text, letters, starts, place, left, at, depth) -> None:
    while len(left):
        left = left[_tied(place[left])]
        if not len(left):
            return
        order = np.argsort(place[left], kind="stable")
        left = left[order]
        head = np.concatenate(([True], place[left][1:] != place[left][:-1]))
        path = left[np.flatnonzero(head)[np.cumsum(head) - 1]]
        common = _common(letters, starts[left], starts[path], at, depth)
        end = common >= depth
        inside = np.where(end, 0, common)
        byte = np.where(end, 0, text[starts[left] + inside]).astype(np.int64)
        smaller = ~end & (byte < text[starts[path] + inside])
        # Branches below the path come first, the shallow ones before the deep ones; above it the other way round.
        side = np.where(end, 0, np.where(smaller, -1, 1))
        deep = np.where(smaller, common, -common)
        deep[end] = 0
        _refine(place, left, (byte, deep, side, place[left]))
        left = left[~end]


def _common(letters: np.ndarray, one: np.ndarray, other: np.ndarray, at: int, depth: int) -> np.ndarray:
    """Length of the common prefix, at most ``depth``; the first ``at`` bytes are known to be equal."""
    common = np.full(len(one), depth, dtype=np.int64)
    going = np.arange(len(one))
    while at < depth and len(going):
        differ = letters[one[going] + at].astype(np.uint64) ^ letters[other[going] + at].astype(np.uint64)
        apart = np.flatnonzero(differ)
        first = (differ[apart].astype(">u8").view(np.uint8).reshape(-1, LETTER) != 0).argmax(axis=1)
        common[going[apart]] = np.minimum(at + first, depth)
        going = np.delete(going, apart)
        at += LETTER
    return common
