"""Equal substrings of one length, by blockwise suffix sorting with a difference cover.

A block is a set of strings; every position from which ``LENGTH`` bytes follow starts a
suffix, and only its first ``LENGTH`` bytes count. The suffixes are sorted by their first
``HEAD`` bytes. Ties longer than that are not compared byte by byte: positions whose number
modulo ``PERIOD`` is in the difference cover are ranked beforehand, and for any two positions
some shift below ``PERIOD`` takes both into the cover, so one look at the ranks decides. The
memory is a few words per byte of the block, however long the ties are.
"""

from __future__ import annotations

import numpy as np

LENGTH = 50
PERIOD = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13 occurs
HEAD = 16  # bytes sorted directly; at least PERIOD
_PAD = 64

_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _shifts() -> np.ndarray:
    """For two remainders, the smallest shift that takes both into the cover."""
    table = np.zeros((PERIOD, PERIOD), dtype=np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(
                d for d in range(PERIOD) if _IN_COVER[(a + d) % PERIOD] and _IN_COVER[(b + d) % PERIOD]
            )
    return table


_SHIFTS = _shifts()


class Text:
    """Bytes with 8-byte loads at any position."""

    def __init__(self, data: bytes):
        self.padded = data + bytes(_PAD)
        self.size = len(data)
        self._words = np.ndarray((len(data) + _PAD - 8,), dtype=">u8", buffer=self.padded, strides=(1,))

    def words(self, positions: np.ndarray) -> np.ndarray:
        """Eight bytes from each position, as numbers that sort like the bytes."""
        return self._words[positions].astype(np.uint64)


def cover_ranks(text: Text) -> np.ndarray:
    """Rank of each position in the cover by its next ``LENGTH`` bytes; -1 elsewhere.

    Bytes of the string behind may count, which can only order suffixes whose first
    ``LENGTH`` bytes inside their own strings are equal.
    """
    places = np.flatnonzero(_IN_COVER[np.arange(text.size) % PERIOD])
    ranks = np.full(text.size, -1, dtype=np.int64)
    if not len(places):
        return ranks
    # Refined word by word: only ties go on.
    rank = np.zeros(len(places), dtype=np.int64)
    tied = np.arange(len(places))
    for step in range(0, LENGTH, 8):
        word = text.words(np.minimum(places[tied] + step, text.size + _PAD - 16))
        order = np.lexsort((word, rank[tied]))
        sorted_rank, sorted_word = rank[tied][order], word[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (sorted_rank[1:] != sorted_rank[:-1]) | (sorted_word[1:] != sorted_word[:-1])
        # Ranks count the members before, so a class that splits stays inside its old range.
        opens = np.ones(len(order), dtype=bool)
        opens[1:] = sorted_rank[1:] != sorted_rank[:-1]
        at = np.arange(len(order))
        base = np.maximum.accumulate(np.where(opens, at, 0))
        first = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[tied[order]] = sorted_rank + first - base
        alone = fresh & np.append(fresh[1:], True)
        tied = tied[order][~alone]
        if not len(tied):
            break
    ranks[places] = rank
    return ranks


def sort_suffixes(text: Text, starts: np.ndarray) -> np.ndarray:
    """Order of the suffixes from ``starts`` by their first ``LENGTH`` bytes."""
    first, second = text.words(starts), text.words(starts + 8)
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    same = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
    if not same.any():
        return order
    ranks = cover_ranks(text)
    in_tie = np.zeros(len(order), dtype=bool)
    in_tie[1:] |= same
    in_tie[:-1] |= same
    places = np.flatnonzero(in_tie)
    groups = np.cumsum(np.concatenate([[True], ~same]))[places]
    members = starts[order[places]]
    chosen = order[places]
    while len(places):
        # One step of a quicksort of all ties at once: against the middle member of each.
        opens = np.concatenate([[True], groups[1:] != groups[:-1]])
        firsts = np.flatnonzero(opens)
        sizes = np.diff(np.append(firsts, len(groups)))
        pivots = np.repeat(members[firsts + sizes // 2], sizes)
        shift = _SHIFTS[members % PERIOD, pivots % PERIOD]
        side = np.sign(ranks[members + shift] - ranks[pivots + shift]) + 1
        number = np.cumsum(opens) - 1
        keys = number * 3 + side
        moved = np.argsort(keys, kind="stable")
        keys, members, chosen = keys[moved], members[moved], chosen[moved]
        order[places] = chosen
        counts = np.bincount(keys)
        open_still = (keys % 3 != 1) & (counts[keys] > 1)
        places, groups = places[open_still], keys[open_still]
        members, chosen = members[open_still], chosen[open_still]
    return order


def equal_neighbours(text: Text, starts: np.ndarray) -> np.ndarray:
    """Whether each start's ``LENGTH`` bytes equal those of the start before it."""
    same = np.zeros(len(starts), dtype=bool)
    if len(starts) > 1:
        same[1:] = True
        for step in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
            rest = np.flatnonzero(same)
            if not len(rest):
                break
            same[rest] = text.words(starts[rest] + step) == text.words(starts[rest - 1] + step)
    return same


def smallest_owners(data: bytes, sizes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix of strings laid end to end, the smallest owner of an equal one.

    Returns the suffixes' starts and the owners found, string after string.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    bounds = np.cumsum(sizes)
    counts = np.maximum(sizes - LENGTH + 1, 0)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    starts = np.repeat(bounds - sizes - before, counts) + np.arange(total)
    if not total:
        return starts, np.empty(0, dtype=np.int64)
    text = Text(data)
    order = sort_suffixes(text, starts)
    fresh = np.flatnonzero(~equal_neighbours(text, starts[order]))
    owned = np.repeat(np.asarray(owners, dtype=np.int64), counts)
    least = np.minimum.reduceat(owned[order], fresh)
    found = np.empty(total, dtype=np.int64)
    found[order] = np.repeat(least, np.diff(np.append(fresh, total)))
    return starts, found
