"""K-d trees over letter counts, and the one-edit neighbours of words found with them.

A word's vector counts its letters in ``AXES`` classes (a to z, and the rest in a few). One
inserted or deleted letter changes one count by one, one replaced letter at most two: words one
edit apart are at most two apart in L1, and one if their lengths differ. A range search descends
a tree only into boxes that the query's ball reaches; what it meets is compared letter by letter.

Counts are kept as bits, one for each of the first ``LEVELS`` steps of each axis that a count has
reached. The bits in which two words differ are their distance (a lower bound above the last
step), and a box is the bits that all or any of its words have: what a word lacks of the former
and has beyond the latter is its distance from the box. A cut between two counts is one bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

AXES, LEVELS = 32, 4
_REST = AXES - 26
_BITS = AXES * LEVELS
_PARTS = _BITS // 64
REACH = 2  # of words of the same length; one less where lengths differ
LEAF = 64
_CHUNK = 16_384  # words whose counts are spread out at a time
_PAIRS = 1 << 20  # pairs compared at a time

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters in a row, and each word's first place (one more)."""
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32), starts


def letter_counts(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row for each word, one column for each class."""
    n = len(starts) - 1
    owners = np.repeat(np.arange(n), np.diff(starts))
    small = (letters >= 97) & (letters <= 122)
    axis = np.where(small, letters - 97, 26 + letters % _REST).astype(np.int64)
    return np.bincount(owners * AXES + axis, minlength=n * AXES).reshape(n, AXES)


def packed_counts(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Counts as bits: one row of ``_PARTS`` numbers for each word."""
    found = np.empty((len(starts) - 1, _PARTS), dtype=np.uint64)
    steps = np.arange(1, LEVELS + 1)[None, :, None]
    for first in range(0, len(found), _CHUNK):
        bounds = starts[first : first + _CHUNK + 1]
        counts = letter_counts(letters[bounds[0] : bounds[-1]], bounds - bounds[0])
        bits = np.packbits(counts[:, None, :] >= steps, axis=-1)
        found[first : first + _CHUNK] = bits.reshape(len(counts), -1).view(np.uint64)
    return found


def _with_bit(codes: np.ndarray, bit: int) -> np.ndarray:
    """Which codes have a bit."""
    return codes.view(np.uint8)[:, bit // 8] & (128 >> bit % 8) != 0


def _one_bit(bit: int) -> np.ndarray:
    mask = np.zeros(_BITS // 8, dtype=np.uint8)
    mask[bit // 8] = 128 >> bit % 8
    return mask.view(np.uint64)


def _outside(codes: np.ndarray, all_have: np.ndarray, any_has: np.ndarray) -> np.ndarray:
    """Distance of each code from a box."""
    apart = np.bitwise_count(all_have[0] & ~codes[:, 0]) + np.bitwise_count(codes[:, 0] & ~any_has[0])
    for i in range(1, _PARTS):
        apart += np.bitwise_count(all_have[i] & ~codes[:, i]) + np.bitwise_count(codes[:, i] & ~any_has[i])
    return apart


def _best_bit(codes: np.ndarray) -> tuple[int, int]:
    """The bit that halves the codes best, and the size of its smaller half."""
    have = np.zeros(_BITS, dtype=np.int64)
    for first in range(0, len(codes), _CHUNK):
        have += np.unpackbits(codes[first : first + _CHUNK].view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    smaller = np.minimum(have, len(codes) - have)
    bit = int(smaller.argmax())
    return bit, int(smaller[bit])


@dataclass
class Boxes:
    """Leaf boxes of a tree: a word's own one, and all that its ball reaches.

    Inner node ``i`` cuts at a bit, or (``bit`` of -1) behind a length of ``cut[i]``; words
    without the bit or no longer go ``below``, others ``above``. Numbers of leaves are negative.
    """

    bit: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    above: np.ndarray
    leaves: int

    def reached(self, codes: np.ndarray, sizes: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, leaf) of every leaf that may hold a word one edit away.

        A reach of zero gives each word's own leaf.
        """
        slack = min(reach, 1)
        none, every = np.zeros(_PARTS, dtype=np.uint64), np.full(_PARTS, _ALL)
        at = [(0 if len(self.bit) else -1, np.arange(len(codes)), none, every, 0, 1 << 62)]
        words, leaves = [], []
        while at:
            node, some, all_have, any_has, least, most = at.pop()
            if node < 0:
                words.append(some)
                leaves.append(np.full(len(some), -1 - node))
                continue
            bit, cut = self.bit[node], int(self.cut[node])
            if bit < 0:
                sides = ((all_have, any_has, least, cut), (all_have, any_has, cut + 1, most))
            else:
                mask = _one_bit(bit)
                sides = ((all_have, any_has & ~mask, least, most), (all_have | mask, any_has, least, most))
            for child, side in zip((self.below[node], self.above[node]), sides):
                own = sizes[some]
                allowed = np.where((own >= side[2]) & (own <= side[3]), reach, reach - 1)
                allowed = np.where((own >= side[2] - slack) & (own <= side[3] + slack), allowed, -1)
                inside = some[_outside(codes[some], side[0], side[1]) <= allowed]
                if len(inside):
                    at.append((child, inside, *side))
        if not words:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate(words), np.concatenate(leaves)


def grow_boxes(codes: np.ndarray, sizes: np.ndarray, most: int, leaves: int) -> Boxes:
    """Cut the largest part in two, where that halves it best, until all have ``most`` or fewer.

    Parts whose words are all alike cannot be cut; there are at most ``leaves`` parts.
    """
    nodes: list[list[int]] = []
    parts: list[tuple[np.ndarray, tuple[int, int] | None]] = [(np.arange(len(codes)), None)]
    done = 0
    while parts:
        part, place = parts.pop(max(range(len(parts)), key=lambda i: len(parts[i][0])))
        cut = _best_cut(codes[part], sizes[part]) if len(part) > most and len(parts) + done + 1 < leaves else None
        if cut is None:
            done += 1
            number = -done
        else:
            number = len(nodes)
            nodes.append([cut[0], cut[1], 0, 0])
            above = _with_bit(codes[part], cut[0]) if cut[0] >= 0 else sizes[part] > cut[1]
            parts += [(part[~above], (number, 2)), (part[above], (number, 3))]
        if place is not None:
            nodes[place[0]][place[1]] = number
    columns = np.array(nodes, dtype=np.int64).reshape(-1, 4).T
    return Boxes(*columns, done)


def _best_cut(codes: np.ndarray, sizes: np.ndarray) -> tuple[int, int] | None:
    """A bit, or -1 and a length; none if all words are alike."""
    bit, smaller = _best_bit(codes)
    cut = int(np.median(sizes))
    cut = cut if cut < sizes.max() else int(sizes.max()) - 1
    shorter = int((sizes <= cut).sum())
    # A ball reaches no further than the next length, so that cut is worth more.
    if 2 * min(shorter, len(sizes) - shorter) >= max(smaller, 1):
        return -1, cut
    return (bit, 0) if smaller else None


def near_in_order(letters: np.ndarray, a: np.ndarray, b: np.ndarray, size: int, other: int) -> np.ndarray:
    """Whether words of ``size`` letters from ``a`` on are one edit from words of ``other`` from ``b`` on.

    ``other`` is ``size`` or one more.
    """
    left = letters[a[:, None] + np.arange(size)]
    if size == other:
        return (left != letters[b[:, None] + np.arange(size)]).sum(axis=1) == 1
    right = letters[b[:, None] + np.arange(other)]
    front = np.cumprod(left == right[:, :-1], axis=1).sum(axis=1)
    back = np.cumprod((left == right[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= size


def pairs_within(held: np.ndarray, asking: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (asking, held) of codes at most ``reach`` apart, a leaf of the held words' tree at a time."""
    at = [(np.arange(len(held)), np.arange(len(asking)))]
    while at:
        points, some = at.pop()
        part = held[points]
        all_have, any_has = np.bitwise_and.reduce(part, axis=0), np.bitwise_or.reduce(part, axis=0)
        some = some[_outside(asking[some], all_have, any_has) <= reach]
        if not len(some):
            continue
        bit, smaller = _best_bit(part) if len(points) > LEAF else (0, 0)
        if smaller:
            above = _with_bit(part, bit)
            at += [(points[above], some), (points[~above], some)]
            continue
        step = max(_PAIRS // len(points), 1)
        for first in range(0, len(some), step):
            few = some[first : first + step]
            apart = np.bitwise_count(asking[few, 0][:, None] ^ part[None, :, 0])
            for i in range(1, _PARTS):
                apart += np.bitwise_count(asking[few, i][:, None] ^ part[None, :, i])
            q, p = np.nonzero(apart <= reach)
            yield few[q], points[p]
