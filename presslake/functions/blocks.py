"""Similarity of two texts by matching blocks.

The longest common block splits both texts; what stands before it and what stands behind it are matched in the same
way. The ratio is twice the length of all blocks over both lengths. Of equally long blocks the one that begins first in the first text counts,
then the one that begins first in the second, so the ratio depends on the order of the two texts.

Blocks of short texts are found with whole numbers as sets of positions: bit ``j`` of ``runs[i]`` says that a block of
the current length begins at ``i`` in the first text and at ``j`` in the second. Lengths double until none is left, and the
longest one is put together from the powers of two. That takes room for every pair of positions, so long texts go
through a suffix automaton of the second one instead, in room for its characters.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Container, Iterator

import pandas as pd
from pyspark.sql import functions as F, types as T

#: From this length of the second text on, its frequent characters do not begin a block.
LONG = 200
#: Pairs of positions from which on the automaton finds the longest block.
MANY = 1 << 22


def _begins(text: str) -> set[str]:
    """Characters that may begin a block: in a long text, not those with more than 1 % of it (and one more)."""
    return {c for c, n in Counter(text).items() if len(text) < LONG or n <= len(text) // 100 + 1}


def _places(text: str) -> dict[str, int]:
    """The positions of each of these characters as bits."""
    places = dict.fromkeys(_begins(text), 0)
    for j, c in enumerate(text):
        if c in places:
            places[c] |= 1 << j
    return places


def _longest(runs: list[int]) -> tuple[int, int, int]:
    """``(i, j, length)`` of the longest common block, given where blocks of one character begin."""
    if not any(runs):
        return 0, 0, 0
    powers, size = [runs], 1
    while True:
        last = powers[-1]
        double = [x & (y >> size) if x and y else 0 for x, y in zip(last, last[size:])]
        if not any(double):
            break
        powers.append(double)
        size *= 2
    found, length = powers[-1], size
    for step in range(len(powers) - 2, -1, -1):
        more = [x & (y >> length) if x and y else 0 for x, y in zip(found, powers[step][length:])]
        if any(more):
            found, length = more, length + (1 << step)
    i = next(k for k, x in enumerate(found) if x)
    return i, (found[i] & -found[i]).bit_length() - 1, length


def _longest_by_automaton(a: str, b: str, begins: Container[str]) -> tuple[int, int, int]:
    """The same of two texts; only characters of ``begins`` are in blocks.

    A state of the automaton stands for the substrings of ``b`` that end at the same places; ``end`` is the first of them.
    """
    step: list[dict[str, int]] = [{}]
    link, size, end = [-1], [0], [-1]
    last = 0
    for at, c in enumerate(b):
        state = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        end.append(at)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = state
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] == size[p] + 1:
                link[state] = q
            else:  # a shorter substring that ends in more places becomes a state of its own
                own = len(step)
                step.append(step[q].copy())
                link.append(link[q])
                size.append(size[p] + 1)
                end.append(end[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = own
                    p = link[p]
                link[q] = link[state] = own
        last = state
    best = (0, 0, 0)
    state = n = 0
    for at, c in enumerate(a):
        if c not in begins:
            state = n = 0
            continue
        while state and c not in step[state]:
            state = link[state]
            n = size[state]
        if c in step[state]:
            state = step[state][c]
            n += 1
        if n > best[2]:
            # The state's substrings end where this one does, and first at ``end``.
            best = (at - n + 1, end[state] - n + 1, n)
    return best


def matched(a: str, b: str) -> int:
    """Characters in matching blocks."""
    wide = len(a) * len(b) > MANY
    places = _places(b) if not wide else dict.fromkeys(_begins(b), 0)
    starts = [] if wide else [places.get(c, 0) for c in a]
    total, open_ = 0, [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        if wide and (a1 - a0) * (b1 - b0) > MANY:
            i, j, n = _longest_by_automaton(a[a0:a1], b[b0:b1], places)
        elif wide:
            inner: dict[str, int] = defaultdict(int)
            for k, c in enumerate(b[b0:b1]):
                if c in places:
                    inner[c] |= 1 << k
            i, j, n = _longest([inner.get(c, 0) for c in a[a0:a1]])
        else:
            inside = (1 << (b1 - b0)) - 1
            i, j, n = _longest([x >> b0 & inside for x in starts[a0:a1]])
        i, j = i + a0, j + b0
        # Characters that begin no block still lengthen one, also an empty one at the very start.
        while i > a0 and j > b0 and a[i - 1] == b[j - 1]:
            i, j, n = i - 1, j - 1, n + 1
        while i + n < a1 and j + n < b1 and a[i + n] == b[j + n]:
            n += 1
        if n:
            total += n
            if a0 < i and b0 < j:
                open_.append((a0, i, b0, j))
            if i + n < a1 and j + n < b1:
                open_.append((i + n, a1, j + n, b1))
    return total


def matching_ratio(a: str, b: str) -> float:
    """Twice the matched characters over all; 1 for two empty texts."""
    both = len(a) + len(b)
    return 2 * matched(a, b) / both if both else 1.0


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, which no set of matching blocks exceeds; a few operations per character."""
    places: dict[str, int] = defaultdict(int)
    for j, c in enumerate(b):
        places[c] |= 1 << j
    full = (1 << len(b)) - 1
    free = full
    for c in a:
        hit = free & places.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(b) - free.bit_count()


def ratio_of_least(a: str, b: str, low: float) -> float | None:
    """The ratio where it is ``low`` or more, else None."""
    both = len(a) + len(b)
    if both and 2 * common_letters(a, b) < low * both - 1e-9:
        return None
    found = matching_ratio(a, b)
    return found if found >= low else None


@F.pandas_udf(T.DoubleType())
def text_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Column form of ``matching_ratio`` for texts as they are; a null text counts as empty."""
    for a, b in batches:
        yield pd.Series([matching_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")
