"""Token-set similarity of names."""

from __future__ import annotations

import re
from collections.abc import Callable

Words = frozenset


def name_words(name: str) -> frozenset[str]:
    plain = name.encode("ascii", "ignore").decode()
    return frozenset(re.sub(r"\W", " ", plain).lower().split())


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word step per letter of b."""
    where: dict[str, int] = {}
    for at, letter in enumerate(a):
        where[letter] = where.get(letter, 0) | (1 << at)
    full = (1 << len(a)) - 1
    free = full
    for letter in b:
        hit = free & where.get(letter, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def percent_of(common: int, letters: int) -> int:
    return round(200 * common / letters) if letters else 0


def score_words(left: frozenset[str], right: frozenset[str], least: int = 0) -> int:
    """0..100 for two prepared names; 100 if the words of one all occur in the other.

    The letters are only compared if the lengths alone leave room for `least`;
    a score below it may be reported too low.
    """
    if not left or not right:
        return 0
    both = left & right
    if both and (both == left or both == right):
        return 100
    shared = " ".join(sorted(both))
    one = f"{shared} {' '.join(sorted(left - both))}".strip()
    two = f"{shared} {' '.join(sorted(right - both))}".strip()
    if one == two:
        return 100
    # the shared words begin both texts, so against them alone nothing has to be compared
    best = max(percent_of(len(shared), len(shared) + len(t)) for t in (one, two)) if shared else 0
    letters = len(one) + len(two)
    if percent_of(min(len(one), len(two)), letters) >= max(least, best):
        best = max(best, percent_of(common_letters(one, two), letters))
    return best


def token_set_scorer() -> Callable[[str, str], int]:
    """A function (a, b) -> 0..100 of two names."""
    return lambda a, b: score_words(name_words(a), name_words(b))
