"""Guess cost of a password: the cheapest way to write it as a row of guessable spans.

A span is a word, a date, a repeat, a keyboard or alphabet walk, or brute force. Its cost is the
decimal logarithm of the guesses it takes, and each span adds ``SPAN``. The cheapest segmentation is
found by dynamic programming over the end of the last span.

Words and dates are short. Repeats and walks may begin and end anywhere in a run of any length, so that a
run of n characters has n * n of them. Of the places where one may begin only those are kept that can still
be the best for some end (see :class:`_Starts`); a handful, so the time is linear in the value.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
from collections.abc import Iterator, Mapping

import ahocorasick

SPAN = math.log10(2)  # for the place of a border
BRUTE = 1.0  # one of ten likely characters
LONGEST_UNIT = 4  # of a repeat
# The rows of a US keyboard, and digits and signs that stand for letters.
KEY_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("013457@$", "oleastas")
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d)", re.A)
LONGEST_DATE = 10


@functools.cache
def _neighbours() -> frozenset[tuple[str, str]]:
    places = {key: (row, column + 0.5 * row) for row, keys in enumerate(KEY_ROWS) for column, key in enumerate(keys)}
    return frozenset(
        (a, b)
        for a, (row, column) in places.items()
        for b, (row_b, column_b) in places.items()
        if a != b and abs(row - row_b) <= 1 and abs(column - column_b) <= 1
    )


class Words:
    """Ranked words, found in a value by one automaton."""

    def __init__(self, ranks: Mapping[str, int]) -> None:
        self.ranks = ranks
        self._automaton = ahocorasick.Automaton()
        for word in ranks:
            self._automaton.add_word(word, word)
        if ranks:
            self._automaton.make_automaton()

    def spans(self, value: str) -> Iterator[tuple[int, int, float]]:
        """Words as they are, and behind signs that stand for letters; capitals and signs cost one bit each."""
        if not self.ranks:
            return
        lowered = "".join(c.lower() if c.isascii() else c for c in value)
        plain = lowered.translate(LEET)
        for text, extra in ((lowered, 0.0), (plain, math.log10(2))):
            if extra and plain == lowered:
                continue
            for last, word in self._automaton.iter(text):
                start = last + 1 - len(word)
                capitals = 0.0 if word == value[start : last + 1] else math.log10(2)
                yield start, last + 1, math.log10(self.ranks[word]) + extra + capitals


@functools.cache
def public_words(path: str) -> Words:
    """Words of a vocabulary file with word ends, ranked from 1 in its order; three letters or more."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ends = (w.removesuffix("</w>") for w, _ in sorted(vocabulary.items(), key=lambda item: item[1]) if w.endswith("</w>"))
    return Words({w: rank for rank, w in enumerate((w for w in ends if len(w) > 2 and w.isalpha()), 1)})


def _dates(value: str) -> Iterator[tuple[int, int, float]]:
    for start in range(len(value)):
        if value[start].isdigit():
            for end in range(start + 4, min(len(value), start + LONGEST_DATE) + 1):
                if DATE.fullmatch(value, start, end):
                    apart = not value[start:end].isdigit()
                    yield start, end, math.log10((365 if end - start > 4 else 1) * 120 * (4 if apart else 1))


class _Starts:
    """Places where a span of cost ``key(start) + log10(length / unit)`` may begin, for ends that rise by ``unit``.

    Of two places the later one is shorter for every end. So the earlier goes if its key is no less. The later
    one gains most at its first end, and less and less behind it; if that does not make up for its key, it goes.
    """

    def __init__(self, unit: int, least: int) -> None:
        self._unit, self._least = unit, least  # least length of a span
        self._kept: list[tuple[float, int]] = []

    def add(self, start: int, key: float) -> None:
        kept = self._kept
        while kept and kept[-1][0] >= key:
            kept.pop()
        if all(key - k < math.log10((start + self._least - s) / self._least) for k, s in kept):
            kept.append((key, start))

    def clear(self) -> None:
        self._kept.clear()

    def best(self, end: int) -> float:
        return min((key + math.log10((end - start) / self._unit) for key, start in self._kept), default=math.inf)


class _Repeats:
    """Repeats of a unit of some characters, twice at least and over three characters at least."""

    def __init__(self, value: str, unit: int) -> None:
        self._value, self._unit = value, unit
        self._least = unit * max(2, -(-3 // unit))
        self._starts = [_Starts(unit, self._least) for _ in range(unit)]
        self._run = 0  # where the run of equal units begins

    def cost(self, end: int, best: list[float]) -> float:
        """Cheapest way to end with a repeat in front of ``end``."""
        unit, last = self._unit, end - 1
        if last >= unit and self._value[last] != self._value[last - unit]:
            self._run = end - unit
            for starts in self._starts:
                starts.clear()
        start, starts = end - self._least, self._starts[end % unit]
        if start >= self._run:
            starts.add(start, best[start])
        return SPAN + BRUTE * unit + starts.best(end)


class _Walks:
    """Walks over neighbouring keys, or by steps of one in the alphabet, over three characters at least."""

    def __init__(self, value: str) -> None:
        self._lowered = value.lower() if value.isascii() else value
        self._near = _neighbours()
        self._starts = _Starts(1, 3)
        self._run, self._last, self._turns = 0, None, [0.0]

    def cost(self, end: int, best: list[float]) -> float:
        """Cheapest way to end with a walk in front of ``end``. Its first step is a turn, so is each change."""
        if end < 2:
            return math.inf
        before, now = self._lowered[end - 2 : end]
        step = ord(now) - ord(before)
        kind = step if abs(step) == 1 else "key" if (before, now) in self._near else None
        self._turns.append(self._turns[-1] + (math.log10(2) if kind != self._last or kind == "key" else 0.0))
        self._last = kind
        if kind is None:
            self._run = end - 1
            self._starts.clear()
            return math.inf
        start = end - 3
        if start >= self._run:
            self._starts.add(start, best[start] - self._turns[start + 1])
        return SPAN + math.log10(47) + math.log10(2) + self._turns[end - 1] + self._starts.best(end)


def guess_cost(value: str, words: Words) -> float:
    """log10 of the guesses for ``value``; 0 for the empty value."""
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in itertools.chain(words.spans(value), _dates(value)):
        ending.setdefault(end, []).append((start, cost))
    runs = [_Walks(value), *(_Repeats(value, unit) for unit in range(1, LONGEST_UNIT + 1))]
    best, brute = [0.0], math.inf
    for end in range(1, len(value) + 1):
        brute = BRUTE + min(brute, best[-1] + SPAN)
        ways = [best[start] + SPAN + cost for start, cost in ending.get(end, ())]
        best.append(min([brute, *ways, *(run.cost(end, best) for run in runs)]))
    return best[-1]
