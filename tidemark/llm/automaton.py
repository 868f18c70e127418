"""Suffix automaton over sequences of words, with the smallest owner of every substring."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """All substrings of the sequences added; each state stands for substrings that end at the same places."""

    def __init__(self):
        self.next: list[dict[Hashable, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner: list[float | int] = [float("inf")]

    def _state(self, length: int, link: int, after: dict, owner) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, word: Hashable, q: int) -> int:
        """The state for the substrings of ``q`` that are one word longer than those of ``p``; made if ``q`` holds longer ones too."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), float("inf"))
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: Iterable[Hashable], owner: int) -> None:
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
            else:
                new = self._state(self.length[last] + 1, 0, {}, owner)
                p = last
                while p != -1 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p != -1:
                    self.link[new] = self._split(p, word, self.next[p][word])
                last = new
            self.owner[last] = min(self.owner[last], owner)

    def close(self) -> None:
        """Pass the owners on from longer substrings to their suffixes. To be called once, after the last sequence."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            above = self.link[state]
            if self.owner[state] < self.owner[above]:
                self.owner[above] = self.owner[state]

    def spans(self, words: Sequence[Hashable], size: int, before: int) -> list[tuple[int, int]]:
        """Maximal stretches covered by runs of ``size`` words that a sequence of an owner below ``before`` has too.

        The matching statistic of a place is the longest run ending there that the automaton knows.
        """
        out: list[tuple[int, int]] = []
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            else:
                matched = 0
            if matched < size:
                continue
            # The state of exactly the last ``size`` words: all places where these occur, whatever stands before them.
            while self.length[self.link[state]] >= size:
                state = self.link[state]
                matched = self.length[state]
            if self.owner[state] < before:
                begin = i + 1 - size
                if out and begin <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((begin, i + 1))
        return out
