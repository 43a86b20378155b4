"""A generalised suffix automaton over words, in flat arrays.

While it grows, a state keeps one transition in two arrays and only states
with several have a dictionary.  Grown, the transitions of a state are a range
of sorted word numbers that is searched by bisection, and the windows that end
in a state are a range of groups: about 60 bytes a word of the items in all,
beside the dictionary of their different words.
"""

from __future__ import annotations

import sys
from array import array
from bisect import bisect_left
from collections.abc import Iterable

import numpy as np


class _Growing:
    """States, suffix links, lengths and transitions; the root's are an array by word number."""

    def __init__(self):
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.root: array = array("i")
        self.word, self.next = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}

    def get(self, state: int, word: int) -> int:
        """The state after ``word``, 0 for none (no transition leads to the root)."""
        if not state:
            return self.root[word]
        if self.word[state] == word:
            return self.next[state]
        several = self.more.get(state)
        return several.get(word, 0) if several else 0

    def put(self, state: int, word: int, after: int) -> None:
        if not state:
            self.root[word] = after
        elif self.word[state] in (-1, word):
            self.word[state], self.next[state] = word, after
        else:
            self.more.setdefault(state, {})[word] = after

    def extend(self, last: int, word: int) -> int:
        old = self.get(last, word)
        if old:
            return old if self.length[old] == self.length[last] + 1 else self._clone(last, old, word)
        new, state = self._state(self.length[last] + 1, 0), last
        while state >= 0:
            old = self.get(state, word)
            if old:
                self.link[new] = old if self.length[old] == self.length[state] + 1 else self._clone(state, old, word)
                break
            self.put(state, word, new)
            state = self.link[state]
        return new

    def _clone(self, state: int, old: int, word: int) -> int:
        copy = self._state(self.length[state] + 1, self.link[old])
        self.word[copy], self.next[copy] = self.word[old], self.next[old]
        if old in self.more:
            self.more[copy] = dict(self.more[old])
        self.link[old] = copy
        while state >= 0 and self.get(state, word) == old:
            self.put(state, word, copy)
            state = self.link[state]
        return copy

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(-1)
        self.next.append(0)
        return len(self.length) - 1

    def transitions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State, word and next state of each, by state and word; the root has one for every word."""
        word, after = (np.frombuffer(a, dtype=np.int32) for a in (self.word, self.next))
        one = np.flatnonzero(word >= 0)
        owner = [np.zeros(len(self.root), np.int32), one.astype(np.int32)]
        words, nexts = [np.arange(len(self.root), dtype=np.int32), word[one]], [np.array(self.root, np.int32), after[one]]
        some = sum(map(len, self.more.values()))
        owner.append(np.repeat(np.fromiter(self.more, np.int32, len(self.more)),
                               np.fromiter(map(len, self.more.values()), np.int64, len(self.more))))
        words.append(np.fromiter((w for d in self.more.values() for w in d), np.int32, some))
        nexts.append(np.fromiter((n for d in self.more.values() for n in d.values()), np.int32, some))
        owner, words, nexts = (np.concatenate(c) for c in (owner, words, nexts))
        order = np.lexsort((words, owner))
        return owner[order], words[order], nexts[order]


def _flat(values: np.ndarray) -> array:
    return array("i", np.ascontiguousarray(values, dtype=np.int32).tobytes())


def _starts(sorted_values: np.ndarray, n: int) -> array:
    """Where the range of each of ``0 .. n - 1`` begins, and the end."""
    return _flat(np.searchsorted(sorted_values, np.arange(n + 1)))


class Automaton:
    """The automaton of ``(key, words)`` items, with the windows of their words.

    A window is ``window`` consecutive words of an item, or a whole shorter
    item; an item without words has none.
    """

    def __init__(self, items: Iterable[tuple], window: int):
        self.ids: dict[bytes, int] = {}
        self.keys, numbers = [], []
        grown = _Growing()
        for key, words in items:
            if not words:
                continue
            own = array("i", [self.ids.setdefault(word, len(self.ids)) for word in words])
            grown.root.extend([0] * (len(self.ids) - len(grown.root)))
            state = 0
            for word in own:
                state = grown.extend(state, word)
            self.keys.append(key)
            numbers.append(own)
        self._place_windows(grown, numbers, window)
        owner, words, nexts = grown.transitions()
        self.link, self.length = grown.link, grown.length
        self.first, self.word, self.next = _starts(owner, len(self.length)), _flat(words), _flat(nexts)

    def _place_windows(self, grown: _Growing, numbers: list[array], window: int) -> None:
        """Groups of items by the state in which a window ends and its size; ``near`` is the next state with any."""
        link, length = grown.link, grown.length
        states, sizes, members = array("i"), array("i"), array("i")
        for item, own in enumerate(numbers):
            size, state = min(window, len(own)), 0
            for place, word in enumerate(own, 1):
                state = grown.get(state, word)
                while length[link[state]] >= size:
                    state = link[state]
                if place >= size:
                    states.append(state)
                    sizes.append(size)
                    members.append(item)
        state, size, member = (np.array(a, dtype=np.int32) for a in (states, sizes, members))
        order = np.lexsort((member, size, state))
        state, size, member = state[order], size[order], member[order]
        fresh = np.ones(len(state), dtype=bool)
        fresh[1:] = (state[1:] != state[:-1]) | (size[1:] != size[:-1])
        again = np.zeros(len(state), dtype=bool)
        again[1:] = ~fresh[1:] & (member[1:] == member[:-1])
        group = (np.cumsum(fresh) - 1)[~again]
        self.sizes, self.members = _flat(size[fresh]), _flat(member[~again])
        self.groups, self.group = _starts(state[fresh], len(length)), _starts(group, len(self.sizes))
        self.shortest = min(self.sizes, default=0)
        ends = np.zeros(len(length), dtype=bool)
        ends[state] = True
        self.near = array("i", bytes(4 * len(length)))
        for at in np.argsort(np.frombuffer(length, dtype=np.int32), kind="stable")[1:].tolist():
            self.near[at] = at if ends[at] else self.near[link[at]]

    def n_bytes(self) -> int:
        """Memory that the automaton holds, its different words included."""
        arrays = sum(sys.getsizeof(a) for a in vars(self).values() if isinstance(a, array))
        return arrays + sys.getsizeof(self.ids) + sum(sys.getsizeof(word) + 32 for word in self.ids) + 64 * len(self.keys)

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Maximal runs ``[start, end)`` of hit words, and the items hit."""
        ids, first, own, nexts = self.ids, self.first, self.word, self.next
        link, lengths, near, shortest = self.link, self.length, self.near, self.shortest
        spans, items, state, size = [], set(), 0, 0
        for place, spelled in enumerate(words, 1):
            word = ids.get(spelled)
            if word is None:
                state = size = 0
                continue
            while state:
                high = first[state + 1]
                at = bisect_left(own, word, first[state], high)
                if at < high and own[at] == word:
                    state, size = nexts[at], size + 1
                    break
                state = link[state]
                size = lengths[state]
            else:
                # The root's transitions come first, one for every word.
                state, size = nexts[word], 1
            if size < shortest or not near[state]:
                continue
            longest, mark = 0, near[state]
            while mark:
                for group in range(self.groups[mark], self.groups[mark + 1]):
                    if self.sizes[group] <= size:
                        longest = max(longest, self.sizes[group])
                        items.update(self.members[self.group[group]:self.group[group + 1]])
                mark = near[link[mark]]
            if longest:
                start = place - longest
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, place])
        return spans, {self.keys[item] for item in items}
