"""Terms within a few edits of a word: the Levenshtein automata of all terms, as one automaton over their trie.

A state is a set of (node of the trie, edits spent); a letter moves it to the set of all pairs it can lead to. Sets are made
when first met and remembered, so a word costs a look-up per letter and most words leave the trie after a few. Edits are a
letter put in, left out or replaced, and two neighbours swapped.
"""

from __future__ import annotations

MOST_STATES = 50_000


def allowed_edits(term: str) -> int:
    """Short terms have too many neighbours that are words of their own."""
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class Lexicon:
    def __init__(self, terms: list[str], most_states: int = MOST_STATES):
        self.terms, self._most = terms, most_states
        self._children: list[dict[str, int]] = [{}]
        self._term, self._room = [-1], [0]  # the term that ends in a node, the most edits of any below it
        for index, term in enumerate(terms):
            node, edits = 0, allowed_edits(term)
            self._room[0] = max(self._room[0], edits)
            for letter in term:
                if letter not in self._children[node]:
                    self._children[node][letter] = len(self._children)
                    self._children.append({})
                    self._term.append(-1)
                    self._room.append(0)
                node = self._children[node][letter]
                self._room[node] = max(self._room[node], edits)
            self._term[node] = index
        self._begin()

    def _begin(self) -> None:
        self._ids: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._moves: list[dict[str, int]] = []
        self._ends: list[tuple[int, int] | None] = []
        self._dead = self._state({})
        self._start = self._state({(0, ""): 0})

    def _state(self, reached: dict[tuple[int, str], int]) -> int:
        """The state of the pairs reached, with those that left-out letters lead to. A pair may wait for a swapped letter."""
        todo = list(reached.items())
        while todo:
            (node, waiting), edits = todo.pop()
            if waiting:
                continue
            for child in self._children[node].values():
                if edits < self._room[child] and edits + 1 < reached.get((child, ""), 99):
                    reached[child, ""] = edits + 1
                    todo.append(((child, ""), edits + 1))
        key = frozenset(reached.items())
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(key)
            self._moves.append({})
            ends = [(edits, self._term[node]) for (node, waiting), edits in key
                    if not waiting and self._term[node] >= 0 and edits <= allowed_edits(self.terms[self._term[node]])]
            self._ends.append(min(ends, default=None))
        return self._ids[key]

    def _move(self, state: int, letter: str) -> int:
        reached: dict[tuple[int, str], int] = {}

        def reach(node: int, waiting: str, edits: int) -> None:
            if edits <= self._room[node] and edits < reached.get((node, waiting), 99):
                reached[node, waiting] = edits

        for (node, waiting), edits in self._sets[state]:
            if waiting:
                if letter == waiting:
                    reach(node, "", edits)
                continue
            reach(node, "", edits + 1)  # a letter put in
            for own, child in self._children[node].items():
                reach(child, "", edits + (own != letter))
                if letter in self._children[child] and own != letter:
                    reach(self._children[child][letter], own, edits + 1)  # swapped: the first letter comes next
        return self._state(reached)

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, index of the term) of the nearest term within its allowed edits; of equals the first."""
        if len(self._sets) > self._most:
            self._begin()
        state = self._start
        for letter in word:
            moves = self._moves[state]
            state = moves[letter] if letter in moves else moves.setdefault(letter, self._move(state, letter))
            if state == self._dead:
                return None
        return self._ends[state]
