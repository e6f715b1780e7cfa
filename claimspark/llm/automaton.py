"""Deterministic automata over bytes: regexes to one minimal transition table, run over many lanes at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Ends every text inside a scan; it occurs in no UTF-8 text and in no rule.
END = 0xFF


class _Nfa:
    """Thompson automaton: edges by byte set, and empty moves."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


class _Builder:
    """Reads a regex of literals, escapes, classes, groups, ``|`` and ``? * + {n} {n,}`` into an automaton."""

    def __init__(self, nfa: _Nfa, pattern: str, fold: str = ""):
        self.nfa, self.text, self.at, self.fold = nfa, pattern, 0, fold

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _escaped(self) -> int:
        c = self._take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def _class(self) -> frozenset[int]:
        out: set[int] = set()
        while (c := self._take()) != "]":
            low = self._escaped() if c == "\\" else ord(c)
            high = low
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                c = self._take()
                high = self._escaped() if c == "\\" else ord(c)
            out.update(range(low, high + 1))
        return frozenset(out)

    def _bytes(self) -> frozenset[int]:
        c = self._take()
        if c == "[":
            return self._class()
        b = self._escaped() if c == "\\" else ord(c)
        return frozenset({b, ord(chr(b).swapcase())} if self.ignore_case else {b})

    def _atom(self) -> tuple[int, int]:
        if self._peek() == "(":
            self.at += 1
            part = self._either()
            self.at += 1
            return part
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.edges[a].append((self._bytes(), b))
        return a, b

    def _repeated(self) -> tuple[int, int]:
        begin = self.at
        part = self._atom()
        end = self.at

        def again() -> tuple[int, int]:
            keep, self.at = self.at, begin
            copy = self._atom()
            self.at = keep
            return copy

        mark = self._peek()
        least, unbounded, optional = 1, False, False
        if mark in ("?", "*", "+") and mark:
            self.at += 1
            least, unbounded, optional = 1, mark != "?", mark != "+"
        elif mark == "{":
            close = self.text.index("}", self.at)
            least, _, more = self.text[self.at + 1:close].partition(",")
            unbounded = "," in self.text[self.at:close]
            if more:
                raise ValueError("only {n} and {n,} are read")
            least, self.at = int(least), close + 1
        assert end <= self.at
        first, last = part
        if unbounded and least == 1:
            self.nfa.empty[last].append(first)
        for i in range(1, least):
            a, b = again()
            self.nfa.empty[last].append(a)
            if unbounded and i == least - 1:
                self.nfa.empty[b].append(a)
            last = b
        if optional:
            a, b = self.nfa.state(), self.nfa.state()
            self.nfa.empty[a] += [first, b]
            self.nfa.empty[last].append(b)
            first, last = a, b
        return first, last

    def _series(self) -> tuple[int, int]:
        first = last = self.nfa.state()
        while self._peek() not in ("", "|", ")"):
            a, b = self._repeated()
            self.nfa.empty[last].append(a)
            last = b
        return first, last

    def _either(self) -> tuple[int, int]:
        parts = [self._series()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._series())
        if len(parts) == 1:
            return parts[0]
        a, b = self.nfa.state(), self.nfa.state()
        for first, last in parts:
            self.nfa.empty[a].append(first)
            self.nfa.empty[last].append(b)
        return a, b

    def build(self, ignore_case: bool) -> tuple[int, int]:
        self.ignore_case = ignore_case
        part = self._either()
        if self.at != len(self.text):
            raise ValueError(f"cannot read {self.text!r} at {self.at}")
        return part


@dataclass(frozen=True)
class Automaton:
    """``move[state, class_of[byte]]`` is the next state; ``accepts[state]`` has a bit for each rule that ends there."""

    class_of: np.ndarray
    move: np.ndarray
    accepts: np.ndarray


def compiled(rules: Sequence[tuple[str, bool]]) -> Automaton:
    """The minimal automaton that finds, in one pass, where matches of any rule end.

    ``rules`` are (regex, ignore letter case).  Subset construction starts
    anew at every byte; bytes that no rule tells apart share a column; states
    that no input tells apart are merged.  State 0 is the start.
    """
    nfa = _Nfa()
    start = nfa.state()
    ends: dict[int, int] = {}
    for bit, (pattern, ignore_case) in enumerate(rules):
        first, last = _Builder(nfa, pattern).build(ignore_case)
        nfa.empty[start].append(first)
        ends[last] = 1 << bit
    sets = list(dict.fromkeys(s for edges in nfa.edges for s, _ in edges))
    member = np.array([[b in s for s in sets] for b in range(256)], dtype=bool)
    _, representative, class_of = np.unique(member, axis=0, return_index=True, return_inverse=True)
    class_of = class_of.reshape(-1)

    origin = nfa.closure(frozenset({start}))
    number, states, rows = {origin: 0}, [origin], []
    for current in states:
        row = []
        for b in representative:
            to = {t for s in current for bytes_, t in nfa.edges[s] if b in bytes_}
            after = nfa.closure(frozenset(to)) | origin
            if after not in number:
                number[after] = len(states)
                states.append(after)
            row.append(number[after])
        rows.append(row)
    move = np.array(rows, dtype=np.int64)
    accepts = np.array([sum({ends[x] for x in s if x in ends}) for s in states], dtype=np.int64)

    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack((block, block[move])), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # Blocks are numbered by their first state, so the start stays 0.
    _, first = np.unique(block, return_index=True)
    order = np.argsort(first)
    rename = np.empty(len(order), dtype=np.int64)
    rename[order] = np.arange(len(order))
    kept = first[order]
    return Automaton(class_of.astype(np.uint8), rename[block[move[kept]]].astype(np.int32), accepts[kept])


def scan(automaton: Automaton, data: np.ndarray, offsets: np.ndarray, lanes: int = 4096
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, end in bytes, rule bits) of every position where a rule accepts.

    The texts are laid end to end and cut into lanes after bytes that lead
    from every state to the start, so a lane begins where the automaton
    would be at its start anyway.  All lanes step together.
    """
    n = len(offsets) - 1
    marks = offsets[1:] + np.arange(n)
    joined = np.empty(len(data) + n, dtype=np.uint8)
    inside = np.ones(len(joined), dtype=bool)
    inside[marks] = False
    joined[marks], joined[inside] = END, data
    resets = (automaton.move == 0).all(axis=0)
    columns = automaton.class_of[joined]
    cuts = np.flatnonzero(resets[columns]) + 1
    wanted = np.linspace(0, len(joined), min(lanes, len(joined) // 64 + 1) + 1)[1:-1]
    inner = cuts[np.minimum(np.searchsorted(cuts, wanted), len(cuts) - 1)] if len(cuts) else wanted[:0]
    begins = np.unique(np.concatenate(([0], inner))).astype(np.int64)
    lengths = np.diff(np.concatenate((begins, [len(joined)])))
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
    width = automaton.move.shape[1]
    flat = automaton.move.reshape(-1) * width
    bits = np.repeat(automaton.accepts, width)[::width]
    ending = np.zeros(len(flat), dtype=bool)
    ending[::width] = bits != 0
    state = np.zeros(len(begins), dtype=np.int64)
    at, found = [], []
    for step, count in enumerate(active.tolist()):
        state = flat[state[:count] + columns[begins[:count] + step]]
        hit = np.flatnonzero(ending[state])
        if len(hit):
            at.append(begins[hit] + step)
            found.append(bits[state[hit] // width])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, found = np.concatenate(at), np.concatenate(found)
    sort = np.argsort(at, kind="stable")
    at, found = at[sort], found[sort]
    text = np.searchsorted(marks, at)
    return text, at - text - offsets[text] + 1, found
