"""Rule regexes compiled into one deterministic automaton over bytes, as transition arrays.

Literals, ``\\xHH`` and escaped characters, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{n}`` and ``{n,}`` are read into an
automaton with empty moves (Thompson); subset construction makes it deterministic, with a fresh start at every byte,
and partition refinement minimises it. Bytes that no rule tells apart share a column.
"""

from __future__ import annotations

import numpy as np


class _Nfa:
    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1


def _letters(c: int, fold: bool) -> frozenset[int]:
    both = {c} | ({c ^ 32} if fold and chr(c).isascii() and chr(c).isalpha() else set())
    return frozenset(both)


class _Reader:
    """Recursive descent over a pattern; each method returns (first, last) state."""

    def __init__(self, nfa: _Nfa, pattern: str):
        self.nfa, self.p, self.i, self.fold = nfa, pattern, 0, False

    def peek(self) -> str:
        return self.p[self.i : self.i + 1]

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def choice(self) -> tuple[int, int]:
        first, last = self.nfa.state(), self.nfa.state()
        while True:
            a, b = self.sequence()
            self.nfa.empty[first].append(a)
            self.nfa.empty[b].append(last)
            if self.peek() != "|":
                return first, last
            self.take()

    def sequence(self) -> tuple[int, int]:
        first = last = self.nfa.state()
        while self.peek() not in ("", "|", ")"):
            a, b = self.repeated()
            self.nfa.empty[last].append(a)
            last = b
        return first, last

    def repeated(self) -> tuple[int, int]:
        start = self.i
        a, b = self.single()
        end, mark = self.i, self.peek()
        if mark in ("?", "*", "+") and mark:
            self.take()
            return self.loop(a, b, mark != "+", mark != "?")
        if mark == "{":
            body = self.p[self.i + 1 : self.p.index("}", self.i)]
            after = self.i + len(body) + 2
            least, comma, most = body.partition(",")
            if most:
                raise ValueError(f"no upper bounds: {self.p}")
            first = last = self.nfa.state()
            for k in range(int(least)):
                self.i = start
                a, b = self.single() if k else (a, b)
                self.nfa.empty[last].append(a)
                last = b
            if comma:
                self.i = start
                a, b = self.loop(*self.single(), True, True)
                self.nfa.empty[last].append(a)
                last = b
            self.i = after
            return first, last
        self.i = end
        return a, b

    def loop(self, a: int, b: int, skip: bool, again: bool) -> tuple[int, int]:
        first, last = self.nfa.state(), self.nfa.state()
        self.nfa.empty[first].append(a)
        self.nfa.empty[b].append(last)
        if skip:
            self.nfa.empty[first].append(last)
        if again:
            self.nfa.empty[b].append(a)
        return first, last

    def single(self) -> tuple[int, int]:
        c = self.take()
        if c == "(":
            before = self.fold
            if self.p.startswith("?i:", self.i):
                self.i, self.fold = self.i + 3, True
            elif self.p.startswith("?:", self.i):
                self.i += 2
            found = self.choice()
            self.take()
            self.fold = before
            return found
        if c == "[":
            return self.step(self.members())
        return self.step(_letters(self.escaped() if c == "\\" else ord(c), self.fold))

    def escaped(self) -> int:
        c = self.take()
        if c != "x":
            return ord(c)
        self.i += 2
        return int(self.p[self.i - 2 : self.i], 16)

    def members(self) -> frozenset[int]:
        negated, found = self.peek() == "^", set()
        self.i += negated
        while self.peek() != "]":
            c = self.take()
            low = self.escaped() if c == "\\" else ord(c)
            high = low
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else ord(c)
            for x in range(low, high + 1):
                found |= _letters(x, self.fold)
        self.take()
        return frozenset(range(256)) - found if negated else frozenset(found)

    def step(self, letters: frozenset[int]) -> tuple[int, int]:
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.moves[a].append((letters, b))
        return a, b


class Automaton:
    """``columns[byte]`` picks a column; ``moves[state * width + column]`` is the next state; ``accepts[state]`` has
    bit k set where rule k ends; state 0 is idle: nothing that has been read can still become part of a match."""

    def __init__(self, patterns: list[str]):
        nfa = _Nfa()
        start, ends = nfa.state(), {}
        for k, pattern in enumerate(patterns):
            reader = _Reader(nfa, pattern)
            first, last = reader.choice()
            if reader.i != len(pattern):
                raise ValueError(f"can't read {pattern!r} from {reader.i} on")
            nfa.empty[start].append(first)
            ends[last] = k
        self.columns, samples = self._columns(nfa)
        self.width = len(samples)
        moves, accepts = self._subsets(nfa, start, ends, samples)
        self.built = len(moves)
        moves, accepts = self._minimised(moves, accepts)
        self.states = len(moves)
        self.moves = moves.astype(np.int32).ravel()
        self._next = self.moves * self.width  # where the row of the next state begins
        self.accepts = accepts

    @staticmethod
    def _columns(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
        sets = sorted({letters for row in nfa.moves for letters, _ in row}, key=sorted)
        kinds: dict[tuple[bool, ...], int] = {}
        samples, columns = [], np.zeros(256, dtype=np.int32)
        for byte in range(256):
            kind = tuple(byte in s for s in sets)
            if kind not in kinds:
                kinds[kind] = len(samples)
                samples.append(byte)
            columns[byte] = kinds[kind]
        return columns, samples

    @staticmethod
    def _subsets(nfa: _Nfa, start: int, ends: dict[int, int], samples: list[int]) -> tuple[np.ndarray, np.ndarray]:
        def closed(state: int) -> frozenset[int]:
            found, todo = {state}, [state]
            while todo:
                for nxt in nfa.empty[todo.pop()]:
                    if nxt not in found:
                        found.add(nxt)
                        todo.append(nxt)
            # Only states that read a byte or end a rule tell subsets apart.
            return frozenset(s for s in found if nfa.moves[s] or s in ends)

        idle = closed(start)
        reached = [[frozenset().union(*[closed(b) for letters, b in row if sample in letters]) for sample in samples] for row in nfa.moves]
        fresh = [idle.union(*[reached[s][c] for s in idle]) for c in range(len(samples))]
        number, order, table = {idle: 0}, [idle], []
        for subset in order:
            row, own = [], [reached[s] for s in subset - idle]
            for c in range(len(samples)):
                nxt = fresh[c].union(*[r[c] for r in own])
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row.append(number[nxt])
            table.append(row)
        accepts = np.array([sum({1 << ends[s] for s in subset if s in ends}) for subset in order], dtype=np.int64)
        return np.array(table), accepts

    @staticmethod
    def _minimised(moves: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, part = np.unique(accepts, return_inverse=True)
        # The idle state stands alone: it says where stretches end.
        part = np.where(np.arange(len(moves)) == 0, part.max() + 1, part)
        count = len(np.unique(part))
        while True:
            _, part = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)
            part = part.ravel()
            if (now := len(np.unique(part))) == count:
                break
            count = now
        first = np.array([np.flatnonzero(part == k)[0] for k in range(count)])
        order = np.argsort(first)  # keeps the idle state at 0
        rank = np.empty(count, dtype=np.int64)
        rank[order] = np.arange(count)
        first = first[order]
        return rank[part[moves[first]]], accepts[first]

    def scan(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The state after each byte of ``data``, read in lanes that each begin idle; all lanes move one byte a step."""
        states = np.zeros(len(data), dtype=np.int32)
        column = self.columns[data]
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        now = np.zeros(len(starts), dtype=np.int32)
        live = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
        for k, n in enumerate(live):
            at = starts[:n] + k
            now = self._next[now[:n] + column[at]]
            states[at] = now
        return states // self.width
