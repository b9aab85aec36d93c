"""Weighted finite-state transducers over small alphabets, and their composition.

An arc reads a symbol, writes one and has a weight; weights add up along a path. A machine
may guess: several arcs can read the same symbol, and only paths that end in a final state count.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

Arc = tuple[Hashable, str, float]  # next state, what is written, weight


@dataclass(frozen=True)
class Transducer:
    start: Hashable
    finals: frozenset
    arcs: Mapping[tuple[Hashable, str], tuple[Arc, ...]]

    @staticmethod
    def of(start: Hashable, finals: Iterable[Hashable], arcs: Iterable[tuple[Hashable, str, Hashable, str, float]]) -> Transducer:
        """From arcs (state, read, next state, written, weight)."""
        table: dict[tuple[Hashable, str], list[Arc]] = {}
        for state, read, after, written, weight in arcs:
            table.setdefault((state, read), []).append((after, written, weight))
        return Transducer(start, frozenset(finals), {k: tuple(v) for k, v in table.items()})

    def by_state(self) -> dict[Hashable, list[tuple[str, Arc]]]:
        out: dict[Hashable, list[tuple[str, Arc]]] = {}
        for (state, read), arcs in self.arcs.items():
            out.setdefault(state, []).extend((read, arc) for arc in arcs)
        return out

    def paths(self, symbols: Sequence[str]) -> Iterator[tuple[tuple[str, ...], float]]:
        """(what is written, weight) of every path that reads the symbols; there may be many."""
        todo = [(0, self.start, (), 0.0)]
        while todo:
            at, state, written, weight = todo.pop()
            if at == len(symbols):
                if state in self.finals:
                    yield written, weight
                continue
            for after, out, w in self.arcs.get((state, symbols[at]), ()):
                todo.append((at + 1, after, (*written, out), weight + w))


def _compose(a: Transducer, b: Transducer) -> Transducer:
    """What `a` writes is read by `b`: states are pairs, weights are added."""
    mine = a.by_state()
    start = (a.start, b.start)
    todo, seen, arcs = [start], {start}, []
    while todo:
        one, two = todo.pop()
        for read, (after, between, w) in mine.get(one, ()):
            for end, written, v in b.arcs.get((two, between), ()):
                arcs.append(((one, two), read, (after, end), written, w + v))
                if (after, end) not in seen:
                    seen.add((after, end))
                    todo.append((after, end))
    return _trimmed(Transducer.of(start, (s for s in seen if s[0] in a.finals and s[1] in b.finals), arcs))


def _trimmed(machine: Transducer) -> Transducer:
    """The same without states from which no final state is reached, and with numbers for states."""
    back: dict[Hashable, list[Hashable]] = {}
    for (state, _), arcs in machine.arcs.items():
        for after, _, _ in arcs:
            back.setdefault(after, []).append(state)
    todo, alive = list(machine.finals), set(machine.finals)
    while todo:
        for state in back.get(todo.pop(), ()):
            if state not in alive:
                alive.add(state)
                todo.append(state)
    number = {s: i for i, s in enumerate(sorted(alive | {machine.start}, key=repr))}
    kept = [(number[s], read, number[after], out, w) for (s, read), arcs in machine.arcs.items() if s in alive for after, out, w in arcs if after in alive]
    return Transducer.of(number[machine.start], (number[s] for s in machine.finals), kept)


def compose(*machines: Transducer) -> Transducer:
    """All machines in a row as one."""
    return reduce(_compose, machines)


class Reader:
    """Reads with a machine that has at most one path for any input, guesses and all."""

    def __init__(self, machine: Transducer):
        self.start, self.finals = machine.start, machine.finals
        self.table: dict[str, dict[Hashable, tuple[Arc, ...]]] = {}
        for (state, read), arcs in machine.arcs.items():
            self.table.setdefault(read, {})[state] = arcs

    def read(self, symbols: Iterable[str]) -> list[tuple[int, str, float]]:
        """(place, what is written, weight) where the path writes something; nothing without a path."""
        live: dict[Hashable, tuple | None] = {self.start: None}
        for at, symbol in enumerate(symbols):
            moves = self.table.get(symbol, {})
            after: dict[Hashable, tuple | None] = {}
            for state, path in live.items():
                for end, written, weight in moves.get(state, ()):
                    after[end] = (path, at, written, weight) if written else path
            live = after
        path = next((p for s, p in live.items() if s in self.finals), None)
        out = []
        while path is not None:
            path, at, written, weight = path
            out.append((at, written, weight))
        return out[::-1]
