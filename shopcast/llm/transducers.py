"""Small deterministic weighted transducers over marks, and their composition.

A machine reads one mark after another; an arc gives the next state, the
mark it writes and a weight.  ``compose(a, b)`` lets ``b`` read what ``a``
writes: its states are the pairs that can be reached, its arcs write what
``b`` writes and add both weights.  Missing arcs keep the state and copy the
mark, without weight.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Machine:
    """``arcs``: (state, mark) -> (next state, mark written, weight)."""

    start: object
    arcs: dict = field(default_factory=dict)

    def step(self, state, mark):
        return self.arcs.get((state, mark), (state, mark, 0.0))

    def run(self, marks: Iterable) -> tuple[list, float]:
        """The marks written and the sum of the weights."""
        state, out, total = self.start, [], 0.0
        for mark in marks:
            state, written, weight = self.step(state, mark)
            out.append(written)
            total += weight
        return out, total


def machine(start, marks: Iterable, arc: Callable) -> Machine:
    """All states that ``arc(state, mark) -> (next, written, weight)``
    reaches from ``start``."""
    marks, arcs, todo, seen = tuple(marks), {}, [start], {start}
    while todo:
        state = todo.pop()
        for mark in marks:
            arcs[state, mark] = arc(state, mark)
            if arcs[state, mark][0] not in seen:
                seen.add(arcs[state, mark][0])
                todo.append(arcs[state, mark][0])
    return Machine(start, arcs)


def compose(a: Machine, b: Machine, marks: Iterable) -> Machine:
    """``b`` after ``a``, over the input ``marks``."""
    def arc(state, mark):
        x, between, w = a.step(state[0], mark)
        y, written, v = b.step(state[1], between)
        return (x, y), written, w + v
    return machine((a.start, b.start), marks, arc)
