"""Minimal acyclic transducers: sorted terms in, each term's lexicographic ordinal out.

Terms come in ascending byte order.  States with the same future are one state, so the
terms share prefixes and suffixes.  An arc carries the number of terms that come before
it in its state; the sum along a term's path is its place among all terms.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Transducer:
    """Arcs sorted by state and byte; states that end a term are ``final``."""

    arcs: np.ndarray  # state * 256 + byte
    targets: np.ndarray
    outputs: np.ndarray
    final: np.ndarray
    root: int

    def ordinals(self, terms: Sequence[bytes]) -> np.ndarray:
        """The place of each term from 0 on, -1 for a term that is not in the vocabulary.

        All terms go through the arcs together, a byte each at a time; a term leaves
        when it has no further arc, so work follows the prefixes that are known.
        """
        data = np.frombuffer(b"".join(terms), np.uint8).astype(np.int64)
        sizes = np.array([len(term) for term in terms], np.int64)
        starts = np.cumsum(sizes) - sizes
        place = np.full(len(terms), -1, np.int64)
        live = np.arange(len(terms))
        state, total, step = np.full(len(terms), self.root), np.zeros(len(terms), np.int64), 0
        while len(live):
            ended = sizes[live] == step
            done = ended & self.final[state]
            place[live[done]] = total[done]
            live, state, total = live[~ended], state[~ended], total[~ended]
            if not len(live) or not len(self.arcs):
                break
            wanted = (state << 8) | data[starts[live] + step]
            at = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            found = self.arcs[at] == wanted
            live, at = live[found], at[found]
            state, total = self.targets[at].astype(np.int64), total[found] + self.outputs[at]
            step += 1
        return place

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, arcs=self.arcs, targets=self.targets, outputs=self.outputs, final=self.final, root=self.root)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Transducer:
        with np.load(io.BytesIO(data)) as held:
            return Transducer(held["arcs"], held["targets"], held["outputs"], held["final"], int(held["root"]))


class _Open:
    """A state on the path of the last term, which later terms may still add arcs to."""

    __slots__ = ("final", "arcs")

    def __init__(self):
        self.final, self.arcs = False, []


class _Frozen:
    """States that are complete, each once."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.terms: list[int] = []  # that start from each state
        self.final: list[bool] = []
        self.arcs: list[int] = []
        self.targets: list[int] = []
        self.outputs: list[int] = []

    def add(self, state: _Open) -> int:
        key = (state.final, *state.arcs)
        number = self.known.get(key)
        if number is not None:
            return number
        number = self.known[key] = len(self.final)
        before = int(state.final)
        for byte, target in state.arcs:
            self.arcs.append((number << 8) | byte)
            self.targets.append(target)
            self.outputs.append(before)
            before += self.terms[target]
        self.final.append(state.final)
        self.terms.append(before)
        return number


def build(terms: Iterable[bytes]) -> Transducer:
    """From terms in strictly ascending order; anything else ends the job."""
    frozen, path, last = _Frozen(), [_Open()], None

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            done = frozen.add(path.pop())
            path[-1].arcs.append((last[len(path) - 1], done))

    for term in terms:
        if last is not None and term <= last:
            raise ValueError("terms must ascend")
        shared = 0
        if last is not None:
            most = min(len(term), len(last))
            while shared < most and term[shared] == last[shared]:
                shared += 1
            close(shared)
        path.extend(_Open() for _ in range(len(term) - shared))
        path[-1].final = True
        last = term
    close(0)
    root = frozen.add(path[0])
    return Transducer(
        np.array(frozen.arcs, np.int64),
        np.array(frozen.targets, np.int32),
        np.array(frozen.outputs, np.int32),
        np.array(frozen.final, bool),
        root,
    )
