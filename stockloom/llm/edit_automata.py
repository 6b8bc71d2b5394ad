"""Minimised acceptors of short strings, and their composition with a one-edit transducer.

Rows of strings are grouped; a group's strings are the language of one initial state. States
with the same right language are one state, so groups with the same strings share their initial
state and are composed once. A state knows how many strings it accepts, so a path of labels is the
number of its string among the sorted strings of its group. All initial states advance level by
level in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from stockloom.llm.textwords import mix


@dataclass
class Level:
    """Transitions of the states of one depth, sorted by state and label."""

    begin: np.ndarray  # of each state, one entry more than states
    label: np.ndarray
    target: np.ndarray
    offset: np.ndarray  # strings of the state that come before this transition's
    key: np.ndarray  # state * 256 + label

    def out(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, transition) for every transition of the state in each row."""
        size = self.begin[state + 1] - self.begin[state]
        row = np.repeat(np.arange(len(state)), size)
        before = np.cumsum(size) - size
        return row, np.arange(len(row)) + np.repeat(self.begin[state] - before, size)

    def find(self, state: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows whose state goes on by their label, the transition)."""
        want = state * 256 + label
        at = np.searchsorted(self.key, want)
        good = np.flatnonzero(at < len(self.key))
        good = good[self.key[at[good]] == want[good]]
        return good, at[good]


def _classes(begin: np.ndarray, size: np.ndarray, label: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(state of each node, a node of each state): nodes with equal transitions are one state.

    Nodes are told apart by a hash of their transitions, which is then compared in full; in the
    unheard-of case that two differ under one hash, another hash is taken.
    """
    code = label.astype(np.uint64) | child.astype(np.uint64) << np.uint64(8)
    position = np.arange(len(label)) - np.repeat(begin, size)
    salt = 0
    while True:
        salt += 1
        token = mix(code + np.array([salt], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        total = np.add.reduceat(token, begin) if len(begin) else np.zeros(0, np.uint64)
        _, first, state = np.unique(total, return_index=True, return_inverse=True)
        like = first[state]  # a node of the same state
        if (size == size[like]).all():
            twin = np.repeat(begin[like], size) + position
            if (code == code[twin]).all():
                return state.astype(np.int64), first


def minimised(strings: np.ndarray, group: np.ndarray, groups: int) -> tuple[list[Level], np.ndarray]:
    """(levels, initial state of each group or -1) of sorted distinct rows per group.

    ``strings``: a matrix of bytes, one row per string; ``group`` does not decrease.
    """
    n, width = strings.shape
    new = np.ones(n, bool)
    new[1:] = group[1:] != group[:-1]
    firsts = [np.flatnonzero(new)]  # rows at which the nodes of each depth begin
    for depth in range(width):
        new[1:] |= strings[1:, depth] != strings[:-1, depth]
        firsts.append(np.flatnonzero(new))
    levels: list[Level] = []
    state, accepts = np.zeros(len(firsts[width]), np.int64), np.ones(1, np.int64)
    for depth in range(width - 1, -1, -1):
        inner = firsts[depth + 1]  # one transition per node of the next depth
        label = strings[inner, depth].astype(np.int64)
        begin = np.searchsorted(inner, firsts[depth])
        size = np.diff(np.append(begin, len(inner)))
        child = state
        state, one = _classes(begin, size, label, child)
        wide = size[one]
        start = np.concatenate([[0], np.cumsum(wide)])
        row = np.repeat(np.arange(len(one)), wide)
        edge = np.arange(len(row)) + np.repeat(begin[one] - start[:-1], wide)
        many = accepts[child[edge]]
        before = np.cumsum(many) - many
        levels.insert(0, Level(start, label[edge], child[edge], before - before[start[:-1]][row],
                               row * 256 + label[edge]))
        accepts = np.bincount(row, many, len(one)).astype(np.int64)
    initial = np.full(groups, -1, np.int64)
    initial[group[firsts[0]]] = state
    return levels, initial


def replaced(levels: list[Level], initial: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(initial state's index, string, string): pairs that differ in exactly one label."""
    start, state = np.arange(len(initial)), initial
    at = np.zeros(len(initial), np.int64)
    one = tuple(np.zeros(0, np.int64) for _ in range(5))  # start, states and numbers after the edit
    for level in levels:
        # After the edit both sides read the same label.
        row, edge = level.out(one[1])
        good, other = level.find(one[2][row], level.label[edge])
        row, edge = row[good], edge[good]
        on = (one[0][row], level.target[edge], level.target[other],
              one[3][row] + level.offset[edge], one[4][row] + level.offset[other])
        # The edit: two labels of one state; later ones of the same state follow the first.
        row, edge = level.out(state)
        later = level.begin[state[row] + 1] - edge - 1
        first = np.repeat(np.arange(len(row)), later)
        second = edge[first] + 1 + np.arange(len(first)) - np.repeat(np.cumsum(later) - later, later)
        first, row2 = edge[first], row[first]
        new = (start[row2], level.target[first], level.target[second],
               at[row2] + level.offset[first], at[row2] + level.offset[second])
        one = tuple(np.concatenate(x) for x in zip(on, new, strict=True))
        # No edit so far: both sides are in one state.
        start, state, at = start[row], level.target[edge], at[row] + level.offset[edge]
    return one[0], one[3], one[4]


def inserted(short: list[Level], long: list[Level], p: np.ndarray, q: np.ndarray, last: np.ndarray):
    """(index, string of ``short``, string of ``long``): pairs that differ by one inserted label.

    ``p``, ``q``: initial states of both acceptors; strings of ``long`` have one label more. The
    inserted label differs from the next label of the short string, so a pair has one path; a
    label behind the whole short string is an insertion only where ``last`` is set.
    """
    zero = np.zeros(len(p), np.int64)
    none = (np.arange(len(p)), p, q, zero, zero)
    one = tuple(np.zeros(0, np.int64) for _ in range(5))

    def same(now, a: Level, b: Level):
        row, edge = a.out(now[1])
        good, other = b.find(now[2][row], a.label[edge])
        row, edge = row[good], edge[good]
        return (now[0][row], a.target[edge], b.target[other],
                now[3][row] + a.offset[edge], now[4][row] + b.offset[other])

    for depth, level in enumerate(short):
        on = same(one, level, long[depth + 1])
        row, extra = long[depth].out(none[2])  # the inserted label
        again, edge = level.out(none[1][row])  # the next label of both
        row, extra = row[again], extra[again]
        good = np.flatnonzero(level.label[edge] != long[depth].label[extra])
        row, extra, edge = row[good], extra[good], edge[good]
        good, other = long[depth + 1].find(long[depth].target[extra], level.label[edge])
        row, extra, edge = row[good], extra[good], edge[good]
        new = (none[0][row], level.target[edge], long[depth + 1].target[other],
               none[3][row] + level.offset[edge],
               none[4][row] + long[depth].offset[extra] + long[depth + 1].offset[other])
        one = tuple(np.concatenate(x) for x in zip(on, new, strict=True))
        none = same(none, level, long[depth])
    keep = np.flatnonzero(last[none[0]])
    row, edge = long[len(short)].out(none[2][keep])
    row = keep[row]
    return (np.concatenate([one[0], none[0][row]]), np.concatenate([one[3], none[3][row]]),
            np.concatenate([one[4], none[4][row] + long[len(short)].offset[edge]]))
