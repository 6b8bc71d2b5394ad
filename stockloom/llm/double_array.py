"""A trie in two arrays, built and walked by numpy for many keys and positions at once.

State s goes by label c to t = base[s] + c if check[t] == s. A key's end is label 0; the entry it
leads to holds the key's number. Labels are below WIDTH.
"""

from __future__ import annotations

import numpy as np

WIDTH = 258
END = 0


def _nodes(flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, label, leaf node of each key) of sorted distinct keys; node 0 is the root.

    Nodes are numbered level by level, so the children of a node lie side by side.
    """
    lengths = np.diff(first)
    rows = np.flatnonzero(lengths > 0)
    at = np.zeros(len(lengths), np.int64)  # the node that each key has reached
    parents, labels, n, depth = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1, 0
    while len(rows):
        label, node = flat[first[rows] + depth], at[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (node[1:] != node[:-1]) | (label[1:] != label[:-1])
        parents.append(node[new])
        labels.append(label[new].astype(np.int64))
        at[rows] = n + np.cumsum(new) - 1
        n += int(new.sum())
        depth += 1
        rows = rows[lengths[rows] > depth]
    return np.concatenate(parents), np.concatenate(labels), at


def build(flat: np.ndarray, first: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(base, check) of sorted distinct keys; key i is flat[first[i]:first[i + 1]] and ends in END.

    States with many children are placed first, many at a time: each tries a random base, those
    whose entries are free and asked for by no earlier state take them. States with one child
    fill the entries that are left.
    """
    parent, label, leaf = _nodes(flat, first)
    n = len(parent)
    degree = np.bincount(parent[1:], minlength=n)
    begin = np.concatenate([[1], 1 + np.cumsum(degree)])  # children of node i: begin[i] on
    rng = np.random.default_rng(seed)
    size = int(1.3 * n) + 4 * WIDTH
    used = np.zeros(size, bool)
    used[0] = True
    base = np.zeros(n, np.int64)
    many = np.flatnonzero(degree > 1)
    many = many[np.argsort(-degree[many], kind="stable")]
    least = WIDTH
    while len(many):
        least //= 2
        count = int(np.searchsorted(-degree[many], -least, "right")) if least > 1 else len(many)
        left, many = many[:count], many[count:]
        rounds = 0
        while len(left):
            rounds += 1
            if rounds % 40 == 0:  # too full for these
                used = np.concatenate([used, np.zeros(len(used) // 4, bool)])
            trial = rng.integers(0, len(used) - WIDTH, len(left))
            wide = degree[left]
            owner = np.repeat(np.arange(len(left)), wide)
            child = np.arange(wide.sum()) + np.repeat(begin[left] - np.concatenate([[0], np.cumsum(wide)[:-1]]), wide)
            slot = trial[owner] + label[child]
            free = np.bincount(owner, used[slot], len(left)) == 0
            keep = free[owner]
            _, winner = np.unique(slot[keep], return_index=True)
            lost = np.ones(int(keep.sum()), bool)
            lost[winner] = False
            good = free & (np.bincount(owner[keep], lost, len(left)) == 0)
            base[left[good]] = trial[good]
            used[slot[good[owner]]] = True
            left = left[~good]
    single = np.flatnonzero(degree == 1)
    spare = np.flatnonzero(~used[WIDTH:])
    if len(spare) < len(single):
        used = np.concatenate([used, np.zeros(len(single) - len(spare), bool)])
        spare = np.flatnonzero(~used[WIDTH:])
    taken = spare[: len(single)] + WIDTH
    base[single] = taken - label[begin[single]]

    slot = base[parent] + label
    slot[0] = 0
    bases = np.zeros(len(used) + WIDTH, np.int32)
    checks = np.full(len(used) + WIDTH, -1, np.int32)
    bases[slot] = base
    checks[slot[1:]] = slot[parent[1:]]
    bases[slot[leaf]] = np.arange(len(leaf))
    return bases, checks


def start(base: np.ndarray, check: np.ndarray, labels: list[int]) -> int:
    """The state behind ``labels``, -1 if there is none."""
    state = 0
    for c in labels:
        after = int(base[state]) + c
        if check[after] != state:
            return -1
        state = after
    return state


def walk(base: np.ndarray, check: np.ndarray, text: np.ndarray, at: np.ndarray, state: np.ndarray,
         stops: np.ndarray, shift: int, weight: np.ndarray | None = None) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Numbers of all keys met from the positions ``at`` of ``text``, in no order; with ``weight``
    also the weight of the position from which each was met.

    All positions advance together, one byte at a level; a byte b has label b + shift. A key is
    met where its end falls before a byte marked in ``stops``. The text must end in such a byte
    that no key holds.
    """
    met, weights = [], []
    alive = state >= 0
    at, state = at[alive], state[alive]
    weight = weight[alive] if weight is not None else None
    while len(at):
        byte = text[at]
        stop = stops[byte]
        if stop.any():
            here = state[stop]
            end = base[here] + END
            ends = check[end] == here
            if ends.any():
                met.append(base[end[ends]])
                if weight is not None:
                    weights.append(weight[stop][ends])
        after = base[state] + byte + shift
        good = check[after] == state
        at, state = at[good] + 1, after[good]
        weight = weight[good] if weight is not None else None
    numbers = np.concatenate(met) if met else np.zeros(0, np.int32)
    if weight is None:
        return numbers
    return numbers, np.concatenate(weights) if weights else np.zeros(0, weight.dtype)
