"""Double-array tries over sequences of 64-bit word ids, walked for all positions of a text at once.

A word's number in the trie's vocabulary (found by open addressing) is written as two digits of about the square root of the vocabulary, so
a node has at most that many children and one step per digit: ``next = base[state] + digit``, valid where
``check[next] == state``. Nodes with many children get a row of slots each; the others are dealt into free slots at
random places, larger ones first, all of a round at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDE = 16  # children from which a node gets a row of its own
_ROOT = 0


@dataclass
class DoubleArray:
    table: np.ndarray  # word ids by open addressing; free places hold the id of another place
    numbers: np.ndarray  # number of the word in each place, -1 if free
    high: np.ndarray  # first and second digit of each number
    low: np.ndarray
    base: np.ndarray
    check: np.ndarray
    leaf: np.ndarray  # number of the sequence that ends in a slot, or -1

    def ids(self) -> np.ndarray:
        """Word ids by number."""
        used = np.flatnonzero(self.numbers >= 0)
        out = np.empty(len(used), np.int64)
        out[self.numbers[used]] = self.table[used]
        return out

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, -1 if it has none."""
        mask = len(self.table) - 1
        place = ids & mask
        code = np.where(self.table[place] == ids, self.numbers[place], -1)
        left = np.flatnonzero((self.table[place] != ids) & (self.numbers[place] >= 0))
        place = place[left]
        while len(left):
            place = (place + 1) & mask
            equal = self.table[place] == ids[left]
            code[left[equal]] = self.numbers[place[equal]]
            go_on = ~equal & (self.numbers[place] >= 0)
            left, place = left[go_on], place[go_on]
        return code

    def walk(self, code: np.ndarray, piece: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, states) of all places where ``length`` words of one piece lead through the trie."""
        at = np.flatnonzero(code >= 0)
        state = np.full(len(at), _ROOT, np.int64)
        for level in range(length):
            if level:
                inside = at + level < len(code)
                at, state = at[inside], state[inside]
                inside = (piece[at + level] == piece[at]) & (code[at + level] >= 0)
                at, state = at[inside], state[inside]
            for digit in self.high, self.low:
                slot = self.base[state] + digit[code[at + level]]
                known = self.check[slot] == state
                at, state = at[known], slot[known].astype(np.int64)
        return at, state


def _open_addressing(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, numbers) of a table of at least twice as many places."""
    size = 1 << int(2 * len(ids)).bit_length()
    table, numbers = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    left = np.arange(len(ids))
    place = ids & (size - 1)
    while len(left):
        free = numbers[place] < 0
        first = np.zeros(len(left), bool)
        first[np.unique(place, return_index=True)[1]] = True
        won = free & first
        table[place[won]], numbers[place[won]] = ids[left[won]], left[won]
        left, place = left[~won], (place[~won] + 1) & (size - 1)
    return table, numbers


def _nodes(sequences: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(parent, digit, child) of every edge, and the node of each sequence. The root is 0."""
    at, count = np.zeros(len(sequences), np.int64), 1
    parents, digits, children = [], [], []
    width = int(sequences.max(initial=0)) + 1
    for digit in sequences.T:
        key, inverse = np.unique(at * width + digit, return_inverse=True)
        parents.append(key // width)
        digits.append(key % width)
        children.append(count + np.arange(len(key)))
        at = count + inverse
        count += len(key)
    return np.concatenate(parents), np.concatenate(digits), np.concatenate(children), at


def _bases(parent: np.ndarray, digit: np.ndarray, nodes: int, width: int) -> tuple[np.ndarray, int]:
    """Base of every node such that no two edges share a slot, and the number of slots. Slot 0 is the root's."""
    degree = np.bincount(parent, minlength=nodes)
    base = np.zeros(nodes, np.int64)
    wide = np.flatnonzero(degree > WIDE)
    base[wide] = 1 + width * np.arange(len(wide))
    slots = 1 + width * len(wide) + 4 * len(parent) + width
    taken = np.zeros(slots, bool)
    taken[0] = True
    placed = degree[parent] > WIDE
    taken[base[parent[placed]] + digit[placed]] = True
    rng = np.random.default_rng(7)
    order = np.lexsort((digit, parent, -degree[parent]))
    order = order[~placed[order]]
    rounds = 0
    while len(order):
        own, step = parent[order], digit[order]
        first = np.concatenate(([True], own[1:] != own[:-1]))
        start = np.flatnonzero(first)
        spread = np.cumsum(first) - 1
        drawn = rng.integers(1, slots - width, len(start))
        slot = drawn[spread] + step
        claim = np.zeros(len(slot), bool)
        claim[np.unique(slot, return_index=True)[1]] = True
        won = np.logical_and.reduceat(claim & ~taken[slot], start)
        base[own[start[won]]] = drawn[won]
        taken[slot[won[spread]]] = True
        order = order[~won[spread]]
        rounds += 1
        if rounds % 50 == 0:
            taken = np.concatenate((taken, np.zeros(slots, bool)))
            slots *= 2
    return base, slots


def build(ids: np.ndarray) -> DoubleArray:
    """Trie of the rows of ``ids`` (sequences of equal length); leaves carry the row numbers."""
    vocabulary, code = np.unique(ids, return_inverse=True)
    code = code.reshape(ids.shape)
    digits = max(1, int(np.ceil(np.sqrt(len(vocabulary)))))
    pairs = np.empty((ids.shape[0], 2 * ids.shape[1]), np.int64)
    pairs[:, 0::2], pairs[:, 1::2] = code // digits, code % digits
    parent, digit, child, ends = _nodes(pairs)
    nodes = int(child.max(initial=0)) + 1
    base, slots = _bases(parent, digit, nodes, digits)
    slot = np.zeros(nodes, np.int64)
    slot[child] = base[parent] + digit
    number = np.arange(len(vocabulary))
    shape = (np.full(slots + digits, -1, np.int32) for _ in range(3))
    table = DoubleArray(*_open_addressing(vocabulary), number // digits, number % digits, *shape)
    table.base[slot] = base
    table.check[slot[child]] = slot[parent]
    table.leaf[slot[ends]] = np.arange(len(ids))
    return table
