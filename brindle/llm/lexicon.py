"""A minimal acyclic transducer from words to token ids, in one flat file.

States with equal right languages are shared, so common suffixes are stored once. Each
edge holds how many words of its state come before it; the sum along a path numbers
the words in byte order, and the number selects the word's ids. Edges lie in the order
of (state, label), so one binary search finds an edge, and many words are followed at
once. The file is a few arrays one after another, meant to be memory-mapped: the
workers of a machine then share one copy.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterable, Sequence

import numpy as np

_MAGIC = b"LEXICON1"


def build(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The file for words (distinct, in ascending byte order) and their ids."""
    # a state under construction: [is_final, {label: state}], frozen states by signature
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    register: dict[tuple, int] = {}

    def freeze(node: list) -> int:
        signature = (node[0], tuple(node[1].items()))
        number = register.get(signature)
        if number is None:
            number = register[signature] = len(states)
            states.append(signature)
        return number

    path: list[list] = [[False, {}]]
    previous, ids, offsets = b"", [], [0]
    for word, output in entries:
        if word <= previous and offsets != [0]:
            raise ValueError("words must be distinct and in ascending byte order")
        shared = 0
        while shared < min(len(word), len(previous)) and word[shared] == previous[shared]:
            shared += 1
        while len(path) > shared + 1:
            node = path.pop()
            path[-1][1][previous[len(path) - 1]] = freeze(node)
        for _ in word[shared:]:
            path.append([False, {}])
        path[-1][0] = True
        previous = word
        ids.extend(output)
        offsets.append(len(ids))
    while len(path) > 1:
        node = path.pop()
        path[-1][1][previous[len(path) - 1]] = freeze(node)
    root = freeze(path[0])

    words_below: list[int] = []  # targets are always frozen before their sources
    keys, targets, skips = [], [], []
    for state, (final, edges) in enumerate(states):
        before = int(final)
        for label, target in edges:
            keys.append(state << 8 | label)
            targets.append(target)
            skips.append(before)
            before += words_below[target]
        words_below.append(before)
    parts = [
        np.array(keys, np.uint64).tobytes(),
        bytes(f for f, _ in states),
        np.array(targets, np.uint32).tobytes(),
        np.array(skips, np.uint32).tobytes(),
        np.array(offsets, np.uint32).tobytes(),
        np.array(ids, np.uint32).tobytes(),
    ]
    parts = [p + b"\0" * (-len(p) % 8) for p in parts]
    header = struct.pack("<8s5Q", _MAGIC, root, len(states), len(keys), len(offsets), len(ids))
    return header + b"".join(parts)


class Lexicon:
    """Lookups in a memory-mapped file made by ``build``."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        magic, self._root, n_states, n_edges, n_offsets, n_ids = struct.unpack_from("<8s5Q", self._map)
        if magic != _MAGIC:
            raise ValueError(f"not a lexicon: {path}")
        at = struct.calcsize("<8s5Q")

        def take(kind: type, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(self._map, kind, n, at)
            at += got.nbytes + -got.nbytes % 8
            return got

        self._keys = take(np.uint64, n_edges)
        self._final = take(np.uint8, n_states)
        self._targets = take(np.uint32, n_edges)
        self._skips = take(np.uint32, n_edges)
        self._offsets = take(np.uint32, n_offsets)
        self._ids = take(np.uint32, n_ids)

    def get_many(self, words: Sequence[bytes]) -> list[np.ndarray | None]:
        """The ids of each word, or None for a word that is not in it."""
        size = np.array([len(w) for w in words], np.int64)
        if not len(self._keys) or not len(words):
            return [None] * len(words)
        letters = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        state = np.full(len(words), self._root, np.uint64)
        number = np.zeros(len(words), np.int64)
        found = size > 0
        for i in range(int(size.max())):
            going = np.flatnonzero(found & (size > i))
            if not len(going):
                break
            key = state[going] << np.uint64(8) | letters[start[going] + i].astype(np.uint64)
            edge = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            held = self._keys[edge] == key
            found[going[~held]] = False
            going, edge = going[held], edge[held]
            number[going] += self._skips[edge]
            state[going] = self._targets[edge]
        found &= self._final[state.astype(np.int64)] > 0
        return [
            self._ids[self._offsets[n] : self._offsets[n + 1]] if hit else None
            for n, hit in zip(number.tolist(), found.tolist())
        ]
