"""Deep-shallow sorting of fixed-width byte strings that begin inside classes.

Shallow: multikey quicksort, eight bytes at a time, splits every group into smaller, equal and larger at once; the equal
part goes on with the next eight bytes. Deep: what is still together at the shallow depth has long common prefixes. A blind
trie orders it: an internal node knows only the first byte at which its strings differ, a new string goes down blindly, is
compared once with the leaf that it reaches, and is hung in at the depth where the two differ.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class _Node:
    __slots__ = ("children", "depth")

    def __init__(self, depth: int) -> None:
        self.depth, self.children = depth, {}


def common_prefix(a: bytes, b: bytes) -> int:
    if a == b:
        return len(a)
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (differ.bit_length() + 7) // 8


def blind_trie_order(strings: Sequence[bytes]) -> list[int]:
    """Places of equally long strings in sorted order; equal ones as they came."""
    root: _Node | list[int] = [0]  # a leaf lists equal strings
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while isinstance(node, _Node):
            node = node.children.get(s[node.depth]) or next(iter(node.children.values()))
        depth = common_prefix(s, strings[node[0]])
        if depth == len(s):
            node.append(i)
            continue
        met, above, node, edge = strings[node[0]], None, root, -1
        while isinstance(node, _Node) and node.depth < depth:
            above, edge = node, s[node.depth]
            node = node.children[edge]
        if isinstance(node, _Node) and node.depth == depth:
            node.children[s[depth]] = [i]
            continue
        split = _Node(depth)
        split.children = {met[depth]: node, s[depth]: [i]}
        if above is None:
            root = split
        else:
            above.children[edge] = split
    order: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack.extend(node.children[b] for b in sorted(node.children, reverse=True))
        else:
            order.extend(node)
    return order


def deep_shallow_order(rows: np.ndarray, classes: np.ndarray, shallow: int) -> np.ndarray:
    """Places of ``rows`` (n by a multiple of 8 bytes) sorted by class, then bytes; ``shallow`` is a depth in bytes."""
    n, width = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    limit = min(-(-shallow // 8), words.shape[1])
    order = np.argsort(classes, kind="stable")
    sorted_classes = classes[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_classes[1:] != sorted_classes[:-1]])) if n else np.zeros(0, np.int64)
    group = np.repeat(starts, np.diff(np.append(starts, n)))  # where each place's group begins
    depth = np.zeros(n, np.int64)
    while True:
        size = np.bincount(group, minlength=n)[group] if n else group
        open_ = np.flatnonzero((size > 1) & (depth < limit))
        if not len(open_):
            break
        word = words[order[open_], depth[open_]]
        pivot = words[order[group[open_] + size[open_] // 2], depth[open_]]
        side = 1 + (word > pivot).astype(np.int64) - (word < pivot)
        key = group[open_] * 3 + side
        moved = np.argsort(key, kind="stable")
        order[open_] = order[open_][moved]
        key, side = key[moved], side[moved]
        depth[open_] = depth[open_][moved] + (side == 1)
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group[open_] = open_[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
    if limit * 8 < width:
        for at in np.unique(group[size > 1]) if n else ():
            part = slice(at, at + int(size[at]))
            strings = [rows[i].tobytes() for i in order[part]]
            order[part] = order[part][blind_trie_order(strings)]
    return order


def neighbours_prefix(rows: np.ndarray, classes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each place in ``order`` with the one before; -1 where a class begins."""
    if not len(order):
        return np.zeros(0, np.int64)
    differ = rows[order[1:]] != rows[order[:-1]]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    prefix[classes[order[1:]] != classes[order[:-1]]] = -1
    return np.concatenate([[-1], prefix])
