"""An adaptive radix tree over byte strings.

Inner nodes change their layout with the number of their children: sorted
arrays of up to 4 or 16 key bytes, an index of 256 places into 48 children, or
256 children. A node stores the bytes that all keys below it share (path
compression), so a tree of n keys has fewer than n inner nodes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

_NONE = 255


class Sorted:
    """Up to ``size`` children, found by their key bytes in ascending order."""

    __slots__ = ("path", "value", "keys", "children", "size")

    def __init__(self, path: bytes, value: Any, size: int = 4):
        self.path, self.value, self.size = path, value, size
        self.keys, self.children = bytearray(), []

    def child(self, byte: int):
        at = bisect_left(self.keys, byte)
        return self.children[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, child) -> None:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.children[at] = child
        else:
            self.keys.insert(at, byte)
            self.children.insert(at, child)

    def full(self) -> bool:
        return len(self.keys) == self.size

    def grown(self):
        new = Sorted(self.path, self.value, 16) if self.size == 4 else Indexed(self.path, self.value)
        for byte, child in self.ordered():
            new.put(byte, child)
        return new

    def ordered(self) -> Iterator[tuple[int, Any]]:
        return zip(self.keys, self.children, strict=True)


class Indexed:
    """Up to 48 children behind an index of 256 places."""

    __slots__ = ("path", "value", "index", "children")

    def __init__(self, path: bytes, value: Any):
        self.path, self.value = path, value
        self.index, self.children = bytearray([_NONE]) * 256, []

    def child(self, byte: int):
        at = self.index[byte]
        return None if at == _NONE else self.children[at]

    def put(self, byte: int, child) -> None:
        at = self.index[byte]
        if at == _NONE:
            self.index[byte] = len(self.children)
            self.children.append(child)
        else:
            self.children[at] = child

    def full(self) -> bool:
        return len(self.children) == 48

    def grown(self):
        new = Direct(self.path, self.value)
        for byte, child in self.ordered():
            new.put(byte, child)
        return new

    def ordered(self) -> Iterator[tuple[int, Any]]:
        return ((byte, self.children[at]) for byte, at in enumerate(self.index) if at != _NONE)


class Direct:
    """A place for each of 256 children."""

    __slots__ = ("path", "value", "children")

    def __init__(self, path: bytes, value: Any):
        self.path, self.value = path, value
        self.children = [None] * 256

    def child(self, byte: int):
        return self.children[byte]

    def put(self, byte: int, child) -> None:
        self.children[byte] = child

    def full(self) -> bool:
        return False

    def ordered(self) -> Iterator[tuple[int, Any]]:
        return ((byte, child) for byte, child in enumerate(self.children) if child is not None)


class RadixTree:
    """Values under byte strings; a key may be the beginning of another."""

    def __init__(self):
        self.root: Any = None

    def insert(self, key: bytes, value: Any) -> None:
        """Put a value under a key, replacing what is there."""
        if self.root is None:
            self.root = Sorted(key, value)
            return
        node, parent, at = self.root, None, 0  # the rest of the key begins at ``at``
        while True:
            path = node.path
            if key.startswith(path, at):
                at += len(path)
                if at == len(key):
                    node.value = value
                    return
                below = node.child(key[at])
                if below is not None:
                    node, parent, at = below, (node, key[at]), at + 1
                    continue
                if node.full():
                    node = node.grown()
                    self._hang(parent, node)
                node.put(key[at], Sorted(key[at + 1 :], value))
                return
            # The key leaves the path: a node with the shared bytes takes its place.
            shared = _shared(path, key, at)
            fork = Sorted(path[:shared], None)
            below = path[shared]
            node.path = path[shared + 1 :]
            fork.put(below, node)
            if at + shared == len(key):
                fork.value = value
            else:
                fork.put(key[at + shared], Sorted(key[at + shared + 1 :], value))
            self._hang(parent, fork)
            return

    def _hang(self, parent: tuple[Any, int] | None, node: Any) -> None:
        if parent is None:
            self.root = node
        else:
            parent[0].put(parent[1], node)

    def get(self, key: bytes) -> Any:
        node, at = self.root, 0
        while node is not None and key.startswith(node.path, at):
            at += len(node.path)
            if at == len(key):
                return node.value
            node, at = node.child(key[at]), at + 1
        return None


def _shared(path: bytes, key: bytes, at: int) -> int:
    most = min(len(path), len(key) - at)
    for i in range(most):
        if path[i] != key[at + i]:
            return i
    return most


def climb(tree: RadixTree) -> Iterator[tuple[Any, bytes, int]]:
    """Every node after all nodes below it, with the whole key up to it and the
    depth in bytes at which it begins: the edge into it covers key[begin:].
    """
    if tree.root is None:
        return
    stack = [(tree.root, tree.root.path, 0, False)]
    while stack:
        node, key, begin, seen = stack.pop()
        if seen:
            yield node, key, begin
            continue
        stack.append((node, key, begin, True))
        for byte, child in node.ordered():
            stack.append((child, key + bytes([byte]) + child.path, len(key), False))
