"""Adaptive radix trees over keys of fixed-width parts.

A node holds the bytes that all its keys share from its start on (path compression) and its
children by their next byte, in the smallest of four layouts that takes them: up to 4 or 16
children in order, up to 48 behind an index of 256 bytes, or 256 slots. A key may be a beginning of
others; its value is at the node where it ends.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Children in the order of their bytes: the layouts for few."""

    __slots__ = ("size", "keys", "nodes")

    def __init__(self, size: int) -> None:
        self.size, self.keys, self.nodes = size, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = bisect_left(self.keys, byte)
        return self.nodes[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, node: Node) -> Layout:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.keys) == self.size:
            return moved(self, Sorted(16) if self.size < 16 else Indexed()).put(byte, node)
        self.keys.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.nodes)


class Indexed:
    """Up to 48 children in the order of their arrival, behind an index by byte."""

    __slots__ = ("index", "nodes")

    def __init__(self) -> None:
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        return self.nodes[self.index[byte] - 1] if self.index[byte] else None

    def put(self, byte: int, node: Node) -> Layout:
        if self.index[byte]:
            self.nodes[self.index[byte] - 1] = node
            return self
        if len(self.nodes) == 48:
            return moved(self, Full()).put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[k - 1]) for b, k in enumerate(self.index) if k)


class Full:
    """A slot for each byte."""

    __slots__ = ("nodes",)

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Layout:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


Layout = Sorted | Indexed | Full


def moved(old: Layout, new: Layout) -> Layout:
    for byte, node in old.items():
        new = new.put(byte, node)
    return new


class Node:
    """`path`: the bytes from the parent's end to this node's end, the branching byte included."""

    __slots__ = ("path", "children", "value", "sums")

    def __init__(self, path: bytes, value=None) -> None:
        self.path, self.children, self.value, self.sums = path, None, value, None

    def put(self, node: Node) -> None:
        layout = self.children or Sorted(4)
        self.children = layout.put(node.path[0], node)

    def below(self) -> list[Node]:
        """The children by their byte."""
        return [n for _, n in self.children.items()] if self.children else []


class RadixTree:
    """Keys with values; the root's path is empty."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        """Add `key`; one that is there gets the new value."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                node.put(Node(key[at:], value))
                return
            path = child.path
            if key.startswith(path, at):
                node, at = child, at + len(path)
                continue
            same, most = 1, min(len(path), len(key) - at)
            while same < most and path[same] == key[at + same]:
                same += 1
            fork = Node(path[:same])
            child.path = path[same:]
            fork.put(child)
            node.put(fork)
            node, at = fork, at + same
        node.value = value
