"""An adaptive radix tree over byte strings: resizable node layouts, compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to `room` (4, then 16) edge bytes in order, beside their children."""

    __slots__ = ("room", "edges", "children")

    def __init__(self, room: int = 4):
        self.room, self.edges, self.children = room, bytearray(), []

    def get(self, edge: int):
        at = self.edges.find(edge)
        return None if at < 0 else self.children[at]

    def put(self, edge: int, child):
        """The layout that holds the new child: this one, or the next larger if it is full."""
        if len(self.edges) == self.room:
            larger = Sorted(16) if self.room == 4 else Indexed()
            for own in self.items():
                larger = larger.put(*own)
            return larger.put(edge, child)
        at = bisect_left(self.edges, edge)
        self.edges.insert(at, edge)
        self.children.insert(at, child)
        return self

    def items(self) -> Iterator[tuple]:
        return zip(self.edges, self.children)


class Indexed:
    """Up to 48 children; a table of 256 bytes says where the child of an edge byte stands."""

    __slots__ = ("slots", "children")
    ROOM, FREE = 48, 255

    def __init__(self):
        self.slots, self.children = bytearray([self.FREE]) * 256, []

    def get(self, edge: int):
        at = self.slots[edge]
        return None if at == self.FREE else self.children[at]

    def put(self, edge: int, child):
        if len(self.children) == self.ROOM:
            larger = Direct()
            for own in self.items():
                larger.put(*own)
            return larger.put(edge, child)
        self.slots[edge] = len(self.children)
        self.children.append(child)
        return self

    def items(self) -> Iterator[tuple]:
        return ((edge, self.children[at]) for edge, at in enumerate(self.slots) if at != self.FREE)


class Direct:
    """One place for each of the 256 edge bytes."""

    __slots__ = ("children",)

    def __init__(self):
        self.children = [None] * 256

    def get(self, edge: int):
        return self.children[edge]

    def put(self, edge: int, child):
        self.children[edge] = child
        return self

    def items(self) -> Iterator[tuple]:
        return ((edge, child) for edge, child in enumerate(self.children) if child is not None)


class Node:
    """`path`: the bytes all keys below share from here on. `row`: a row some key below came from."""

    __slots__ = ("path", "layout", "row", "sums", "least", "ends")

    def __init__(self, path: bytes, row, sums: list, least: int):
        self.path, self.row, self.sums, self.least = path, row, sums, least
        self.layout, self.ends = Sorted(), None


class RadixTree:
    """Sums and a minimum over the keys below every node; `ends` lists the ids of keys that end at it."""

    def __init__(self):
        self.root: Node | None = None
        self.keys = 0

    def insert(self, key: bytes, row, sums: list, least: int, ends: list | None) -> None:
        self.keys += 1
        if self.root is None:
            self.root = Node(key, row, list(sums), least)
            self.root.ends = ends
            return
        node, at = self.root, 0
        while True:
            path = node.path
            if key.startswith(path, at):
                same = len(path)
            else:
                same = next((i for i, (a, b) in enumerate(zip(path, key[at : at + len(path)])) if a != b), len(key) - at)
                lower = Node(path[same + 1 :], node.row, node.sums, node.least)
                lower.layout, lower.ends = node.layout, node.ends
                node.path, node.sums, node.ends = path[:same], list(node.sums), None
                node.layout = Sorted().put(path[same], lower)
            node.sums = [a + b for a, b in zip(node.sums, sums)]
            node.least = min(node.least, least)
            at += same
            if at == len(key):
                node.ends = (node.ends or []) + ends if ends else node.ends
                return
            child = node.layout.get(key[at])
            if child is None:
                child = Node(key[at + 1 :], row, list(sums), least)
                child.ends = ends
                node.layout = node.layout.put(key[at], child)
                return
            node, at = child, at + 1

    def aligned(self, width: int) -> Iterator[tuple[int, Node, bool]]:
        """(depth, node, whether it is the node's own end) for every byte depth that `width` divides, the root's empty prefix left out."""
        stack = [(self.root, 0)] if self.root else []
        while stack:
            node, above = stack.pop()  # `above`: bytes up to and with the edge into the node
            end = above + len(node.path)
            first = above if above and above % width == 0 else above - above % width + width
            for depth in range(first, end + 1, width):
                yield depth // width, node, depth == end
            stack.extend((child, end + 1) for _, child in node.layout.items())
