"""An adaptive radix tree over byte keys (Leis et al. 2013): inner nodes grow with their fan-out, single paths are compressed."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Node:
    """A compressed path, an optional value where it ends, and children by their next byte.

    Four layouts by fan-out: up to 4 and up to 16 children, sorted bytes beside the children; up to 48, an index of 256 bytes
    into the children; beyond, a child for each byte.
    """

    __slots__ = ("path", "value", "room", "bytes", "kids")

    def __init__(self, path: bytes, value: int | None = None):
        self.path, self.value, self.room = path, value, 4
        self.bytes, self.kids = bytearray(), []

    def find(self, byte: int) -> Node | None:
        if self.room <= 16:
            at = bisect_left(self.bytes, byte)
            return self.kids[at] if at < len(self.bytes) and self.bytes[at] == byte else None
        if self.room == 48:
            return self.kids[self.bytes[byte] - 1] if self.bytes[byte] else None
        return self.kids[byte]

    def add(self, byte: int, kid: Node) -> None:
        if self.room < 256 and len(self.kids) == self.room:
            self.grow()
        if self.room <= 16:
            at = bisect_left(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.room == 48:
            self.kids.append(kid)
            self.bytes[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray(256)
            for slot, byte in enumerate(self.bytes):
                index[byte] = slot + 1
            self.room, self.bytes = 48, index
        else:
            self.room, self.kids, self.bytes = 256, [self.kids[slot - 1] if slot else None for slot in self.bytes], bytearray()

    def children(self) -> Iterator[Node]:
        """In the order of their bytes."""
        if self.room == 48:
            return (self.kids[slot - 1] for slot in self.bytes if slot)
        return (kid for kid in self.kids if kid is not None)

    def split(self, at: int) -> None:
        """The path ends after ``at`` bytes from now on; what stood here moves one node down."""
        lower = Node(self.path[at + 1 :], self.value)
        lower.room, lower.bytes, lower.kids = self.room, self.bytes, self.kids
        byte = self.path[at]
        self.path, self.value, self.room, self.bytes, self.kids = self.path[:at], None, 4, bytearray(), []
        self.add(byte, lower)


def shared(a: bytes, b: bytes) -> int:
    """How many bytes two keys share at their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] equals b[:low], a[:high] does not equal b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def insert(root: Node, key: bytes, value: int) -> None:
    node, at = root, 0
    while True:
        n = len(node.path) if key.startswith(node.path, at) else shared(node.path, key[at : at + len(node.path)])
        if n < len(node.path):
            node.split(n)
        at += n
        if at == len(key):
            node.value = value
            return
        kid = node.find(key[at])
        if kid is None:
            node.add(key[at], Node(key[at + 1 :], value))
            return
        node, at = kid, at + 1


def tree(keys: list[bytes]) -> Node:
    """The tree of distinct keys, each with its number as value."""
    root = Node(keys[0], 0) if keys else Node(b"")
    for number, key in enumerate(keys[1:], 1):
        insert(root, key, number)
    return root
