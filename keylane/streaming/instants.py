"""The pending instants of a key, ordered, in keyed state: each operation touches at most four small entries."""

from __future__ import annotations

from collections.abc import Iterator

#: Seconds are 32 bits, eight to a level; a node is one bit for each of 256 children.
LEVELS, BITS = 4, 8
NODE_BYTES = (1 << BITS) // 8


class Instants:
    """A set of whole seconds as a tree of bitmaps in a map state from (level, prefix) to bits.

    A node says which of its 256 children hold anything; those of the last level
    are the seconds themselves. Adding, removing and finding the first are walks
    down one path, whatever the number of instants. Nodes are read when first
    needed and written back by :meth:`save`.
    """

    def __init__(self, state) -> None:
        self.state = state
        self.nodes: dict[tuple[int, int], int] = {}
        self.changed: set[tuple[int, int]] = set()
        self.wiped = False

    def _node(self, name: tuple[int, int]) -> int:
        if name not in self.nodes:
            found = None if self.wiped else self.state.getValue(name)
            self.nodes[name] = 0 if found is None else int.from_bytes(found[0], "little")
        return self.nodes[name]

    def _put(self, name: tuple[int, int], bits: int) -> None:
        self.nodes[name] = bits
        self.changed.add(name)

    @staticmethod
    def _place(second: int, level: int) -> tuple[tuple[int, int], int]:
        """The node of a level on the way to a second, and the bit to follow there."""
        prefix = second >> BITS * (LEVELS - 1 - level)
        return (level, prefix >> BITS), 1 << (prefix & (1 << BITS) - 1)

    def add(self, second: int) -> None:
        for level in reversed(range(LEVELS)):
            name, bit = self._place(second, level)
            held = self._node(name)
            if not held & bit:
                self._put(name, held | bit)
            if held:  # the way down to this node is there already
                return

    def discard(self, second: int) -> None:
        if second not in self:
            return
        for level in reversed(range(LEVELS)):
            name, bit = self._place(second, level)
            left = self._node(name) & ~bit
            self._put(name, left)
            if left:
                return

    def __contains__(self, second: int) -> bool:
        name, bit = self._place(second, LEVELS - 1)
        return bool(self._node(name) & bit)

    def first(self) -> int | None:
        prefix = 0
        for level in range(LEVELS):
            held = self._node((level, prefix))
            if not held:
                return None
            prefix = prefix << BITS | (held & -held).bit_length() - 1
        return prefix

    def clear(self) -> None:
        self.nodes, self.changed, self.wiped = {}, set(), True

    def __iter__(self) -> Iterator[int]:
        """All instants in order."""
        yield from self._below(0, 0)

    def _below(self, level: int, prefix: int) -> Iterator[int]:
        held = self._node((level, prefix))
        while held:
            low = held & -held
            held ^= low
            child = prefix << BITS | low.bit_length() - 1
            if level == LEVELS - 1:
                yield child
            else:
                yield from self._below(level + 1, child)

    def save(self) -> None:
        if self.wiped:
            self.state.clear()
        for name in sorted(self.changed):
            bits = self.nodes[name]
            if bits:
                self.state.updateValue(name, (bits.to_bytes(NODE_BYTES, "little"),))
            elif not self.wiped:
                self.state.removeKey(name)
        self.changed, self.wiped = set(), False
