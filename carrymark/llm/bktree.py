"""BK-tree over 64-bit fingerprints: children keyed by Hamming distance to the parent."""

from __future__ import annotations

from collections.abc import Iterable


class BKTree:
    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near_then_add(self, value: int, radius: int) -> list[int]:
        """Positions of earlier values within ``radius``; then adds ``value``.

        One walk serves both: the search follows every edge whose distance differs
        from the parent's by at most the radius, and the new node's own path (the
        edge of exactly that distance) is among those.
        """
        found, position = [], len(self.values)
        self.values.append(value)
        self.children.append({})
        if not position:
            return found
        stack, parent = [0], 0
        while stack:
            node = stack.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            edges = self.children[node]
            if node == parent:
                if distance in edges:
                    parent = edges[distance]
                else:
                    edges[distance] = position
                    parent = -1
            for edge in range(max(0, distance - radius), distance + radius + 1):
                child = edges.get(edge)
                if child is not None and child != position:
                    stack.append(child)
        return found


def links(values: Iterable[int], radius: int) -> list[tuple[int, int]]:
    """(value, first value of its group) for every value linked to an earlier one.

    Groups are closed under links within the radius, so the pairs are as many as
    the values at most, however many of them are near one another.
    """
    tree, first = BKTree(), []

    def find(i: int) -> int:
        while first[i] != i:
            first[i] = first[first[i]]
            i = first[i]
        return i

    for i, value in enumerate(values):
        first.append(i)
        for j in tree.near_then_add(value, radius):
            a, b = find(i), find(j)
            first[max(a, b)] = min(a, b)
    return [(tree.values[i], tree.values[find(i)]) for i in range(len(first)) if find(i) != i]
