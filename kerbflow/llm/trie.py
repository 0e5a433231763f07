"""Self-join of a binary trie: values that differ in few bits, and spanning forests of the pairs."""

from __future__ import annotations

import numpy as np


def trie_pairs(values: np.ndarray, budget: int, bits: int = 64, cuts: np.ndarray | None = None) -> np.ndarray:
    """Index pairs (i < j) of sorted distinct unsigned values that differ in at most `budget` bits.

    A node of the binary trie is a range of the sorted values that agree in their leading bits. Pairs of nodes go down
    together, one bit a level; a pair that has used up more than the budget is dropped with all below it. With `cuts`
    (first places of groups, and the end) values are sorted inside each group, and only pairs of one group are returned:
    each group has a trie of its own, and all of them go down together.
    """
    n = len(values)
    low, high = (cuts[:-1][np.diff(cuts) > 1], cuts[1:][np.diff(cuts) > 1]) if cuts is not None else (np.array([0]), np.array([n]))
    nodes = [low, high, low, high, np.zeros(len(low), np.int64)]  # low and high of both nodes, differing bits so far
    for level in range(bits - 1, -1, -1):
        low_a, high_a, low_b, high_b, used = nodes
        bit = np.concatenate([[0], np.cumsum((values >> np.uint64(level)) & np.uint64(1)).astype(np.int64)])
        # In a node the values with a zero in this bit come first.
        mid_a, mid_b = high_a - (bit[high_a] - bit[low_a]), high_b - (bit[high_b] - bit[low_b])
        same = (low_a == low_b) & (high_a == high_b)
        below = [(low_a, mid_a, low_b, mid_b, used), (mid_a, high_a, mid_b, high_b, used),
                 (low_a, mid_a, mid_b, high_b, used + 1),
                 (mid_a[~same], high_a[~same], low_b[~same], mid_b[~same], used[~same] + 1)]
        nodes = [np.concatenate(column) for column in zip(*below)]
        low_a, high_a, low_b, high_b, used = nodes
        alone = (low_a == low_b) & (high_a == high_b) & (high_a - low_a == 1)
        stay = (high_a > low_a) & (high_b > low_b) & (used <= budget) & ~alone
        nodes = [column[stay] for column in nodes]
        if not len(nodes[0]):
            break
    return np.column_stack([np.minimum(nodes[0], nodes[2]), np.maximum(nodes[0], nodes[2])])


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that suffice to connect what `pairs` connect: fewer than there are ends."""
    above, kept = {}, []
    for a, b in pairs.tolist():
        while (up := above.get(a, a)) != a:
            above[a] = a = above.get(up, up)
        while (up := above.get(b, b)) != b:
            above[b] = b = above.get(up, up)
        if a != b:
            above[max(a, b)] = min(a, b)
            kept.append((a, b))
    return kept
