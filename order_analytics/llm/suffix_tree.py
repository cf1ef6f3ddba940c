"""Suffix trees from suffixes in order and what each shares with the one before it."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class SuffixTree(NamedTuple):
    """Nodes 0 to ``leaves - 1`` are the suffixes in order, those after them internal. ``depth`` is the number of symbols
    on the way to an internal node, all suffixes below it start with them. The root is its own parent, at depth -1.
    """

    leaves: int
    depth: np.ndarray
    parent: np.ndarray

    def climb(self, nodes: np.ndarray, least: int) -> np.ndarray:
        """Each node, or its parent where that is at least ``least`` deep."""
        above = self.parent[nodes]
        return np.where(self.depth[above] >= least, above, nodes)


def suffix_tree(shared: np.ndarray, longest: int) -> SuffixTree:
    """The tree of suffixes of at most ``longest`` symbols; ``shared`` counts what one has in common with the one before
    it, -1 where they are to have nothing but the root in common (also for the first).
    """
    leaves = len(shared)
    depth, parent = [longest + 1] * leaves + [-1], [leaves] * (leaves + 1)
    # internal nodes from the root to the parent of the last suffix
    path = [leaves]
    for leaf, common in enumerate(shared.tolist()):
        below = leaf - 1
        while depth[path[-1]] > common:
            if below >= 0:
                parent[below] = path[-1]
            below = path.pop()
        if depth[path[-1]] < common:
            depth.append(common)
            parent.append(path[-1])
            path.append(len(depth) - 1)
        if below >= 0:
            parent[below] = path[-1]
    below = leaves - 1
    while below >= 0 and path:
        parent[below] = path[-1]
        below = path.pop()
    parent[leaves] = leaves
    return SuffixTree(leaves, np.array(depth), np.array(parent))
