"""A multiway hyperplane tree over integer vectors that answers windows of scores.

A node has some split points; each of its rows goes to the nearest. For every split point and every
subtree the node stores the least and greatest distance between that point and the subtree's rows, and
for every subtree the range of its rows' norms. A window of inner products with a query is, over a
range of norms, an annulus of distances around the query. By the triangle inequality a subtree can
hold a row of the annulus only if, for each split point, the annulus meets what the point's distance to the
query and its range to the subtree allow. Subtrees that fail for one point are left out; leaves
compare all their rows with the queries that reach them, exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from tonnage.llm.vectors import check_width, products

#: Split points of a node, and rows up to which a node is a leaf.
FAN = 12
LEAF = 96
#: Of so many random rows for each split point, those far from each other are taken.
CANDIDATES = 3
#: Distances are compared with this much tolerance, relative to the norms.
SLACK = 1e-7
#: A row's number in its block takes so many bits of a key, below the score.
NUMBER_BITS = 16
NONE = np.iinfo(np.int64).min
WIDE = 1 << 46


def norms(x: np.ndarray) -> np.ndarray:
    """Squared length of each row."""
    return np.einsum("ij,ij->i", x, x)


def distances(points: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distance of each row of x to each point."""
    square = norms(x)[:, None] + norms(points)[None, :] - 2 * products(x, points)
    return np.sqrt(np.maximum(square, 0).astype(np.float64))


def split_points(x: np.ndarray, fan: int, rng: np.random.Generator) -> np.ndarray:
    """Up to fan rows of x far from each other: each the farthest from those before among some random rows."""
    some = x[rng.choice(len(x), min(len(x), CANDIDATES * fan), replace=False)]
    far = distances(some, some)
    picked, nearest = [0], far[0]
    while len(picked) < fan and nearest.max() > 0:
        picked.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, far[picked[-1]])
    return some[picked]


@dataclass
class Split:
    """Split points with, for each point and subtree, the range of distances, and each subtree's range of norms.

    A subtree without rows has empty ranges, and nothing reaches it.
    """

    points: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray
    least_norm: np.ndarray
    most_norm: np.ndarray

    @classmethod
    def empty(cls, points: np.ndarray) -> Split:
        n = len(points)
        return cls(points, np.full((n, n), np.inf), np.full((n, n), -np.inf), np.full(n, np.inf), np.full(n, -np.inf))

    def widen(self, far: np.ndarray, subtree: np.ndarray, x: np.ndarray) -> None:
        """Let the ranges cover rows x of the given subtrees, whose distances to the points are far."""
        square = norms(x)
        for j in np.unique(subtree).tolist():
            mine = subtree == j
            self.nearest[:, j] = np.minimum(self.nearest[:, j], far[mine].min(axis=0))
            self.farthest[:, j] = np.maximum(self.farthest[:, j], far[mine].max(axis=0))
            self.least_norm[j] = min(self.least_norm[j], square[mine].min())
            self.most_norm[j] = max(self.most_norm[j], square[mine].max())

    def reached(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which subtrees may hold a row with a product in a window of the query's: queries by subtrees.

        low and high are the windows of each query; one with low above high is no window.
        """
        far = distances(self.points, q)
        # The ranges of distances that the split points leave for each subtree's rows.
        least = np.full((len(q), len(self.points)), 0.0)
        most = np.full((len(q), len(self.points)), np.inf)
        for i in range(len(self.points)):
            to = far[:, i : i + 1]
            np.maximum(least, np.maximum(to - self.farthest[i], self.nearest[i] - to), out=least)
            np.minimum(most, to + self.farthest[i], out=most)
        square = norms(q).astype(np.float64)[:, None]
        slack = SLACK * (1 + np.sqrt(square) + np.sqrt(np.maximum(self.most_norm, 0)))
        out = np.zeros(least.shape, bool)
        for w in range(low.shape[1]):
            outer = square + self.most_norm - 2.0 * low[:, w : w + 1]
            inner = square + self.least_norm - 2.0 * high[:, w : w + 1]
            meets = (outer >= -slack) & (np.sqrt(np.maximum(outer, 0)) >= least - slack)
            meets &= np.sqrt(np.maximum(inner, 0)) <= most + slack
            out |= meets & (low[:, w] <= high[:, w])[:, None]
        return out & np.isfinite(self.least_norm)


@dataclass
class Node:
    rows: np.ndarray
    labels: np.ndarray
    split: Split | None = None
    children: list[Node] = field(default_factory=list)


@dataclass
class Queries:
    """Vectors with labels, the number of each one's own row or -1, and their windows of scores.

    same tells whether rows of the query's label are wanted, or of the others. best holds, for each
    window, keys of the best rows so far: the score, then the complement of the row's number.
    """

    x: np.ndarray
    label: np.ndarray
    own: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int

    def __post_init__(self):
        self.best = np.full((*self.low.shape, self.k), NONE)

    def floor(self, some: np.ndarray) -> np.ndarray:
        """The least score that still counts in each window: equal ones may win by their number."""
        worst = self.best[some].min(axis=2)
        return np.where(worst == NONE, self.low[some], np.maximum(self.low[some], worst >> NUMBER_BITS))


class Tree:
    """The tree of one block of rows x with labels, in order of their names."""

    def __init__(self, x: np.ndarray, label: np.ndarray):
        if len(x) > 1 << NUMBER_BITS:
            raise ValueError(f"a block holds {len(x)} rows, more than {1 << NUMBER_BITS}")
        self.x, self.label = x, label
        self.rng = np.random.Generator(np.random.PCG64(len(x)))
        self.root = self._node(np.arange(len(x)))
        self.compared = 0

    def _node(self, rows: np.ndarray) -> Node:
        node = Node(rows, np.unique(self.label[rows]))
        if len(rows) <= LEAF:
            return node
        points = split_points(self.x[rows], FAN, self.rng)
        far = distances(points, self.x[rows])
        child = np.argmin(far, axis=1)
        # Rows that cannot be told apart stay together, however many.
        if len(points) > 1 and np.bincount(child).max() < len(rows):
            node.split = Split.empty(points)
            node.split.widen(far, child, self.x[rows])
            node.children = [self._node(rows[child == j]) for j in range(len(points))]
        return node

    def search(self, queries: Queries) -> None:
        """Fill in queries.best."""
        if check_width(self.x, queries.x) >= WIDE:
            raise OverflowError(f"inner products beyond {WIDE} do not fit beside the rows' numbers")
        everyone = np.arange(len(queries.x))
        home = np.full(len(everyone), -1)
        # First each query's own corner, where scores are high, so that the bounds are good from the start.
        self._home(self.root, queries, everyone, home)
        self._visit(self.root, queries, everyone, home)

    def _wanted(self, node: Node, queries: Queries, some: np.ndarray) -> np.ndarray:
        """Those of some that want a row of the node by its labels."""
        if queries.same:
            return some[np.isin(queries.label[some], node.labels)]
        return some if len(node.labels) > 1 else some[queries.label[some] != node.labels[0]]

    def _home(self, node: Node, queries: Queries, some: np.ndarray, home: np.ndarray) -> None:
        if not len(node.rows) or not len(some):
            return
        if node.split is None:
            home[some] = node.rows[0]
            self._compare(node, queries, self._wanted(node, queries, some))
            return
        child = np.argmin(distances(node.split.points, queries.x[some]), axis=1)
        for j in np.unique(child).tolist():
            self._home(node.children[j], queries, some[child == j], home)

    def _visit(self, node: Node, queries: Queries, some: np.ndarray, home: np.ndarray) -> None:
        if not len(node.rows) or not len(some := self._wanted(node, queries, some)):
            return
        if node.split is None:
            self._compare(node, queries, some[home[some] != node.rows[0]])
            return
        # The bounds only rise, so what is out of reach now stays so.
        reached = node.split.reached(queries.x[some], queries.floor(some), queries.high[some])
        for j in np.argsort(-reached.sum(axis=0), kind="stable").tolist():
            self._visit(node.children[j], queries, some[reached[:, j]], home)

    def _compare(self, node: Node, queries: Queries, some: np.ndarray) -> None:
        """Take the leaf's rows that lie in the windows of some into their best."""
        if not len(some):
            return
        self.compared += len(some) * len(node.rows)
        score = products(queries.x[some], self.x[node.rows])
        fits = (queries.label[some][:, None] == self.label[node.rows]) == queries.same
        fits &= queries.own[some][:, None] != node.rows
        key = (score << NUMBER_BITS) | ((1 << NUMBER_BITS) - 1 - node.rows)
        for w in range(queries.low.shape[1]):
            worst = queries.best[some, w].min(axis=1)
            taken = fits & (score >= queries.low[some, w][:, None]) & (score <= queries.high[some, w][:, None])
            taken &= key > worst[:, None]
            better = np.flatnonzero(taken.any(axis=1))
            if len(better):
                both = np.concatenate([queries.best[some[better], w], np.where(taken, key, NONE)[better]], axis=1)
                queries.best[some[better], w] = np.partition(both, -queries.k, axis=1)[:, -queries.k :]
