"""A hierarchical navigable small-world graph over vectors, kept in flat neighbour arrays.

Nodes are linked in blocks: the candidates of a block come from its products with all nodes before and
in it, the links of all its nodes are chosen together, and so are those of the nodes that they link
back from. Queries are searched in blocks too, each step taking the next nodes of all of them.
"""

from __future__ import annotations

import io

import numpy as np

#: Nodes that are linked together, and queries that are searched together.
BLOCK = 256
#: Nodes of which a search looks at the neighbours in one step.
STEP = 4


class SmallWorld:
    """Nearest by inner product. Vectors get one more component that makes all lengths equal, so that
    the nearest in the graph's distance has the largest inner product."""

    def __init__(self, vectors: np.ndarray, degree: int, levels: np.ndarray):
        self.vectors = np.ascontiguousarray(vectors, np.float64)
        scaled = self.vectors / max(float(np.abs(self.vectors).max(initial=0)), 1e-300)  # no overflow
        squares = (scaled**2).sum(axis=1)
        self.points = np.concatenate(
            [scaled, np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))[:, None]], axis=1
        ).astype(np.float32)
        self.degree, self.levels = degree, levels
        # of level k: the row of a node in neighbours[k], and its neighbours, -1 where there are fewer
        self.rows, self.neighbours = [], []
        for k in range(int(levels.max(initial=0)) + 1):
            there = levels >= k
            self.rows.append(np.where(there, np.cumsum(there) - 1, -1).astype(np.int32))
            self.neighbours.append(np.full((int(there.sum()), degree * (2 if k == 0 else 1)), -1, np.int32))
        self.entry = int(levels.argmax()) if len(levels) else -1

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = 16, breadth: int = 100, seed: int = 9) -> SmallWorld:
        """``breadth``: of how many candidates a node's links are chosen."""
        draw = np.random.default_rng(seed)
        levels = np.floor(-np.log(1 - draw.random(len(vectors))) / np.log(degree)).astype(np.int16)
        index = cls(vectors, degree, levels)
        for level in range(len(index.neighbours)):
            nodes = np.flatnonzero(levels >= level)
            for start in range(0, len(nodes), BLOCK):
                index.link(nodes, start, min(start + BLOCK, len(nodes)), breadth, level)
        return index

    def link(self, nodes: np.ndarray, start: int, end: int, breadth: int, level: int) -> None:
        """Link a block of a level's nodes with those before and in it, both ways."""
        block, before = nodes[start:end], nodes[:end]
        if len(before) < 2:
            return
        products = self.points[block] @ self.points[before].T
        products[np.arange(len(block)), np.arange(start, end)] = -np.inf
        most = min(breadth, len(before) - 1)
        best = np.argpartition(-products, most - 1, axis=1)[:, :most]
        links, rows = self.neighbours[level], self.rows[level]
        mine = self.chosen(block, before[best], self.degree)
        links[rows[block], : mine.shape[1]] = mine
        # back from the others: what they have, and the new ones
        owner, other = np.repeat(block, mine.shape[1]), mine.ravel()
        owner, other = owner[other >= 0], other[other >= 0]
        order = np.lexsort((owner, other))
        owner, other = owner[order], other[order]
        others, first, count = np.unique(other, return_index=True, return_counts=True)
        for low in range(0, len(others), 1024):
            some = slice(low, min(low + 1024, len(others)))
            new = np.full((some.stop - low, int(count[some].max())), -1, np.int32)
            place = np.arange(new.shape[1]) < count[some, None]
            new[place] = owner[first[low] : first[some.stop - 1] + count[some.stop - 1]]
            old = links[rows[others[some]]]
            new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1  # linked already
            both = np.concatenate([old, new], axis=1)
            both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
            room = links.shape[1]
            full = (both >= 0).sum(axis=1) > room
            kept = both[:, :room].copy()
            if full.any():
                kept[full] = self.chosen(others[some][full], both[full], room)
            links[rows[others[some]]] = kept

    def chosen(self, nodes: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
        """Of each node's candidates (-1: none), nearest first, those nearer to it than to any chosen before;
        then the nearest others, ``most`` in all."""
        there = candidates >= 0
        points = self.points[np.where(there, candidates, 0)]
        near = np.einsum("ijk,ik->ij", points, self.points[nodes])
        near[~there] = -np.inf
        order = np.argsort(-near, axis=1, kind="stable")
        candidates, near = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(near, order, axis=1)
        points = np.take_along_axis(points, order[:, :, None], axis=1)
        among = points @ points.transpose(0, 2, 1)
        count = candidates.shape[1]
        closest = np.full(near.shape, -np.inf, np.float32)  # the largest product with a chosen one
        taken = np.zeros(near.shape, bool)
        for k in range(count):
            own = (closest[:, k] < near[:, k]) & (near[:, k] > -np.inf) & (taken.sum(axis=1) < most)
            taken[:, k] = own
            closest[own] = np.maximum(closest[own], among[own, k])
        first = np.argsort(~taken, axis=1, kind="stable")[:, :most]  # the chosen, then the nearest others
        out = np.take_along_axis(candidates, first, axis=1)
        if out.shape[1] < most:
            out = np.concatenate([out, np.full((len(out), most - out.shape[1]), -1, out.dtype)], axis=1)
        return out.astype(np.int32)

    def near(self, points: np.ndarray, starts: np.ndarray, breadth: int, level: int) -> np.ndarray:
        """For each point the nearest nodes of a level that a search of some breadth meets, nearest first, -1 where fewer."""
        size, rows, neighbours = len(points), self.rows[level], self.neighbours[level]
        seen = np.zeros((size, len(self.points)), bool)
        every = np.arange(size)[:, None]
        best = np.full((size, breadth), -1, np.int64)
        best[:, :1] = starts[:, None]
        seen[every, best[:, :1]] = True
        score = np.full((size, breadth), -np.inf, np.float32)
        score[:, 0] = np.einsum("ij,ij->i", self.points[starts], points)
        fresh = best >= 0  # whose neighbours have not been looked at
        live = np.arange(size)
        while len(live):
            waiting = np.where(fresh[live], score[live], -np.inf)
            step = min(STEP, breadth)
            pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step] if step < breadth else np.tile(np.arange(breadth), (len(live), 1))
            good = np.take_along_axis(waiting, pick, axis=1) > -np.inf
            fresh[live[:, None], pick] = False
            nodes = np.where(good, best[live[:, None], pick], -1)
            around = np.where((nodes >= 0)[:, :, None], neighbours[rows[np.maximum(nodes, 0)]], -1).reshape(len(live), -1)
            around = np.sort(around, axis=1)
            new = around >= 0
            new[:, 1:] &= around[:, 1:] != around[:, :-1]
            new &= ~seen[live[:, None], np.maximum(around, 0)]
            row, column = np.nonzero(new)
            found = around[row, column]
            seen[live[row], found] = True
            products = np.full(around.shape, -np.inf, np.float32)
            products[row, column] = np.einsum("ij,ij->i", self.points[found], points[live[row]])
            ids = np.concatenate([best[live], np.where(new, around, -1)], axis=1)
            scores = np.concatenate([score[live], products], axis=1)
            open_ = np.concatenate([fresh[live], new], axis=1)
            top = np.argpartition(-scores, breadth - 1, axis=1)[:, :breadth]
            best[live], score[live] = np.take_along_axis(ids, top, axis=1), np.take_along_axis(scores, top, axis=1)
            fresh[live] = np.take_along_axis(open_, top, axis=1)
            live = live[(fresh[live] & (best[live] >= 0)).any(axis=1)]
        order = np.argsort(-score, axis=1, kind="stable")
        return np.take_along_axis(best, order, axis=1)

    def search(self, vectors: np.ndarray, breadth: int) -> list[list[int]]:
        """Nodes near each vector, nearest first."""
        if self.entry < 0:
            return [[] for _ in vectors]
        out: list[list[int]] = []
        for start in range(0, len(vectors), BLOCK):
            some = vectors[start : start + BLOCK]
            size = np.maximum(np.abs(some).max(axis=1, keepdims=True), 1e-300)
            points = np.concatenate([some / size, np.zeros((len(some), 1))], axis=1).astype(np.float32)
            starts = np.full(len(some), self.entry)
            for level in range(int(self.levels[self.entry]), 0, -1):
                starts = self.near(points, starts, STEP, level)[:, 0]
            out += [[n for n in row if n >= 0] for row in self.near(points, starts, breadth, 0).tolist()]
        return out

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out, vectors=self.vectors, levels=self.levels, shape=np.array([self.degree]),
            **{f"neighbours{k}": x for k, x in enumerate(self.neighbours)},
        )
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> SmallWorld:
        with np.load(io.BytesIO(data)) as held:
            index = cls(held["vectors"], int(held["shape"][0]), held["levels"])
            index.neighbours = [held[f"neighbours{k}"] for k in range(len(index.neighbours))]
        return index
