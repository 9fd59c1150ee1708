"""Hierarchical navigable small-world graphs over unit vectors, as flat neighbour arrays.

Vectors lie in the order of their levels, so the nodes of a layer are a prefix and a layer is one array of
neighbour places, -1 where there is none. All work is done for many vectors in step: a beam search
expands the best open places of all its queries at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Neighbours of a node in the lowest layer, and above it.
LINKS, UPPER_LINKS = 32, 16
#: One in so many nodes of a layer is in the next one up.
RATIO = 8
#: The uppermost layer has no more nodes than this, and is scanned whole.
TOP = 512
#: Beam of the insertions, and how many of what it finds take part in the choice of neighbours.
BUILD_BEAM, CHOICE = 80, 64
#: Vectors inserted, or queries searched, in step.
STEP = 512
#: Open places of a beam that are expanded at once.
EXPAND = 4


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, largest first."""
    if k < sims.shape[1]:
        some = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        return np.take_along_axis(some, np.argsort(-np.take_along_axis(sims, some, 1), axis=1, kind="stable"), 1)
    return np.argsort(-sims, axis=1, kind="stable")


@dataclass
class Graph:
    """`vectors`: unit vectors, 32 bits, in graph order. `layers`: neighbours, lowest first, without the scanned one.
    `order`: where each node was in the input."""

    vectors: np.ndarray
    order: np.ndarray
    sizes: list[int]
    layers: list[np.ndarray]

    @staticmethod
    def build(vectors: np.ndarray, seed: int = 17, top: int = TOP) -> Graph:
        """Deterministic for the order of its input. The uppermost layer has no more than `top` nodes."""
        n = len(vectors)
        level = np.floor(-np.log1p(-np.random.default_rng(seed).random(n)) / np.log(RATIO)).astype(int)
        order = np.argsort(-level, kind="stable")
        sizes = [n]
        while sizes[-1] > top:
            above = int((level >= len(sizes)).sum())
            sizes.append(above if 0 < above < sizes[-1] else min(top, sizes[-1]))
        graph = Graph(np.ascontiguousarray(vectors[order], np.float32), order, sizes, [])
        built: list[np.ndarray] = []
        for depth in range(len(sizes) - 2, -1, -1):
            # Layers above are finished and lead to good entry places.
            graph.layers = [np.empty((0, 0), np.int32)] * (depth + 1) + built
            built.insert(0, graph._layer(depth))
        graph.layers = built
        return graph

    def _layer(self, depth: int) -> np.ndarray:
        n, m = self.sizes[depth], LINKS if depth == 0 else UPPER_LINKS
        links = np.full((n, m), -1, np.int32)
        at = 0
        while at < n:
            new = np.arange(at, min(n, at + (STEP if at else TOP)))
            vectors = self.vectors[new]
            sims = vectors @ vectors.T
            np.fill_diagonal(sims, -np.inf)
            near = _top(sims, min(CHOICE, len(new)))
            ids, found = new[near], np.take_along_axis(sims, near, 1)
            if at:
                old, old_sims = self._beam(vectors, links, self._entries(vectors, depth, 8), BUILD_BEAM)
                ids, found = np.concatenate([ids, old], 1), np.concatenate([found, old_sims], 1)
                best = _top(found, CHOICE)
                ids, found = np.take_along_axis(ids, best, 1), np.take_along_axis(found, best, 1)
            ids = np.where(np.isfinite(found), ids, -1)
            links[new] = self._choose(ids, found, m)
            self._link_back(links, new, m)
            at += len(new)
        return links

    def _choose(self, ids: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
        """Of candidates (largest first, -1: none) those nearer to the node than to any chosen before, then the rest."""
        rows, k = ids.shape
        vectors = self.vectors[np.maximum(ids, 0)]
        mutual = vectors @ vectors.transpose(0, 2, 1)
        there = ids >= 0
        chosen = np.zeros((rows, k), bool)
        nearest = np.full((rows, k), -np.inf, np.float32)
        for j in range(k):
            take = there[:, j] & (nearest[:, j] < sims[:, j])
            chosen[:, j] = take
            nearest[take] = np.maximum(nearest[take], mutual[take, :, j])
        rank = np.where(chosen, 0, np.where(there, 1, 2)) * k + np.arange(k)
        first = np.argsort(rank, axis=1)[:, :m]
        out = np.take_along_axis(ids, first, 1)
        return np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)

    def _link_back(self, links: np.ndarray, new: np.ndarray, m: int) -> None:
        """Give the chosen neighbours of the new nodes links to them, and choose anew where there are too many."""
        to, source = links[new].reshape(-1), np.repeat(new, m)
        to, source = to[to >= 0], source[to >= 0]
        sims = np.einsum("nd,nd->n", self.vectors[to], self.vectors[source])
        order = np.lexsort((-sims, to))
        to, source = to[order], source[order]
        target, first, size = np.unique(to, return_index=True, return_counts=True)
        rank = np.arange(len(to)) - np.repeat(first, size)
        keep = rank < m
        incoming = np.full((len(target), m), -1, np.int32)
        incoming[np.repeat(np.arange(len(target)), size)[keep], rank[keep]] = source[keep]
        for i in range(0, len(target), STEP):
            some = target[i : i + STEP]
            ids = np.concatenate([links[some], incoming[i : i + STEP]], 1)
            # A pair of new nodes may have chosen each other: the second mention is dropped.
            ids = np.sort(ids, axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.einsum("nd,nkd->nk", self.vectors[some], self.vectors[np.maximum(ids, 0)])
            sims[ids < 0] = -np.inf
            best = _top(sims, min(CHOICE, ids.shape[1]))
            links[some] = self._choose(np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1), m)

    def _entries(self, queries: np.ndarray, depth: int, width: int) -> np.ndarray:
        """Places in layer `depth` to begin at: the uppermost layer whole, then down through those between."""
        top = self.sizes[-1]
        ids = _top(queries @ self.vectors[:top].T, min(width, top))
        for layer in range(len(self.sizes) - 2, depth, -1):
            ids = self._beam(queries, self.layers[layer], ids, width)[0]
        return ids

    def _beam(self, queries: np.ndarray, links: np.ndarray, entries: np.ndarray, width: int):
        """(places, similarities), largest first, -1 and -inf where fewer were found."""
        n, m = links.shape
        width = max(width, entries.shape[1])
        ids = np.full((len(queries), width), -1, np.int64)
        sims = np.full((len(queries), width), -np.inf, np.float32)
        done = np.ones((len(queries), width), bool)
        seen = np.zeros((len(queries), n + 1), bool)
        e = entries.shape[1]
        ids[:, :e] = entries
        sims[:, :e] = np.einsum("qd,qed->qe", queries, self.vectors[np.maximum(entries, 0)])
        sims[:, :e][entries < 0] = -np.inf
        done[:, :e] = entries < 0
        np.put_along_axis(seen, np.where(entries < 0, n, entries), True, 1)
        active = np.arange(len(queries))
        while len(active):
            open_ = ~done[active]
            take = open_ & (np.cumsum(open_, axis=1) <= EXPAND)
            going = take.any(axis=1)
            active, take = active[going], take[going]
            if not len(active):
                break
            row, column = np.nonzero(take)
            slot = np.cumsum(take, axis=1)[row, column] - 1
            near = np.full((len(active), EXPAND, m), -1, np.int64)
            near[row, slot] = links[ids[active][row, column]]
            done[active] |= take
            near = np.sort(near.reshape(len(active), -1), axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            place = np.where(fresh, near, n)
            fresh &= ~seen[active[:, None], place]
            seen[active[:, None], place] = True
            # Only the fresh ones are compared: rows are shortened to the most of any of them.
            most = int(fresh.sum(axis=1).max())
            if not most:
                continue
            front = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
            near, fresh = np.take_along_axis(near, front, 1), np.take_along_axis(fresh, front, 1)
            found = np.matmul(self.vectors[np.maximum(near, 0)], queries[active][:, :, None])[:, :, 0]
            found[~fresh] = -np.inf
            all_sims = np.concatenate([sims[active], found], 1)
            all_ids = np.concatenate([ids[active], near], 1)
            all_done = np.concatenate([done[active], ~fresh], 1)
            best = _top(all_sims, width)
            sims[active] = np.take_along_axis(all_sims, best, 1)
            ids[active] = np.take_along_axis(all_ids, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1)
        ids[~np.isfinite(sims)] = -1
        return ids, sims

    def search(self, queries: np.ndarray, width: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(places, similarities) of the `width` nearest found for each query; a graph of one layer is scanned.

        `own`: the place of a query that is a node itself, else -1. It is entered there too: a cluster far from
        all others may be out of reach of the upper layers, but not of its own members.
        """
        if not self.layers:
            sims = queries @ self.vectors.T
            best = _top(sims, min(width, len(self.vectors)))
            return best, np.take_along_axis(sims, best, 1)
        parts = []
        step = max(1, STEP * 128 // max(128, width))
        for i in range(0, len(queries), step):
            some = queries[i : i + step]
            entries = self._entries(some, 0, 16)
            if own is not None:
                mine = own[i : i + step, None]
                entries = np.concatenate([mine, np.where(entries == mine, -1, entries)], 1)
            parts.append(self._beam(some, self.layers[0], entries, width))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def arrays(self) -> tuple[bytes, bytes, list[int]]:
        """Order and neighbour arrays as bytes, and the layers' sizes."""
        flat = [x.reshape(-1) for x in self.layers]
        links = np.concatenate(flat).tobytes() if flat else b""
        return self.order.astype("<i4").tobytes(), links, self.sizes

    @staticmethod
    def stored(vectors: np.ndarray, order: bytes, links: bytes, sizes: list[int]) -> Graph:
        """The graph of arrays() and the unit vectors in input order."""
        places = np.frombuffer(order, "<i4")
        flat, layers, at = np.frombuffer(links, np.int32), [], 0
        for depth, n in enumerate(sizes[:-1]):
            m = LINKS if depth == 0 else UPPER_LINKS
            layers.append(flat[at : at + n * m].reshape(n, m))
            at += n * m
        return Graph(np.ascontiguousarray(vectors[places], np.float32), places, list(sizes), layers)
