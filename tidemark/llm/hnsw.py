"""A hierarchical navigable small-world graph over unit vectors, built and searched in batches of arrays.

Nodes are dealt to layers at random: layer k holds the first n / DEGREE**k nodes, so a node's number tells its
layers.  Layers are built from the top: each starts as the graph above it, then takes in the remaining nodes in
batches no larger than itself.  A new node's candidates are what a beam search finds among the nodes present,
and its batch; of these, neighbours are taken that are closer to it than to a neighbour taken before, then the
closest others.  Nodes that get too many links from the other side choose among them in the same way.

A search goes down greedily to the lowest layer and keeps the ``beam`` best nodes seen there.
"""

from __future__ import annotations

import numpy as np

DEGREE = 16  # links a new node makes
MOST = 32  # links a node keeps in the lowest layer
BUILD_BEAM = 48
TOP_NODES = 128  # the top layer is built from all pairs
BATCH = 1024
SEEN_BYTES = 32 << 20  # marks of visited nodes
EXPAND = 4  # nodes of a beam looked into at a time


class Graph:
    """``vectors`` are unit vectors in an order that has nothing to do with their content."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray] | None = None):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        self.layers = layers if layers is not None else self._built()  # lowest first; -1 for no link

    def _built(self) -> list[np.ndarray]:
        sizes = [len(self.vectors)]
        while sizes[-1] > TOP_NODES:
            sizes.append(max(1, sizes[-1] // DEGREE))
        layers: list[np.ndarray] = []
        for depth in range(len(sizes) - 1, -1, -1):
            links = np.full((sizes[depth], MOST if depth == 0 else DEGREE), -1, np.int32)
            start = 0
            if layers:
                above = layers[0]
                links[: len(above), : above.shape[1]] = above
                start = len(above)
            while start < len(links):
                end = min(len(links), start + min(max(start, TOP_NODES), BATCH))
                self._take_in(links, layers, start, end)
                start = end
            layers.insert(0, links)
        return layers

    def _take_in(self, links: np.ndarray, above: list[np.ndarray], start: int, end: int) -> None:
        """Add the nodes start..end to a layer that holds those below ``start``."""
        new = np.arange(start, end)
        mine = self.vectors[start:end]
        near = mine @ mine.T
        np.fill_diagonal(near, -np.inf)
        k = min(BUILD_BEAM, end - start - 1)
        ids, sims = np.zeros((len(new), 0), np.int32), np.zeros((len(new), 0), np.float32)
        if k > 0:
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            ids, sims = (best + start).astype(np.int32), np.take_along_axis(near, best, 1)
        if start:
            seen_ids, seen_sims = self._search(mine, [links[:start], *above], BUILD_BEAM)
            ids, sims = np.hstack([seen_ids, ids]), np.hstack([seen_sims, sims])
        degree = min(DEGREE, links.shape[1])
        chosen, chosen_sims = self._choose(ids, sims, degree)
        links[start:end, :degree] = chosen
        at, column = np.nonzero(chosen >= 0)
        self._link_back(links, chosen[at, column], new[at], chosen_sims[at, column])

    def _choose(self, ids: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each row's candidates up to ``most``: first those closer to the row's node than to one taken."""
        wide = 2 * BUILD_BEAM
        out_ids = np.full((len(ids), most), -1, np.int32)
        out_sims = np.full((len(ids), most), -np.inf, np.float32)
        for part in range(0, len(ids), 512):
            order = np.argsort(-sims[part : part + 512], axis=1, kind="stable")[:, :wide]
            i, s = np.take_along_axis(ids[part : part + 512], order, 1), np.take_along_axis(sims[part : part + 512], order, 1)
            real = i >= 0
            vectors = self.vectors[np.where(real, i, 0)]
            mutual = vectors @ vectors.transpose(0, 2, 1)
            blocked, taken = ~real, np.zeros(i.shape, bool)
            for c in range(i.shape[1]):
                take = ~blocked[:, c]
                taken[:, c] = take
                blocked[:, c:] |= take[:, None] & (mutual[:, c, c:] > s[:, c:])
            first = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
            got = np.take_along_axis(real, first, 1)
            out_ids[part : part + 512, : first.shape[1]] = np.where(got, np.take_along_axis(i, first, 1), -1)
            out_sims[part : part + 512, : first.shape[1]] = np.where(got, np.take_along_axis(s, first, 1), -np.inf)
        return out_ids, out_sims

    def _link_back(self, links: np.ndarray, targets: np.ndarray, new: np.ndarray, sims: np.ndarray) -> None:
        order = np.lexsort((-sims, targets))
        targets, new, sims = targets[order], new[order], sims[order]
        nodes, first, count = np.unique(targets, return_index=True, return_counts=True)
        row = np.repeat(np.arange(len(nodes)), count)
        place = np.arange(len(targets)) - first[row]
        most = links.shape[1]
        near = place < most  # more than fit at all cannot be chosen together
        row, place, new, sims = row[near], place[near], new[near], sims[near]
        wide = int(min(count.max(initial=0), most))
        more = np.full((len(nodes), wide), -1, np.int32)
        more_sims = np.full((len(nodes), wide), -np.inf, np.float32)
        more[row, place], more_sims[row, place] = new, sims
        for part in range(0, len(nodes), 2048):
            at = nodes[part : part + 2048]
            old = links[at]
            fits = (old >= 0).sum(1) + (more[part : part + 2048] >= 0).sum(1) <= most
            both = np.hstack([old, more[part : part + 2048]])
            full = ~fits
            if fits.any():
                front = np.argsort(both[fits] < 0, axis=1, kind="stable")[:, :most]
                links[at[fits]] = np.take_along_axis(both[fits], front, 1)
            if full.any():
                there = old[full]
                known = np.einsum("tmd,td->tm", self.vectors[np.where(there >= 0, there, 0)], self.vectors[at[full]])
                known[there < 0] = -np.inf
                links[at[full]] = self._choose(both[full], np.hstack([known, more_sims[part : part + 2048][full]]), most)[0]

    def _search(self, queries: np.ndarray, layers: list[np.ndarray], beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.zeros((len(queries), 1), np.int32)
        for links in reversed(layers[1:]):
            entry = self._beam(queries, links, entry, 4)[0]
        return self._beam(queries, layers[0], entry, beam)

    def _beam(self, queries: np.ndarray, links: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.full((len(queries), beam), -1, np.int32)
        sims = np.full((len(queries), beam), -np.inf, np.float32)
        some = max(1, min(BATCH, SEEN_BYTES // max(1, len(links))))
        for k in range(0, len(queries), some):
            part = slice(k, k + some)
            ids[part], sims[part] = self._beam_of_some(queries[part], links, entry[part], beam)
        return ids, sims

    def _beam_of_some(self, queries, links, entry, beam):
        n, b = len(links), len(queries)
        seen = np.zeros(b * n, bool)
        ids = np.full((b, beam), -1, np.int32)
        sims = np.full((b, beam), -np.inf, np.float32)
        open_ = np.zeros((b, beam), bool)
        at, column = np.nonzero(entry >= 0)
        fresh = np.unique(at.astype(np.int64) * n + entry[at, column])
        while len(fresh):
            seen[fresh] = True
            at, node = fresh // n, fresh % n
            near = np.einsum("kd,kd->k", queries[at], self.vectors[node])
            better = near > sims[at, -1]
            at, node, near = at[better], node[better], near[better]
            if len(at):
                rows, first, count = np.unique(at, return_index=True, return_counts=True)
                row = np.repeat(np.arange(len(rows)), count)
                place = np.arange(len(at)) - first[row]
                wide = int(count.max())
                all_ids = np.full((len(rows), beam + wide), -1, np.int32)
                all_sims = np.full((len(rows), beam + wide), -np.inf, np.float32)
                all_open = np.zeros((len(rows), beam + wide), bool)
                all_ids[:, :beam], all_sims[:, :beam], all_open[:, :beam] = ids[rows], sims[rows], open_[rows]
                all_ids[row, beam + place], all_sims[row, beam + place], all_open[row, beam + place] = node, near, True
                order = np.argsort(-all_sims, axis=1)[:, :beam]
                ids[rows] = np.take_along_axis(all_ids, order, 1)
                sims[rows] = np.take_along_axis(all_sims, order, 1)
                open_[rows] = np.take_along_axis(all_open, order, 1)
            now = open_ & (np.cumsum(open_, axis=1) <= EXPAND)
            at, column = np.nonzero(now)
            open_[at, column] = False
            around = links[ids[at, column]]
            fresh = (at[:, None].astype(np.int64) * n + around)[around >= 0]
            fresh = np.unique(fresh[~seen[fresh]])
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: none) and products of the ``beam`` nearest nodes found, best first."""
        return self._search(np.ascontiguousarray(queries, np.float32), self.layers, min(beam, max(1, len(self.vectors))))
