"""Runs of introns inside cells of a contig, in numpy: what ``paths`` does where a cell has all it needs.

A cell has the introns that start in it, those close to it, and the reference there if asked for.
Introns of one key (a sample, say) are told apart by multiples of a width added to their positions,
so sorted arrays hold all keys of a cell at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Positions of a cell, and how far around it its introns are known.
CELL, AROUND = 1 << 16, 1 << 12
#: Introns from which runs are grown at once.
STARTS = 2_000


@dataclass(frozen=True)
class Rules:
    """The bounds of ``paths.intron_configurations``; which columns its rows have; bases of a chunk of the reference."""

    reach: int
    min_overlap: int
    edge_span: int
    min_edge_span_size: int
    inner: tuple[str, ...]
    merged: bool
    columns: tuple[str, ...]
    chunk_size: int = 0


class Cell:
    """The intron graph of one cell, its nodes sorted by key and start."""

    def __init__(self, table: pa.Table, outer: tuple[str, ...], rules: Rules):
        self.rules, self.cell = rules, table.column("_cell")[0].as_py()
        self.low, self.high = self.cell * CELL - AROUND, (self.cell + 1) * CELL + AROUND
        self.outer = {c: table.column(c)[0] for c in outer}
        is_node = table.column("bases").is_null() if rules.chunk_size else None
        nodes = table.filter(is_node) if rules.chunk_size else table
        start, end = nodes.column("start").to_numpy(), nodes.column("end_pos").to_numpy()
        keys = self._keys(nodes, any(v.as_py() is None for v in self.outer.values()))
        order = np.lexsort((end, start, keys))
        a, b = order[1:], order[:-1]
        order = order[np.append(np.ones(len(order[:1]), bool), (keys[a] != keys[b]) | (start[a] != start[b]) | (end[a] != end[b]))]
        self.rows = nodes.take(pa.array(order))
        self.start, self.end, self.key = start[order], end[order], keys[order]
        self.base = int(min(self.start.min(), self.end.min())) - rules.min_overlap - 1 if len(start) else 0
        width = int(max(self.start.max(), self.end.max())) - self.base + 2 * rules.min_overlap + 2 if len(start) else 1
        self.floor = self.key * width
        self.s, self.e, self.top = self.floor + self.start - self.base, self.floor + self.end - self.base, self.floor + width
        self._edges()
        self._before()
        self.own = np.flatnonzero((self.start >= self.cell * CELL) & (self.start < (self.cell + 1) * CELL))
        if rules.chunk_size:
            self._reference(table.filter(table.column("bases").is_valid()))

    def _keys(self, nodes: pa.Table, apart: bool) -> np.ndarray:
        """A number of each node's key; what has a null in its keys has no neighbours."""
        number = np.zeros(nodes.num_rows, np.int64)
        null = np.full(nodes.num_rows, apart)
        for c in self.rules.inner:
            column = nodes.column(c).combine_chunks()
            coded = column.dictionary_encode()
            codes = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
            null |= column.is_null().to_numpy(zero_copy_only=False)
            number = np.unique(number * (len(coded.dictionary) + 1) + codes, return_inverse=True)[1].reshape(-1).astype(np.int64)
        number[null] = number.max(initial=0) + 1 + np.arange(null.sum())
        return number

    def _edges(self) -> None:
        """What follows a node begins behind it and before the least end of all that do."""
        overlap = self.rules.min_overlap
        none = np.iinfo(np.int64).max // 2
        least = np.append(np.minimum.accumulate(self.e[::-1])[::-1], none)
        self.first = np.searchsorted(self.s, self.e + overlap, "left")
        found = least[self.first]
        some = found < self.top
        self.degree = np.where(some, np.searchsorted(self.s, np.where(some, found, 0) + overlap, "left") - self.first, 0)
        self.sure = some & (found - self.floor + self.base + overlap <= self.high)

    def _before(self) -> None:
        """Bases up to the farthest node that a node directly follows, -1 without."""
        overlap = self.rules.min_overlap
        by_end = np.argsort(self.e, kind="stable")
        ends, most = self.e[by_end], np.maximum.accumulate(self.s[by_end])
        upto = np.searchsorted(ends, self.s - overlap, "right") - 1
        some = (upto >= 0) & (ends[np.maximum(upto, 0)] >= self.floor) if len(ends) else np.zeros(0, bool)
        last = most[np.maximum(upto, 0)] if len(ends) else ends
        near = ends[np.minimum(np.searchsorted(ends, np.maximum(last - overlap, self.floor - 1), "right"), max(len(ends) - 1, 0))] if len(ends) else ends
        self.before = np.where(some, self.s - near, -1)
        self.sure_before = some & (last - self.floor + self.base - overlap + 1 >= self.low)

    def _reference(self, chunks: pa.Table) -> None:
        size = self.rules.chunk_size
        self.from_base = self.low // size * size - size
        self.bases = np.full(self.high - self.from_base + 2 * size, ord("N"), np.uint8)
        for at, text in zip(chunks.column("start").to_pylist(), chunks.column("bases").to_pylist()):
            bases = np.frombuffer(text.encode("ascii", "replace")[:size], np.uint8)
            self.bases[at - self.from_base: at - self.from_base + len(bases)] = bases

    def open(self) -> pa.Table:
        """Keys whose runs need introns below ``lo`` or from ``hi`` on; null if they need more of the reference."""
        reach = self.rules.reach
        least = np.full(len(self.s), reach, np.int64)
        least[self.own] = 0
        at = self.own
        while len(at):
            _, to, gap = self._follow(at)
            bases = np.repeat(least[at], self.degree[at]) + gap
            better = bases < np.minimum(least[to], reach)
            to, bases = to[better], bases[better]
            np.minimum.at(least, to, bases)
            at = np.unique(to)
        reached = least < reach
        ends, begins = reached & ~self.sure, np.zeros(len(self.s), bool)
        begins[self.own] = ~self.sure_before[self.own] & any(c.startswith("left") for c in self.rules.columns)
        beyond = reached & (self.end + reach >= self.high) if self.rules.chunk_size else np.zeros(len(self.s), bool)
        parts = []
        for flagged, lo, hi in ((ends, None, self.high), (begins, self.low, None), (beyond, None, None)):
            at = np.flatnonzero(flagged)
            at = at[np.unique(self.key[at], return_index=True)[1]]
            parts.append((at, lo, hi))
        at = np.concatenate([p[0] for p in parts])
        column = lambda i: pa.array([v for p in parts for v in [p[i]] * len(p[0])], pa.int64())
        return self._table(at, {"_cell": pa.array([self.cell] * len(at), pa.int64()), "lo": column(1), "hi": column(2)})

    def _table(self, nodes: np.ndarray, more: dict[str, pa.Array], inner: bool = True) -> pa.Table:
        outer = {c: pa.repeat(v, len(nodes)) for c, v in self.outer.items()}
        own = {c: self.rows.column(c).take(pa.array(nodes)).combine_chunks() for c in self.rules.inner} if inner else {}
        return pa.table(outer | own | more)

    def _follow(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each edge out of ``at``: its place there, the next node, the bases between."""
        many = self.degree[at]
        row = np.repeat(np.arange(len(at)), many)
        to = self.first[at][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        return row, to, self.start[to] - self.end[at[row]]

    def runs(self) -> Iterator[pa.Table]:
        own = self.own[np.lexsort((self.end[self.own], self.start[self.own]))]
        cuts = [0]
        while cuts[-1] < len(own):
            stop = min(cuts[-1] + STARTS, len(own))
            cuts.append(int(np.searchsorted(self.start[own], self.start[own[stop - 1]], "right")))
        for a, b in zip(cuts, cuts[1:]):
            yield from self._grown(own[a:b])

    def _grown(self, own: np.ndarray) -> Iterator[pa.Table]:
        rules = self.rules
        path, gaps, bases = own[:, None], np.zeros((len(own), 0), np.int64), np.zeros(len(own), np.int64)
        right = "right_ext" in rules.columns or "right_avail" in rules.columns
        while len(path):
            row, to, gap = self._follow(path[:, -1])
            far = bases[row] + gap >= rules.reach
            if right:
                alone = np.flatnonzero(self.degree[path[:, -1]] == 0)
                done, behind = np.concatenate([alone, row[far]]), np.concatenate([np.full(len(alone), -1), gap[far]])
            else:
                ended = self.degree[path[:, -1]] == 0
                ended[row[far]] = True
                done, behind = np.flatnonzero(ended), None
            if len(done):
                yield self._made(path[done], behind)
            after = np.concatenate([gaps[row], gap[:, None]], 1)
            tight = (after.shape[1] >= rules.edge_span) & (after[:, -rules.edge_span:].sum(1) < rules.min_edge_span_size)
            on = ~far & ~tight
            path, gaps, bases = np.concatenate([path[row[on]], to[on, None]], 1), after[on], (bases[row] + gap)[on]

    def _made(self, path: np.ndarray, behind: np.ndarray | None) -> pa.Table:
        """Rows of finished runs, each once."""
        rules, reach = self.rules, self.rules.reach
        head = path[:, 0]
        numbers: dict[str, np.ndarray] = {}
        if "left_ext" in rules.columns:
            whole = self.start[head] - np.maximum(self.start[head] - reach, 1)
            numbers["left_ext"] = np.minimum(reach, np.where(self.before[head] >= 0, self.before[head], whole))
            if rules.chunk_size:
                numbers["left_ext"] = self.start[head] - np.maximum(self.start[head] - numbers["left_ext"], 1)
        if "left_avail" in rules.columns:
            numbers["left_avail"] = self.before[head]
        if "right_ext" in rules.columns:
            numbers["right_ext"] = np.where(behind < 0, reach, np.minimum(reach, behind))
        if "right_avail" in rules.columns:
            numbers["right_avail"] = behind
        if rules.merged or behind is not None:
            columns = [*numbers.values(), *(x for i in range(path.shape[1]) for x in (self.end[path[:, i]], self.start[path[:, i]]))]
            columns += [] if rules.merged else [self.key[head]]
            order = np.lexsort(columns)
            new = np.zeros(len(order), bool)
            new[:1] = True
            for x in columns:
                new[1:] |= x[order[1:]] != x[order[:-1]]
            keep = order[new]
            path, head, numbers = path[keep], head[keep], {k: v[keep] for k, v in numbers.items()}
        starts, ends = self.start[path], self.end[path]
        if rules.chunk_size:
            return self._fragments(head, starts, ends, numbers)
        made = {"starts": listed(starts), "ends": listed(ends)}
        made |= {k: pa.array(v, pa.int64(), mask=v < 0 if k.endswith("avail") else None) for k, v in numbers.items()}
        return self._table(head, made, not rules.merged)

    def _fragments(self, head: np.ndarray, starts: np.ndarray, ends: np.ndarray, numbers: dict[str, np.ndarray]) -> pa.Table:
        left = starts[:, 0] - numbers["left_ext"]
        lows = np.concatenate([left[:, None], ends], 1)
        sizes = np.concatenate([starts, (ends[:, -1] + numbers["right_ext"])[:, None]], 1) - lows
        long = np.maximum(sizes, 0).reshape(-1)
        at = np.repeat(lows.reshape(-1) - 1 - self.from_base - np.cumsum(long) + long, long) + np.arange(long.sum())
        stops = np.append(0, np.cumsum(long.reshape(sizes.shape).sum(1))).astype(np.int32)
        text = pa.StringArray.from_buffers(len(head), pa.py_buffer(stops), pa.py_buffer(self.bases[at]))
        made = {"start": pa.array(left, pa.int64()), "exon_sizes": listed(sizes), "intron_sizes": listed(ends - starts), "sequence": text}
        return self._table(head, made, not self.rules.merged)


def listed(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1), pa.int64()))
