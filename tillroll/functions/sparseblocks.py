"""Products of two small sparse matrices, inside one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Cells of the dense result held at a time, and products expanded at a time.
STRIP_CELLS = 1_000_000
EXPANSION = 4_000_000
# Adding one product of a walk takes about as long as this many cells of a dense product.
WALK_COST = 250
# Products that are added before the cells they reach are looked at.
WALKED = 1 << 17
# Cells of the dense side that is held for all strips.
DENSE_CELLS = 1 << 23


class Product:
    """``left @ right.T`` of two sparse matrices, each ``(row, dim, weight)`` triples with rows numbered from 0.

    Dims that so many rows of both sides have that walking them would take
    longer are multiplied densely, the others are walked.
    """

    def __init__(self, left: tuple, right: tuple, n_left: int, n_right: int):
        self.n_left, self.n_right = n_left, n_right
        l_dims, l_slot, l_count = _counted(left[1])
        r_dims, r_slot, r_count = _counted(right[1])
        shared, l_at, r_at = np.intersect1d(l_dims, r_dims, assume_unique=True, return_indices=True)
        products = l_count[l_at].astype(np.float64) * r_count[r_at]
        # the dims with most products first: these are the dense ones
        order = np.argsort(-products, kind="stable")
        dense = int((products * WALK_COST > float(n_left) * n_right).sum())
        self.dense = dense = min(dense, DENSE_CELLS // max(n_right, 1))
        sides = []
        for (row, _, weight), inverse, dims, at in ((left, l_slot, l_dims, l_at), (right, r_slot, r_dims, r_at)):
            slot = np.full(len(dims), -1, dtype=np.int64)
            slot[at[order]] = np.arange(len(shared))
            mine = slot[inverse]
            known = mine >= 0
            sides.append((row[known], mine[known], weight[known]))
        (l_row, l_dim, l_w), (r_row, r_dim, r_w) = sides
        if len(l_row) and np.any(np.diff(l_row) < 0):
            by_row = np.argsort(l_row, kind="stable")
            l_row, l_dim, l_w = l_row[by_row], l_dim[by_row], l_w[by_row]
        head = l_dim < dense
        self.l_head = l_row[head], l_dim[head], l_w[head]
        self.l_tail = l_row[~head], l_dim[~head], l_w[~head]
        head = r_dim < dense
        self.r_head = r_row[head], r_dim[head], r_w[head]
        r_row, r_dim, r_w = r_row[~head], r_dim[~head], r_w[~head]
        by_dim = np.argsort(r_dim, kind="stable")
        self.r_row, self.r_w = r_row[by_dim].astype(np.int32), r_w[by_dim]
        self.per_dim = np.bincount(r_dim, minlength=len(shared)).astype(np.int64)
        self.start = np.cumsum(self.per_dim) - self.per_dim
        self._fixed = None

    @property
    def fixed(self) -> np.ndarray:
        """The right side's weights in the dense dims."""
        if self._fixed is None:
            row, dim, w = self.r_head
            self._fixed = np.zeros((self.dense, self.n_right))
            np.add.at(self._fixed, (dim, row), w)
        return self._fixed

    def head_bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """What the dense dims can add at most to the products of each left row, and of each right row."""
        sides = []
        for (row, dim, w), n in ((self.l_head, self.n_left), (self.r_head, self.n_right)):
            most = np.zeros(self.dense)
            np.maximum.at(most, dim, np.abs(w))
            sides.append((row, dim, np.abs(w), most, np.sqrt(np.bincount(row, w * w, minlength=n))))
        bounds = []
        for (row, dim, w, _, length), (*_, most, other) in (sides, sides[::-1]):
            bounds.append(np.minimum(np.bincount(row, w * most[dim], minlength=len(length)), length * other.max(initial=0.0)))
        # rounding may take a sum over its bound
        margin = 1e-9 if self.dense else 0.0
        self.l_length, self.r_length = sides[0][-1] + margin, sides[1][-1] + margin
        return bounds[0] + margin, bounds[1] + margin

    def _mine(self, first: int, rows: int) -> np.ndarray:
        row, dim, w = self.l_head
        a, b = np.searchsorted(row, [first, first + rows])
        mine = np.zeros((rows, self.dense))
        np.add.at(mine, (row[a:b] - first, dim[a:b]), w[a:b])
        return mine

    def strips(self) -> Iterator[tuple[int, np.ndarray]]:
        """The product as strips ``(first_row, dense rows)``."""
        height = max(1, STRIP_CELLS // max(self.n_right, 1))
        l_row, l_dim, l_w = self.l_tail
        for first in range(0, self.n_left, height):
            rows = min(height, self.n_left - first)
            out = np.empty((rows, self.n_right)) if self.dense else np.zeros((rows, self.n_right))
            if self.dense:
                mine = self._mine(first, rows)
                if self.dense > 2:
                    np.matmul(mine, self.fixed, out=out)
                else:
                    np.multiply(mine[:, :1], self.fixed[0], out=out)
                    for d in range(1, self.dense):
                        out += mine[:, d, None] * self.fixed[d]
            flat = out.reshape(-1)
            a, b = np.searchsorted(l_row, [first, first + rows])
            reached = np.cumsum(self.per_dim[l_dim[a:b]])
            at = a
            while at < b:
                done = reached[at - a - 1] if at > a else 0
                end = a + max(at - a + 1, int(np.searchsorted(reached, done + EXPANSION, side="right")))
                cell, product, *_ = self._walked(at, end, first)
                np.add.at(flat, cell, product)
                at = end
            yield first, out

    def _walked(self, at: int, end: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cells and products of some entries of the left side, the number of products of each entry, and their columns."""
        l_row, l_dim, l_w = (x[at:end] for x in self.l_tail)
        n = self.per_dim[l_dim]
        # a strip's cells and a side's entries are numbered in 32 bits
        hit = np.arange(int(n.sum()), dtype=np.int32)
        hit += np.repeat((self.start[l_dim] - (np.cumsum(n) - n)).astype(np.int32), n)
        column = self.r_row[hit]
        cell = np.repeat(((l_row - first) * self.n_right).astype(np.int32), n)
        cell += column
        product = np.repeat(l_w, n)
        product *= self.r_w[hit]
        return cell, product, n, column

    def cells_above(self, row_least: np.ndarray, column_least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, columns and values of the cells that reach the least of their row or of their column, and maybe others.

        The ``head_bounds`` lie below these, so a cell that no walked dim reaches can't be one, and isn't looked at.
        """
        bounds = self.head_bounds()
        row_floor, column_floor = row_least - bounds[0], column_least - bounds[1]
        l_row, l_dim, _ = self.l_tail
        reached = np.concatenate([[0], np.cumsum(self.per_dim[l_dim])])
        ends = np.searchsorted(l_row, np.arange(self.n_left), side="right")
        done = reached[ends]
        height = max(1, STRIP_CELLS // max(self.n_right, 1))
        buffer = np.zeros(min(height, self.n_left) * self.n_right)
        first = 0
        while first < self.n_left:
            at = int(ends[first - 1]) if first else 0
            last = int(np.searchsorted(done, reached[at] + WALKED, side="right"))
            last = max(first + 1, min(last, first + height, self.n_left))
            cell, product, n, column = self._walked(at, int(ends[last - 1]), first)
            np.add.at(buffer, cell, product)
            value = buffer[cell]
            near = value >= np.repeat(row_floor[l_row[at : ends[last - 1]]], n)
            near |= value >= column_floor[column]
            near = np.flatnonzero(near)
            if len(near):
                yield from self._completed(cell[near], column[near], value[near], first, last, row_least, column_least)
            buffer[cell] = 0.0
            first = last

    def _completed(self, cell, column, value, first, last, row_least, column_least):
        if self.dense:
            row = (cell - column) // self.n_right + first
            most = value + self.l_length[row] * self.r_length[column]
            able = (most >= row_least[row]) | (most >= column_least[column])
            cell, value = cell[able], value[able]
        cell, at = np.unique(cell, return_index=True)
        value = value[at]
        row, column = np.divmod(cell, self.n_right)
        if self.dense:
            mine = self._mine(first, last - first)
            for some in range(0, len(cell), 1 << 14):
                part = slice(some, some + (1 << 14))
                value[part] += np.einsum("ij,ji->i", mine[row[part]], self.fixed[:, column[part]])
        yield row + first, column, value


def row_strips(left: tuple, right: tuple, n_left: int, n_right: int) -> Iterator[tuple[int, np.ndarray]]:
    """``left @ right.T`` as strips ``(first_row, dense rows)``."""
    return Product(left, right, n_left, n_right).strips()


def _counted(dim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct dims, the place of each dim among them, and how often it occurs."""
    if len(dim) and dim.min() >= 0 and dim.max() < 4 * len(dim) + 1024:
        count = np.bincount(dim)
        dims = np.flatnonzero(count)
        place = np.zeros(len(count), dtype=np.int64)
        place[dims] = np.arange(len(dims))
        return dims, place[dim], count[dims]
    return np.unique(dim, return_inverse=True, return_counts=True)
