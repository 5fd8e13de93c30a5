"""Comparing sets of vectors tile by tile, in numpy, inside a task.

A set is cut into tiles of rows that lie close together. A pair of tiles is left out when
their balls are too far apart. A product in single precision says which pairs of rows may
be close enough, with room for its error; only those are measured in double precision.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from .matrices import DIGITS, spanning_forest

CHUNK = 1 << 16      # pairs measured at once
STRIP = 256          # rows of a tile in one product
SEEDS = 4            # pairs of each row that a forest starts from, among those beside it
SPREAD = 1024        # and among so many rows from everywhere
BUFFER = 1 << 18     # pairs found before a forest, or a list of neighbours, is made of them
LEVELS = 16          # weights at which a forest's components are known to the comparison
SLACK = 1e-9


def cut_tiles(v: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row numbers in sets of at most ``rows``, parted along the line of two far rows."""
    open_, done = [np.arange(len(v))], []
    while open_:
        part = open_.pop()
        if len(part) <= max(1, rows):
            done.append(part)
            continue
        x = v[part]
        a = x[((x - x.mean(0)) ** 2).sum(1).argmax()]
        b = x[((x - a) ** 2).sum(1).argmax()]
        half = len(part) // 2
        order = np.argpartition(x @ (b - a), half)
        open_ += [part[order[:half]], part[order[half:]]]
    return [part for part in done if len(part)]


def exact(left: np.ndarray, right: np.ndarray, row: np.ndarray, col: np.ndarray,
          metric: str) -> np.ndarray:
    """The measure of each listed pair, smaller is closer."""
    out = np.empty(len(row))
    for lo in range(0, len(row), CHUNK):
        part = slice(lo, lo + CHUNK)
        x, y = left[row[part]], right[col[part]]
        if metric == "cosine":
            out[part] = -np.einsum("nd,nd->n", x, y)
        else:
            x -= y
            out[part] = np.sqrt(np.einsum("nd,nd->n", x, x))
    return out


def squared(measure, metric: str):
    """The squared distance that goes with a measure; cosines are of unit vectors."""
    return np.maximum(0.0, 2 + 2 * measure) if metric == "cosine" else np.square(measure)


class Meeting:
    """The rows of one set, or of several, and which pairs of them may be close.

    ``v`` holds the rows tile by tile; ``order`` says where each one stood, ``set_of`` the set
    of each tile. Sets meet each other; one alone, or with ``itself`` all, meet themselves too.
    """

    def __init__(self, sides: list[np.ndarray], rows: int, itself: bool | None = None):
        parts = [cut_tiles(side, rows) for side in sides]
        shift = np.cumsum([0] + [len(side) for side in sides])
        self.set_of = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
        placed = [part + shift[k] for k, found in enumerate(parts) for part in found]
        self.order = np.concatenate(placed) if placed else np.zeros(0, np.int64)
        self.v = np.concatenate(sides)[self.order]
        self.starts = np.cumsum([0] + [len(part) for part in placed])
        self.itself = len(sides) == 1 if itself is None else itself
        tiles = list(zip(self.starts[:-1], self.starts[1:]))
        self.centres = np.array([self.v[a:b].mean(0) for a, b in tiles])
        self.radii = np.array([np.sqrt(((self.v[a:b] - c) ** 2).sum(1).max())
                               for (a, b), c in zip(tiles, self.centres)])
        x = self.v - self.v.mean(0) if len(self.v) else self.v
        self.scale = float(np.sqrt((x * x).sum(1).max(initial=0.0))) or 1.0
        self.sure = bool(np.isfinite(self.scale)) and self.scale < 1e150
        if self.sure:
            x = x / self.scale
            half, one = -0.5 * (x * x).sum(1)[:, None], np.ones((len(x), 1))
            # The product of a row of each is minus half their squared distance.
            self.left = np.hstack([x, half, one]).astype(np.float32)
            self.right = np.hstack([x, one, half]).astype(np.float32)
        # Rounding of single precision: some units in the last place for each term.
        self.room = 3e-7 * (self.v.shape[1] + 2)

    def tile(self, t: int) -> slice:
        return slice(int(self.starts[t]), int(self.starts[t + 1]))

    def pairs(self, reach: float | np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs of tiles within ``reach``, of all or of each tile, the closest first."""
        n = len(self.radii)
        if not n:
            return
        reach = np.broadcast_to(np.asarray(reach, float), (n,))
        squares = (self.centres ** 2).sum(1)
        gap = np.sqrt(np.maximum(0.0, squares[:, None] + squares[None, :]
                                 - 2 * self.centres @ self.centres.T))
        # Centres that are near each other lose digits in the difference of squares.
        gap -= self.radii[:, None] + self.radii[None, :] + 1e-6 * np.sqrt(squares.max(initial=0.0))
        near = ~(gap > np.maximum(reach[:, None], reach[None, :]) + SLACK)
        near &= np.tri(n, dtype=bool).T
        if not self.itself:
            near &= self.set_of[:, None] != self.set_of[None, :]
        a, b = np.nonzero(near)
        for k in np.argsort(gap[a, b], kind="stable"):
            yield int(a[k]), int(b[k])

    def halves(self, a: slice, b: slice) -> np.ndarray:
        """Minus half the squared distances of two runs of rows over the squared scale, about;
        infinite where single precision does not tell."""
        if not self.sure:
            return np.full((a.stop - a.start, b.stop - b.start), np.inf, np.float32)
        return self.left[a] @ self.right[b].T

    def strips(self, a: int, b: int) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """(rows, columns, halves) of two tiles, some rows at a time; a tile against itself
        has no pair twice."""
        i, j = self.tile(a), self.tile(b)
        for lo in range(i.start, i.stop, STRIP):
            rows = slice(lo, min(lo + STRIP, i.stop))
            cols = slice(lo, j.stop) if a == b else j
            yield rows, cols, self.halves(rows, cols)

    def bound(self, squares):
        """What `halves` are at least for pairs with squared distances up to ``squares``."""
        if not self.sure:
            return np.where(np.asarray(squares) < 0, np.inf, -np.inf).astype(np.float32)
        return (-0.5 * np.asarray(squares) / self.scale ** 2 - self.room).astype(np.float32)

    def within(self, a: int, b: int, squares: np.ndarray) -> Iterator[tuple]:
        """(row, col, lower): pairs of two tiles that may be as close as one of the two allows,
        and a lower bound of their distance, a strip at a time. ``squares`` are the squared
        distances that the rows of both tiles allow, negative for none."""
        i, j = (np.arange(self.starts[t], self.starts[t + 1]) for t in (a, b))
        allowed = squares[:len(i)], squares[-len(j):]
        asks = [x >= 0 for x in allowed]
        if asks[0].all() or asks[1].all():
            sets = [(i, j)]
        else:
            # Rows that allow nothing meet only those that do.
            sets = [(i[asks[0]], j), (i[~asks[0]], j[asks[1]])]
        least = self.bound(allowed[0]), self.bound(allowed[1])
        for rows, cols in sets:
            right = self.right[self.tile(b) if len(cols) == len(j) else cols] if self.sure else None
            for lo in range(0, len(rows) if len(cols) else 0, STRIP):
                some = rows[lo:lo + STRIP]
                halves = (self.left[some] @ right.T if self.sure else
                          np.full((len(some), len(cols)), np.inf, np.float32))
                mine, other = least[0][some - i[0]], least[1][cols - j[0]]
                hit = halves >= mine[:, None]
                if other.min() < mine.max():
                    hit |= halves >= other[None, :]
                if a == b:
                    hit &= (some[:, None] < cols[None, :] if len(sets) == 1
                            else some[:, None] != cols[None, :])
                at = np.flatnonzero(hit)
                row, col = np.divmod(at, hit.shape[1])
                lower = np.sqrt(np.maximum(0.0, -2 * (halves.ravel()[at].astype(float)
                                                      + self.room))
                                ) * self.scale if self.sure else np.zeros(len(at))
                yield some[row], cols[col], lower

    def near_rows(self, each: int) -> Iterator[tuple]:
        """(row, col): about the ``each`` closest rows of every row among those beside it, and
        among some from everywhere."""
        n = len(self.v)
        spread = np.unique(np.linspace(0, n - 1, min(n, SPREAD)).astype(int))
        for t in range(len(self.radii)):
            for lo in range(int(self.starts[t]), int(self.starts[t + 1]), STRIP):
                rows = np.arange(lo, min(lo + STRIP, int(self.starts[t + 1])))
                for cols in (rows, spread):
                    halves = (self.left[rows] @ self.right[cols].T if self.sure else
                              np.zeros((len(rows), len(cols)), np.float32))
                    halves[rows[:, None] == cols[None, :]] = -np.inf
                    k = min(each, len(cols))
                    col = cols[np.argpartition(halves, len(cols) - k, axis=1)[:, len(cols) - k:]]
                    row = np.repeat(rows, k)
                    apart = row != col.ravel()
                    yield row[apart], col.ravel()[apart]


def components(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The component of each of ``n`` nodes, after those that ``label`` has already joined."""
    label = np.arange(n) if label is None else label
    if not len(i):
        return label
    return spanning_forest(label[i], label[j], np.zeros(len(i)), n)[1][label]


class Growing:
    """A lightest spanning forest of the pairs found so far, of weights up to ``limit``.

    A pair whose ends are already joined by lighter edges is of no use. Components are known
    at ``LEVELS`` weights of the forest, and pairs are asked at the highest level that is not
    above them before they are measured. Every row also knows the level at which it joins the
    core of its own component: two rows of one component are joined at the higher of
    their levels, so farther pairs need not be looked at.
    """

    def __init__(self, n: int, limit: float, part: np.ndarray, flat: bool = False):
        self.n, self.limit, self.flat = n, limit, flat
        nothing = np.zeros(0, np.int64)
        self.i, self.j, self.weight = nothing, nothing, np.zeros(0)
        self.new: list[tuple] = []
        self.held = 0
        self.levels, self.labels = np.zeros(0), np.zeros((0, n), np.int32)
        # What a row allows in its own component, and in others; nothing outside the tree.
        self.own = self.other = np.where(part, limit, -np.inf)
        self.top = np.arange(n)

    def reach(self, at: np.ndarray) -> np.ndarray:
        """The weight up to which pairs among the rows ``at`` may join something, by row: a pair
        is of use when one of its rows allows it."""
        top = self.top[at]
        found, count = np.unique(top, return_counts=True)
        return np.where(top == found[count.argmax()], self.own[at], self.other[at])

    def useful(self, i: np.ndarray, j: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Which pairs may join something, ``lower`` being lower bounds of their weights."""
        if not len(self.levels):
            return np.ones(len(i), bool)
        level = np.searchsorted(self.levels, lower, "right") - 1
        known = np.maximum(level, 0)
        return (level < 0) | (self.labels[known, i] != self.labels[known, j])

    def add(self, i: np.ndarray, j: np.ndarray, weight: np.ndarray) -> None:
        self.new.append((i, j, weight))
        self.held += len(i)
        if self.held >= max(BUFFER, 2 * self.n if len(self.levels) else 0):
            self.settle()

    def settle(self, final: bool = False) -> None:
        parts = [(self.i, self.j, self.weight), *self.new]
        i, j, weight = (np.concatenate(x) for x in zip(*parts))
        kept, _ = spanning_forest(i, j, weight, self.n)
        self.i, self.j, self.weight = i[kept], j[kept], weight[kept]
        self.new, self.held = [], 0
        if final or not len(kept):
            return
        order = np.argsort(self.weight)
        sorted_ = self.weight[order]
        self.levels = np.unique(sorted_[np.linspace(0, len(sorted_) - 1, LEVELS).astype(int)])
        label, lo, labels = None, 0, []
        for level in self.levels:
            hi = int(np.searchsorted(sorted_, level, "right"))
            some = order[lo:hi]
            label, lo = components(self.n, self.i[some], self.j[some], label), hi
            labels.append(label.astype(np.int32))
        self.labels, self.top = np.stack(labels), label
        self.own = np.where(np.isfinite(self.other), -np.inf if self.flat else self.levels[-1],
                            -np.inf)
        if self.flat:
            return
        # Down the levels, the largest part of what was the core above.
        core = np.isfinite(self.other)
        for level, label in zip(self.levels[::-1], labels[::-1]):
            size = np.bincount(label[core], minlength=self.n)
            part = np.flatnonzero(size)
            part = part[np.argsort(size[part], kind="stable")]
            largest = np.full(self.n, -1)
            largest[self.top[part]] = part
            core &= label == largest[self.top]
            self.own[core] = level


def grow_forests(meet: Meeting, metric: str, limits: list[float], cores: np.ndarray,
                 flat: bool = False, beside: bool = False) -> list[Growing]:
    """For each limit the lightest forest of the pairs within it, a pair weighing the largest of
    its measure and its rows' ``cores`` (row, limit). ``flat``: all weights are one. With
    ``beside``, some close pairs of rows of one set count where sets meet only each other: they
    join what need not be joined again."""
    # Rows outside a tree have infinite cores, also where all distances count.
    part = (cores <= np.array(limits)) & (cores < np.inf)
    kinds = [Growing(len(meet.v), limit, part[:, kind], flat) for kind, limit in enumerate(limits)]

    def add(row, col, lower):
        for kind, (limit, found) in enumerate(zip(limits, kinds)):
            core = np.maximum(cores[row, kind], cores[col, kind])
            if flat:
                least = np.maximum(core, limit)
            elif metric == "cosine":
                least = np.maximum(lower ** 2 / 2 - 1 - SLACK, core)
            else:
                least = np.maximum(lower - SLACK, core)
            some = np.flatnonzero((least <= limit) & np.isfinite(least)
                                  & found.useful(row, col, least))
            if not len(some):
                continue
            i, j = row[some], col[some]
            m = np.maximum(exact(meet.v, meet.v, i, j, metric), core[some])
            hit = m <= limit
            # Rounded, so that equal weights of several comparisons are equal.
            found.add(i[hit], j[hit], np.full(hit.sum(), limit) if flat
                      else np.round(m[hit], DIGITS))

    # Rows that lie side by side make the first forest, so that few pairs are looked at.
    for row, col in meet.near_rows(SEEDS) if beside or meet.itself else ():
        add(row, col, np.zeros(len(row)))
    for found in kinds:
        found.settle()
    for a, b in meet.pairs(np.sqrt(squared(max(limits), metric))):
        at = np.arange(meet.starts[a], meet.starts[a + 1])
        at = at if a == b else np.append(at, np.arange(meet.starts[b], meet.starts[b + 1]))
        reach = np.max([found.reach(at) for found in kinds], axis=0)
        far = np.where(reach > -np.inf, squared(reach + SLACK, metric), -1.0)
        if (far < 0).all():
            continue
        for row, col, lower in meet.within(a, b, far):
            if len(row):
                add(row, col, lower)
    for found in kinds:
        found.settle(final=True)
    return kinds


def pairs_found(meet: Meeting, metric: str, limit: float, core: np.ndarray) -> Iterator[tuple]:
    """(i, j, weight) of all pairs within ``limit``, a pair of tiles at a time."""
    far = squared(limit, metric)
    for a, b in meet.pairs(np.sqrt(far)):
        n = meet.starts[a + 1] - meet.starts[a]
        n += meet.starts[b + 1] - meet.starts[b] if a != b else 0
        for i, j, _ in meet.within(a, b, np.full(n, far)):
            if len(i):
                m = np.maximum(exact(meet.v, meet.v, i, j, metric), np.maximum(core[i], core[j]))
                hit = m <= limit
                yield i[hit], j[hit], m[hit]


def _best(i, j, m, ids: np.ndarray, k: int):
    order = np.lexsort((ids[j], m, i))
    i, j, m = i[order], j[order], m[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep], m[keep]


def _shrunk(reach: np.ndarray, found: tuple, metric: str, k: int) -> np.ndarray:
    """``reach`` where fewer than ``k`` are ``found`` (row by row, closest first), else theirs."""
    rows, n = np.unique(found[0], return_counts=True)
    last = np.cumsum(n) - 1
    full = n >= k
    # Measures may be rounded; the reach must not be too short for that.
    far = np.sqrt(squared(found[2][last[full]], metric))
    out = reach.copy()
    out[rows[full]] = np.minimum(out[rows[full]], far + 1e-4 + 1e-6 * far)
    return out


def closest(meet: Meeting, metric: str, k: int, ids: np.ndarray, reach: np.ndarray,
            chosen: Iterable[tuple[int, int]] | None = None, kept: tuple | None = None):
    """(i, j, measure): the ``k`` closest of each row among those it meets, no farther than its
    ``reach``, which shrinks as they are found. Equal measures go by ``ids``. ``kept`` are
    pairs found before, ``chosen`` the pairs of tiles to look at instead of all in reach."""
    nothing = np.zeros(0, np.int64)
    kept, new, held = kept or (nothing, nothing, np.zeros(0)), [], 0
    reach = reach.copy()

    def settle():
        found = _best(*(np.concatenate(x) for x in zip(kept, *new)), ids, k)
        reach[:] = _shrunk(reach, found, metric, k)
        return found
    if chosen is None:
        chosen = meet.pairs(np.array([reach[meet.tile(t)].max() for t in range(len(meet.radii))]))
    for a, b in chosen:
        least = meet.bound(np.square(reach[meet.tile(a)]))
        other = meet.bound(np.square(reach[meet.tile(b)]))
        for rows, cols, halves in meet.strips(a, b):
            start = rows.start - meet.starts[a], cols.start - meet.starts[b]
            hits = [halves >= least[start[0]:start[0] + len(halves), None],
                    halves >= other[None, start[1]:]]
            if a == b:
                for hit in hits:
                    hit[:, :len(hit)] &= ~np.tri(len(hit), dtype=bool)
            at = np.flatnonzero(hits[0] | hits[1])
            if not len(at):
                continue
            row, col = np.divmod(at, halves.shape[1])
            i, j = row + rows.start, col + cols.start
            m = np.round(exact(meet.v, meet.v, i, j, metric), DIGITS)
            one, two = (hit.ravel()[at] for hit in hits)
            new.append((np.append(i[one], j[two]), np.append(j[one], i[two]),
                        np.append(m[one], m[two])))
            held += len(new[-1][0])
            if held >= BUFFER:
                kept, new, held = settle(), [], 0
    return settle()


def first_reach(meet: Meeting, metric: str, k: int, ids: np.ndarray, each: int = 3) -> np.ndarray:
    """A distance within which each row has ``k`` others: those of its own tile and of the
    closest ones. Infinite for rows with fewer."""
    n = len(meet.radii)
    reach = np.full(len(meet.v), np.inf)
    for t in range(n if meet.sure else 0):
        tile = meet.tile(t)
        for lo in range(tile.start, tile.stop, STRIP):
            rows = slice(lo, min(lo + STRIP, tile.stop))
            halves = meet.halves(rows, tile)
            # A row itself is the closest, or as close as the closest.
            if halves.shape[1] > k:
                kth = np.partition(halves, halves.shape[1] - k - 1, axis=1)[:, -k - 1]
                far = np.sqrt(np.maximum(0.0, -2 * (kth.astype(float) - meet.room))) * meet.scale
                reach[rows] = far + 1e-4 + 1e-6 * far
    squares = (meet.centres ** 2).sum(1)
    gap = squares[None, :] - 2 * meet.centres @ meet.centres.T
    np.fill_diagonal(gap, -np.inf)
    close = np.argsort(gap, axis=1, kind="stable")[:, :min(each + 1, n)]
    chosen = sorted({(min(t, int(o)), max(t, int(o))) for t in range(n) for o in close[t]},
                    key=lambda pair: (pair[0] != pair[1], pair))
    return _shrunk(reach, closest(meet, metric, k, ids, reach, chosen), metric, k)
