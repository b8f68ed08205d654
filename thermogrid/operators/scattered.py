"""Scattered points to a smooth field (J5): Delaunay triangulation and C1 cubic triangles.

Every point finds its own star, the triangles around it: seen from the point through an
inversion, its Delaunay neighbours are the convex hull of all others. Points
are dealt to tiles of about equal count; a star is first taken from the tile and the
tiles that touch it. Only points inside the circles of that star (or beyond its
open side) can still change it, and adding points shrinks these, so a star that reaches
other tiles asks each of them once and is then exact. No task holds more than a tile
with its neighbours, or a part of the stars that ask one tile.

Vertex gradients are least squares over the triangles' edges (weight 1 / length**2). Each
triangle is split at its centroid into three cubic Bezier patches whose slope across an
outer edge is linear along it, so the field has a continuous gradient and is exact
on linear data. Decisions on orientation and circles are exact: a floating-point
filter, then rational arithmetic. Points on one circle form a polygon, which is cut into
triangles from its first vertex by (x, y), whichever star finds it.

Edge cases: points with a null or NaN coordinate or value are left out; of points at one
position the one with the smallest ``pid`` stays. Outside the convex hull, and with fewer
than three points or points on one line, the value is null.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.operators.grid import grid_cells
from thermogrid.session import checkpoint_root, work_partitions

TILE_POINTS = 400    # points of a tile, about
PART = 2000          # stars that ask one tile in one group
BAND = 64            # grid rows of a triangle that one row of work covers
CHUNK = 1 << 20      # cells evaluated together
NEAREST = 24         # points of the first guess of a star
OPEN = 8             # points added beyond each end of an open star at once
ROUNDS = 16          # rounds of such additions
INSIDE = -1e-11      # smallest barycentric coordinate of a cell that counts as inside

# Forward error bounds of the two determinants below, in units of the sums of
# their absolute terms (2**-53 is half a unit in the last place).
_CROSS = 4 * 2.0 ** -53
_CIRCLE = 12 * 2.0 ** -53


# ------------------------------------------------------------------ predicates

class Site:
    """A point with others around it, in coordinates relative to it."""

    def __init__(self, px: float, py: float, xs: np.ndarray, ys: np.ndarray):
        self.p, self.abs = (px, py), (xs.tolist(), ys.tolist())
        dx, dy = xs - px, ys - py
        self.dx, self.dy, self.d2 = dx.tolist(), dy.tolist(), (dx * dx + dy * dy).tolist()
        self.angle = np.arctan2(dy, dx)

    def _exact(self, i: int) -> tuple[Fraction, Fraction]:
        return (Fraction(self.abs[0][i]) - Fraction(self.p[0]), Fraction(self.abs[1][i]) - Fraction(self.p[1]))

    def cross(self, a: int, b: int) -> float:
        """Sign of the turn from a to b, seen from the site."""
        l, r = self.dx[a] * self.dy[b], self.dy[a] * self.dx[b]
        if abs(l - r) > _CROSS * (abs(l) + abs(r)):
            return l - r
        (ax, ay), (bx, by) = self._exact(a), self._exact(b)
        d = ax * by - ay * bx
        return (d > 0) - (d < 0)

    def circle(self, a: int, b: int, c: int) -> float:
        """Positive if b belongs between a and c on the star, negative if it does not, zero
        if all three and the site lie on one circle."""
        dx, dy, d2 = self.dx, self.dy, self.d2
        m1, m2, m3 = dx[b] * dy[c], dx[c] * dy[a], dx[a] * dy[b]
        n1, n2, n3 = dx[c] * dy[b], dx[a] * dy[c], dx[b] * dy[a]
        det = d2[a] * (m1 - n1) + d2[b] * (m2 - n2) + d2[c] * (m3 - n3)
        size = d2[a] * (abs(m1) + abs(n1)) + d2[b] * (abs(m2) + abs(n2)) + d2[c] * (abs(m3) + abs(n3))
        if abs(det) > _CIRCLE * size:
            return det
        (ax, ay), (bx, by), (cx, cy) = self._exact(a), self._exact(b), self._exact(c)
        exact = ((ax * ax + ay * ay) * (bx * cy - cx * by) + (bx * bx + by * by) * (cx * ay - ax * cy)
                 + (cx * cx + cy * cy) * (ax * by - bx * ay))
        return (exact > 0) - (exact < 0)

    def around(self, some: list[int]) -> list[int]:
        """The points by angle; of those in one direction the nearest."""
        order = [some[i] for i in np.argsort(self.angle[some], kind="stable").tolist()]
        for i in range(1, len(order)):  # angles that rounding may have swapped
            j = i
            while j and self.angle[order[j]] - self.angle[order[j - 1]] < 1e-9 and self.cross(order[j - 1], order[j]) < 0:
                order[j - 1], order[j] = order[j], order[j - 1]
                j -= 1
        out: list[int] = []
        for i in order:
            if out and self._same_way(out[-1], i):
                out[-1] = min(out[-1], i, key=lambda k: self.d2[k])
            else:
                out.append(i)
        if len(out) > 1 and self._same_way(out[-1], out[0]):
            last = out.pop()
            out[0] = min(out[0], last, key=lambda k: self.d2[k])
        return out

    def _same_way(self, a: int, b: int) -> bool:
        return self.dx[a] * self.dx[b] + self.dy[a] * self.dy[b] > 0 and self.cross(a, b) == 0

    def star(self, some: list[int]) -> tuple[list[int], bool]:
        """Delaunay neighbours among ``some``, counterclockwise, and whether they close
        around the site; an open star begins and ends on the hull."""
        ring = self.around(some)
        n = len(ring)
        gaps = [k for k in range(n) if n == 1 or self.cross(ring[k], ring[(k + 1) % n]) <= 0]
        closed = not gaps and n > 2
        if closed:
            first = min(range(n), key=lambda k: self.d2[ring[k]])
            walk = ring[first:] + ring[:first + 1]
        else:
            first = (gaps[0] + 1) % n
            walk = ring[first:] + ring[:first]
        hull: list[int] = []
        for q in walk:
            while len(hull) >= 2 and self.circle(hull[-2], hull[-1], q) < 0:
                hull.pop()
            hull.append(q)
        return (hull[:-1] if closed else hull), closed

    def disc(self, a: int, b: int) -> tuple[float, float, float]:
        """Circle through the site, a and b: centre (absolute) and radius."""
        d = 2 * (self.dx[a] * self.dy[b] - self.dy[a] * self.dx[b])
        if d == 0:
            return self.p[0], self.p[1], np.inf
        ux = (self.dy[b] * self.d2[a] - self.dy[a] * self.d2[b]) / d
        uy = (self.dx[a] * self.d2[b] - self.dx[b] * self.d2[a]) / d
        return self.p[0] + ux, self.p[1] + uy, float(np.hypot(ux, uy))


def _grown(px: float, py: float, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Places of points among which the star of (px, py) is that of all: the nearest ones, to which are added, as long as there
    are any, points inside a circle of the star or beyond its open side. All points if that takes more than ``ROUNDS``."""
    dx, dy = xs - px, ys - py
    d2 = dx * dx + dy * dy
    use = np.argpartition(d2, NEAREST)[:NEAREST]
    held = np.zeros(xs.size, bool)
    held[use] = True
    for _ in range(ROUNDS):
        s = Site(px, py, xs[use], ys[use])
        ring, closed = s.star(list(range(use.size)))
        new = []
        for a, b in zip(ring, ring[1:] + ring[:1] if closed else ring[1:]):
            d = 2 * (s.dx[a] * s.dy[b] - s.dy[a] * s.dx[b])
            if d <= 2e-6 * (s.d2[a] * s.d2[b]) ** 0.5:  # too flat for a circle in floating point
                return np.arange(xs.size)
            ux = (s.dy[b] * s.d2[a] - s.dy[a] * s.d2[b]) / d
            uy = (s.dx[a] * s.d2[b] - s.dx[b] * s.d2[a]) / d
            to = (dx - ux) ** 2 + (dy - uy) ** 2
            to[held] = np.inf
            k = int(to.argmin())
            if to[k] <= (ux * ux + uy * uy) * (1 + 1e-6):
                new.append(k)
        if not closed:
            if not ring:
                return np.arange(xs.size)
            for q, sign in ((ring[0], -1.0), (ring[-1], 1.0)):
                one, two = s.dx[q] * dy, s.dy[q] * dx
                beyond = np.flatnonzero(~held & (sign * (one - two) >= -1e-9 * (np.abs(one) + np.abs(two))))
                if beyond.size > OPEN:
                    beyond = beyond[np.argpartition(d2[beyond], OPEN)[:OPEN]]
                new += beyond.tolist()
        if not new:
            return use
        more = np.unique(np.array(new, np.int64))
        held[more] = True
        use = np.concatenate([use, more])
    return np.arange(xs.size)


def star_of(px: float, py: float, xs: np.ndarray, ys: np.ndarray) -> tuple[np.ndarray, bool, list]:
    """Neighbours of (px, py) among the points (places in ``xs``), whether the star is
    closed, and its circles."""
    if not xs.size:
        return np.zeros(0, np.int64), False, []
    use = np.arange(xs.size)
    if use.size > 2 * NEAREST:
        use = _grown(px, py, xs, ys)
    s = Site(px, py, xs[use], ys[use])
    ring, closed = s.star(list(range(use.size)))
    pairs = zip(ring, ring[1:] + ring[:1] if closed else ring[1:])
    return use[ring], closed, [s.disc(a, b) for a, b in pairs]


def own_triangles(px: float, py: float, xs: np.ndarray, ys: np.ndarray, closed: bool) -> list[tuple[int, int]]:
    """The (a, b) of the triangles (site, a, b) that this site hands out, for its exact star in order: those
    of polygons whose first vertex by (x, y) it is."""
    s = Site(px, py, xs, ys)
    n = xs.size
    edges = [(k, (k + 1) % n) for k in range(n if closed else n - 1)]
    edges = [(a, b) for a, b in edges if s.cross(a, b) > 0]
    if not edges:
        return []
    # neighbouring edges on one circle are one polygon
    joint = [s.circle(a, b, d) == 0 if b == c else False for (a, b), (c, d) in zip(edges, edges[1:])]
    groups = [[edges[0]]]
    for e, same in zip(edges[1:], joint):
        if same:
            groups[-1].append(e)
        else:
            groups.append([e])
    if closed and len(groups) > 1 and s.circle(edges[-1][0], edges[-1][1], edges[0][1]) == 0:
        groups[0] = groups.pop() + groups[0]
    here = (px, py)
    return [e for g in groups if all(here < (s.abs[0][k], s.abs[1][k]) for e in g for k in e) for e in g]


# ------------------------------------------------------------------ tiles

class Tiles:
    """Stripes along x, each cut along y, of about equal count; ``x_cuts`` and ``y_cuts`` (per
    stripe) are upper bounds. One number per cut travels to the driver and back."""

    def __init__(self, x_cuts: list[float], y_cuts: list[list[float]]):
        self.x = np.array(x_cuts, float)
        self.y = [np.array(c, float) for c in y_cuts]
        self.first = np.concatenate([[0], np.cumsum([c.size + 1 for c in self.y])])

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        stripe = np.searchsorted(self.x, x, side="left")
        out = np.empty(x.size, np.int64)
        for s in np.unique(stripe).tolist():
            k = stripe == s
            out[k] = self.first[s] + np.searchsorted(self.y[s], y[k], side="left")
        return out

    def touching(self) -> list[list[int]]:
        """For each tile itself and those that share a border or a corner with it."""
        out = []
        for s, cuts in enumerate(self.y):
            edge = np.concatenate([[-np.inf], cuts, [np.inf]])
            for j in range(cuts.size + 1):
                near = [self.first[s] + k for k in (j - 1, j, j + 1) if 0 <= k <= cuts.size]
                for o in (s - 1, s + 1):
                    if 0 <= o < len(self.y):
                        lo = np.searchsorted(self.y[o], edge[j], side="left")
                        hi = np.searchsorted(self.y[o], edge[j + 1], side="right")
                        near += list(range(self.first[o] + lo, self.first[o] + min(hi, self.y[o].size) + 1))
                out.append([int(k) for k in near])
        return out


def _tiles(pts: DataFrame, n: int, tile_points: int) -> Tiles:
    side = max(1, int(np.ceil(np.sqrt(n / tile_points))))
    inner = [k / side for k in range(1, side)]
    if not inner:
        return Tiles([], [[]])
    cuts = sorted(set(pts.agg(F.percentile_approx("x", inner, 10 * side + 1000)).first()[0]))
    of = F.lit(0)
    for start in range(0, len(cuts), 500):
        part = F.array(*[F.lit(c) for c in cuts[start:start + 500]])
        of = of + F.size(F.filter(part, lambda c: c < F.col("x")))
    stripes = pts.select(of.alias("s"), "y")
    sizes = {r.s: r.n for r in stripes.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = max(int(np.ceil(k / tile_points)) for k in sizes.values())
    steps = [k / most for k in range(1, most)]
    y_cuts: list[list[float]] = [[] for _ in range(len(cuts) + 1)]
    if steps:
        for r in stripes.groupBy("s").agg(F.percentile_approx("y", steps, 10 * most + 1000).alias("q")).collect():
            own = max(1, int(np.ceil(sizes[r.s] / tile_points)))
            y_cuts[r.s] = sorted({r.q[min(most - 2, k * most // own - 1)] for k in range(1, own) if k * most // own >= 1})
    return Tiles(cuts, y_cuts)


def _reached(boxes: np.ndarray, px: float, py: float, xs, ys, ring, closed: bool, circles) -> np.ndarray:
    """Which of the boxes (x0, x1, y0, y1) hold places that could change a star."""
    hit = np.zeros(len(boxes), bool)
    for cx, cy, radius in circles:
        dx = np.maximum(np.maximum(boxes[:, 0] - cx, cx - boxes[:, 1]), 0)
        dy = np.maximum(np.maximum(boxes[:, 2] - cy, cy - boxes[:, 3]), 0)
        hit |= dx * dx + dy * dy <= radius * radius * (1 + 1e-9)
    if closed or not len(boxes):
        return hit
    if not len(ring):
        return np.ones(len(boxes), bool)
    # beyond the open side: right of the way to the first neighbour, left of that to the last
    for k, sign in ((ring[0], -1.0), (ring[-1], 1.0)):
        ex, ey = xs[k] - px, ys[k] - py
        size = (np.abs(boxes).max() + abs(px) + abs(py)) * (abs(ex) + abs(ey)) * 1e-14
        for i in (0, 1):
            for j in (2, 3):
                hit |= sign * (ex * (boxes[:, j] - py) - ey * (boxes[:, i] - px)) >= -size
    return hit


POINT = "x double, y double, v double"
STAR = f"{POINT}, closed boolean, nx array<double>, ny array<double>, nv array<double>"


def _star_rows(x, y, v, closed, nx, ny, nv, **more) -> pa.Table:
    lists = pa.list_(pa.float64())
    return pa.table({"x": pa.array(x, pa.float64()), "y": pa.array(y, pa.float64()), "v": pa.array(v, pa.float64()),
                     "closed": pa.array(closed, pa.bool_()), "nx": pa.array(nx, lists), "ny": pa.array(ny, lists),
                     "nv": pa.array(nv, lists), **more})


def _column(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def stars(pts: DataFrame, n: int, tile_points: int = TILE_POINTS) -> DataFrame:
    """(x, y, v, closed, nx, ny, nv): for each of the distinct points (x, y, v) its exact Delaunay star,
    counterclockwise. ``pts`` must be cut from its lineage: it is read several times."""
    spark = pts.sparkSession
    tiles = _tiles(pts, n, tile_points)
    shared = spark.sparkContext.broadcast((tiles, [np.array(t) for t in tiles.touching()]))

    def dealt(batches):
        tiles, near = shared.value
        for b in batches:
            of = tiles.of(b.column(0).to_numpy(), b.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of)], names=["x", "y", "v", "tile"])

    placed = pts.select("x", "y", "v").mapInArrow(dealt, f"{POINT}, tile long").checkpoint(eager=True)
    # a row per tile, that is one per TILE_POINTS points
    box = placed.groupBy("tile").agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).toArrow()
    boxes = spark.sparkContext.broadcast((_column(box, "tile"), np.stack(
        [_column(box, c) for c in ("min(x)", "max(x)", "min(y)", "max(y)")], axis=1)))

    def spread(batches):
        near = shared.value[1]
        for b in batches:
            tile = b.column(3).to_numpy()
            group = [near[t] for t in tile.tolist()]  # touching is symmetric
            take = pa.array(np.repeat(np.arange(tile.size), [len(g) for g in group]))
            where = np.concatenate(group) if group else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*[c.take(take) for c in b.columns], pa.array(where.astype(np.int64))],
                                             names=["x", "y", "v", "tile", "group"])

    def first(key, table):
        here = key[0].as_py()
        x, y, v, tile = (_column(table, c) for c in ("x", "y", "v", "tile"))
        names, sides = boxes.value
        other = ~np.isin(names, shared.value[1][here])
        own = np.flatnonzero(tile == here)
        rows = []
        for i in own.tolist():
            rest = np.arange(x.size) != i
            xs, ys, vs = x[rest], y[rest], v[rest]
            ring, closed, circles = star_of(x[i], y[i], xs, ys)
            todo = names[other][_reached(sides[other], x[i], y[i], xs, ys, ring, closed, circles)]
            rows.append((x[i], y[i], v[i], closed, xs[ring], ys[ring], vs[ring], todo))
        cols = list(zip(*rows)) if rows else [()] * 8
        return _star_rows(*cols[:7], todo=pa.array(cols[7], pa.list_(pa.int64())))

    found = (placed.mapInArrow(spread, f"{POINT}, tile long, group long").groupBy("group")
             .applyInArrow(first, f"{STAR}, todo array<long>").checkpoint(eager=True))

    asked = found.where(F.size("todo") > 0).select("*", F.explode("todo").alias("tile")).drop("todo")
    sizes = asked.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    asked = asked.join(sizes, "tile").withColumn("part", F.pmod(F.xxhash64("x", "y"), F.col("parts")).cast("int")).drop("parts")
    held = (placed.join(asked.select("tile", "part").distinct(), "tile")
            .select("x", "y", "v", F.col("tile").alias("at"), F.col("part").alias("share")))

    def ask(key, stars, table):
        x, y, v = (_column(table, c) for c in ("x", "y", "v"))
        rows = []
        for px, py, pv, nx, ny, nv in zip(*(_column(stars, c) for c in ("x", "y", "v")),
                                          *(stars.column(c).to_pylist() for c in ("nx", "ny", "nv"))):
            xs, ys, vs = (np.concatenate([np.array(a, float), b]) for a, b in ((nx, x), (ny, y), (nv, v)))
            ring, closed, _ = star_of(px, py, xs, ys)
            new = ring[ring >= len(nx)]
            if new.size:
                rows.append((px, py, pv, closed, xs[new], ys[new], vs[new]))
        return _star_rows(*(list(zip(*rows)) if rows else [()] * 7))

    more = asked.groupBy("tile", "part").cogroup(held.groupBy("at", "share")).applyInArrow(ask, STAR)

    def last(batches):
        for b in batches:
            rows = []
            for px, py, pv, nx, ny, nv in zip(*(c.to_pylist() for c in b.columns)):
                xs, ys, vs = (np.array([q for part in a for q in part], float) for a in (nx, ny, nv))
                ring, closed, _ = star_of(px, py, xs, ys)
                rows.append((px, py, pv, closed, xs[ring], ys[ring], vs[ring]))
            yield from _star_rows(*(list(zip(*rows)) if rows else [()] * 7)).to_batches()

    lists = [F.collect_list(c).alias(c) for c in ("nx", "ny", "nv")]
    open_ = found.where(F.size("todo") > 0).drop("todo").unionByName(more)
    joined = open_.groupBy("x", "y", "v").agg(*lists).mapInArrow(last, STAR)
    return found.where(F.size("todo") == 0).drop("todo").unionByName(joined)


TRIANGLE = ", ".join(f"{c}{k} double" for k in "abc" for c in "xyv")


def triangles(pts: DataFrame, n: int, tile_points: int = TILE_POINTS) -> DataFrame:
    """(xa, ya, va, xb, ...): the Delaunay triangles of the distinct points, counterclockwise, each once."""
    def run(batches):
        for b in batches:
            rows = []
            for px, py, pv, closed, nx, ny, nv in zip(*(c.to_pylist() for c in b.columns)):
                for i, j in own_triangles(px, py, np.array(nx, float), np.array(ny, float), closed):
                    rows.append((px, py, pv, nx[i], ny[i], nv[i], nx[j], ny[j], nv[j]))
            cols = list(zip(*rows)) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in cols],
                                             names=[f"{c}{k}" for k in "abc" for c in "xyv"])

    return stars(pts, n, tile_points).mapInArrow(run, TRIANGLE)


# ------------------------------------------------------------------ surface

def gradients(tri: DataFrame) -> DataFrame:
    """(x, y, gx, gy): slopes at the vertices of the triangles."""
    ends = [(a, b) for a in "abc" for b in "abc" if a != b]
    edge = F.explode(F.array(*[F.struct(F.col(f"x{a}").alias("x"), F.col(f"y{a}").alias("y"), (F.col(f"x{b}") - F.col(f"x{a}")).alias("dx"),
                                        (F.col(f"y{b}") - F.col(f"y{a}")).alias("dy"), (F.col(f"v{b}") - F.col(f"v{a}")).alias("dv"))
                               for a, b in ends]))
    e = tri.select(edge.alias("e")).select("e.*")
    dx, dy, dv = F.col("dx"), F.col("dy"), F.col("dv")
    w = 1 / (dx * dx + dy * dy)
    s = e.groupBy("x", "y").agg(F.sum(w * dx * dx).alias("xx"), F.sum(w * dx * dy).alias("xy"), F.sum(w * dy * dy).alias("yy"),
                                F.sum(w * dx * dv).alias("xv"), F.sum(w * dy * dv).alias("yv"))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    solve = lambda n: F.when(det > 0, n / det).otherwise(0.0)
    return s.select("x", "y", solve(F.col("xv") * F.col("yy") - F.col("yv") * F.col("xy")).alias("gx"),
                    solve(F.col("yv") * F.col("xx") - F.col("xv") * F.col("xy")).alias("gy"))


def _patches(t: dict[str, np.ndarray]):
    """Bezier ordinates of the three patches of each triangle, opposite to its vertices 0, 1, 2."""
    p = [np.stack([t[f"x{k}"], t[f"y{k}"]], axis=1) for k in "abc"]
    g = [np.stack([t[f"gx{k}"], t[f"gy{k}"]], axis=1) for k in "abc"]
    f = [t[f"v{k}"] for k in "abc"]
    mid = (p[0] + p[1] + p[2]) / 3
    along = lambda i, to: f[i] + ((to - p[i]) * g[i]).sum(axis=1) / 3
    third = {(i, j): along(i, p[j]) for i in range(3) for j in range(3) if i != j}
    inward = [along(i, mid) for i in range(3)]
    across = {}
    for i, j in ((0, 1), (1, 2), (2, 0)):
        e = p[j] - p[i]
        s = ((mid - p[i]) * e).sum(axis=1) / (e * e).sum(axis=1)  # foot of the centroid on the edge
        one = -(1 - s) * f[i] - s * third[i, j] + inward[i]
        two = -(1 - s) * third[j, i] - s * f[j] + inward[j]
        across[i, j] = across[j, i] = (one + two) / 2 + (1 - s) * third[i, j] + s * third[j, i]
    ring = [(inward[i] + across[i, (i + 1) % 3] + across[i, (i + 2) % 3]) / 3 for i in range(3)]
    top = (ring[0] + ring[1] + ring[2]) / 3
    out = []
    for k in range(3):
        a, b = (k + 1) % 3, (k + 2) % 3
        out.append(np.stack([f[a], f[b], top, third[a, b], third[b, a], inward[a], inward[b], ring[a], ring[b], across[a, b]], axis=1))
    return np.stack(out, axis=1)


def surface(t: dict[str, np.ndarray], of: np.ndarray, x: np.ndarray, y: np.ndarray):
    """Value at (x, y) in the triangles ``of``, and the smallest barycentric coordinate."""
    ax, ay, bx, by, cx, cy = (t[c][of] for c in ("xa", "ya", "xb", "yb", "xc", "yc"))
    area = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    l0 = ((bx - x) * (cy - y) - (by - y) * (cx - x)) / area
    l1 = ((cx - x) * (ay - y) - (cy - y) * (ax - x)) / area
    bary = np.stack([l0, l1, 1 - l0 - l1], axis=1)
    k = bary.argmin(axis=1)
    row = np.arange(of.size)
    least = bary[row, k]
    o = _patches(t)[of, k]
    s, u, w = bary[row, (k + 1) % 3] - least, bary[row, (k + 2) % 3] - least, 3 * least
    v = (o[:, 0] * s ** 3 + o[:, 1] * u ** 3 + o[:, 2] * w ** 3
         + 3 * (o[:, 3] * s * s * u + o[:, 4] * s * u * u + o[:, 5] * s * s * w + o[:, 6] * u * u * w + o[:, 7] * s * w * w + o[:, 8] * u * w * w)
         + 6 * o[:, 9] * s * u * w)
    return v, least


def _sloped(tri: DataFrame) -> DataFrame:
    """Triangles with the slopes of their vertices (gxa, gya, ...)."""
    key = [f"{c}{k}" for k in "abc" for c in "xyv"]
    vertex = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
                                 for n, k in enumerate("abc")])).alias("p")
    rows = tri.select(*key, vertex).select(*key, "p.*").join(gradients(tri), ["x", "y"])
    pick = [F.max(F.when(F.col("n") == n, F.col(g))).alias(f"{g}{k}") for n, k in enumerate("abc") for g in ("gx", "gy")]
    return rows.groupBy(*key).agg(*pick)


def interpolate_scattered(points: DataFrame, rows: int, cols: int, tile_points: int = TILE_POINTS) -> DataFrame:
    """J5 for scattered points ``pid, x, y, v`` (grid units, x along the rows): ``r, c, v`` for every cell
    of a ``rows`` x ``cols`` grid, null outside the points' convex hull."""
    spark = points.sparkSession
    checkpoint_root(spark)
    num = lambda c: F.col(c).cast("double")
    usable = (num("x").isNotNull() & num("y").isNotNull() & num("v").isNotNull()
              & ~F.isnan(num("x")) & ~F.isnan(num("y")) & ~F.isnan(num("v")))
    pts = (points.where(usable).select((num("x") + 0.0).alias("x"), (num("y") + 0.0).alias("y"), "pid", num("v").alias("v"))
           .groupBy("x", "y").agg(F.min(F.struct("pid", "v")).alias("p")).select("x", "y", F.col("p.v").alias("v"))
           .checkpoint(eager=True))
    tri = triangles(pts, pts.count(), tile_points).checkpoint(eager=True)
    lo = lambda c: F.greatest(F.ceil(F.least(*[F.col(f"{c}{k}") for k in "abc"]) - 1e-9), F.lit(0))
    hi = lambda c, n: F.least(F.floor(F.greatest(*[F.col(f"{c}{k}") for k in "abc"]) + 1e-9), F.lit(n - 1))
    boxed = _sloped(tri).withColumns({"r0": lo("x"), "r1": hi("x", rows), "c0": lo("y"), "c1": hi("y", cols)})
    bands = (boxed.where("r0 <= r1 and c0 <= c1")
             .withColumn("band", F.explode(F.sequence(F.floor(F.col("r0") / BAND), F.floor(F.col("r1") / BAND))))
             .withColumns({"r0": F.greatest("r0", F.col("band") * BAND), "r1": F.least("r1", F.col("band") * BAND + BAND - 1)})
             .repartition(work_partitions(rows * cols, 50_000), "xa", "ya", "xb", "yb", "band"))

    def run(batches):
        for b in batches:
            t = {n: b.column(i).to_numpy() for i, n in enumerate(b.schema.names)}
            r0, r1, c0, c1 = (t[k].astype(np.int64) for k in ("r0", "r1", "c0", "c1"))
            wide = c1 - c0 + 1
            size = (r1 - r0 + 1) * wide
            ends = np.cumsum(size)
            i = 0
            while i < size.size:
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CHUNK, side="right")))
                of = np.repeat(np.arange(j - i), size[i:j])
                k = np.arange(of.size) - np.repeat(np.cumsum(size[i:j]) - size[i:j], size[i:j])
                r, c = r0[i:j][of] + k // wide[i:j][of], c0[i:j][of] + k % wide[i:j][of]
                part = {n: a[i:j] for n, a in t.items()}
                v, least = surface(part, of, r.astype(float), c.astype(float))
                ok = least >= INSIDE
                yield pa.RecordBatch.from_arrays([pa.array(r[ok].astype(np.int32)), pa.array(c[ok].astype(np.int32)), pa.array(v[ok]),
                                                  pa.array(least[ok])], names=["r", "c", "v", "least"])
                i = j

    # a cell on an edge is met by both triangles, with equal values
    met = bands.mapInArrow(run, "r int, c int, v double, least double").groupBy("r", "c").agg(F.max_by("v", "least").alias("v"))
    return grid_cells(spark, rows, cols).join(met, ["r", "c"], "left")
