"""Web-map tiles that polygons cover, counted for every zoom.

A tile ``(z, tx, ty)`` is covered by a polygon if a point of its rings lies in the
tile (left and upper edges belong to it) or the tile's middle lies inside by the
even-odd rule, holes included. Work is done on the finest zoom by scan lines:
every segment is cut at the tile rows it passes, which gives the columns it
touches in each row and where it crosses the row's middle; between the odd and
the even crossings of a row lies the inside. The columns of a row are merged to
disjoint ranges, so a polygon of any size is a few numbers a row, never a list
of tiles. A coarser zoom's ranges are the finer one's with the last bit dropped.

Counting is by differences: a range adds one where it begins and takes one away
behind its end. These are added up in each task and by Spark (``groupBy``), and
a running total over each tile row gives runs of equal counts, which alone are
written out as tiles. What is shuffled is thus bounded by the tile grid, not by
polygons or their sizes, and no tile, however hot, meets in one task.

Borders: a point beyond latitude +-85.0511 counts on the border row, and one on
the lower border in the last row. Columns wrap at the antimeridian: a polygon
that goes on past 180 degrees covers tiles on the other side, one that is wider
than the world covers each column once; one that only touches 180 degrees from
the west does not. NULL geometries, and kinds without area, cover nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areatab.operators.geo import EARTH_RADIUS, MAX_ZOOM, wkb_rings

WORLD = 2 * math.pi * EARTH_RADIUS
#: Differences that a task gathers before it passes them on.
GATHERED = 1 << 20


def grid(x: np.ndarray, y: np.ndarray, zoom: int) -> tuple[np.ndarray, np.ndarray]:
    """Web Mercator metres -> tile units at ``zoom``, y downwards and kept within the world."""
    n = float(1 << zoom)
    return (x / WORLD + 0.5) * n, np.clip((0.5 - y / WORLD) * n, 0.0, n)


def segments(rings: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, start points, end points) of the rings of all features; an open ring is closed."""
    feature, starts, ends = [], [], []
    for i, own in enumerate(rings):
        for ring in own:
            if len(ring):
                starts.append(ring)
                ends.append(np.concatenate([ring[1:], ring[:1]]))
                feature.append(np.full(len(ring), i))
    if not feature:
        return np.zeros(0, np.int64), np.zeros((0, 2)), np.zeros((0, 2))
    return np.concatenate(feature), np.concatenate(starts), np.concatenate(ends)


def merged(feature: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of columns of each feature and row, joined where they overlap or touch."""
    by = np.lexsort((lo, row, feature))
    feature, row, lo, hi = feature[by], row[by], lo[by], hi[by]
    if not len(by):
        return feature, row, lo, hi
    group = np.cumsum(np.r_[True, (np.diff(feature) != 0) | (np.diff(row) != 0)]) - 1
    # the furthest end so far within a group: groups lifted above one another
    lift = group * (int(hi.max()) - int(lo.min()) + 2)
    furthest = np.maximum.accumulate(hi + lift) - lift
    new = np.r_[True, (np.diff(group) != 0) | (lo[1:] > furthest[:-1] + 1)]
    first = np.flatnonzero(new)
    return feature[first], row[first], lo[first], np.maximum.reduceat(hi, first)


def cover(rings: list[list[np.ndarray]], zoom: int) -> tuple[np.ndarray, ...]:
    """(feature, row, first column, last column) of the tiles that each feature's rings (metres) cover; columns don't wrap yet."""
    feature, a, b = segments(rings)
    (u1, v1), (u2, v2) = grid(a[:, 0], a[:, 1], zoom), grid(b[:, 0], b[:, 1], zoom)
    last = (1 << zoom) - 1
    # a feature that ends on the world's right edge does not begin on the other side
    east = np.full(len(rings), -np.inf)
    np.maximum.at(east, feature, np.maximum(u1, u2))
    edge = np.where(east == last + 1, last, np.iinfo(np.int64).max)[feature]
    top = np.minimum(np.floor(np.minimum(v1, v2)).astype(np.int64), last)
    bottom = np.minimum(np.floor(np.maximum(v1, v2)).astype(np.int64), last)
    count = bottom - top + 1
    s = np.repeat(np.arange(len(feature)), count)
    row = np.repeat(top - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    f, u1, v1, u2, v2, edge = feature[s], u1[s], v1[s], u2[s], v2[s], edge[s]
    # the part of the segment within the row; its ends are taken as they are where they lie in it
    with np.errstate(divide="ignore", invalid="ignore"):
        def at(line: np.ndarray) -> np.ndarray:
            x = (u1 * (v2 - line) + u2 * (line - v1)) / (v2 - v1)
            return np.clip(x, np.minimum(u1, u2), np.maximum(u1, u2))

        upper, lower = at(row), at(row + 1)
        middle = at(row + 0.5)
    down = v1 <= v2
    left = np.where(np.where(down, v1, v2) >= row, np.where(down, u1, u2), upper)
    ends_here = (np.where(down, v2, v1) < row + 1) | (row == last)
    right = np.where(ends_here, np.where(down, u2, u1), lower)
    # where it leaves the row through the lower border, that point is the next row's
    first, final = np.floor(left), np.where(~ends_here & (right > left), np.ceil(right) - 1, np.floor(right))
    lo = np.minimum(np.minimum(first, final).astype(np.int64), edge)
    hi = np.minimum(np.maximum(first, final).astype(np.int64), edge)
    # a segment crosses the middle of a row if its ends lie on different sides; a middle on the line counts as below
    crossing = (v1 > row + 0.5) != (v2 > row + 0.5)
    cf, cr, cu = f[crossing], row[crossing], middle[crossing]
    by = np.lexsort((cu, cr, cf))
    cf, cr, cu = cf[by], cr[by], cu[by]
    inside_lo = np.ceil(cu[0::2] - 0.5).astype(np.int64)  # tiles whose middle lies between two crossings
    inside_hi = np.ceil(cu[1::2] - 0.5).astype(np.int64) - 1
    full = inside_lo <= inside_hi
    return merged(np.r_[f, cf[0::2][full]], np.r_[row, cr[0::2][full]], np.r_[lo, inside_lo[full]], np.r_[hi, inside_hi[full]])


def wrapped(feature: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, zoom: int) -> tuple[np.ndarray, ...]:
    """Ranges brought into the world's columns; one that passes the antimeridian is two."""
    n = 1 << zoom
    whole = hi - lo + 1 >= n
    lo, hi = np.where(whole, 0, lo), np.where(whole, n - 1, hi)
    start = lo % n
    end = start + hi - lo
    over = end >= n
    parts = [np.r_[x, x[over]] for x in (feature, row)]
    return merged(*parts, np.r_[start, np.zeros(int(over.sum()), np.int64)], np.r_[np.minimum(end, n - 1), end[over] - n])


def differences(rings: list[list[np.ndarray]], min_zoom: int, max_zoom: int) -> tuple[np.ndarray, ...]:
    """(z, ty, tx, change): where the number of covering features changes along each tile row, summed up."""
    ranges = wrapped(*cover(rings, max_zoom), max_zoom)
    found = []
    for z in range(max_zoom, min_zoom - 1, -1):
        feature, row, lo, hi = ranges
        found += [(z, row, lo, 1), (z, row, hi + 1, -1)]
        ranges = merged(feature, row >> 1, lo >> 1, hi >> 1)
    z = np.concatenate([np.full(len(r), k) for k, r, _, _ in found])
    return summed(z, *(np.concatenate([x[i] for x in found]) for i in (1, 2)), np.concatenate([np.full(len(r), d) for _, r, _, d in found]))


def summed(z: np.ndarray, ty: np.ndarray, tx: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, ...]:
    by = np.lexsort((tx, ty, z))
    z, ty, tx, change = z[by], ty[by], tx[by], change[by]
    if not len(by):
        return z, ty, tx, change
    first = np.flatnonzero(np.r_[True, (np.diff(z) != 0) | (np.diff(ty) != 0) | (np.diff(tx) != 0)])
    total = np.add.reduceat(change, first)
    first, total = first[total != 0], total[total != 0]
    return z[first], ty[first], tx[first], total


def tile_cover_polygons(df: DataFrame, geometry: str = "geometry", min_zoom: int = 0, max_zoom: int = MAX_ZOOM) -> DataFrame:
    """Polygons per tile for every zoom level, ``(z, tx, ty, n)``; ``geometry`` is WKB in Web Mercator metres."""
    names = ["z", "ty", "tx", "change"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def gathered() -> tuple[np.ndarray, ...]:
            return summed(*(np.concatenate(x) for x in zip(*held, strict=True)))

        for batch in batches:
            held.append(differences([wkb_rings(g.as_py()) for g in batch.column(0) if g.is_valid], min_zoom, max_zoom))
            if sum(len(x[0]) for x in held) >= GATHERED:
                held = [gathered()]
                if len(held[0][0]) >= GATHERED:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held[0]], names)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in gathered()], names)

    changes = df.select(geometry).mapInArrow(work, "z long, ty long, tx long, change long")
    changes = changes.groupBy("z", "ty", "tx").agg(F.sum("change").alias("change")).where("change <> 0")
    along = Window.partitionBy("z", "ty").orderBy("tx")  # at most a grid row's columns
    runs = changes.select("z", "ty", "tx", F.sum("change").over(along).alias("n"), F.lead("tx").over(along).alias("next")).where("n > 0")
    tiles = runs.select("z", F.explode(F.sequence("tx", F.col("next") - 1)).alias("tx"), "ty", "n")
    return tiles.select(F.col("z").cast("int").alias("z"), "tx", "ty", "n")
