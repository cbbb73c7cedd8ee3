"""Totals over the pairs within a radius, an outlet a row, where the pairs themselves are too many to be rows; and the pairs themselves, where they are asked for.

The plane is cut into tiles. A tile's task gets the tile's outlets and every point within reach of the tile, and counts and adds up pair by pair in blocks of a
bounded size; a tile with many pairs has its outlets dealt to several tasks. Every pair is looked at with the formulas of the edges, and what is rounded there is added
up here in whole units, so totals are those of the edges to the last digit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lookup
from ..session import once
from .features import CATEGORIES, CATEGORY_NAMES
from .spatial import DENSITY_RANGE, FOOTFALL, OTHER_FOOTFALL, projected

#: Pairs of outlets and points within reach of a tile that one task is given, and pairs that are compared at once.
TASK_PAIRS, BLOCK_PAIRS = 200_000_000, 1 << 16
SORTED_PAIRS, SENT_PAIRS = 1 << 22, 1 << 16  # pairs that a task sorts by distance at once, and that it gives away at once
COUNTED = 8  # times as many for a task that only counts them, most without looking
STRIPS = 16  # rows of points on a radius, where they are only counted
SLACK = 1e-3  # metres by which candidates are taken too widely, so that no error of rounding loses a pair


class Points:
    """Points sorted by rows of ``size`` metres and by x in them, so that those near a box are a few slices."""

    def __init__(self, x: np.ndarray, y: np.ndarray, size: float) -> None:
        rows = np.floor(y / size).astype(np.int64)
        self.order, self.size = np.lexsort((x, rows)), size
        self.x, self.y = x[self.order], y[self.order]
        rows, starts = np.unique(rows[self.order], return_index=True)
        self.rows = dict(zip(rows.tolist(), zip(starts.tolist(), [*starts.tolist()[1:], len(x)], strict=True), strict=True))

    def near(self, x: np.ndarray, y: np.ndarray, radius: float) -> np.ndarray:
        """Places (in the sorted order) of all points within the radius of any of the given ones, and of few others."""
        x0, x1, y0, y1 = x.min() - SLACK, x.max() + SLACK, y.min() - SLACK, y.max() + SLACK
        found = []
        for row in range(math.floor((y0 - radius) / self.size), math.floor((y1 + radius) / self.size) + 1):
            if row in self.rows:
                a, b = self.rows[row]
                gap = max(0.0, row * self.size - SLACK - y1, y0 - (row + 1) * self.size - SLACK)
                wide = math.sqrt(max(0.0, radius * radius - gap * gap)) + SLACK
                low, high = np.searchsorted(self.x[a:b], (x0 - wide, x1 + wide))
                found.append(np.arange(a + low, a + high))
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def cells(x: np.ndarray, y: np.ndarray, size: float) -> Iterator[np.ndarray]:
    """Places of the outlets of each occupied cell."""
    cx, cy = np.floor(x / size).astype(np.int64), np.floor(y / size).astype(np.int64)
    order = np.lexsort((cx, cy))
    new = np.flatnonzero((np.diff(cx[order]) != 0) | (np.diff(cy[order]) != 0)) + 1
    yield from np.split(order, new) if len(order) else ()


def blocks(own: np.ndarray, others: int) -> Iterator[np.ndarray]:
    step = max(1, BLOCK_PAIRS // max(1, others))
    for k in range(0, len(own), step):
        yield own[k : k + step]


def _distances(x, y, px, py) -> np.ndarray:
    dx, dy = x[:, None] - px, y[:, None] - py
    dx *= dx
    dy *= dy
    dx += dy
    return np.sqrt(dx, out=dx)


def competition(x: np.ndarray, y: np.ndarray, who: np.ndarray, px: np.ndarray, py: np.ndarray, other: np.ndarray, radius: float, sigma: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each outlet: number of points of another id within the radius, least distance, and sum of frictions in ten-thousandths."""
    n, least, friction = np.zeros(len(x), np.int64), np.full(len(x), np.inf), np.zeros(len(x))
    grid = Points(px, py, radius / 8)
    other = other[grid.order]
    alone = len(np.unique(other)) == len(other)  # no id has two places, so each outlet meets itself once at most
    place = np.full(max(who.max(initial=-1), other.max(initial=-1)) + 1, -1)
    place[other] = np.arange(len(other))
    faint = 10_000 * math.exp(-radius * radius / (2.0 * sigma * sigma)) < 0.49  # frictions beyond the radius round to nothing
    for cell in cells(x, y, radius / 8):
        near = grid.near(x[cell], y[cell], radius)
        if not len(near):
            continue
        nx, ny, ids = grid.x[near], grid.y[near], other[near]
        for own in blocks(cell, len(near)):
            d = _distances(x[own], y[own], nx, ny)
            if alone:
                itself = place[who[own]]
                at = np.minimum(np.searchsorted(near, itself), len(near) - 1)
                here = np.flatnonzero(near[at] == itself)
                d[here, at[here]] = np.inf
            else:
                d[who[own][:, None] == ids] = np.inf
            inside = d <= radius
            n[own] = np.count_nonzero(inside, axis=1)
            least[own] = d.min(axis=1)
            d *= d
            d /= -(2.0 * sigma * sigma)
            np.exp(d, out=d)
            d *= 10_000.0
            np.rint(d, out=d)
            friction[own] = d.sum(axis=1) if faint else d.sum(axis=1, where=inside)
    return n, least, friction


def edges(x: np.ndarray, y: np.ndarray, who: np.ndarray, px: np.ndarray, py: np.ndarray, other: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of an outlet and a point of a larger id within the radius: both ids and the distance, some ``SORTED_PAIRS`` at a time, those in order of their distance in hundredths."""
    grid = Points(px, py, radius / 8)
    other, held, n = other[grid.order], [], 0
    for cell in cells(x, y, radius / 8):
        near = grid.near(x[cell], y[cell], radius)
        nx, ny, ids = grid.x[near], grid.y[near], other[near]
        for own in blocks(cell, len(near)) if len(near) else ():
            d = _distances(x[own], y[own], nx, ny)
            inside = d <= radius
            inside &= who[own][:, None] < ids
            i, j = np.nonzero(inside)
            held.append((who[own[i]], ids[j], d[i, j]))
            n += len(i)
            if n >= SORTED_PAIRS:
                yield _by_distance(held)
                held, n = [], 0
    if n:
        yield _by_distance(held)


def _by_distance(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    first, second, d = (np.concatenate(c) for c in zip(*held, strict=True))
    held.clear()
    place = len(d).bit_length()
    turn = np.rint(d * 100.0).astype(np.int64) << place  # distance and place in one number, which sorts faster than places by distance
    turn |= np.arange(len(d))
    turn.sort()
    turn &= (1 << place) - 1
    return first[turn], second[turn], d[turn]


def _members(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches [first, last): the stretch of each place in them, and the place."""
    sizes = last - first
    at = np.repeat(np.arange(len(first)), sizes)
    return at, np.arange(len(at)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def _met(x, y, px, py, first, last, radius: float) -> np.ndarray:
    """Of each outlet the number of the points at places [first, last) that are within the radius, looked at in blocks."""
    n, until = np.zeros(len(x), np.int64), np.cumsum(last - first)
    start = 0
    while start < len(x):
        before = until[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(until, before + BLOCK_PAIRS, "right")))
        i, j = _members(first[start:end], last[start:end])
        dx, dy = x[start:end][i] - px[j], y[start:end][i] - py[j]
        n[start:end] = np.bincount(i[np.sqrt(dx * dx + dy * dy) <= radius], minlength=end - start)
        start = end
    return n


def rivals(x: np.ndarray, y: np.ndarray, who: np.ndarray, px: np.ndarray, py: np.ndarray, other: np.ndarray, radius: float) -> np.ndarray:
    """Of each outlet the number of points of another id within the radius.

    Points stand in rows, in order of x. Of each row those certainly inside are counted by their first and last place; only those between the least and the
    greatest width of the circle over the row are looked at one by one, with the formula of the edges. Outlets go by row and x too, so that searches that follow each other end close by.
    """
    if not len(x) or not len(px):
        return np.zeros(len(x), np.int64)
    size, low, bottom = radius / STRIPS, px.min(), py.min()
    turn = np.lexsort((x, np.floor((y - bottom) / size)))
    n = np.empty(len(x), np.int64)
    n[turn] = _rivals(x[turn], y[turn], who[turn], px, py, other, radius, size, low, bottom)
    return n


def _rivals(x, y, who, px, py, other, radius: float, size: float, low: float, bottom: float) -> np.ndarray:
    n = np.zeros(len(x), np.int64)
    row = np.floor((py - bottom) / size).astype(np.int64)
    wide = px.max() - low + 1.0  # rows stand one after the other on one axis
    order = np.lexsort((px, row))
    axis, sx, sy = (row * wide + (px - low))[order], px[order], py[order]
    home = np.floor((y - bottom) / size).astype(np.int64)
    for step in range(-STRIPS - 1, STRIPS + 2):
        at = home + step
        base = bottom + at * size
        gap = np.maximum(np.maximum(base - y, y - (base + size)), 0.0)
        far = np.maximum(np.abs(y - base), np.abs(y - (base + size))) + SLACK
        own = np.flatnonzero((gap <= radius + SLACK) & (at >= 0) & (at <= row.max()))
        if not len(own):
            continue
        gap, far, at = np.maximum(gap[own] - SLACK, 0.0), far[own], at[own] * wide
        place = lambda v, side: np.searchsorted(axis, at + np.clip(v - low, -0.5, wide - 0.5), side)  # noqa: B023, E731
        outer = np.sqrt(np.maximum(radius * radius - gap * gap, 0.0)) + SLACK
        inner = np.sqrt(np.maximum(radius * radius - far * far, 0.0)) - SLACK
        first, last = place(x[own] - outer, "left"), place(x[own] + outer, "right")
        some = inner > 0
        a = np.where(some, place(x[own] - inner, "left"), first)
        b = np.where(some, place(x[own] + inner, "right"), first)
        n[own] += b - a + _met(x[own], y[own], sx, sy, first, a, radius) + _met(x[own], y[own], sx, sy, b, last, radius)
    mine = np.argsort(other, kind="stable")
    named = other[mine]
    return n - _met(x, y, px[mine], py[mine], np.searchsorted(named, who, "left"), np.searchsorted(named, who, "right"), radius)


def footfall(
    x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, base: np.ndarray, kind: np.ndarray, kinds: int, macro: float, micro: float, sigma: float, density_scale: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each outlet: points within ``micro``, sum of their distances in hundredths, and sums of impacts in hundredths by kind.

    Points within ``macro`` are only counted where those within ``micro`` don't bring the multiplier to its upper bound.
    """
    n, far, impact = np.zeros(len(x), np.int64), np.zeros(len(x)), np.zeros((len(x), kinds))
    low, high = DENSITY_RANGE
    grid = Points(px, py, micro / 4)
    base, kind = base[grid.order], kind[grid.order]
    for cell in cells(x, y, micro / 4):
        near = grid.near(x[cell], y[cell], micro)
        for own in blocks(cell, len(near)) if len(near) else ():
            d = _distances(x[own], y[own], grid.x[near], grid.y[near])
            i, j = np.nonzero(d <= micro)
            d, at = d[i, j], near[j]
            n[own] = number = np.bincount(i, minlength=len(own))
            wide = number.astype(np.float64)
            if len(few := np.flatnonzero((number > 0) & (number / density_scale < high))):
                reach = grid.near(x[own[few]], y[own[few]], macro)
                for part in blocks(few, len(reach)):
                    wide[part] = np.count_nonzero(_distances(x[own[part]], y[own[part]], grid.x[reach], grid.y[reach]) <= macro, axis=1)
            m = np.minimum(np.maximum(wide / density_scale, low), high)
            far[own] = np.bincount(i, np.rint(d * 100.0), len(own))
            score = np.rint(base[at] * m[i] * np.exp(d * d / -(2.0 * sigma * sigma)) * 100.0)
            impact[own] = np.bincount(i * kinds + kind[at], score, len(own) * kinds).reshape(len(own), kinds)
    return n, far, impact


def _tile(c: str, size: float, reach: float = 0.0) -> Column:
    return F.floor((F.col(c) + F.lit(reach)) / F.lit(size)).cast("long")


def _over_tiles(outlets: DataFrame, points: DataFrame, reach: float, part, schema: str, wide: int = 1, times: int = 1) -> DataFrame:
    """Rows that ``part(outlets of a tile, points within reach of the tile)`` makes of Arrow tables; an outlet is in one of them. Points stand at (px, py)."""
    left, right = _in_tiles(outlets, points, reach, wide, times)
    return _spread(left).cogroup(_spread(right)).applyInArrow(part, schema)


def _in_tiles(outlets: DataFrame, points: DataFrame, reach: float, wide: int = 1, times: int = 1) -> tuple[DataFrame, DataFrame]:
    """Outlets and points with the tile (__tx, __ty) and the __part of it that they are dealt to. Points stand at (px, py).

    A tile is ``wide`` times the reach and a task has ``times`` the usual number of pairs: a point is repeated for some 9 tiles of one reach, but for 4 of two.
    """
    size = wide * reach
    keys = ["__tx", "__ty"]
    own = outlets.withColumns({"__tx": _tile("x", size), "__ty": _tile("y", size)})
    far = reach + SLACK
    dealt = points.withColumn("__tx", F.explode(F.sequence(_tile("px", size, -far), _tile("px", size, far))))
    dealt = dealt.withColumn("__ty", F.explode(F.sequence(_tile("py", size, -far), _tile("py", size, far))))
    sizes = own.groupBy(*keys).agg(F.count("*").alias("__n")).join(dealt.groupBy(*keys).agg(F.count("*").alias("__m")), keys)
    # a row a tile, made once: its size is then known, and points aren't exchanged to be told their tile's parts
    sizes = once(sizes.select(*keys, F.ceil(F.col("__n") * F.col("__m") / F.lit(float(times * TASK_PAIRS))).cast("int").alias("__parts")).coalesce(1))
    left = own.join(sizes, keys).withColumn("__part", F.pmod(F.hash("Outlet_ID", "x", "y"), F.col("__parts")))
    right = dealt.join(sizes, keys).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    return left.drop("__parts"), right.drop("__parts")


def _spread(df: DataFrame):
    """Groups by tile and part. The number of partitions is given, so that small but slow tasks aren't put together."""
    keys = ["__tx", "__ty", "__part"]
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).groupBy(*keys)


def placed(points: DataFrame, *keep: str) -> DataFrame:
    """``projected`` points, made once: tiles are counted before they are dealt, from either side. They are spread first, as their table may be a file or two. Points that are placed already stay as they are."""
    if {"x", "y"} <= {*points.columns}:
        return points.select(*keep, "x", "y")
    return once(projected(points.select(*keep, "Latitude", "Longitude").repartition("Latitude", "Longitude"), *keep))


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


def competitor_totals(outlets: DataFrame, radius: float = 5000.0, sigma: float = 1000.0) -> DataFrame:
    """``features.competitor_features`` of ``spatial.competitor_graph(outlets, radius, sigma)`` without its edges."""

    def part(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = pa.chunked_array([*left.column("Outlet_ID").chunks, *right.column("other").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
        n, least, friction = competition(*_numbers(left, "x", "y"), ids[: left.num_rows], *_numbers(right, "px", "py"), ids[left.num_rows :], radius, sigma)
        met = pa.array(n > 0)
        out = pa.table({"Outlet_ID": left.column("Outlet_ID"), "n": n, "least": np.rint(least * 100.0) / 100.0, "friction": friction.astype(np.int64)})
        return out.filter(met)

    places = placed(outlets, "Outlet_ID")
    others = places.select(F.col("Outlet_ID").alias("other"), F.col("x").alias("px"), F.col("y").alias("py"))
    found = _over_tiles(places, others, radius, part, "Outlet_ID string, n long, least double, friction long").groupBy("Outlet_ID").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("friction").alias("friction"))
    added = F.col("friction").cast("double") / F.lit(10_000.0)
    return found.select(
        "Outlet_ID", F.col("n").alias("Competitor_Count_5km"), F.col("least").alias("Min_Competitor_Distance_Meters"),
        added.alias("Total_Competitive_Friction"), (added / F.col("n").cast("double")).alias("Average_Competitive_Friction"),
    )


def competitor_edges(outlets: DataFrame, radius: float = 5000.0, sigma: float = 1000.0) -> DataFrame:
    """The rows of ``spatial.competitor_graph(outlets, radius, sigma)``, in an order that takes less room in Parquet files.

    A tile's task finds the pairs whose smaller id is the tile's. It gives them away some millions at a time in order of distance: what is rounded then repeats from row to row,
    and a distance takes a few bits instead of eight bytes.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        ids = table.column("Outlet_ID").combine_chunks().dictionary_encode()
        turn = pc.array_sort_indices(ids.dictionary)
        rank = np.empty(len(turn), np.int32)
        rank[turn.to_numpy()] = np.arange(len(turn), dtype=np.int32)
        names, who = ids.dictionary.take(turn), rank[ids.indices.to_numpy()]
        x, y, own = table.column("x").to_numpy(), table.column("y").to_numpy(), table.column("own").to_numpy()
        for first, second, d in edges(x[own], y[own], who[own], x[~own], y[~own], who[~own], radius):
            for k in range(0, len(d), SENT_PAIRS):
                e = d[k : k + SENT_PAIRS]
                friction = np.rint(np.exp(e * e / -(2.0 * sigma * sigma)) * 10_000.0) / 10_000.0
                yield pa.RecordBatch.from_arrays([names.take(pa.array(first[k : k + SENT_PAIRS])), names.take(pa.array(second[k : k + SENT_PAIRS])), pa.array(np.rint(e * 100.0) / 100.0), pa.array(friction)], columns)

    columns = ["Source_Outlet_ID", "Target_Competitor_ID", "Distance_Meters", "Competitive_Friction"]
    places = placed(outlets, "Outlet_ID").where(F.col("Outlet_ID").isNotNull() & (F.abs("x") < math.inf) & (F.abs("y") < math.inf))
    own, others = _in_tiles(places, places.withColumnsRenamed({"x": "px", "y": "py"}), radius, 2)
    both = own.withColumn("own", F.lit(True)).unionByName(others.withColumnsRenamed({"px": "x", "py": "y"}).withColumn("own", F.lit(False)))
    return _spread(both).applyInArrow(part, "Source_Outlet_ID string, Target_Competitor_ID string, Distance_Meters double, Competitive_Friction double")


def competitor_counts(outlets: DataFrame, radius: float = 5000.0) -> DataFrame:
    """Outlet_ID and Competitor_Count_5km of ``competitor_totals``, for what needs only the number: most pairs are then counted without being looked at."""

    def part(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = pa.chunked_array([*left.column("Outlet_ID").chunks, *right.column("other").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
        n = rivals(*_numbers(left, "x", "y"), ids[: left.num_rows], *_numbers(right, "px", "py"), ids[left.num_rows :], radius)
        return pa.table({"Outlet_ID": left.column("Outlet_ID"), "n": n}).filter(pa.array(n > 0))

    places = placed(outlets, "Outlet_ID")
    others = places.select(F.col("Outlet_ID").alias("other"), F.col("x").alias("px"), F.col("y").alias("py"))
    return _over_tiles(places, others, radius, part, "Outlet_ID string, n long", 2, COUNTED).groupBy("Outlet_ID").agg(F.sum("n").alias("Competitor_Count_5km"))


def poi_totals(outlets: DataFrame, points: DataFrame, macro: float = 3000.0, micro: float = 1000.0, sigma: float = 300.0, density_scale: float = 100.0) -> DataFrame:
    """``features.poi_features`` of ``spatial.poi_edges`` with the same arguments, without its edges. Outlet_ID must be unique."""
    names = list(CATEGORY_NAMES)

    def part(left: pa.Table, right: pa.Table) -> pa.Table:
        n, far, impact = footfall(*_numbers(left, "x", "y"), *_numbers(right, "px", "py", "base", "kind"), len(names), macro, micro, sigma, density_scale)
        sums = {f"POI_Impact_{c}": impact[:, k] / 100.0 for k, c in enumerate(names)}
        with np.errstate(invalid="ignore"):
            return pa.table({"Outlet_ID": left.column("Outlet_ID"), "POI_Total_Impact_Score": impact.sum(axis=1) / 100.0, "POI_Avg_Distance_Meters": far / 100.0 / n, **sums}).filter(pa.array(n > 0))

    kind = lookup(F.col("POI_Type"), CATEGORIES, "Other")
    spots = placed(points, "POI_Type").select(F.col("x").alias("px"), F.col("y").alias("py"), lookup(F.col("POI_Type"), FOOTFALL, OTHER_FOOTFALL).alias("base"), (F.array_position(F.array(*[F.lit(c) for c in names]), kind) - 1).alias("kind"))
    schema = "Outlet_ID string, POI_Total_Impact_Score double, POI_Avg_Distance_Meters double, " + ", ".join(f"POI_Impact_{c} double" for c in names)
    return _over_tiles(placed(outlets, "Outlet_ID"), spots, macro, part, schema, 2)
