"""Radius joins on a grid, the competitor graph, and point-of-interest decay edges.

A radius join meets points through the cell they lie in: one side is repeated for the nine cells around it, the other stands in its own, so each pair meets once and the
join is an equality join that spreads over tasks; adaptive execution splits a dense cell's partition. The exact distance is then checked, the radius itself included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import angles, conformal, gaussian_decay, metres
from ..functions.numeric import clip, missing, round_half_even
from ..functions.text import lookup

#: Fixed base footfall by type of point.
FOOTFALL = {
    "station": 25000.0, "bus_station": 10000.0, "hospital": 5000.0, "university": 4000.0, "marketplace": 3000.0, "college": 2000.0, "school": 1000.0,
    "apartments": 500.0, "place_of_worship": 300.0, "clinic": 200.0, "bus_stop": 150.0, "hotel": 100.0, "guest_house": 50.0, "industrial": 1000.0,
}
OTHER_FOOTFALL = 100.0
#: Bounds of the density multiplier.
DENSITY_RANGE = (0.2, 2.0)


def projected(points: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and metres x, y of points with both coordinates.

    Generators keep the optimizer from copying the projection's long expression into every later use of x and y. It goes by steps, as in one its code is too long for Java to compile.
    """
    told = lambda **c: F.inline(F.array(F.struct(*[v.alias(k) for k, v in c.items()])))
    there = points.where(~missing("Latitude") & ~missing("Longitude")).select(*keep, "Longitude", told(__t=conformal(F.col("Latitude"))))
    xi, eta = angles(F.col("__t"), F.col("Longitude"))
    x, y = metres(F.col("__xi"), F.col("__eta"))
    return there.select(*keep, told(__xi=xi, __eta=eta)).select(*keep, told(x=x, y=y))


def _cell(c: Column, radius: float) -> Column:
    return F.floor(c / F.lit(radius)).cast("long")


def _distance() -> Column:
    dx, dy = F.col("x") - F.col("rx"), F.col("y") - F.col("ry")
    return F.sqrt(dx * dx + dy * dy)


def _dealt(points: DataFrame, x: str, y: str, radius: float, cells) -> DataFrame:
    """Points repeated for the cells at the given steps from their own."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in cells])
    return points.withColumn("__s", F.explode(steps)).withColumns({"__cx": _cell(F.col(x), radius) + F.col("__s.i"), "__cy": _cell(F.col(y), radius) + F.col("__s.j")})


def radius_join(left: DataFrame, right: DataFrame, radius: float, condition: Column | None = None) -> DataFrame:
    """Pairs of rows with (x, y) and (rx, ry) at most ``radius`` apart, with ``distance``. Column names of the sides must differ otherwise."""
    a = left.withColumns({"__cx": _cell(F.col("x"), radius), "__cy": _cell(F.col("y"), radius)})
    b = _dealt(right, "rx", "ry", radius, [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]).drop("__s")
    pairs = a.join(b, ["__cx", "__cy"])
    if condition is not None:
        pairs = pairs.where(condition)
    return pairs.withColumn("distance", _distance()).where(F.col("distance") <= F.lit(radius)).drop("__cx", "__cy")


def radius_self_join(points: DataFrame, key: str, radius: float) -> DataFrame:
    """(low, high, distance) of pairs of points (``key``, x, y) at most ``radius`` apart, the smaller key first, each pair once.

    Of two neighbouring cells only one looks into the other: a point is repeated for its own cell and half of the eight around it, and in its own cell
    it meets only larger keys, so no pair is made twice.
    """
    a = points.withColumns({"__cx": _cell(F.col("x"), radius), "__cy": _cell(F.col("y"), radius)})
    renamed = points.withColumnsRenamed({key: "__other", "x": "rx", "y": "ry"})
    b = _dealt(renamed, "rx", "ry", radius, [(0, 0), (1, 0), (-1, 1), (0, 1), (1, 1)])
    own = (F.col("__s.i") == 0) & (F.col("__s.j") == 0)
    pairs = a.join(b, ["__cx", "__cy"]).where(~own | (F.col(key) < F.col("__other"))).where(F.col(key) != F.col("__other"))
    found = pairs.withColumn("distance", _distance()).where(F.col("distance") <= F.lit(radius))
    return found.select(F.least(key, "__other").alias("low"), F.greatest(key, "__other").alias("high"), "distance")


def competitor_graph(outlets: DataFrame, radius: float = 5000.0, sigma: float = 1000.0) -> DataFrame:
    """One row for each pair of outlets within the radius, the smaller id first: distance (2 places) and friction (4 places)."""
    pairs = radius_self_join(projected(outlets, "Outlet_ID"), "Outlet_ID", radius)
    return pairs.select(F.col("low").alias("Source_Outlet_ID"), F.col("high").alias("Target_Competitor_ID"), round_half_even(F.col("distance"), 2).alias("Distance_Meters"), round_half_even(gaussian_decay(F.col("distance"), sigma), 4).alias("Competitive_Friction"))


def poi_edges(outlets: DataFrame, points: DataFrame, macro: float = 3000.0, micro: float = 1000.0, sigma: float = 300.0, density_scale: float = 100.0, multiplier: bool = True) -> DataFrame:
    """Edges of outlets to points within ``micro`` metres with their decayed footfall.

    The density multiplier is the number of points within ``macro`` metres over ``density_scale``, kept in [0.2, 2]; without it
    edges are those of the older model. The larger radius is only counted, on places alone; edges come from a join at the smaller one.
    """
    a = projected(points, "POI_ID", "POI_Type").withColumn("Base_Footfall", lookup(F.col("POI_Type"), FOOTFALL, OTHER_FOOTFALL))
    b = projected(outlets, "Outlet_ID").withColumnsRenamed({"x": "rx", "y": "ry"})
    kept = ["Outlet_ID", "POI_ID", "POI_Type", round_half_even(F.col("distance"), 2).alias("Distance_Meters"), "Base_Footfall"]
    weight = gaussian_decay(F.col("distance"), sigma)
    e = radius_join(a, b, micro)
    if not multiplier:
        return e.select(*kept, round_half_even(weight, 4).alias("Decay_Weight"), round_half_even(F.col("Base_Footfall") * weight, 2).alias("Footfall_Impact_Score"))
    density = radius_join(a.select("x", "y"), b, macro).groupBy("Outlet_ID").agg(F.count("*").alias("__n"))
    m = clip(F.col("__n") / F.lit(density_scale), *DENSITY_RANGE)
    return e.join(density, "Outlet_ID").select(*kept, round_half_even(m, 2).alias("Regional_Multiplier"), round_half_even(weight, 4).alias("Decay_Weight"), round_half_even(F.col("Base_Footfall") * m * weight, 2).alias("Footfall_Impact_Score"))


def poi_counts(outlets: DataFrame, points: DataFrame, near: float = 500.0, far: float = 1000.0) -> DataFrame:
    """Outlet_ID, POI_Count_500m, POI_Count_1km of outlets with a point within ``far``: the older model's features."""
    pairs = radius_join(projected(points, "POI_ID"), projected(outlets, "Outlet_ID").withColumnsRenamed({"x": "rx", "y": "ry"}), far)
    return pairs.groupBy("Outlet_ID").agg(F.count_if(F.col("distance") <= near).alias("POI_Count_500m"), F.count("*").alias("POI_Count_1km"))


def poi_type(*tags: str) -> Column:
    """First tag that is there, or unknown."""
    return F.coalesce(*[F.col(t) for t in tags], F.lit("unknown"))


def sequential_ids(df: DataFrame, order: Sequence[str], bucket: Sequence[Column], name: str = "POI_ID", prefix: str = "POI_", width: int = 6) -> DataFrame:
    """``df`` with running numbers in ``order``, zero-padded: POI_000000, POI_000001 ...

    ``bucket`` are columns that grow with the order; rows are numbered inside a bucket, and sums of buckets tell where each begins, so no task sees all rows.
    Rows that agree in ``order`` are numbered as they come.
    """
    keys = [f"__b{k}" for k in range(len(bucket))]
    dealt = df.withColumns(dict(zip(keys, bucket, strict=True)))
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("__n"))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    starts = sizes.select(*[F.col(k).alias(f"{k}s") for k in keys], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    same = [F.col(k).eqNullSafe(F.col(f"{k}s")) for k in keys]
    numbered = dealt.withColumn("__i", inside).join(starts, same)
    number = (F.col("__s") + F.col("__i") - 1).cast("string")
    padded = F.when(F.length(number) < width, F.lpad(number, width, "0")).otherwise(number)
    return numbered.select(F.concat(F.lit(prefix), padded).alias(name), *df.columns)
