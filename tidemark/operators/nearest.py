"""Exact nearest sites on the globe, without comparing every point with every site.

Points and sites are placed on the unit sphere, where there are neither poles nor a
180th meridian, and the distance through the sphere rises with the one along it.
Sites are counted in cubes of halving side, and points are gathered in the same cubes.
Each cube of points descends from the whole sphere to small cubes, two levels at a time,
and keeps the cubes of sites that may hold one of the ``k`` nearest of any of its points: those
no farther at their near side than the far side of the cubes that surely hold ``k`` sites.
Only the sites in the cubes that are left are compared with the points.

All of that is equi-joins on cubes and a ranking per cube. The points themselves move once, to the
sites listed for their cube, and each keeps its nearest of them at once. Coarse levels
have a number of cubes bounded by geometry and are broadcast; finer ones are left
to Spark, which splits a cube that many points share.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import haversine_distance

#: Levels at most (cubes of 12 m), and those whose cubes are few enough to broadcast (some 50,000 meet the sphere).
DEEPEST, COARSE = 20, 6
#: Sites in a cube at which the descent may end.
LEAF = 16
STEP = 2
#: Sites in one list that points are compared with.
LISTED = 1024
_AXES = ("x", "y", "z")


def _placed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """id, lat, lon and the place on the unit sphere; rows without one are left out."""
    ident, lat, lon = (F.col(c) for c in columns)
    rows = df.select(ident.alias("id"), lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))
    phi, theta = F.radians("lat"), F.radians("lon")
    known = F.col("lat").between(-1e9, 1e9) & F.col("lon").between(-1e9, 1e9)  # false for null, nan and infinite
    return rows.where(known).withColumns(
        {"x": F.cos(phi) * F.cos(theta), "y": F.cos(phi) * F.sin(theta), "z": F.sin(phi)}
    )


def _cube(axis: str, level: int) -> Column:
    """The number of the cube along an axis; 2 ** level of them from -1 to 1."""
    across = F.floor((F.col(axis) + 1) * F.lit(float(1 << level) / 2))
    return F.greatest(F.least(across, F.lit((1 << level) - 1)), F.lit(0)).cast("bigint")


def _between(axis: str, level: int) -> tuple[Column, Column]:
    """Smallest and largest squared distance along an axis between a cube of points and one of sites."""
    side = F.lit(2.0 / (1 << level))
    apart = F.abs(F.col(f"c{axis}") - F.col(f"q{axis}")) * side
    near, far = F.greatest(apart - side, F.lit(0.0)), apart + side
    return near * near, far * far


def nearest(
    points: DataFrame,
    sites: DataFrame,
    k: int = 1,
    point: Sequence[str] = ("id", "lat", "lon"),
    site: Sequence[str] = ("id", "lat", "lon"),
    unit: str = "mi",
) -> DataFrame:
    """The ``k`` nearest sites of every point: ``point_id``, ``place`` from 1, ``site_id``, ``distance``.

    ``point`` and ``site`` name id, latitude and longitude in degrees. Ties go to the
    smaller site id. Rows without a position are left out; where there are fewer than
    ``k`` sites, all are given. Points are told apart by their id.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    # the same of several positions whenever it is evaluated
    sources = _placed(points, point).groupBy("id").agg(F.min(F.struct("lat", "lon", *_AXES)).alias("at")).select("id", "at.*")
    # of sites at one spot, only the first k can ever be among the nearest
    spot = Window.partitionBy("lat", "lon").orderBy("id")
    spots = _placed(sites, site).withColumn("rank", F.row_number().over(spot)).where(F.col("rank") <= k)
    leaf = _leaf_level(spots)

    sources = sources.withColumns({f"q{a}": _cube(a, leaf) for a in _AXES})
    cells = sources.select(*[f"q{a}" for a in _AXES]).distinct()
    # all are in the one cube of level 0, found as on any level, so that the joins have keys
    frontier = _cells(cells, leaf).withColumns({f"c{a}": F.col(f"q{a}") for a in _AXES})
    frontier = frontier.withColumn("enough", F.lit(None).cast("double"))
    for level in range(STEP, leaf + 1, STEP):
        frontier = _descend(frontier, _cells(cells, leaf - level), spots, level, k)
    held = spots.select(
        F.struct(F.col("id").alias("site_id"), F.col("lat").alias("site_lat"), F.col("lon").alias("site_lon")).alias("site"),
        *[_cube(a, leaf).alias(f"c{a}") for a in _AXES],
    )
    cell = [f"q{a}" for a in _AXES]
    listed = frontier.select(*cell, *[f"c{a}" for a in _AXES]).join(held, [f"c{a}" for a in _AXES])
    number = F.row_number().over(Window.partitionBy(*cell).orderBy("site.site_id"))
    lists = listed.withColumn("part", F.floor(number / LISTED)).groupBy(*cell, "part").agg(F.collect_list("site").alias("sites"))

    def measured(site: Column) -> Column:
        distance = haversine_distance(F.col("lat"), F.col("lon"), site["site_lat"], site["site_lon"], unit)
        return F.struct(distance.alias("distance"), site["site_id"].alias("site_id"))

    first = F.slice(F.array_sort(F.transform("sites", measured)), 1, k)
    found = sources.join(lists, cell).select(F.col("id").alias("point_id"), F.explode(first).alias("site"))
    found = found.select("point_id", "site.*")
    place = Window.partitionBy("point_id").orderBy("distance", "site_id")
    ranked = found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)
    return ranked.select("point_id", "place", "site_id", "distance")


def _cells(cells: DataFrame, up: int) -> DataFrame:
    """The cubes that hold points, so many levels above the given ones."""
    return cells.select(*[F.shiftright(f"q{a}", up).alias(f"q{a}") for a in _AXES]).distinct() if up else cells


def _leaf_level(spots: DataFrame) -> int:
    """The first level at which no cube holds many sites."""
    levels = list(range(STEP, DEEPEST + 1, STEP))
    cubes = F.array(*[F.struct(F.lit(n).alias("level"), *[_cube(a, n).alias(a) for a in _AXES]) for n in levels])
    sizes = spots.select(F.explode(cubes).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("c.level").agg(F.max("n").alias("n")).where(F.col("n") <= LEAF)
    return largest.agg(F.min("level")).first()[0] or DEEPEST


def _descend(frontier: DataFrame, cells: DataFrame, spots: DataFrame, level: int, k: int) -> DataFrame:
    """Replace each pair of cubes by those of the given level inside them whose sites may be one of the k nearest of a point."""
    cubes = spots.groupBy(*[_cube(a, level).alias(f"c{a}") for a in _AXES]).agg(F.count(F.lit(1)).alias("sites"))
    inside = cubes.select("*", *[F.shiftright(f"c{a}", STEP).alias(f"p{a}") for a in _AXES])
    within = cells.select("*", *[F.shiftright(f"q{a}", STEP).alias(f"o{a}") for a in _AXES])
    if level <= COARSE:
        inside, within = F.broadcast(inside), F.broadcast(within)
    above = frontier.withColumnsRenamed({f"{new}{a}": f"{old}{a}" for new, old in ("cp", "qo") for a in _AXES})
    opened = above.join(inside, [f"p{a}" for a in _AXES]).join(within, [f"o{a}" for a in _AXES])
    bounds = [_between(a, level) for a in _AXES]
    near, far = (sum((b[i] for b in bounds[1:]), bounds[0][i]) for i in (0, 1))
    opened = opened.withColumns({"near": near, "far": far})
    # rounding must not lose a cube at the very edge
    open_ = F.col("enough").isNull() | (F.col("near") <= F.col("enough") * (1 + 1e-9) + 1e-12)
    cell, cube = [f"q{a}" for a in _AXES], [f"c{a}" for a in _AXES]
    # what holds for the whole cube holds for its parts, before any of them is moved
    opened = opened.where(open_).select(*cell, *cube, "sites", "near", "far")
    # the far side of the cubes that together hold k sites, nearest far sides first
    by_far = Window.partitionBy(*cell).orderBy("far", *cube).rowsBetween(Window.unboundedPreceding, 0)
    enough = F.min(F.when(F.col("so_far") >= k, F.col("far"))).over(Window.partitionBy(*cell))
    kept = opened.withColumn("so_far", F.sum("sites").over(by_far)).withColumn("enough", enough)
    return kept.where(open_).select(*cell, *cube, "enough")
