"""Points near other points, and the region around a point."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance on a sphere of radius 6371.0 km; degrees in."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = p2 - p1, F.radians(lng2) - F.radians(lng1)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def on_globe(lat: Column, lng: Column) -> Column:
    """True for a usable coordinate; false for null, NaN and anything off the globe."""
    ok = lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0) & ~F.isnan(lat) & ~F.isnan(lng)
    return F.coalesce(ok, F.lit(False))


def within_distance(
    left: DataFrame, right: DataFrame, km: float, *, id: str = "id", lat: str = "lat", lng: str = "lng"
) -> DataFrame:
    """``id_l, id_r, km``: every pair of a left and a right point at most ``km`` apart.

    Grid join. Rows of latitude are ``km`` high; cells of a row are as wide as ``km`` at the
    row's most poleward neighbour, so that the 3 x 3 cells round a point cover its circle,
    across the antimeridian too. Points of equal coordinates collapse before the cells are
    joined, so a coordinate shared by a third of all rows is one grid point; its ids are only
    spread again over the pairs of coordinates that are really near. A pair of ids appears once,
    with its smallest distance. Rows without an id or without a usable coordinate have no pairs.
    """
    step = math.degrees(km / EARTH_KM) * (1 + 1e-9)

    def cells_in(row: Column) -> Column:
        poleward = F.least(F.lit(90.0), F.greatest(F.abs(row * step), F.abs((row + 1) * step)) + step)
        width = F.lit(step) / F.greatest(F.cos(F.radians(poleward)), F.lit(1e-9))
        return F.greatest(F.lit(1), F.floor(F.lit(360.0) / width)).cast("long")

    def column_of(x: Column, n: Column) -> Column:
        return F.pmod(F.floor((x + 180.0) / 360.0 * n).cast("long"), n)

    def clean(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            F.col(id).alias(f"id_{tag}"), F.col(lat).cast("double").alias(f"lat_{tag}"), F.col(lng).cast("double").alias(f"lng_{tag}")
        ).filter(F.col(f"id_{tag}").isNotNull() & on_globe(F.col(f"lat_{tag}"), F.col(f"lng_{tag}"))).distinct()

    a, b = clean(left, "l"), clean(right, "r")
    row = lambda x: F.floor(x / step).cast("long")
    spots_l = (
        a.select("lat_l", "lng_l").distinct()
        .withColumn("row", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: row(F.col("lat_l")) + d)))
        .withColumn("n", cells_in(F.col("row")))
        .withColumn("col", F.explode(F.array_distinct(F.transform(
            F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(column_of(F.col("lng_l"), F.col("n")) + d, F.col("n"))))))
        .drop("n")
    )
    spots_r = b.select("lat_r", "lng_r").distinct().withColumn("row", row(F.col("lat_r"))).withColumn(
        "col", column_of(F.col("lng_r"), cells_in(F.col("row"))))
    near = (
        spots_l.join(spots_r, ["row", "col"])
        .withColumn("km", haversine_km(F.col("lat_l"), F.col("lng_l"), F.col("lat_r"), F.col("lng_r")))
        .filter(F.col("km") <= km)
        .select("lat_l", "lng_l", "lat_r", "lng_r", "km")
    )
    return (
        near.join(a, ["lat_l", "lng_l"]).join(b, ["lat_r", "lng_r"])
        .groupBy("id_l", "id_r").agg(F.min("km").alias("km"))
    )


def region_edges(regions: DataFrame, *, id: str = "region_id", ring: str = "ring", strip: float = 0.25) -> DataFrame:
    """Polygon edges, one row for each latitude strip an edge crosses, with its region's box.

    The last corner joins the first. Rings of under three corners, null corners and null ids
    are left out.
    """
    corners = F.filter(F.col(ring), lambda p: p["lat"].isNotNull() & p["lng"].isNotNull())
    edges = (
        regions.select(F.col(id).alias("region"), corners.alias("p"))
        .filter(F.col("region").isNotNull() & (F.size("p") >= 3))
        .select(
            "region", F.array_min(F.transform("p", lambda c: c["lng"])).alias("west"), F.array_max(F.transform("p", lambda c: c["lng"])).alias("east"),
            F.explode(F.arrays_zip(F.col("p").alias("a"), F.concat(F.slice("p", 2, 1 << 30), F.slice("p", 1, 1)).alias("b"))).alias("z"),
        )
        .select("region", "west", "east", F.col("z.a.lat").alias("y1"), F.col("z.a.lng").alias("x1"), F.col("z.b.lat").alias("y2"), F.col("z.b.lng").alias("x2"))
    )
    at = lambda y: F.floor(y / strip).cast("long")
    return edges.withColumn("strip", F.explode(F.sequence(at(F.least("y1", "y2")), at(F.greatest("y1", "y2")))))


def containing_region(
    points: DataFrame, regions: DataFrame, *, id: str = "id", lat: str = "lat", lng: str = "lng",
    region_id: str = "region_id", ring: str = "ring", strip: float = 0.25, salt: int = 8,
) -> DataFrame:
    """``id, lat, lng, region, boundary``: each point with the region whose ring encloses it.

    Crossing parity: an eastward ray from the point crosses the ring an odd number of times.
    Edges are binned into latitude strips and joined to the points of the strip; the join keeps
    only regions whose west-east box holds the point, then ray crossings are counted per point
    and region, which combines before its shuffle. An edge counts for latitudes in ``[low, high)``,
    so a ray through a corner counts once. A point exactly on an edge is in that region
    (``boundary``); where several regions share the edge, the smallest region id has it. Points
    are spread over ``salt`` copies of the edges, so one hot strip is never one task.
    Repeated points count once; rows without an id or a usable coordinate have no region. Regions must not overlap.
    """
    at = lambda y: F.floor(y / strip).cast("long")
    spots = (
        points.select(F.col(id).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lng).cast("double").alias("lng"))
        .filter(F.col("id").isNotNull() & on_globe(F.col("lat"), F.col("lng")))
        .distinct()
        .withColumn("strip", at(F.col("lat")))
        .withColumn("salt", F.pmod(F.xxhash64("id", "lng"), F.lit(salt)).cast("int"))
    )
    edges = region_edges(regions, id=region_id, ring=ring, strip=strip).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    y, x = F.col("lat"), F.col("lng")
    y1, x1, y2, x2 = (F.col(c) for c in ("y1", "x1", "y2", "x2"))
    side = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    on_edge = (side == 0) & y.between(F.least(y1, y2), F.greatest(y1, y2)) & x.between(F.least(x1, x2), F.greatest(x1, x2))
    spans = (y1 <= y) != (y2 <= y)
    crosses = spans & F.when(y2 > y1, side > 0).otherwise(side < 0)
    hits = (
        spots.join(edges, ["strip", "salt"])
        .filter(x.between(F.col("west"), F.col("east")) & (crosses | on_edge))
        .groupBy("id", "lat", "lng", "region")
        .agg((F.sum(crosses.cast("int")) % 2 == 1).alias("odd"), F.max(on_edge).alias("boundary"))
        .filter(F.col("odd") | F.col("boundary"))
    )
    return hits.groupBy("id", "lat", "lng").agg(
        F.min("region").alias("region"), F.max("boundary").alias("boundary"))
