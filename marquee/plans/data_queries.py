"""Queries of the general data operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals, spatial

#: Box of usable catalogue coordinates: degrees north and west.
BOX = {"south": 23.0, "north": 72.0, "west": -172.0, "east": -52.0}
NEAR_KM = 0.25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous periods and gaps of each production key."""
    return intervals.periods_and_gaps(
        table(spark, sf_dir, "productions").select("key", "start_date", "end_date"),
        "key", "start_date", "end_date", min_rows=2,
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concord and mti productions close by, and regions of productions without a state."""
    points = table(spark, sf_dir, "productions").select("key", "source", "state", "lat", "lng").filter(
        F.col("lat").between(BOX["south"], BOX["north"]) & F.col("lng").between(BOX["west"], BOX["east"])
    )
    side = lambda s: points.filter(F.col("source") == s).select(F.col("key").alias("id"), "lat", "lng")
    near = spatial.within_distance(side("concord"), side("mti"), NEAR_KM).select(
        F.lit("near").alias("kind"), F.least("id_l", "id_r").alias("id_a"), F.greatest("id_l", "id_r").alias("id_b"))
    stateless = points.filter(F.trim(F.coalesce("state", F.lit(""))) == "").select(F.col("key").alias("id"), "lat", "lng")
    inside = spatial.containing_region(stateless, table(spark, sf_dir, "state_regions"))
    return near.unionByName(
        inside.select(F.lit("region").alias("kind"), F.col("id").alias("id_a"), F.col("region").alias("id_b")).distinct())


QUERIES = {"p4_found": p4_found, "p7_found": p7_found}

SQL = {
    "p4_found": """
WITH v AS (SELECT key, start_date AS s, end_date AS e FROM productions
           WHERE key IS NOT NULL AND start_date IS NOT NULL AND end_date >= start_date),
k AS (SELECT key FROM v GROUP BY key HAVING count(*) >= 2),
d AS (SELECT DISTINCT v.key, s, e FROM v JOIN k ON v.key = k.key),
o AS (SELECT key, s, e, max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM d),
g AS (SELECT key, s, e, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM o),
p AS (SELECT key, run, min(s) AS s, max(e) AS e FROM g GROUP BY key, run),
q AS (SELECT key, e + 1 AS s, lead(s) OVER (PARTITION BY key ORDER BY s) - 1 AS e FROM p)
SELECT key, 'period' AS kind, strftime(s, '%Y-%m-%d') AS from_day, strftime(e, '%Y-%m-%d') AS to_day FROM p
UNION ALL
SELECT key, 'gap', strftime(s, '%Y-%m-%d'), strftime(e, '%Y-%m-%d') FROM q WHERE e IS NOT NULL""",
    "p7_found": """
WITH pt AS (SELECT key, source, state, lat, lng FROM productions WHERE lat BETWEEN 23 AND 72 AND lng BETWEEN -172 AND -52),
a AS (SELECT DISTINCT key, lat, lng, CAST(floor(lat / 0.01) AS BIGINT) AS c FROM pt WHERE source = 'concord'),
b AS (SELECT DISTINCT key, lat, lng, CAST(floor(lat / 0.01) AS BIGINT) AS c FROM pt WHERE source = 'mti'),
a3 AS (SELECT key, lat, lng, c + d AS c FROM a, (VALUES (-1), (0), (1)) t(d)),
near AS (SELECT DISTINCT 'near' AS kind, least(a3.key, b.key) AS id_a, greatest(a3.key, b.key) AS id_b FROM a3 JOIN b ON a3.c = b.c
  WHERE 2 * 6371.0 * asin(sqrt(pow(sin(radians(b.lat - a3.lat) / 2), 2)
        + cos(radians(a3.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a3.lng) / 2), 2))) <= 0.25),
n AS (SELECT DISTINCT key, lat AS y, lng AS x FROM pt WHERE trim(coalesce(state, '')) = ''),
e AS (SELECT region_id, ring[i].lat AS y1, ring[i].lng AS x1, ring[i % len(ring) + 1].lat AS y2, ring[i % len(ring) + 1].lng AS x2
      FROM (SELECT region_id, ring, unnest(range(1, len(ring) + 1)) AS i FROM state_regions)),
r AS (SELECT key, region_id FROM n JOIN e ON (y1 <= y) <> (y2 <= y) AND x < x1 + (x2 - x1) * (y - y1) / (y2 - y1)
      GROUP BY key, y, x, region_id HAVING count(*) % 2 = 1)
SELECT kind, id_a, id_b FROM near UNION ALL SELECT DISTINCT 'region', key, region_id FROM r""",
}
