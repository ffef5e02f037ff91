import math
import random

from pyspark.sql import functions as F

from marquee.operators.spatial import containing_region, within_distance


def km(a, b):
    p1, p2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1, math.sqrt(h)))


def test_near_against_all_pairs(spark):
    rnd = random.Random(3)
    point = lambda i: (f"p{i}", rnd.choice([0, 45, 71.99, 89.999]) + rnd.uniform(-0.02, 0.02), rnd.choice([179.999, -179.999, 10]) + rnd.uniform(-0.02, 0.02))
    a, b = [point(i) for i in range(150)], [point(i) for i in range(200)]
    a = [(i, min(90.0, float(y)), ((x + 180) % 360) - 180) for i, y, x in a]
    b = [(i, min(90.0, float(y)), ((x + 180) % 360) - 180) for i, y, x in b] + [("same", 45.0, 10.0)]
    a += [("same", 45.0, 10.0), (None, 45.0, 10.0), ("bad", None, 1.0), ("nan", float("nan"), 1.0), ("off", 95.0, 1.0)] + a[:5]
    frame = lambda rows: spark.createDataFrame(rows, "id string, lat double, lng double")
    found = {(r.id_l, r.id_r) for r in within_distance(frame(a), frame(b), 1.5).collect()}
    usable = [r for r in a if r[0] and r[1] is not None and r[1] == r[1] and abs(r[1]) <= 90]
    assert found == {(x[0], y[0]) for x in usable for y in b if km(x, y) <= 1.5}
    assert within_distance(frame([]), frame(b), 1.5).count() == 0


def test_regions(spark):
    ring = lambda *c: [{"lat": float(y), "lng": float(x)} for y, x in c]
    regions = spark.createDataFrame(
        [("L", ring((0, 0), (0, 5), (10, 5), (10, 0))), ("R", ring((0, 5), (0, 10), (10, 10), (10, 5))), ("U", ring((20, 0), (20, 9), (29, 9), (29, 6), (23, 6), (23, 3), (29, 3), (29, 0))), (None, ring((0, 0), (1, 0), (1, 1))), ("line", ring((0, 0), (1, 1)))],
        "region_id string, ring array<struct<lat:double,lng:double>>")
    pts = [("in", 5.0, 2.0), ("in", 5.0, 2.0), ("edge", 5.0, 5.0), ("corner", 0.0, 5.0), ("out", 11.0, 2.0), ("notch", 25.0, 4.5), ("arm", 25.0, 1.0), ("level", 23.0, 1.0), ("none", None, 1.0), (None, 5.0, 2.0)]
    points = spark.createDataFrame(pts, "id string, lat double, lng double").withColumn("region", F.lit("clash"))
    found = {r.id: (r.region, r.boundary) for r in containing_region(points, regions).collect()}
    assert found == {"in": ("L", False), "edge": ("L", True), "corner": ("L", True), "arm": ("U", False), "level": ("U", False)}
