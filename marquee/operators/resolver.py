"""State and country of listings that lack them, from listings that have them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import cell, coarse_country
from ..functions.text import city_form
from .spatial import haversine_km

MAX_KM = 60.0


def resolved(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """``rows`` with ``geo_state, geo_country, geo_method``.

    Rows with state and country are ``already``. Others take, in turn: the one state their city
    name has in the reference (``city``); the nearest reference of their city name within 60 km
    (``city+distance``); the nearest within 60 km in their whole-degree cell, else in the ring
    round it, else in the next (``nearest``); a country from the coordinate alone (``coarse``);
    nothing (``unresolved``). Ties go to the smallest ``seq``.

    Reference points are distinct before any join; unresolved points are distinct by city and
    coordinate, so a repeated venue is looked up once.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    ref = reference.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull() & (text("state") != "")).groupBy(
        city_form(F.col("city")).alias("city_key"), F.col("state").alias("r_state"), text("country").alias("r_country"), F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng")
    ).agg(F.min("seq").alias("r_seq"))
    open_ = (text("state") == "") | (text("country") == "")
    points = rows.filter(open_).select(city_form(F.col("city")).alias("city_key"), "lat", "lng").distinct().withColumn("point", F.xxhash64("city_key", F.coalesce("lat", F.lit(-999.0)), F.coalesce("lng", F.lit(-999.0))))
    by_city = ref.groupBy("city_key").agg(
        (F.min("r_state") == F.max("r_state")).alias("single"), F.min_by(F.struct(F.col("r_state").alias("state"), F.col("r_country").alias("country")), "r_seq").alias("only"))
    named = points.join(by_city, "city_key", "left")
    located = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    km = haversine_km(F.col("lat"), F.col("lng"), F.col("r_lat"), F.col("r_lng"))
    hit = F.struct(F.col("r_state").alias("state"), F.col("r_country").alias("country"))
    in_city = named.filter((F.col("single") == F.lit(False)) & located).join(ref, "city_key").withColumn("km", km).filter(F.col("km") <= MAX_KM).groupBy("point").agg(F.min_by(hit, F.struct("km", "r_seq")).alias("city_hit"))
    stage = named.join(in_city, "point", "left")
    rest = stage.filter(~F.coalesce(F.col("single"), F.lit(False)) & F.col("city_hit").isNull() & located)
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(max(abs(i), abs(j))).alias("ring")) for i in range(-2, 3) for j in range(-2, 3)))
    spread = rest.select("point", "lat", "lng", F.inline(steps)).select("point", "lat", "lng", "ring", (cell(F.col("lat")) + F.col("i")).alias("cy"), (cell(F.col("lng")) + F.col("j")).alias("cx"))
    around = spread.join(ref.withColumn("cy", cell(F.col("r_lat"))).withColumn("cx", cell(F.col("r_lng"))), ["cy", "cx"]).withColumn("km", km).filter(F.col("km") <= MAX_KM).groupBy("point").agg(
        F.min_by(hit, F.struct("ring", "km", "r_seq")).alias("near_hit"))
    coarse = coarse_country(F.col("lat"), F.col("lng"))
    none = F.struct(F.lit("").alias("state"), coarse.alias("country"))
    found = stage.join(around, "point", "left").select(
        "point", F.when(F.col("single"), F.col("only")).otherwise(F.coalesce("city_hit", "near_hit", none)).alias("hit"),
        F.when(F.col("single"), "city").when(F.col("city_hit").isNotNull(), "city+distance").when(F.col("near_hit").isNotNull(), "nearest").when(coarse != "", "coarse").otherwise("unresolved").alias("method"))
    keyed = rows.withColumn("point", F.when(open_, F.xxhash64(city_form(F.col("city")), F.coalesce("lat", F.lit(-999.0)), F.coalesce("lng", F.lit(-999.0)))))
    pick = lambda own, c: F.when(text(own) != "", text(own)).otherwise(F.coalesce(F.col(f"hit.{c}"), F.lit("")))
    return keyed.join(found, "point", "left").withColumn("geo_state", pick("state", "state")).withColumn("geo_country", pick("country", "country")).withColumn(
        "geo_method", F.coalesce("method", F.lit("already"))).drop("point", "hit", "method")
