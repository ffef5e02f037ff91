"""Postal addresses of one building written differently.

Addresses become components (number, street words, way, direction, unit, postcode, place). An
index over block and number finds the streets of either side that can be one; where they are many, a further one over every
street word of four letters or more and all forms of its beginning that lack up to two letters. A pair is verified by the best
one-to-one assignment of its street components, with vetoes for another number and, where asked for, another unit.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import apart, small, work_dir, written
from . import canon, names
from .udfs import batch_udf

_PARTS = "form string, number string, name string, way string, direction string, unit string, postal string, place string"
#: Degrees of a locality cell, and cells that a place name may be off before it is another place.
CELL = 0.1
PLACE_REACH = 4
#: Degrees beyond its border at which a point also counts for the neighbouring cell.
MARGIN = 0.02
#: Letters at the beginning of a word whose forms are indexed: words within two edits share one of them.
PREFIX = 6
#: Least share of letters that the assignment must match.
LEAST = 0.7
#: A pair of streets compared costs about as much as this part of the forms of both.
PAIR_COST = 1 / 16


@batch_udf(_PARTS, once=True)
def address_parts(texts: pd.Series, towns: pd.Series) -> pd.DataFrame:
    """Components of each address; the city inside it goes before the town beside it."""
    parts = [(p, town) for p, town in zip(map(canon.address_parts, texts), towns)]
    return pd.DataFrame([(*p[:7], canon.locality(p[7] or town) if p[0] else "") for p, town in parts], columns=[c.split()[0] for c in _PARTS.split(", ")])


def street_forms(name: str) -> list[str]:
    """Beginnings that lack up to two letters of each word of a street; words under four letters
    stand for themselves where it has no longer one or they alone could match, and words with digits always do.

    Names that the assignment matches share one of them: what it matches of either are longer words within
    two edits, equal words with digits, or else short words that make up the least share by themselves.
    """
    found: set[str] = set()
    every = re.split(r"[ /]", name)
    brief = sum(len(w) for w in every if len(w) < 4) >= LEAST * sum(map(len, every))
    for street in name.split("/"):
        words = street.split()
        spelled = [w for w in words if len(w) >= 4 and not re.search(r"\d", w)]
        for word in spelled:
            found |= {f for form in canon.deletions(word[:PREFIX]) for f in canon.deletions(form)}
        found |= {w for w in words if re.search(r"\d", w) or not spelled or (brief and len(w) < 4)}
    return sorted(found - {""})


@batch_udf("array<string>")
def _forms(names: pd.Series) -> pd.Series:
    return names.map(street_forms)


@batch_udf("double", once=True)
def _assignment(a: pd.Series, b: pd.Series) -> pd.Series:
    split = lambda n: tuple(re.split(r"[ /]", n))
    return pd.Series([1.0 if x == y else canon.assigned(split(x), split(y)) for x, y in zip(a, b)], dtype=float)


def address_records(rows: DataFrame, folder: str, *, id: str, address: str, city: str, lat: str, lng: str) -> tuple[DataFrame, DataFrame]:
    """Members ``id, place_key`` and the distinct places with their components.

    An address without a numbered street or a crossing has no place. ``cell`` is null without a
    usable coordinate; the city inside the address goes before the column's.
    """
    number = lambda c: F.expr(f"try_cast(trim(cast({c} as string)) as double)")
    raw = rows.select(F.col(id).alias("id"), F.coalesce(F.col(address), F.lit("")).alias("address"), F.coalesce(F.col(city), F.lit("")).alias("town"), number(lat).alias("y"), number(lng).alias("x")).filter(F.col("id").isNotNull())
    ok = F.coalesce(F.col("y").between(-90, 90) & F.col("x").between(-180, 180) & ~((F.col("y") == 0) & (F.col("x") == 0)), F.lit(False))
    cell = lambda v, by=0.0: F.when(ok, F.floor((F.col(v) + by) / CELL).cast("int"))
    corner = lambda i, j: F.concat_ws(":", cell("y", i).cast("string"), cell("x", j).cast("string"))
    round_it = F.when(ok, F.array_distinct(F.array(*(corner(i, j) for i in (-MARGIN, MARGIN) for j in (-MARGIN, MARGIN)))))
    raw = raw.select("id", "address", "town", cell("y").alias("cy"), cell("x").alias("cx"), round_it.alias("cells")).distinct()
    parts = raw.withColumn("p", address_parts("address", "town")).filter(F.col("p.form") != "")
    traits = ["form", "number", "name", "way", "direction", "unit", "postal", "place"]
    members = parts.select("id", "cy", "cx", "cells", *(F.col(f"p.{c}").alias(c) for c in traits)).withColumn(
        "place_key", F.xxhash64(*traits, F.coalesce("cy", F.lit(-9999)), F.coalesce("cx", F.lit(-9999)), F.coalesce("cells", F.array().cast("array<string>"))))
    members = written(members, folder, "addresses")
    return members.select("id", "place_key").distinct(), written(members.drop("id").dropDuplicates(["place_key"]), folder, "places")


def _with_likelier_places(left: DataFrame, right: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``likelier``: the commoner place names of either table that ``place`` may be a slip of."""
    told = written(names.likelier_texts(left.select("place").unionByName(right.select("place")), "place", [], folder, join=names.deletion_join), folder, "localities", measured=True)
    return left.join(small(told), "place", "left"), right.join(small(told), "place", "left")


def _index(places: DataFrame, tag: str, *, spread: bool) -> DataFrame:
    """Entries (hash of block and number) of each place, and its street; with ``spread`` also for cells close by."""
    own = F.when(F.col("cy").isNotNull(), F.array(F.concat_ws(":", F.col("cy").cast("string"), F.col("cx").cast("string"))))
    none = F.array().cast("array<string>")
    blocks = F.concat(
        F.transform(F.coalesce(F.col("cells") if spread else own, none), lambda c: F.concat(F.lit("g:"), c)),
        F.when(F.col("postal") != "", F.array(F.concat(F.lit("p:"), "postal"))).otherwise(none),
        F.when(F.col("place") != "", F.transform(F.concat(F.array("place"), F.coalesce("likelier", none)), lambda c: F.concat(F.lit("c:"), c))).otherwise(none),
    )
    entries = places.select("place_key", "number", "name", F.explode(blocks).alias("block"))
    return entries.select(F.col("place_key").alias(f"k_{tag}"), F.col("block").startswith("c:").alias("by_name"), F.xxhash64("block", "number").alias("entry"), F.col("name").alias(f"name_{tag}"))


def _near_streets(index_l: DataFrame, index_r: DataFrame, folder: str, pair_cost: float) -> DataFrame:
    """``entry, name_l, name_r``: the streets under one entry that the assignment matches.

    Entries that only one side has end here. Of the others, all streets of either side are paired
    where that is cheaper than their forms are, else those that share a form: as matching streets
    always share one, this decides the cost alone.
    """
    streets = lambda index, tag: index.select("entry", f"name_{tag}").distinct()
    counted = lambda index, tag: streets(index, tag).groupBy("entry").agg(F.count(F.lit(1)).alias(f"n_{tag}"))
    few = F.col("n_l") * F.col("n_r") * pair_cost <= F.col("n_l") + F.col("n_r")
    shared = counted(index_l, "l").join(apart(counted(index_r, "r")), "entry").select("entry", few.alias("few"))
    shared = written(shared, folder, "shared")
    side = {tag: written(streets(index, tag).join(apart(shared), "entry"), folder, f"streets_{tag}") for index, tag in ((index_l, "l"), (index_r, "r"))}
    paired = side["l"].filter("few").drop("few").join(apart(side["r"].filter("few").drop("few")), "entry")
    spelled = lambda tag: side[tag].filter("not few").select("entry", f"name_{tag}", F.explode(_forms(f"name_{tag}")).alias("form"))
    met = paired.unionByName(spelled("l").join(apart(spelled("r")), ["entry", "form"]).select("entry", "name_l", "name_r").distinct())
    # letters of words that have one within the assignment's edits (twice as many where a swap is two) on the other side: at most these match
    words = lambda tag: F.split(f"name_{tag}", "[ /]")
    shorter = lambda x, y: F.least(F.length(x), F.length(y))
    close = lambda x, y: (x == y) | F.levenshtein(x, y, 4).between(0, F.when(shorter(x, y) < 4, 0).when(shorter(x, y) < 6, 2).otherwise(4))
    hopeful = F.filter(words("l"), lambda x: F.exists(words("r"), lambda y: close(x, y)))
    most = F.aggregate(hopeful, F.lit(0), lambda n, x: n + F.length(x))
    met = met.filter((F.col("name_l") == F.col("name_r")) | (most >= LEAST * (F.length("name_l") - F.size(words("l")) + 1) - 1e-9))
    return met.filter(_assignment("name_l", "name_r") >= LEAST)


def same_building(left: tuple[DataFrame, DataFrame], right: tuple[DataFrame, DataFrame], folder: str, *, unit_veto: bool = False, pair_cost: float = PAIR_COST) -> DataFrame:
    """``id_l, id_r``: records at one building.

    Blocks are the postcode, the place name and the cells of 0.1 degrees at the coordinate, so
    a record whose postcode or coordinate is missing or wrong still meets its building by place;
    a misspelt place name also counts as the commoner ones within its allowed edits.
    Numbers must be equal; directions and ways must not contradict; with ``unit_veto`` neither may
    units. Where only the place name brought a pair together although both have coordinates
    further apart than ``PLACE_REACH`` cells, it is another town of the name. Distinct places are
    compared, not records; their records are joined at the end.
    """
    (members_l, places_l), (members_r, places_r) = left, right
    told_l, told_r = _with_likelier_places(places_l, places_r, folder)
    clash = lambda c: (F.col(f"l.{c}") != "") & (F.col(f"r.{c}") != "") & (F.col(f"l.{c}") != F.col(f"r.{c}"))
    far = (F.abs(F.col("l.cy") - F.col("r.cy")) > PLACE_REACH) | (F.abs(F.col("l.cx") - F.col("r.cx")) > PLACE_REACH)
    local = ~F.col("by_name") | ~F.coalesce(far, F.lit(False))
    traits = F.struct("form", "number", "way", "direction", "unit", "cy", "cx")
    index_l, index_r = written(_index(told_l, "l", spread=False), folder, "index_l"), written(_index(told_r, "r", spread=True).drop("by_name"), folder, "index_r")
    near = _near_streets(index_l, index_r, folder, pair_cost)
    # places that meet in any other block than that of the place name need not be near
    met = index_l.join(apart(near), ["entry", "name_l"]).join(apart(index_r), ["entry", "name_r"]).groupBy("k_l", "k_r").agg(F.min("by_name").alias("by_name"))
    met = met.join(places_l.select(F.col("place_key").alias("k_l"), traits.alias("l")), "k_l").join(places_r.select(F.col("place_key").alias("k_r"), traits.alias("r")), "k_r").filter(
        (F.col("l.form") == F.col("r.form")) & (F.col("l.number") == F.col("r.number")) & local & ~clash("direction") & ~clash("way") & (~clash("unit") if unit_veto else F.lit(True)))
    same = written(met.select("k_l", "k_r"), folder, "same")
    return (
        same.join(members_l.select(F.col("id").alias("id_l"), F.col("place_key").alias("k_l")), "k_l")
        .join(members_r.select(F.col("id").alias("id_r"), F.col("place_key").alias("k_r")), "k_r").select("id_l", "id_r").distinct()
    )


def match_addresses(a: DataFrame, b: DataFrame, *, unit_veto: bool = False) -> DataFrame:
    """``id_l, id_r`` for two tables with ``id, address, city, lat, lng``; see :func:`same_building`."""
    folder = work_dir(a.sparkSession)
    columns = {"id": "id", "address": "address", "city": "city", "lat": "lat", "lng": "lng"}
    return same_building(address_records(a, folder, **columns), address_records(b, folder, **columns), folder, unit_veto=unit_veto)
