"""Catalogue readers: raw JSON, markers and pages as one production schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_first, iso_day, open_range
from ..functions.text import break_address, content_key, country_of_state, slug, state_code, strip
from ..schema import PRODUCTION_COLUMNS

#: Sources in the order that first-wins rules follow; ``seq`` is rank x 2^40 + feed position.
SOURCE_ORDER = ("mti", "concord", "trw")
# Rows under which a catalogue's feed counts as broken.
LEAST_ROWS = {"mti": 1000, "concord": 500, "trw": 50}


def number(c: Column) -> Column:
    """Double of a text or number; null for anything else."""
    return strip(c.cast("string")).try_cast("double")


def _seq(source: str, position: Column) -> Column:
    return F.lit(SOURCE_ORDER.index(source) * (1 << 40)).cast("long") + position.cast("long")


def read_listing_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of catalogue A's envelope ``{success, data: [...]}`` with their feed ``position``; a refusal raises."""
    row = "id:bigint,title:string,show_title:string,lat:string,lng:string,venue:string,venue_type:string,organization:string,address:string,date_range:string,start:string,end:string,venue_url:string,active:int,show_type:string,location_text:string"
    raw = spark.read.schema(f"success boolean, data array<struct<{row}>>").option("multiLine", True).json(path)
    checked = raw.withColumn("data", F.when(F.col("success"), F.col("data")).otherwise(F.raise_error(F.lit("catalogue A refused the request"))))
    return checked.select(F.posexplode("data").alias("position", "r")).select("position", "r.*").withColumnsRenamed({"start": "start_iso", "end": "end_iso"})


def listings(rows: DataFrame, position: str = "id") -> DataFrame:
    """Catalogue A rows as productions; the venue stands in for a blank organization, rows with neither go."""
    t = lambda c: strip(F.col(c))
    org = F.when(t("organization") != "", t("organization")).otherwise(t("venue"))
    df = rows.withColumn("_a", break_address(F.col("address"))).withColumn("_org", org).filter(F.col("_org") != "")
    place = t("location_text")
    has = F.instr(place, ",") > 0
    late_city = F.when(has, strip(F.regexp_extract(place, r"^(.*),[^,]*$", 1))).otherwise(place)
    late_state = F.when(has, state_code(F.substring_index(place, ",", -1))).otherwise("")
    bare = F.col("_a.city") == ""
    state = F.when(bare & (F.col("_a.state") == ""), late_state).otherwise(F.col("_a.state"))
    return df.select(
        F.concat(F.lit("mti:"), F.col("id").cast("string")).alias("key"), F.lit("mti").alias("source"), F.when(t("show_title") != "", t("show_title")).otherwise(t("title")).alias("show_title"),
        F.col("_org").alias("organization"), t("venue").alias("venue"), t("venue_type").alias("venue_type"), F.col("_a.street").alias("street"),
        F.when(bare, late_city).otherwise(F.col("_a.city")).alias("city"), state.alias("state"), F.col("_a.postal").alias("postal"),
        F.when(F.col("_a.country") != "", F.col("_a.country")).otherwise(country_of_state(state)).alias("country"), number(F.col("lat")).alias("lat"), number(F.col("lng")).alias("lng"),
        iso_day(F.col("start_iso")).alias("start_date"), iso_day(F.col("end_iso")).alias("end_date"), F.lit("").alias("source_url"), t("venue_url").alias("org_website"), _seq("mti", F.col(position)).alias("seq"),
    ).select(*PRODUCTION_COLUMNS)


def read_marker_json(spark: SparkSession, path: str) -> DataFrame:
    """Markers of catalogue B's envelope ``{Ok, EMsg, Markers: [...]}``; anything but ``Ok`` 1 raises."""
    row = "Type:int,C:int,I:string,Uid:string,Lat:string,Lon:string,productid:string,name:string,producer:string,performancetype:string,authors:string,address:string,city:string,state:string,startdate:string,enddate:string"
    raw = spark.read.schema(f"Ok string, EMsg string, Markers array<struct<{row}>>").option("multiLine", True).json(path)
    checked = raw.withColumn("Markers", F.when(F.col("Ok") == "1", F.col("Markers")).otherwise(F.raise_error(F.concat(F.lit("catalogue B refused: "), F.coalesce("EMsg", F.lit(""))))))
    return checked.select(F.posexplode("Markers").alias("position", "m")).select("position", "m.*")


def is_marker() -> Column:
    """A single marker; all else stands for a cluster of them."""
    return F.coalesce((F.col("Type") == 1) & (strip(F.col("name")) != ""), F.lit(False))


def markers(rows: DataFrame, show_url: str = "https://catalogue-b.test/p/") -> DataFrame:
    """Catalogue B markers as productions. The key is a hash of what identifies a run, never the per-response id."""
    t = lambda c: strip(F.col(c))
    key = content_key(F.lit("concord"), *(F.col(c) for c in ("productid", "I", "startdate", "enddate", "producer")))
    state = state_code(F.col("state"))
    return rows.filter(is_marker() & (t("producer") != "")).select(
        key.alias("key"), F.lit("concord").alias("source"), t("name").alias("show_title"), t("producer").alias("organization"), t("producer").alias("venue"), t("performancetype").alias("venue_type"),
        t("address").alias("street"), t("city").alias("city"), state.alias("state"), F.lit("").alias("postal"), country_of_state(state).alias("country"), number(F.col("Lat")).alias("lat"), number(F.col("Lon")).alias("lng"),
        day_first(F.col("startdate")).alias("start_date"), day_first(F.col("enddate")).alias("end_date"),
        F.when(t("productid") != "", F.concat(F.lit(show_url), t("productid"), F.lit("/"), slug(F.col("name")))).otherwise("").alias("source_url"), F.lit("").alias("org_website"), _seq("concord", F.col("position")).alias("seq"),
    ).select(*PRODUCTION_COLUMNS)


def show_urls(sitemap: Column) -> Column:
    """Array of the ``<loc>`` addresses of shows in a sitemap."""
    return F.filter(F.regexp_extract_all(sitemap, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), 1), lambda u: u.contains("/show/"))


def page_title(html: Column, url: Column) -> Column:
    """Title of a page up to its site suffix; else the last part of its address, capitalised."""
    found = F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    named = F.trim(F.regexp_replace(found, r"\s+[|–-]\s+[^|–-]*$", ""))
    # a capital after everything that is no letter
    words = F.lower(F.replace(F.regexp_extract(url, r"([^/]+)/*$", 1), F.lit("-"), F.lit(" ")))
    raised = F.transform(F.regexp_extract_all(words, F.lit(r"[^\p{L}]*\p{L}*"), 0), lambda w: F.concat(F.regexp_extract(w, r"^([^\p{L}]*)", 1), F.upper(F.regexp_extract(w, r"(\p{L})", 1)), F.regexp_extract(w, r"\p{L}(\p{L}*)$", 1)))
    return F.when(named != "", named).otherwise(F.array_join(raised, ""))


# A run on a show page; groups: first day, last day, organization, place.
RUN_BLOCK = r"(?s)date-display-start\"\s*>\s*([^<]*?)\s*</span>\s*&ndash;\s*<span class=\"date-display-end\"\s*>\s*([^<]*?)\s*</span>\s*<h5>\s*(.*?)\s*<br\s*/?>\s*(.*?)\s*</h5>"
#: Runs that a page's feed positions leave room for; beyond it a page is refused rather than mixed up with the next.
PAGE_RUNS = 1 << 20


def show_pages(pages: DataFrame, block: str = RUN_BLOCK) -> DataFrame:
    """Catalogue C pages ``page_id, url, html`` as productions.

    Runs are the blocks between ``id="upcoming"`` and ``id="related"``; a page without the first
    has none. Equal organization, place and dates count once a page, the first of them.
    """
    a = F.instr(F.col("html"), 'id="upcoming"')
    rest = F.expr("substring(html, instr(html, 'id=\"upcoming\"'))")
    b = F.instr(rest, 'id="related"')
    part = F.when(a > 0, F.when(b > 0, F.substring(rest, F.lit(1), b - 1)).otherwise(rest)).otherwise("")
    group = lambda i: F.regexp_extract_all("part", F.lit(block), F.lit(i)).alias(f"g{i}")
    runs = pages.withColumn("part", part).select("page_id", "url", page_title(F.col("html"), F.col("url")).alias("title"), F.posexplode(F.arrays_zip(*(group(i) for i in (1, 2, 3, 4)))).alias("at", "z"))
    flat = lambda c: strip(F.regexp_replace(c, r"\s+", " "))
    place = flat(F.col("z.g4"))
    has = F.instr(place, ",") > 0
    runs = runs.select(
        "page_id", "url", "title", "at", flat(F.col("z.g3")).alias("organization"), F.when(has, strip(F.regexp_extract(place, r"^(.*),[^,]*$", 1))).otherwise(place).alias("city"),
        F.when(has, state_code(F.substring_index(place, ",", -1))).otherwise("").alias("state"), open_range(F.col("z.g1"), F.col("z.g2")).alias("d"),
    ).filter(F.col("organization") != "").select("*", F.col("d.start").alias("start_date"), F.col("d.end").alias("end_date"))
    once = runs.groupBy("page_id", "url", "title", "organization", "city", "state", "start_date", "end_date").agg(F.min("at").alias("at"))
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    blank = lambda c: F.lit("").alias(c)
    return once.select(
        content_key(F.lit("trw"), F.regexp_extract("url", r"([^/]+)/*$", 1), F.col("organization"), F.col("city"), F.col("state"), day("start_date"), day("end_date")).alias("key"), F.lit("trw").alias("source"), F.col("title").alias("show_title"), "organization",
        F.col("organization").alias("venue"), blank("venue_type"), blank("street"), "city", "state", blank("postal"), country_of_state(F.col("state")).alias("country"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"),
        "start_date", "end_date", F.col("url").alias("source_url"), blank("org_website"), _seq("trw", F.col("page_id").cast("long") * PAGE_RUNS + F.when(F.col("at") < PAGE_RUNS, F.col("at")).otherwise(F.raise_error(F.lit("a page with more runs than feed positions")))).alias("seq"),
    ).select(*PRODUCTION_COLUMNS)


def united(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def floor_check(productions: DataFrame, floors: dict[str, int] = LEAST_ROWS) -> DataFrame:
    """``source, rows, least, ok`` for every source with a floor, also one without rows."""
    wanted = productions.sparkSession.createDataFrame(sorted(floors.items()), "source string, least long")
    have = productions.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    return wanted.join(have, "source", "left").select("source", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "least", (F.coalesce("rows", F.lit(0)) >= F.col("least")).alias("ok"))


def refused_below_floor(productions: DataFrame, floors: dict[str, int] = LEAST_ROWS) -> DataFrame:
    """``productions``; reading it raises where a source has fewer rows than its floor."""
    broken = floor_check(productions, floors).filter(~F.col("ok")).agg(F.concat_ws(", ", F.array_sort(F.collect_list("source"))).alias("_broken"))
    checked = broken.select(F.when(F.col("_broken") != "", F.raise_error(F.concat(F.lit("feeds under their floor: "), "_broken"))).otherwise(F.lit(True)).alias("_sound"))
    return productions.join(F.broadcast(checked)).filter("_sound").drop("_sound")  # one row


def quadrants(box: dict[str, float]) -> list[dict[str, float]]:
    """The four quarters of a box, south-west first."""
    y, x = (box["south"] + box["north"]) / 2, (box["west"] + box["east"]) / 2
    return [{"south": s, "north": n, "west": w, "east": e} for s, n in ((box["south"], y), (y, box["north"])) for w, e in ((box["west"], x), (x, box["east"]))]


def live_quadrants(clusters: DataFrame, box: dict[str, float]) -> DataFrame:
    """Quarters of ``box`` that hold a cluster's coordinate, borders included; all four if none does."""
    spark = clusters.sparkSession
    four = spark.createDataFrame([(i, q["south"], q["north"], q["west"], q["east"]) for i, q in enumerate(quadrants(box))], "quadrant int, south double, north double, west double, east double")
    tiles = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(q["south"]).alias("s"), F.lit(q["north"]).alias("n"), F.lit(q["west"]).alias("w"), F.lit(q["east"]).alias("e")) for i, q in enumerate(quadrants(box))))
    lat, lng = F.col("lat"), F.col("lng")
    hit = clusters.select(F.explode(F.filter(tiles, lambda t: lat.between(t["s"], t["n"]) & lng.between(t["w"], t["e"]))).alias("t")).select(F.col("t.i").alias("quadrant")).distinct()
    any_hit = hit.agg(F.count(F.lit(1)).alias("n"))
    marked = four.join(hit.withColumn("live", F.lit(True)), "quadrant", "left").join(F.broadcast(any_hit))
    return marked.filter(F.coalesce("live", F.lit(False)) | (F.col("n") == 0)).drop("live", "n")


def sweep(fetch, box: dict[str, float], *, zoom: int = 16, step: int = 2, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """Markers, first per key, and stuck clusters of a quadtree descent.

    ``fetch(box, zoom)`` gives a marker table. A box is cut into its live quarters while it has
    clusters and the zoom allows; the descent has at most ``(most - zoom) / step + 1`` levels.
    """
    found, stuck, boxes = [], [], [box]
    while boxes:
        below = []
        for b in boxes:
            rows = fetch(b, zoom)
            found.append(rows.filter(is_marker()))
            clusters = rows.filter(~is_marker()).select(number(F.col("Lat")).alias("lat"), number(F.col("Lon")).alias("lng"), "C")
            if zoom + step > most:
                stuck.append(clusters)
            elif not clusters.isEmpty():
                below += [{k: r[k] for k in ("south", "north", "west", "east")} for r in live_quadrants(clusters, b).collect()]
        boxes, zoom = below, zoom + step
    key = content_key(F.lit("concord"), *(F.col(c) for c in ("productid", "I", "startdate", "enddate", "producer")))
    every = united(*found).withColumn("_key", key)
    others = [c for c in every.columns if c != "_key"]
    first = every.groupBy("_key").agg(F.min_by(F.struct(*others), "position").alias("r")).select("r.*")
    left = united(*stuck) if stuck else every.select(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng"), "C").limit(0)
    return first, left.agg(F.coalesce(F.sum(F.coalesce("C", F.lit(0))), F.lit(0)).alias("stuck"))
