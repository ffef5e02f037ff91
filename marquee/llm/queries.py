"""Queries of the text and record-linkage operators, with their SQL where SQL can do it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import org_key
from ..functions.web import email_domain, email_rejection, site_url
from ..operators.spatial import containing_region
from . import addresses, entity_match, fusion, history, mixing, names, packing, quality, tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures of every document."""
    return quality.quality_statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are mainly a list, a table or junk."""
    return quality.classified(table(spark, sf_dir, "documents").select("doc_id", "text")).filter(F.col("text_class") != "prose")


def p5_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each registry key with the id of the organization it means."""
    return names.linked_organizations(table(spark, sf_dir, "organizations").select("key", "name", "city", "state", "street"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of registry keys that mean the same organization."""
    return names.same_organization_pairs(p5_links(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings and concord productions in the same building."""
    town = F.regexp_extract(F.coalesce("location_text", F.lit("")), r"^([^,]*)", 1)
    listings = table(spark, sf_dir, "mti_listings").select("id", "address", town.alias("city"), "lat", "lng")
    shows = table(spark, sf_dir, "productions").filter(F.col("source") == "concord").select(F.col("key").alias("id"), F.col("street").alias("address"), "city", "lat", "lng")
    return addresses.match_addresses(listings, shows).select(F.col("id_l").alias("id"), F.col("id_r").alias("key"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of later batches, or of one batch, that tell a production already told."""
    return history.linked_batches(table(spark, sf_dir, "productions").select(
        "seq", "key", "source", "show_title", "organization", "venue", "street", "city", "start_date", "end_date", "loaded_at"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept value of each disputed field of registry keys with several rows."""
    orgs = table(spark, sf_dir, "organizations").select("key", "name", "website", "website_source", "email", "contact_checked")
    return fusion.fused(fusion.registry_claims(orgs)).filter(F.col("values") > 1).select("key", "field", "kept")


def p6_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most probable value of each disputed field by votes, source accuracies and copying alone."""
    orgs = table(spark, sf_dir, "organizations").select("key", "name", "website", "website_source", "email", "contact_checked")
    return fusion.fused(fusion.registry_claims(orgs, by_rule=False)).filter(F.col("values") > 1).select("key", "field", "kept", "source", F.round("posterior", 6).alias("posterior"))


def p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving record of each registry key."""
    orgs = table(spark, sf_dir, "organizations").select("key", "name", "website", "website_source", "email", "contact_checked")
    return fusion.surviving_records(fusion.fused(fusion.registry_claims(orgs)))


PACK = "standard"


def _sized(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return tokens.with_tokens(table(spark, sf_dir, "documents").select("doc_id", "text", *columns))


def p8_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pack of the standard size."""
    capacity = table(spark, sf_dir, "pack_sizes").filter(F.col("pack_name") == PACK).first()["capacity_tokens"]
    packs = packing.packed(_sized(spark, sf_dir), capacity)
    return packs.select(F.col("doc").cast("long").alias("doc_id"), "part", "parts", "tokens", "pack")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to take from each source, with repeats and the share reached."""
    return mixing.mixed(_sized(spark, sf_dir, "source"), table(spark, sf_dir, "mix_targets"))


def _with_mapped_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Productions whose blank state is filled from the region round their coordinates."""
    rows = table(spark, sf_dir, "productions").select("key", "source", "organization", "street", "city", "state", "lat", "lng")
    regions = table(spark, sf_dir, "state_regions")
    spot = F.xxhash64("lat", "lng")
    blank = F.trim(F.coalesce("state", F.lit(""))) == ""
    points = rows.filter(blank & F.col("lat").isNotNull()).select(spot.alias("spot"), "lat", "lng").distinct()
    mapped = containing_region(points, regions, id="spot").select(F.col("id").alias("spot"), "region").join(
        regions.select(F.col("region_id").alias("region"), F.col("state").alias("mapped")), "region").drop("region")
    # only rows without a state are joined
    filled = rows.filter(blank).withColumn("spot", spot).join(mapped, "spot", "left").withColumn("state", F.coalesce("mapped", F.lit("")))
    columns = ("key", "source", "organization", "street", "city", "state")
    return rows.filter(~blank).select(*columns).unionByName(filled.select(*columns))


def _host(site: str) -> Column:
    return F.regexp_extract(F.lower(site_url(F.col(site))), r"^https?://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)


def registry_hosts(orgs: DataFrame) -> DataFrame:
    """``known_as, token``: the hosts of the usable sites and addresses of each registry key."""
    mail = F.when(email_rejection(F.col("email")) == "", email_domain(F.col("email"))).otherwise("")
    # made before they are exploded: code is generated for a selection, not for what a generator holds
    made = orgs.select(F.col("key").alias("known_as"), _host("website").alias("host"), mail.alias("mail"))
    return made.select("known_as", F.explode(F.array("host", "mail")).alias("token")).filter(F.col("known_as").isNotNull() & (F.col("token") != "")).distinct()


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each production's organization over all sources, with rule and confidence."""
    # evidence stands under the registry key and, for a listing's own site, under the production key
    known_as = F.array(org_key(F.col("organization"), F.col("city"), F.col("state")), F.concat(F.lit("key:"), "key"))
    own = table(spark, sf_dir, "productions").filter("org_website <> '' AND key IS NOT NULL").select(F.concat(F.lit("key:"), "key").alias("known_as"), "org_website").distinct().select(
        "known_as", _host("org_website").alias("host")).select("known_as", F.explode(F.array("host")).alias("token")).filter("token <> ''").distinct()
    evidence = registry_hosts(table(spark, sf_dir, "organizations")).unionByName(own)
    return entity_match.matched_records(_with_mapped_state(spark, sf_dir).withColumn("known_as", known_as), evidence=evidence)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of productions of different sources that one organization puts on."""
    # a record that no rule linked is its own organization
    return entity_match.cross_source_pairs(p3_links(spark, sf_dir).filter("rule_name IS NOT NULL"))


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_links": p3_links,
    "p5_found": p5_found,
    "p5_links": p5_links,
    "p6_found": p6_found,
    "p6_fused": p6_fused,
    "p6_records": p6_records,
    "p8_packs": p8_packs,
    "p9_mix": p9_mix,
    "p10_found": p10_found,
    "p10_statistics": p10_statistics,
}
from .sql import SQL  # noqa: E402

__all__ = ["QUERIES", "SQL"]
