"""Organizations collapsed from productions, and what they lend back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_shouty, org_key, strip, street_form
from ..functions.web import site_url


def with_org_key(productions: DataFrame) -> DataFrame:
    return productions.withColumn("org_key", org_key(F.col("organization"), F.col("city"), F.col("state")))


def _first(value: Column, ok: Column) -> Column:
    """Value of the earliest row (by ``seq``) that is ok; blank without one."""
    return F.coalesce(F.min_by(F.when(ok, value), F.when(ok, F.col("seq"))), F.lit(""))


def collapse(productions: DataFrame) -> DataFrame:
    """One row per organization key: count, sources, best name and first non-blank attributes.

    The best name is in mixed case before capitals only, then the longest, then the earliest.
    All are aggregates that combine map-side, so a hot key is no hot task.
    """
    p = with_org_key(productions)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    url = site_url(F.col("org_website"))
    earliest = lambda c: F.coalesce(F.min_by(text(c), "seq"), F.lit(""))
    return p.groupBy("org_key").agg(
        F.coalesce(F.max_by(text("organization"), F.struct((text("organization") != "").alias("some"), (~is_shouty(F.col("organization"))).alias("mixed"), F.length(text("organization")).alias("n"), (-F.col("seq")).alias("early"))), F.lit("")).alias("name"),
        earliest("city").alias("city"), earliest("state").alias("state"), _first(text("country"), text("country") != "").alias("country"),
        _first(text("street"), text("street") != "").alias("street"), _first(url, url != "").alias("website"), _first(F.col("source"), url != "").alias("website_source"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.count(F.lit(1)).alias("production_count"), F.min("seq").alias("first_seq"),
    )


def share_by_address(orgs: DataFrame) -> DataFrame:
    """Organizations without a site take that of the first one at the same street and city.

    A blank street form matches nothing; filled sites are not lent on.
    """
    keyed = orgs.withColumn("_street", street_form(F.col("street"))).withColumn("_city", F.lower(strip(F.col("city"))))
    lenders = keyed.filter((F.col("website") != "") & (F.col("_street") != "")).groupBy("_street", "_city").agg(F.min_by("website", "first_seq").alias("_lent"))
    takes = (F.col("website") == "") & F.col("_lent").isNotNull()
    return keyed.join(lenders, ["_street", "_city"], "left").withColumn("website_source", F.when(takes, "address-match").otherwise(F.col("website_source"))).withColumn(
        "website", F.when(takes, F.col("_lent")).otherwise(F.col("website"))).select(*orgs.columns)


def with_registry_site(productions: DataFrame, orgs: DataFrame) -> DataFrame:
    """Productions whose blank site is their organization's."""
    site = orgs.select("org_key", F.col("website").alias("_site"))
    return with_org_key(productions).join(site, "org_key", "left").withColumn(
        "org_website", F.when(F.coalesce(F.col("org_website"), F.lit("")) == "", F.coalesce("_site", F.lit(""))).otherwise(F.col("org_website"))).drop("_site")


def coverage(orgs: DataFrame) -> DataFrame:
    """One row: organizations, those with a site, those that another source's site reached, percentage."""
    has = F.col("website") != ""
    beyond = F.size(F.array_except(F.split("sources", ","), F.array(F.lit("mti")))) > 0
    return orgs.agg(
        F.count(F.lit(1)).alias("orgs"), F.count_if(has).alias("with_website"),
        F.count_if(has & beyond & F.col("website_source").isin("mti", "address-match")).alias("cross_source_filled"),
    ).withColumn("pct_with_website", F.coalesce(F.bround(F.try_divide(F.col("with_website") * 100.0, F.col("orgs")), 1), F.lit(0.0)))


def sampled(productions: DataFrame, n: int) -> DataFrame:
    """Keys of ``n`` organizations: one of each leading source first, then by (site, source, size, key)."""
    from pyspark.sql.window import Window as W

    orgs = with_org_key(productions).groupBy("org_key").agg(
        F.max((F.coalesce(F.col("org_website"), F.lit("")) != "").cast("int")).alias("site"), F.min_by("source", "seq").alias("source"), F.count(F.lit(1)).alias("rows"))
    order = [F.desc("site"), "source", F.desc("rows"), "org_key"]
    # only n rows of each source can be chosen, so the global order sees few rows
    ranked = orgs.withColumn("in_source", F.row_number().over(W.partitionBy("source").orderBy(*order))).filter(F.col("in_source") <= n)
    return ranked.orderBy((F.col("in_source") > 1), *order).limit(n).select("org_key", "source", F.col("rows").alias("production_count"))
