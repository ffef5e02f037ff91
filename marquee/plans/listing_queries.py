"""Queries over listings, organizations and ledgers, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text, web
from ..functions.geo import cell, coarse_country
from ..operators import contacts, ledgers, registry, resolver
from ..sinks import sheets
from ..sources import catalogues
from ..streaming import first_seen
from .data_queries import BOX, table

#: The day that queries take for today.
TODAY = date(2026, 8, 1)
DAY = TODAY.isoformat()


def _day(c: str):
    """Day as text, blank for null."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))


def productions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "productions")


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Productions with state and country as resolved: keys of organizations are made of these."""
    p = productions(spark, sf_dir)
    return resolver.resolved(p, p.filter(F.col("source") == "mti")).withColumn("state", F.col("geo_state")).withColumn("country", F.col("geo_country")).select(*p.columns)


def scope_filter(spark, sf_dir):
    p = productions(spark, sf_dir)
    return p.filter(F.col("country").isin("US", "CA") & (F.col("end_date").isNull() | (F.col("end_date") >= F.lit(TODAY)))).select("seq", "country", _day("end_date").alias("end_date"))


def run_kinds(spark, sf_dir):
    s, e = F.col("start_date"), F.col("end_date")
    return productions(spark, sf_dir).select("seq", F.coalesce(dates.run_days(s, e).cast("string"), F.lit("")).alias("run_days"), dates.run_kind(s, e).alias("run_kind"))


def name_forms(spark, sf_dir):
    c = F.col
    return productions(spark, sf_dir).select(
        "seq", text.org_name(c("organization")).alias("org_name"), text.org_key(c("organization"), c("city"), c("state")).alias("org_key"), text.street_form(c("street")).alias("street_form"),
        text.title_form(c("show_title")).alias("title_form"), text.is_shouty(c("organization")).alias("shouty"), text.state_code(c("state")).alias("state_code"), text.country_of_state(text.state_code(c("state"))).alias("state_country"),
        text.content_key(c("source"), c("organization"), c("show_title")).alias("content_key"), text.slug(c("show_title")).alias("slug"),
    )


def address_lines(spark, sf_dir):
    c = F.col
    return productions(spark, sf_dir).select("seq", text.address_line(c("street"), c("city"), c("state"), c("postal"), c("country")).alias("address"))


def listing_productions(spark, sf_dir):
    rows = table(spark, sf_dir, "mti_listings").distinct()
    return catalogues.listings(rows).select("key", "show_title", "organization", "street", "city", "state", "postal", "country", "lat", "lng", "start_date", "end_date")


def union_floors(spark, sf_dir):
    p = productions(spark, sf_dir)
    return catalogues.floor_check(catalogues.united(*(p.filter(F.col("source") == s) for s in catalogues.SOURCE_ORDER)))


def required_organization(spark, sf_dir):
    return productions(spark, sf_dir).groupBy("source").agg(F.count_if(text.strip(F.col("organization")) != "").alias("kept"), F.count_if(text.strip(F.col("organization")) == "").alias("dropped"))


def box_scan(spark, sf_dir):
    return productions(spark, sf_dir).filter(F.col("lat").between(BOX["south"], BOX["north"]) & F.col("lng").between(BOX["west"], BOX["east"])).groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


def box_quadrants(spark, sf_dir):
    p = productions(spark, sf_dir).filter(F.col("source") == "concord").select("lat", "lng")
    return catalogues.live_quadrants(p, BOX)


def org_registry(spark, sf_dir):
    return registry.collapse(placed(spark, sf_dir))


def org_sites(spark, sf_dir):
    return registry.share_by_address(org_registry(spark, sf_dir)).select("org_key", "website", "website_source")


def site_writeback(spark, sf_dir):
    orgs = registry.share_by_address(org_registry(spark, sf_dir))
    return registry.with_registry_site(placed(spark, sf_dir), orgs).select("seq", "org_key", "org_website")


def org_coverage(spark, sf_dir):
    return registry.coverage(registry.share_by_address(org_registry(spark, sf_dir)))


def org_sample(spark, sf_dir):
    return registry.sampled(placed(spark, sf_dir), 50)


def geo_resolved(spark, sf_dir):
    p = productions(spark, sf_dir).select("seq", "source", "city", "state", "country", "lat", "lng")
    return resolver.resolved(p, p.filter(F.col("source") == "mti")).select("seq", "geo_state", "geo_country", "geo_method")


def geo_methods(spark, sf_dir):
    return geo_resolved(spark, sf_dir).groupBy("geo_method").agg(F.count(F.lit(1)).alias("rows"))


def geo_cells(spark, sf_dir):
    p = productions(spark, sf_dir).filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    return p.select("seq", cell(F.col("lat")).cast("long").alias("cell_lat"), cell(F.col("lng")).cast("long").alias("cell_lng"), coarse_country(F.col("lat"), F.col("lng")).alias("coarse"))


def first_rows(spark, sf_dir):
    p = productions(spark, sf_dir).select("key", "seq", "show_title", "organization")
    return ledgers.first_per_key(p, ["key"], "seq")


def last_rows(spark, sf_dir):
    p = productions(spark, sf_dir).select("key", "seq", "show_title", "organization")
    return ledgers.last_per_key(p, ["key"], "seq")


def distinct_runs(spark, sf_dir):
    p = productions(spark, sf_dir).select("organization", "city", "state", "start_date", "end_date", "seq")
    return p.groupBy("organization", "city", "state", "start_date", "end_date").agg(F.min("seq").alias("seq")).withColumn(
        "start_date", _day("start_date")).withColumn("end_date", _day("end_date"))


def seen_news(spark, sf_dir):
    return ledgers.seen_diff(productions(spark, sf_dir).select("key"), table(spark, sf_dir, "sightings"), TODAY)


def new_by_source(spark, sf_dir):
    return seen_news(spark, sf_dir).filter("is_new").groupBy(F.split_part(F.lower(text.strip(F.col("key"))), F.lit(":"), F.lit(1)).alias("source")).agg(F.count(F.lit(1)).alias("new_keys"))


def ledger_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "sightings").groupBy("key").agg(F.min("first_seen").alias("first_seen"), F.min("source").alias("source"))
    news = productions(spark, sf_dir).filter(F.col("first_seen") != "").groupBy("key").agg(F.min("first_seen").alias("first_seen"), F.min("source").alias("source"))
    return ledgers.upsert(old, news, "key")


def contact_freshness(spark, sf_dir):
    o = table(spark, sf_dir, "organizations")
    return o.select("row_id", ledgers.is_fresh(F.col("contact_status"), F.col("contact_checked"), TODAY).alias("fresh"))


def contact_disposition(spark, sf_dir):
    o = table(spark, sf_dir, "organizations")
    cache = ledgers.last_per_key(o.select("key", F.col("contact_status").alias("status"), F.col("contact_checked").alias("checked"), F.lit(False).alias("manual"), "row_id"), ["key"], "row_id")
    orgs = ledgers.first_per_key(o.select("key", "website", "row_id"), ["key"], "row_id").select("key", "website")
    return contacts.disposition(orgs, cache, TODAY).groupBy("disposition").agg(F.count(F.lit(1)).alias("organizations"))


def email_checks(spark, sf_dir):
    e = F.col("email")
    return table(spark, sf_dir, "organizations").select("row_id", web.email_rejection(e).alias("rejection"), web.email_domain(e).alias("domain"), web.mailbox_rank(e).cast("long").alias("mailbox_rank"))


def site_checks(spark, sf_dir):
    return table(spark, sf_dir, "organizations").select("row_id", web.site_url(F.col("website")).alias("url"))


def phone_forms(spark, sf_dir):
    return table(spark, sf_dir, "organizations").select("row_id", web.phone_format(F.col("phone")).alias("phone"))


def document_contacts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    emails = F.regexp_extract_all("text", F.lit(contacts.EMAIL), 0)
    return d.select("doc_id", F.size(emails).cast("long").alias("emails"), F.array_join(contacts.page_phones(F.col("text")), ",").alias("phones")).filter((F.col("emails") > 0) | (F.col("phones") != ""))


def title_counts(spark, sf_dir):
    p = productions(spark, sf_dir)
    span = F.datediff("start_date", F.lit(TODAY))
    return p.filter(span.between(30, 120) & (dates.run_kind(F.col("start_date"), F.col("end_date")) != "license window")).groupBy("show_title").agg(F.count(F.lit(1)).alias("productions"))


def link_merge(spark, sf_dir):
    links = table(spark, sf_dir, "sample_links").select("show_title", "sample_url", F.col("productions").cast("long").alias("productions"), "notes")
    return ledgers.merged_counts(links, title_counts(spark, sf_dir), "show_title", "productions").select("show_title", F.coalesce("sample_url", F.lit("")).alias("sample_url"), "productions", F.coalesce("notes", F.lit("")).alias("notes"))


def link_lookup(spark, sf_dir):
    """Each production's sample link by title; of two links of one title the later row holds. Rows are numbered by their place in the table."""
    links = table(spark, sf_dir, "sample_links").withColumn("row", F.monotonically_increasing_id()).filter((F.col("show_title") != "") & (F.col("sample_url") != ""))
    last = links.groupBy(text.title_form(F.col("show_title")).alias("title_form")).agg(F.max_by("sample_url", "row").alias("sample_url"))
    p = productions(spark, sf_dir).select("seq", text.title_form(F.col("show_title")).alias("title_form"))
    return p.join(last, "title_form", "left").select("seq", F.coalesce("sample_url", F.lit("")).alias("sample_url"))


def _reached(spark, sf_dir):
    """Organizations with sites shared by address and the latest contact that the registry rows of their key hold."""
    orgs = registry.share_by_address(org_registry(spark, sf_dir))
    kept = table(spark, sf_dir, "organizations").select(F.col("key").alias("org_key"), "email", "phone", "facebook", "instagram", "contact_status", "contact_checked", "row_id")
    return orgs.join(ledgers.last_per_key(kept, ["org_key"], "row_id").drop("row_id"), "org_key", "left").na.fill("", ["email", "phone", "facebook", "instagram", "contact_status", "contact_checked"])


def production_sheet(spark, sf_dir):
    return sheets.production_sheet(placed(spark, sf_dir), _reached(spark, sf_dir))


def organization_sheet(spark, sf_dir):
    return sheets.organization_sheet(_reached(spark, sf_dir))


def contact_sheet(spark, sf_dir):
    o = table(spark, sf_dir, "organizations").select(F.col("key").alias("org_key"), "name", "city", "state", "website", "email", "phone", "facebook", "instagram", F.col("contact_status").alias("status"), F.col("contact_checked").alias("checked"), F.lit(False).alias("manual"), F.col("row_id"))
    return sheets.contact_sheet(ledgers.last_per_key(o, ["org_key"], "row_id").drop("row_id"))


def next_shows(spark, sf_dir):
    """Each organization's next show that is no licence window."""
    return ledgers.next_per_key(registry.with_org_key(placed(spark, sf_dir)), "org_key", TODAY).select("org_key", F.col("key"), _day("start_date").alias("start_date"))


def shared_mailboxes(spark, sf_dir):
    """Of the organizations that share a mailbox and have a next show, the one whose show is soonest."""
    nexts = next_shows(spark, sf_dir)
    boxes = _reached(spark, sf_dir).select("org_key", web.email_normal(F.col("email")).alias("address"), "first_seq").filter(web.email_rejection(F.col("address")) == "")
    return ledgers.winner_per_key(nexts.join(boxes, "org_key"), "address", ["start_date", "first_seq"]).select("address", "org_key", "start_date")


def digest_top(spark, sf_dir):
    """The first fifteen new productions in arrival order: the digest's table."""
    news = seen_news(spark, sf_dir).filter("is_new").select("key")
    first = ledgers.first_per_key(productions(spark, sf_dir).select("key", "seq", "show_title", "organization"), ["key"], "seq")
    return first.join(news, "key", "left_semi").orderBy("seq").limit(15)


def run_log(spark, sf_dir):
    p = productions(spark, sf_dir)
    return p.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("source") == "mti").alias("mti"), F.count_if(F.col("source") == "concord").alias("concord"), F.count_if(F.col("source") == "trw").alias("trw"),
        F.count_if(F.col("country").isin("US", "CA")).alias("in_countries"), F.count_distinct("key").alias("keys"), F.count_if(F.col("org_website") != "").alias("with_site"),
    )


def summary_sets(spark, sf_dir):
    """Counts by source, by source and kind, and in all: one pass of grouping sets."""
    p = productions(spark, sf_dir).select("source", dates.run_kind(F.col("start_date"), F.col("end_date")).alias("kind"))
    return p.rollup("source", "kind").agg(F.count(F.lit(1)).alias("rows"), F.grouping_id().cast("long").alias("level")).select(F.coalesce("source", F.lit("*")).alias("source"), F.coalesce("kind", F.lit("*")).alias("kind"), "rows", "level")


def similar_fields(spark, sf_dir):
    """Wanted titles of the link list beside known ones that share two words or hold all of theirs."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != ""))
    links = table(spark, sf_dir, "sample_links").select(F.col("show_title").alias("wanted"), words(F.col("show_title")).alias("a")).distinct()
    shared = links.select("wanted", F.size("a").alias("na"), F.explode("a").alias("w"))
    known = links.select(F.col("wanted").alias("known"), F.size("a").alias("nb"), F.explode("a").alias("w"))
    both = shared.join(known, "w").filter(F.col("wanted") < F.col("known")).groupBy("wanted", "known", "na", "nb").agg(F.count(F.lit(1)).alias("shared"))
    return both.filter((F.col("shared") >= 2) | (F.col("shared") == F.least("na", "nb"))).select("wanted", "known", "shared")


def event_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


def stream_first_seen(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    # a single file has its folder and name as stream source
    source = path if _is_folder(spark, path) else f"{sf_dir}/events*.parquet"
    return first_seen.ledger_of_files(spark, source, schema, "user_id", "ts").select(F.col("key").alias("user_id"), "first_seen")


def _is_folder(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


QUERIES = {f.__name__: f for f in (
    scope_filter, run_kinds, name_forms, address_lines, listing_productions, union_floors, required_organization, box_scan, box_quadrants, org_registry, org_sites, site_writeback, org_coverage, org_sample,
    geo_resolved, geo_methods, geo_cells, first_rows, last_rows, distinct_runs, seen_news, new_by_source, ledger_upsert, contact_freshness, contact_disposition, email_checks, site_checks, phone_forms, document_contacts,
    title_counts, link_merge, link_lookup, production_sheet, organization_sheet, contact_sheet, next_shows, shared_mailboxes, digest_top, run_log, summary_sets, similar_fields, event_props, stream_first_seen,
)}
from .listing_sql import SQL  # noqa: E402

__all__ = ["QUERIES", "SQL"]
