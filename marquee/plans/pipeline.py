"""The daily report: catalogues in, sheets, ledgers and figures out."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import contacts, ledgers, registry, resolver
from ..session import work_dir, written
from ..sinks import sheets
from ..sources import catalogues


@dataclass(frozen=True)
class Options:
    """Controls of a run."""

    today: date
    countries: tuple[str, ...] = ("US", "CA")
    #: Leave out productions that have ended.
    drop_ended: bool = True
    #: Catalogues to leave out.
    skip: tuple[str, ...] = ()
    #: Only so many organizations, one of each catalogue first; 0 takes all.
    sample: int = 0
    #: Keep contacts as they are.
    no_enrich: bool = False
    #: Read pages again of organizations whose contact is still fresh; rows made by hand never are.
    force_enrich: bool = False
    #: Write the preview only.
    dry_run: bool = False
    #: Save the contact cache in a dry run, too.
    save_cache: bool = False
    #: Rows under which a catalogue's feed counts as broken; empty for small test feeds.
    floors: dict[str, int] = field(default_factory=lambda: dict(catalogues.LEAST_ROWS))


@dataclass
class Report:
    """Tables of one run; all are made from tables written once, so each can be read on its own."""

    productions: DataFrame
    organizations: DataFrame
    news: DataFrame
    seen: DataFrame
    contacts: DataFrame
    statistics: DataFrame
    log: DataFrame


def daily(feeds: dict[str, DataFrame], seen: DataFrame, cache: DataFrame, pages: DataFrame, options: Options) -> Report:
    """One day's report.

    ``feeds`` has a table of productions per catalogue; ``seen`` is ``key, first_seen``; ``cache`` the
    contacts of :data:`~marquee.operators.contacts.CONTACT` by ``org_key``; ``pages`` is ``url, html, status``.
    A feed under its floor stops the run. Places are resolved before keys are made; productions out
    of scope go before organizations are formed; contacts follow; what the ledger lacks is news.
    """
    used = {s: feeds[s] for s in catalogues.SOURCE_ORDER if s in feeds and s not in options.skip}
    every = catalogues.united(*used.values())
    folder = work_dir(every.sparkSession)
    every = catalogues.refused_below_floor(every, {s: n for s, n in options.floors.items() if s in used})
    every = written(every, folder, "feeds")
    columns = every.columns
    placed = resolver.resolved(every, every.filter(F.col("source") == catalogues.SOURCE_ORDER[0])).withColumn("state", F.col("geo_state")).withColumn("country", F.col("geo_country")).select(*columns)
    running = F.col("end_date").isNull() | (F.col("end_date") >= F.lit(options.today)) | F.lit(not options.drop_ended)
    scoped = placed.filter(F.col("country").isin(*options.countries) & running)
    if options.sample:
        chosen = registry.sampled(scoped, options.sample).select("org_key")
        scoped = registry.with_org_key(scoped).join(F.broadcast(chosen), "org_key", "left_semi").drop("org_key")  # as many keys as asked for
    scoped = written(scoped, folder, "scoped")
    orgs = written(registry.share_by_address(registry.collapse(scoped)), folder, "registry")
    if options.no_enrich:
        kept = cache.select("org_key", *contacts.CONTACT)
        held = kept.select("org_key", "email", "phone", "facebook", "instagram", F.col("status").alias("contact_status"), F.col("checked").alias("contact_checked"))
        reached = orgs.join(held, "org_key", "left").na.fill("", held.columns[1:]).withColumn("disposition", F.lit("fresh"))
    else:
        kept, reached = contacts.merged_contacts(orgs, cache, pages, options.today, force=options.force_enrich)
    reached, kept = written(reached, folder, "organizations"), written(kept, folder, "contacts")
    sited = written(registry.with_registry_site(scoped, reached).drop("org_key"), folder, "productions")
    news = written(ledgers.seen_diff(sited.select("key"), seen, options.today), folder, "news")
    stamped = sited.drop("first_seen", "last_seen").join(news.select("key", "first_seen", "last_seen", "is_new"), "key", "left")
    ledger = ledgers.upsert(seen.select("key", "first_seen"), news.filter("is_new").select("key", "first_seen"), "key")
    figures = contacts.contact_statistics(reached)
    counts = stamped.agg(*(F.count_if(F.col("source") == s).alias(s) for s in catalogues.SOURCE_ORDER), F.count(F.lit(1)).alias("in_scope"), F.count_distinct(F.when(F.col("is_new"), F.col("key"))).alias("new_today"))
    log = counts.join(F.broadcast(figures)).select(F.lit(options.today.isoformat()).alias("run_day"), "*")  # one row each
    return Report(stamped, reached, stamped.filter("is_new"), ledger, kept, figures, log)


def publish(report: Report, folder: str, options: Options) -> None:
    """Write the sheets and, last, the ledgers; a dry run writes the preview and no more."""
    sheets.write_sheet(sheets.preview(report.productions, report.organizations), f"{folder}/preview")
    if options.dry_run:
        if options.save_cache:
            ledgers.save_ledger(report.contacts, f"{folder}/contact-ledger", "org_key")
        return
    sheets.write_sheet(sheets.production_sheet(report.productions, report.organizations), f"{folder}/productions")
    sheets.write_sheet(sheets.production_sheet(report.news, report.organizations), f"{folder}/new")
    sheets.write_sheet(sheets.organization_sheet(report.organizations), f"{folder}/organizations")
    sheets.write_sheet(sheets.contact_sheet(report.contacts), f"{folder}/contacts", sheets.CONTACT_HEADERS)
    report.log.write.mode("append").option("header", True).csv(f"{folder}/log")
    ledgers.save_ledger(report.contacts, f"{folder}/contact-ledger", "org_key")
    ledgers.save_ledger(report.seen, f"{folder}/seen-ledger", "key")
