from dataclasses import replace
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marquee.operators import contacts, ledgers
from marquee.plans import pipeline
from marquee.sinks import sheets
from marquee.sources import catalogues

TODAY = date(2026, 8, 1)
PRODUCTION = "key string, source string, show_title string, organization string, venue string, venue_type string, street string, city string, state string, postal string, country string, lat double, lng double, start_date date, end_date date, source_url string, org_website string, seq long"
CACHE = "org_key string, email string, phone string, facebook string, instagram string, status string, checked string, website string, name string, city string, state string, manual boolean"


def feeds(spark):
    def rows(source, *some):
        return spark.createDataFrame([(k, source, "Show", org, "", "", street, city, state, "", "US" if state else "", lat, lng, start, end, "", site, seq) for seq, (k, org, street, city, state, lat, lng, start, end, site) in some], PRODUCTION)

    d = date(2026, 9, 1)
    return {
        "mti": rows("mti", (1, ("mti:1", "Sample Players", "1 Low St", "Exampleton", "TX", 30.0, -100.0, d, d, "www.sample.org")), (2, ("mti:2", "Old Troupe", "", "Exampleton", "TX", 30.0, -100.0, d, date(2026, 1, 1), ""))),
        "concord": rows("concord", (10, ("concord:1", "SAMPLE PLAYERS", "", "Exampleton", "", 30.01, -100.01, None, None, "")), (11, ("concord:2", "Other House", "1 Low Street", "Exampleton", "", 30.0, -100.0, date(2026, 8, 20), None, ""))),
    }


def run(spark, options, cache=(), seen=(("mti:1", "2026-07-01"),)):
    pages = spark.createDataFrame([("http://www.sample.org", "info@sample.org", 200)], "url string, html string, status int")
    return pipeline.daily(feeds(spark), spark.createDataFrame(list(seen), "key string, first_seen string"), spark.createDataFrame(list(cache), CACHE), pages, options)


def test_daily(spark, tmp_path):
    options = pipeline.Options(TODAY, floors={})
    report = run(spark, options)
    orgs = {r.name: r for r in report.organizations.collect()}
    # concord has no state: its place is resolved before the key is made, so both rows are one organization
    assert set(orgs) == {"Sample Players", "Other House"} and orgs["Sample Players"].production_count == 2
    assert orgs["Other House"].website == "http://www.sample.org" and orgs["Other House"].website_source == "address-match"
    assert orgs["Sample Players"].email == "info@sample.org"
    assert {r.key for r in report.news.collect()} == {"concord:1", "concord:2"}
    log = report.log.first()
    assert (log.mti, log.concord, log.in_scope, log.new_today, log.with_contact) == (1, 2, 3, 2, 2)
    pipeline.publish(report, str(tmp_path), options)
    sheet = spark.read.option("header", True).csv(f"{tmp_path}/productions")
    assert len(sheet.columns) == 21 and [r.start for r in sheet.collect()] == ["2026-08-20", "2026-09-01", None]
    assert ledgers.load_ledger(spark, f"{tmp_path}/seen-ledger", "key string, first_seen string").count() == 3
    back = {r.organization if "organization" in r else r.name: r for r in sheets.read_contacts(spark, f"{tmp_path}/contacts").collect()}
    assert back["Sample Players"].email == "info@sample.org" and not back["Sample Players"].manual


def test_controls(spark, tmp_path):
    options = pipeline.Options(TODAY, floors={})
    assert {r.source for r in run(spark, replace(options, skip=("concord",))).productions.select("source").distinct().collect()} == {"mti"}
    assert run(spark, replace(options, sample=1)).organizations.count() == 1
    assert run(spark, replace(options, drop_ended=False)).productions.count() == 4
    hand = [("sample players|exampleton|TX", "hand@sample.org", "", "", "", "found", "", "", "Sample Players", "Exampleton", "TX", True)]
    for forced in (False, True):
        got = {r.name: r.email for r in run(spark, replace(options, force_enrich=forced), cache=hand).organizations.collect()}
        assert got["Sample Players"] == "hand@sample.org"
    assert {r.email for r in run(spark, replace(options, no_enrich=True)).organizations.collect()} == {""}
    with pytest.raises(PySparkException, match="concord, mti"):
        run(spark, pipeline.Options(TODAY))
    dry = replace(options, dry_run=True)
    pipeline.publish(run(spark, dry), str(tmp_path / "dry"), dry)
    assert [p.name for p in (tmp_path / "dry").iterdir()] == ["preview"]


def test_contact_sheet_round_trip(spark, tmp_path):
    rows = [("b", "x@b.org", "", "", "", "found", "2026-07-01", "", "beta", "T", "TX", True), ("a", "", "", "", "", "", "", "www.a.org", "Alpha", "T", "TX", False), ("c", None, None, None, None, "error", None, None, None, None, None, None)]
    sheets.write_sheet(sheets.contact_sheet(spark.createDataFrame(rows, CACHE)), str(tmp_path / "s"), sheets.CONTACT_HEADERS)
    got = {r.org_key: r for r in sheets.read_contacts(spark, str(tmp_path / "s")).collect()}
    assert got["b"].manual and got["b"].email == "x@b.org" and got["a"].status == "found" and got["c"].status == "error"
    spark.createDataFrame([("k", "v")], "`Org Key` string, Other string").write.option("header", True).csv(str(tmp_path / "odd"))
    assert sheets.read_contacts(spark, str(tmp_path / "odd")).count() == 0
    spark.createDataFrame([("k", "one@k.org"), ("k", "two@k.org"), ("", "x")], "k string, e string").coalesce(1).select(
        F.col("k").alias("Org Key"), *(F.lit("").alias(h) for h in sheets.CONTACT_HEADERS[1:5]), F.col("e").alias("Email"), *(F.lit("").alias(h) for h in sheets.CONTACT_HEADERS[6:])).write.option("header", True).csv(str(tmp_path / "twice"))
    assert [(r.org_key, r.email) for r in sheets.read_contacts(spark, str(tmp_path / "twice")).collect()] == [("k", "two@k.org")]


def test_ledger_versions(spark, tmp_path):
    folder, schema = str(tmp_path / "l"), "key string, first_seen string"
    assert ledgers.load_ledger(spark, folder, schema).count() == 0
    first = spark.createDataFrame([("a", "1")], schema)
    ledgers.save_ledger(first, folder, "key")
    ledgers.save_ledger(ledgers.upsert(ledgers.load_ledger(spark, folder, schema), spark.createDataFrame([("b", "2")], schema), "key"), folder, "key")
    assert [r.key for r in ledgers.load_ledger(spark, folder, schema).orderBy("key").collect()] == ["a", "b"]


def test_generic_choices(spark):
    rows = spark.createDataFrame([("x", "k2", date(2026, 8, 5), date(2026, 8, 6)), ("x", "k1", date(2026, 8, 5), None), ("x", "k0", date(2026, 7, 1), None), ("y", "k3", date(2026, 8, 2), date(2027, 8, 2))], "org string, key string, start_date date, end_date date")
    assert [(r.org, r.key) for r in ledgers.next_per_key(rows, "org", TODAY).collect()] == [("x", "k1")]
    boxes = spark.createDataFrame([("a@x", "o1", 2), ("a@x", "o2", 1), (None, "o3", 0)], "address string, org string, n int")
    assert [(r.address, r.org) for r in ledgers.winner_per_key(boxes, "address", ["n", "org"]).collect()] == [("a@x", "o2")]
    assert {r.org: r.within for r in ledgers.capped(boxes, ["n"], 2).collect()} == {"o3": True, "o2": True, "o1": False}
    assert ledgers.capped(boxes, ["n"], 0).filter("within").count() == 0 and ledgers.capped(boxes, ["n"], -1).filter("within").count() == 3
    assert [r.address for r in ledgers.absent_keys(boxes, boxes.filter("n = 1"), "address").collect()] == [None]


def test_show_page(spark):
    run_ = '<span class="date-display-start">{}</span> &ndash; <span class="date-display-end">{}</span><h5>{}<br/>{}</h5>'
    html = "<title>x</title>" + run_.format("Aug 1", "3, 2026", "before", "A, TX") + '<div id="upcoming">' + run_.format("Dec 30", "Jan 2, 2027", "Sample  Players", "Exampleton, Texas") * 2 + '</div><div id="related">' + run_.format("Aug 1", "3, 2026", "after", "A, TX") + "</div>"
    pages = spark.createDataFrame([(3, "https://c.test/show/the-o'brien-show", html)], "page_id long, url string, html string")
    got = catalogues.show_pages(pages).collect()
    assert [(r.organization, r.city, r.state, r.start_date, r.end_date) for r in got] == [("Sample Players", "Exampleton", "TX", date(2026, 12, 30), date(2027, 1, 2))]
    assert spark.range(1).select(catalogues.page_title(F.lit(""), F.lit("https://c.test/show/the-o'brien-show/"))).first()[0] == "The O'Brien Show"
