import json
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marquee.operators import contacts, ledgers
from marquee.sources import catalogues


def test_listing_json(spark, tmp_path):
    row = {"id": 1, "title": "T", "show_title": "", "lat": "35.5", "lng": "x", "venue": "Hall", "organization": "", "address": "1 Low St<br>Exampleton, NC<br>27000<br>US", "start": "2026-8-1", "end": "bad", "venue_url": " www.a.test ", "location_text": "X, TX"}
    (tmp_path / "a.json").write_text(json.dumps({"success": True, "data": [row, {**row, "id": 2, "venue": " "}, {**row, "id": 3, "address": None}]}))
    got = catalogues.listings(catalogues.read_listing_json(spark, str(tmp_path / "a.json")), "position").orderBy("seq").collect()
    assert [r.key for r in got] == ["mti:1", "mti:3"]
    assert (got[0].show_title, got[0].organization, got[0].city, got[0].state, got[0].postal, got[0].lat, got[0].lng) == ("T", "Hall", "Exampleton", "NC", "27000", 35.5, None)
    assert (got[0].start_date, got[0].end_date, got[0].org_website) == (date(2026, 8, 1), None, "www.a.test")
    assert (got[1].city, got[1].state, got[1].country) == ("X", "TX", "US")
    (tmp_path / "b.json").write_text(json.dumps({"success": False, "data": [row]}))
    with pytest.raises(PySparkException):
        catalogues.read_listing_json(spark, str(tmp_path / "b.json")).collect()


def test_markers_and_sweep(spark):
    schema = "position long, Type int, C int, I string, Uid string, Lat string, Lon string, productid string, name string, producer string, performancetype string, authors string, address string, city string, state string, startdate string, enddate string"
    mark = lambda i, uid, lat=30.0: (i, 1, None, "v", uid, str(lat), "-100", "7", "A Show!", "Troupe", "", "", "", "C", "", f"{13 + i}/02/2026", "bad")
    cluster = (9, 2, 5, None, None, "30", "-100", None, None, None, None, None, None, None, None, None, None)
    rows = spark.createDataFrame([mark(0, "a"), mark(0, "b"), mark(1, "c"), cluster], schema)
    made = catalogues.markers(rows).collect()
    assert len(made) == 3 and len({r.key for r in made}) == 2 and made[0].start_date == date(2026, 2, 13) and made[0].source_url.endswith("/7/a-show")
    first, stuck = catalogues.sweep(lambda box, zoom: rows, {"south": 23.0, "north": 72.0, "west": -172.0, "east": -52.0}, zoom=18, step=2, most=20)
    assert first.count() == 2 and stuck.first()["stuck"] == 5
    none = rows.select(F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng")).limit(1)
    assert catalogues.live_quadrants(none, {"south": 23.0, "north": 72.0, "west": -172.0, "east": -52.0}).count() == 4


def test_pages(spark):
    run = lambda a, b, o, p: f'<div class="run"><span class="from">{a}</span><span class="to">{b}</span><h3>{o}</h3><p>{p}</p></div>'
    html = f'<title>A Show | Site</title>{run("Jan 1", "2, 2020", "Early", "X, TX")}<div id="upcoming">' + run("Dec 28", "Jan 03, 2027", "Troupe", "Big, Town, TX") * 2 + run("", "", "Other", "Nowhere") + f'<div id="related">{run("Jan 1", "2, 2020", "Late", "X, TX")}'
    pages = spark.createDataFrame([(1, "https://x.test/show/a-show/", html), (2, "https://x.test/show/b-show/", "<p>"), (3, "u", None)], "page_id long, url string, html string")
    got = {r.organization: r for r in catalogues.show_pages(pages).collect()}
    assert set(got) == {"Troupe", "Other"}
    assert (got["Troupe"].show_title, got["Troupe"].city, got["Troupe"].state, got["Troupe"].start_date) == ("A Show", "Big, Town", "TX", date(2026, 12, 28))
    assert (got["Other"].city, got["Other"].start_date) == ("Nowhere", None)
    assert spark.range(1).select(catalogues.show_urls(F.lit("<loc>https://x/show/a</loc><loc> https://x/b </loc>")).alias("u")).first()["u"] == ["https://x/show/a"]


def test_contacts(spark):
    html = """<script>var a="x@script.org"</script><a href="mailto:Zed@real.org?subject=1">z</a> info@real.org ZED@real.org user@domain.com (919) 555-0100 919-555-0100 119-555-0100
      <a href="tel:+1 919 555 0199">c</a><a href="/contact#x">Contact us</a><a href="about">About</a><a href="https://other.test/contact">Contact</a><a href="https://facebook.com/sharer?u=1">s</a><a href="https://facebook.com/troupe?x=1">f</a>
      <script type="application/ld+json">{"@graph":[{"a":{"email":"mailto:first@ld.org"}},{"email":"second@ld.org","telephone":["919 555 0111"]}]}</script><script type="application/ld+json">{bad</script>"""
    r = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    got = r.select(contacts.page_emails(F.col("html")).alias("e"), contacts.page_phones(F.col("html")).alias("p"), contacts.contact_links(F.col("html"), F.lit("https://real.org/")).alias("l"), contacts.social_link(F.col("html"), "facebook.com").alias("s")).first()
    assert got.e[0] == "info@real.org" and "Zed@real.org" in got.e and "ZED@real.org" not in got.e and "user@domain.com" not in got.e
    assert got.p == ["(919) 555-0199", "(919) 555-0100"] and got.l == ["https://real.org/contact", "https://real.org/about"] and got.s == "https://facebook.com/troupe"
    ld = contacts.structured_contacts(r).collect()
    assert [(x.page_id, x.email, x.phone) for x in ld] == [(1, "first@ld.org", "919 555 0111")]


def test_ledgers(spark):
    today = date(2026, 8, 17)
    cases = [("found", "2019-01-01", True), ("no_website", "", True), ("not_found", "2026-05-20", True), ("not_found", "2026-05-19", False), ("error", "2026-08-10", False), ("error", "2026-08-11", True), ("error", "x", False), (None, None, False)]
    df = spark.createDataFrame(cases, "status string, checked string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", ledgers.is_fresh(F.col("status"), F.col("checked"), today)).collect())
    now, seen = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string"), spark.createDataFrame([("a", ""), ("a", "2026-01-02")], "key string, first_seen string")
    assert {(r.key, r.first_seen, r.is_new) for r in ledgers.seen_diff(now, seen, today).collect()} == {("a", "2026-01-02", False), ("b", "2026-08-17", True)}
    both = ledgers.upsert(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int"), "k")
    assert {tuple(r) for r in both.collect()} == {("a", 1), ("b", 3), ("c", 4)}


def test_joined_url(spark):
    cases = [("https://a.org/x/y.html", "z.html", "https://a.org/x/z.html"), ("https://a.org/x/y.html", "../z", "https://a.org/z"), ("https://a.org", "about#top", "https://a.org/about"), ("https://a.org/x", "//b.org/c", "https://b.org/c"), ("https://a.org/x", "mailto:a@b.c", ""), ("https://a.org/x/", "./q?r=1", "https://a.org/x/q?r=1"), ("https://a.org/x", "/../y", "https://a.org/y")]
    df = spark.createDataFrame(cases, "base string, href string, want string")
    assert df.filter(contacts.joined_url(F.col("base"), F.col("href")) != F.col("want")).count() == 0


def test_pages_become_contacts(spark):
    pages = [
        ("https://a.org", "<a href='/contact'>Contact</a><a href='/about'>About</a> (919) 555-0100", 200), ("https://a.org/contact", "<a href='mailto:zed@a.org'>x</a> info@a.org", 200), ("https://a.org/about", "staff@a.org", 200),
        ("https://b.org", "nothing", 200), ("https://c.org", "x@c.org", 500), ("https://e.org", "<script type=\"application/ld+json\">[{\"a\": {\"email\": \"mailto:ld@e.org\", \"telephone\": \"1 2\"}}]</script> zed@e.org (919) 555-0101", 200),
    ]
    orgs = [("a", "A", "T", "TX", "https://a.org"), ("b", "B", "T", "TX", "https://b.org"), ("c", "C", "T", "TX", "https://c.org"), ("d", "D", "T", "TX", ""), ("e", "E", "T", "TX", "https://e.org"), ("m", "M", "T", "TX", ""), ("f", "F", "T", "TX", "https://f.org")]
    kept = [("m", "hand@m.org", "", "", "", "found", "", "https://m.org", "M", "T", "TX", True), ("f", "old@f.org", "", "", "", "found", "2026-01-01", "", "F", "T", "TX", False), ("gone", "g@g.org", "", "", "", "found", "", "", "", "", "", False)]
    cache = spark.createDataFrame(kept, "org_key string, email string, phone string, facebook string, instagram string, status string, checked string, website string, name string, city string, state string, manual boolean")
    df = spark.createDataFrame(orgs, "org_key string, name string, city string, state string, website string")
    merged, reached = contacts.merged_contacts(df, cache, spark.createDataFrame(pages, "url string, html string, status int"), date(2026, 8, 1))
    got = {r.org_key: r for r in merged.collect()}
    assert {k: (r.email, r.status) for k, r in got.items()} == {
        "a": ("info@a.org", "found"), "b": ("", "not_found"), "c": ("", "error"), "d": ("", "no_website"), "e": ("ld@e.org", "found"), "m": ("hand@m.org", "found"), "f": ("old@f.org", "found"), "gone": ("g@g.org", "found")}
    assert got["a"].phone == "(919) 555-0100" and got["e"].phone == "1 2" and got["a"].checked == "2026-08-01"
    assert {r.org_key: r.website for r in reached.collect()}["m"] == "https://m.org"
    stats = contacts.contact_statistics(reached).first()
    assert (stats.orgs_seen, stats.cache_hits, stats.manual_hits, stats.orgs_fetched, stats.with_contact) == (7, 2, 1, 4, 4)
