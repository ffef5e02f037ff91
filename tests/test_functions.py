from datetime import date

from pyspark.sql import functions as F

from marquee.functions import dates, text, web


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'date' if isinstance(v, date) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first()["r"]


def test_names(spark):
    form = lambda v: one(spark, text.org_name(F.col("v")), v=v)
    assert form("The Example Players, Inc.") == form("example players") == "example players"
    assert form("Salt & Pepper Co.") == "salt and pepper" and form(None) == ""
    assert one(spark, text.org_key(F.lit("A Troupe"), F.lit("St. Test"), F.lit("texas"))) == "a troupe|st test|TX"
    assert one(spark, text.street_form(F.lit("224 Sample Street"))) == one(spark, text.street_form(F.lit("224 Sample St."))) == "224sample"
    title = lambda v: one(spark, text.title_form(F.col("v")), v=v)
    assert title("The Baker’s Dream") == title("Bakers Dream") and title("Baker Jr") != title("Baker")
    shout = lambda v: one(spark, text.is_shouty(F.col("v")), v=v)
    assert shout("AB 1!") and not shout("Ab") and not shout("12") and not shout(None)


def test_addresses(spark):
    parse = lambda v: tuple(one(spark, text.break_address(F.col("v")), v=v))
    assert parse("1 Sample Street<br>Exampleton, NC<br>27000<br>US") == ("1 Sample Street", "Exampleton", "NC", "27000", "US")
    assert parse("Hall<br/>2 Low Road<br />Exampleville, ON<br>k1a 0b1<br>Canada") == ("Hall, 2 Low Road", "Exampleville", "ON", "K1A 0B1", "CA")
    assert parse("Some Hall<br>Townham<br>ZZ1<br>GB") == ("Some Hall, Townham", "ZZ1", "", "", "GB")
    assert parse("Lone, TX") == ("", "Lone", "TX", "", "US") and parse(None) == parse("") == parse("<br>") == ("", "", "", "", "")
    assert one(spark, text.address_line(F.lit("1 A St"), F.lit("B"), F.lit("TX"), F.lit(""), F.lit("CA"))) == "1 A St, B, TX, CA"


def test_dates(spark):
    span = lambda a, b: tuple(one(spark, dates.open_range(F.col("a"), F.col("b")), a=a, b=b))
    assert span("Aug 06", "23, 2026") == (date(2026, 8, 6), date(2026, 8, 23))
    assert span("Feb 20", "Mar 14, 2027") == (date(2027, 2, 20), date(2027, 3, 14))
    assert span("Dec 28", "Jan 03, 2027") == (date(2026, 12, 28), date(2027, 1, 3))
    assert span("", "") == span("garbage", "garbage") == (None, None) and span("??", "Mar 14, 2027") == (None, date(2027, 3, 14))
    assert one(spark, dates.iso_day(F.lit(" 2026-8-1 "))) == date(2026, 8, 1) and one(spark, dates.iso_day(F.lit("2026-02-30"))) is None
    assert one(spark, dates.day_first(F.lit("31/12/2026"))) == date(2026, 12, 31) and one(spark, dates.day_first(F.lit("12/31/2026"))) is None
    for days, kind in ((3, "performance run"), (14, "performance run"), (15, "extended run"), (120, "extended run"), (121, "license window"), (-1, "invalid")):
        assert one(spark, dates.run_kind(F.lit(date(2026, 1, 1)), F.date_add(F.lit(date(2026, 1, 1)), days))) == kind


def test_web(spark):
    why = lambda v: one(spark, web.email_rejection(F.col("v")), v=v)
    cases = {None: "empty", "a b@x.org": "malformed", "me@domain.com": "placeholder_domain", "x@group.calendar.google.com": "machine_address", "User@real.org": "placeholder_mailbox", "noreply@real.org": "unattended_mailbox", "a@b.wixpress.com": "blocklisted", " Box@Real.org ": ""}
    assert {v: why(v) for v in cases} == cases
    url = lambda v: one(spark, web.site_url(F.col("v")), v=v)
    assert url("www.real.org/x") == "http://www.real.org/x" and url("https://real.org:80/") == "https://real.org:80/"
    assert [url(v) for v in (None, "", "http://", "a..org", "http://localhost", "-a.org", "HTTP://x.org", "n/a")] == [""] * 8
    assert one(spark, web.phone_format(F.lit("1-919-555-0100"))) == "(919) 555-0100" and one(spark, web.phone_format(F.lit("555-0100"))) == ""
