from marquee.operators import registry, resolver

SCHEMA = "seq long, source string, organization string, city string, state string, country string, street string, org_website string, lat double, lng double"


def rows(spark, *values):
    blank = {"source": "mti", "organization": "Troupe", "city": "Exampleton", "state": "TX", "country": "US", "street": "", "org_website": "", "lat": None, "lng": None}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(({"seq": i} | blank | v)[c] for c in names) for i, v in enumerate(values)], SCHEMA)


def test_collapse(spark):
    p = rows(
        spark, {"organization": "THE TROUPE", "street": "1 Low St"}, {"organization": "The Troupe Inc", "source": "concord", "org_website": "n/a"}, {"organization": "Troupe", "org_website": "www.a.test", "street": "2 High St"},
        {"organization": "House Company", "street": "1 Low Street"}, {"organization": None, "city": None, "state": None, "country": None, "street": None, "org_website": None, "source": None},
    )
    orgs = {r.org_key: r for r in registry.share_by_address(registry.collapse(p)).collect()}
    troupe = orgs["troupe|exampleton|TX"]
    assert (troupe.name, troupe.street, troupe.website, troupe.website_source, troupe.sources, troupe.production_count, troupe.first_seq) == ("The Troupe Inc", "1 Low St", "http://www.a.test", "mti", "concord,mti", 3, 0)
    assert (orgs["house|exampleton|TX"].website, orgs["house|exampleton|TX"].website_source) == ("http://www.a.test", "address-match")
    assert orgs["||"].name == "" and orgs["||"].website == ""
    sites = {r.seq: r.org_website for r in registry.with_registry_site(p, registry.collapse(p)).collect()}
    assert sites[0] == "http://www.a.test" and sites[1] == "n/a" and sites[3] == ""
    c = registry.coverage(registry.share_by_address(registry.collapse(p))).first()
    assert (c.orgs, c.with_website, c.cross_source_filled, c.pct_with_website) == (3, 2, 1, 66.7)
    assert registry.coverage(registry.collapse(p.limit(0))).first().pct_with_website == 0.0
    assert registry.sampled(p, 2).count() == 2


def test_resolver(spark):
    ref = rows(spark, {"city": "One", "state": "TX", "lat": 30.0, "lng": -100.0}, {"city": "Two", "state": "TX", "lat": 31.0, "lng": -100.0}, {"city": "two", "state": "ON", "country": "CA", "lat": 44.0, "lng": -80.0}, {"city": "Off", "state": "", "lat": 30.0, "lng": -100.0})
    want = [
        ({"city": "one.", "state": "", "country": ""}, ("TX", "US", "city")), ({"city": "Two", "state": "", "lat": 44.1, "lng": -80.0}, ("ON", "US", "city+distance")), ({"city": "Three", "state": "", "country": "", "lat": 30.2, "lng": -100.4}, ("TX", "US", "nearest")),
        ({"city": "Far", "state": "", "country": "", "lat": 55.0, "lng": -110.0}, ("", "CA", "coarse")), ({"city": "Far", "state": "", "country": ""}, ("", "", "unresolved")), ({"city": "Kept"}, ("TX", "US", "already")), ({"city": None, "state": None, "country": None}, ("", "", "unresolved")),
    ]
    got = {r.seq: (r.geo_state, r.geo_country, r.geo_method) for r in resolver.resolved(rows(spark, *(v for v, _ in want)), ref).collect()}
    assert got == {i: w for i, (_, w) in enumerate(want)}
