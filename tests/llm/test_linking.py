import random
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from marquee.llm import addresses, canon, entity_match, history, names
from marquee.session import work_dir


def test_segment_join_against_all_pairs(spark):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcde") for _ in range(rnd.randrange(3, 18))) for _ in range(60)]

    def typo(t):
        i = rnd.randrange(len(t))
        return rnd.choice([t[:i] + t[i + 1 :], t[:i] + "z" + t[i:], t[:i] + "q" + t[i + 1 :], t[:i] + t[i + 1 : i + 2] + t[i : i + 1] + t[i + 2 :]])

    texts = base + [typo(t) for t in base] + [typo(typo(t)) for t in base] + ["", None, "same", "same"]
    rows = [(i, t, rnd.choice(["x", "y", None])) for i, t in enumerate(texts)]
    got = {(r.a, r.b) for r in names.segment_join(spark.createDataFrame(rows, "id long, t string, block string"), "id", "t", ["block"]).collect()}
    limit = lambda n: 0 if n < 4 else 1 if n < 12 else 2
    first = {}
    for i, t, b in rows:
        if t and b:
            first.setdefault((b, t), i)
    want = {tuple(sorted((i, j))) for (b1, s), i in first.items() for (b2, t), j in first.items() if b1 == b2 and s < t and 0 < canon.edits(s, t, 2) <= limit(min(len(s), len(t)))}
    assert got == want


def test_names(spark):
    rows = [
        ("k1", "The Exampleton Community Theatre, Inc.", "Exampleton", "TX"), ("k2", "Exampelton Cmty Th.", "exampleton", "TX"), ("k3", "Community Theater of Exampleton", "Exampleton", "TX"), ("k4", "ECT", "Exampleton", "TX"),
        ("k5", "Exampleton Community Theatre", "Otherville", "TX"), ("k6", "Exampleton Community Theatre", "Exampleton", "ON"), ("k7", "Bob Sample School of Dance", "Exampleton", "TX"), ("k8", "Robert Sample Dance Sch.", "Exampleton", "TX"), ("k9", "Susan Sample School of Dance", "Exampleton", "TX"),
        (None, "x", "y", "z"), ("k10", None, None, None), ("", "", "", ""),
    ]
    orgs = spark.createDataFrame(rows, "key string, name string, city string, state string").withColumn("street", F.lit(None).cast("string")).withColumn("organization", F.lit("clash"))
    got = {(r.key_a, r.key_b) for r in names.same_organization_pairs(names.linked_organizations(orgs)).collect()}
    assert got == {("k1", "k2"), ("k1", "k3"), ("k1", "k4"), ("k2", "k3"), ("k2", "k4"), ("k3", "k4"), ("k7", "k8")}
    assert names.linked_organizations(orgs.limit(0)).count() == 0


def test_names_near_under_several_given_names(spark):
    """Each given name is met under both spellings of the other words, and each initial meets its own name."""
    given = ["Robert", "Susan", "William"]
    spelled = [(g, f"{g} {n} School of Dance", "Exampleton") for g in given for n in ("Samplewright", "Samplwright")]
    lettered = [(g, f"{w} Tradeshaw School of Dance", "Exampleton") for g in given for w in (g, g[0] + ".")]
    placed = [(g, f"{g} Grandmoor School of Dance", c) for g in given for c in ("Exampleton", "Exampelton")]
    rows = [(f"{g}-{i}", name, city, "TX", "") for i, (g, name, city) in enumerate(spelled + lettered + placed)]
    got = {(r.key_a, r.key_b) for r in names.same_organization_pairs(names.linked_organizations(spark.createDataFrame(rows, "key string, name string, city string, state string, street string"))).collect()}
    assert got == {tuple(sorted((rows[i][0], rows[i + 1][0]))) for i in range(0, len(rows), 2)}


def test_addresses(spark):
    schema = "id string, address string, city string, lat string, lng string, form string"
    left = [
        ("a", "Some Hall<br>12 N. Sample Street, Ste 4<br>Exampleton, TX<br>75001<br>US", "", "30.001", "-100.001", "x"), ("b", "County Road 9 77<br>Exampleton, TX<br>US", "", None, None, "x"), ("c", "Low Rd & High St<br>Exampleton, TX<br>US", "", "", "", "x"),
        ("d", ".<br>Exampleton, TX<br>US", "", "30", "-100", "x"), ("e", None, None, None, None, "x"), (None, "12 Sample St", "Exampleton", None, None, "x"), ("f", "12 Sample Street", "Exampleton", "50.0", "-80.0", "x"),
    ]
    right = [("1", "12 North Smaple St", "Exampleton", "30.002", "-100.002", "y"), ("2", "77 Co. Rd. 9", "Exampleton", "30", "-100", "y"), ("3", "Corner of High and Low Road", "exampleton", None, None, "y"), ("4", "13 Sample St", "Exampleton", "30", "-100", "y"), ("5", "12 S Sample St", "Exampleton", "30", "-100", "y"), ("6", "12 Sample St, Suite 9", "Exampleton", "30", "-100", "y"), ("6", "12 Sample St, Suite 9", "Exampleton", "30", "-100", "y")]
    make = lambda rows: spark.createDataFrame(rows, schema)
    pairs = lambda **o: {(r.id_l, r.id_r) for r in addresses.match_addresses(make(left), make(right), **o).collect()}
    assert pairs() == {("a", "1"), ("a", "6"), ("b", "2"), ("c", "3")}
    assert pairs(unit_veto=True) == {("a", "1"), ("b", "2"), ("c", "3")}
    assert addresses.match_addresses(make([]), make(right)).count() == 0


def test_cascade(spark):
    rows = [
        ("m1", "mti", "Sample Players", "1 Low St", "Exampleton", "TX"), ("c1", "concord", "SAMPLE PLAYERS, INC.", "1 Low Street", "Exampleton", ""), ("t1", "trw", "The Sample Players", "", "Exampleton", "Texas"), ("t2", "trw", "Smaple Players", "", "Exampleton", "TX"),
        ("c2", "concord", "Sample Players", "", "Elsewhere", ""), ("m2", "mti", "Sample Players", "", "Elsewhere", "TX"), ("m3", "mti", "Sample Players", "", "Elsewhere", "ON"), (None, "mti", "Sample Players", "", "Exampleton", "TX"), ("x", None, "Sample Players", "", "Exampleton", "TX"), ("n", "trw", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "key string, source string, organization string, street string, city string, state string").withColumn("entity", F.lit(1))
    members = entity_match.matched_records(df)
    got = {(r.key_a, r.key_b) for r in entity_match.cross_source_pairs(members).collect()}
    assert got == {("c1", "m1"), ("c1", "t1"), ("m1", "t1"), ("c1", "t2"), ("m1", "t2")}
    assert all(0 < r.confidence < 1 for r in members.filter("confidence is not null").collect())
    assert entity_match.matched_records(df.limit(0)).count() == 0


def test_confidence_is_the_precision_of_a_rule(spark):
    rules = (entity_match.Rule("name, place, state", ("name", "place", "state")), entity_match.Rule("name, place", ("name", "place")))
    rows, tokens = [], []
    for i in range(120):
        strict, right = i < 60, i % 10 < (9 if i < 60 else 5)
        rows += [(f"m{i}", "mti", f"Sample{i}x Players", "", f"Town{i}", "TX", [f"m{i}"]), (f"c{i}", "concord", f"Sample{i}x Players", "", f"Town{i}", "TX" if strict else "", [f"c{i}"])]
        tokens += [(f"m{i}", f"host{i}"), (f"m{i}", "other"), (f"c{i}", f"host{i}" if right else f"elsewhere{i}")]
    df = spark.createDataFrame(rows, "key string, source string, organization string, street string, city string, state string, known_as array<string>")
    evidence = spark.createDataFrame(tokens, "known_as string, token string")
    got = {r.rule_name: r.confidence for r in entity_match.matched_records(df, rules, evidence=evidence).filter("confidence is not null").select("rule_name", "confidence").distinct().collect()}
    assert set(got) == {r.name for r in rules} and got["name, place, state"] > got["name, place"]
    assert abs(got["name, place, state"] - 0.9) < 0.03 and abs(got["name, place"] - 0.5) < 0.05


def test_matched_records_are_anti_joined(spark):
    rules = (entity_match.Rule("name, place, state", ("name", "place", "state")), entity_match.Rule("name, place", ("name", "place")))
    rows = [("m1", "mti", "Sample Players", "", "Exampleton", "TX"), ("c1", "concord", "Sample Players", "", "Exampleton", "TX"), ("c2", "concord", "Sample Players", "", "Exampleton", "")]
    df = spark.createDataFrame(rows, "key string, source string, organization string, street string, city string, state string")
    known, links, _ = entity_match.cascade(df, work_dir(spark), rules)
    met = {(r.key, r.rule) for r in links.join(known, "node").select("key", "rule").distinct().collect()}
    assert {m for m in met if m[1] == 0} == {("m1", 0), ("c1", 0)} and ("c2", 1) in met
    assert len({r.entity for r in entity_match.matched_records(df, rules).collect()}) == 1


def test_cascade_keeps_no_combinations(spark):
    """Combinations and what met them are gone from the work folder; a pair's single value is asked of its two sources only."""
    rules = (entity_match.Rule("name, place", ("name", "place"), single="state"), entity_match.Rule("near name, kind, place", ("near_core", "sort", "place"), single="state"))
    rows = [("m1", "mti", "Sampleton Players", "TX"), ("c1", "concord", "Sampleton Players", "TX"), ("t1", "trw", "Sampleton Players", "ON"), ("c2", "concord", "Samplton Players", "TX")]
    df = spark.createDataFrame([(k, s, o, "", "Exampleton", st) for k, s, o, st in rows], "key string, source string, organization string, street string, city string, state string")
    folder = work_dir(spark)
    known, links, _ = entity_match.cascade(df, folder, rules)
    met = {(r.key, r.rule) for r in links.join(known, "node").select("key", "rule").distinct().collect()}
    assert {("m1", 0), ("c1", 0), ("c2", 1)} <= met and "t1" not in {key for key, _ in met}
    left = {p.name.rsplit("-", 1)[0] for p in Path(folder.removeprefix("file://")).iterdir()}
    assert left == {"records", "nodes", "open", "links", "measures"}


def test_near_forms_of_matched_records_are_not_gone_into(spark, monkeypatch):
    """Only combinations that two sources hold and an open record too are written, and they are those of all forms."""
    rules = (entity_match.Rule("name, place", ("name", "place")), entity_match.Rule("near name, kind, place", ("near_core", "sort", "place")))
    rnd, schema = random.Random(5), "key string, source string, organization string, street string, city string, state string"
    monkeypatch.setattr(entity_match, "drop_written", lambda *_: None)
    rows = [(f"{s}{i}", s, f"{n} Players", "", "Exampleton", "TX") for i, n in enumerate(("Sampleton", "Grandmoor", "Tradeshaw")) for s in ("mti", "concord")]
    folder = work_dir(spark)
    entity_match.cascade(spark.createDataFrame(rows, schema), folder, rules)
    assert spark.read.parquet(f"{folder}/hits-*").count() == len(rows)
    spelt = ["".join(rnd.choice("xz") for _ in range(rnd.randrange(5, 9))) for _ in range(30)]
    rows = [(f"k{i}", rnd.choice(["mti", "concord", "trw"]), f"{n} Players", "", "Exampleton", "TX") for i, n in enumerate(spelt)]
    known, links, _ = entity_match.cascade(spark.createDataFrame(rows, schema), work_dir(spark), rules[1:])
    nodes = {(r.node, r.source, r.core) for r in known.collect()}
    want = set()
    for form in {f for _, _, core in nodes for f in canon.deletions(core)}:
        of = {s: [n for n, x, core in nodes if x == s and form in canon.deletions(core)] for s in entity_match.SOURCES}
        for x, y in (("concord", "mti"), ("concord", "trw"), ("mti", "trw")):
            if of[x] and of[y]:
                a, b = min(of[x]), min(of[y])
                want |= {(n, rep, b if n in of[x] else a) for n in of[x] + of[y] for rep in (a, b)}
    assert want and {(r.node, r.rep, r.other) for r in links.collect()} == want


def test_history(spark):
    day = lambda n: datetime(2026, 7, n, 5)
    d = lambda m, n: date(2026, m, n)
    rows = [
        (1, "mti:1", "mti", "Grand Show", "Sample Players", "Hall", "1 Low St", "Exampleton", d(9, 1), d(9, 5), day(1)), (2, "MTI:1 ", "mti", "Grand Show", "Sample Players", "Hall", "", "Exampleton", d(11, 1), d(11, 5), day(1)),
        (3, "mti:2", "mti", "The Grand Show", "Sample Players Inc", "Hall", "1 Low Street", "Exampleton", d(9, 2), None, day(2)), (4, "mti:3", "mti", "Grand Show JR.", "Sample Players", "Hall", "1 Low St", "Exampleton", d(9, 1), d(9, 5), day(2)),
        (5, "mti:4", "mti", "Grand Show", "Sample Players", "Hall", "1 Low St", "Exampleton", d(9, 20), d(9, 25), day(3)), (6, "mti:2", "mti", "Grand Show", "Sample Players", "Hall", "", "Exampleton", None, None, day(3)), (7, None, None, None, None, None, None, None, None, None, None),
        (8, "trw:1", "trw", "Grand Show", "Sample Players", "", "", "Exampleton", d(9, 1), d(9, 5), day(3)), (9, "mti:9", "mti", "Grand Show", "Sample Players", "Other House", "", "Exampleton", d(9, 1), d(9, 5), day(4)),
    ]
    filler = [(100 + i, f"mti:{100 + i // 2}", "mti", f"Show {i // 2}", f"Troupe{'abcdefgh'[i // 2 % 8]}{i // 2} Theatre", f"House {i // 2}", f"{i // 2} High St", f"Town{i // 2}", d(8, 1 + i // 4), d(8, 2 + i // 4), day(1)) for i in range(80)]
    schema = "seq long, key string, source string, show_title string, organization string, venue string, street string, city string, start_date date, end_date date, loaded_at timestamp"
    df = spark.createDataFrame(rows + filler, schema)
    got = {(r.seq_a, r.seq_b) for r in history.linked_batches(df).collect()}
    assert {p for p in got if p[1] < 100} == {(1, 2), (1, 3), (1, 6)}
    assert {p for p in got if p[1] >= 100} == {(100 + i - 1, 100 + i) for i in range(1, 80, 2)}
    assert history.linked_batches(df.limit(0)).count() == 0


def test_history_misspelt_title(spark):
    d, day = date(2026, 9, 1), datetime(2026, 7, 1, 5)
    telling = lambda n, title, where=0: (n, f"mti:{n}", "mti", title, f"Sample{where} Players", f"Hall{where}", f"{where} Low St", f"Exampleton{where}", d, d, day)
    titles = ["The Ferryman's Locket", "The Ferrymman's Locket", "The Ferymann's Locket", "The Ferrymman's Locket (School Edition)", "The Ferryman's Pocket Watch"]
    rows = [telling(i, t) for i, t in enumerate(titles)] + [telling(100 + i, titles[0], i + 1) for i in range(40)] + [telling(200, titles[1], 99)]
    schema = "seq long, key string, source string, show_title string, organization string, venue string, street string, city string, start_date date, end_date date, loaded_at timestamp"
    got = {(r.seq_a, r.seq_b) for r in history.linked_batches(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(0, 1), (0, 2)}


def test_addresses_slips_on_both_sides(spark):
    schema = "id string, address string, city string, lat string, lng string"
    left = [("a", "4189 Bareckhlo Str", "Exampleton", None, None), ("b", "2898 W Magnoia Ln", "Exampleton", None, None), ("c", "12 Old Samlpe Rd", "Exampleton", None, None), ("d", "7 Sample Harbr St", "Exampleton", None, None)]
    right = [("1", "4189 BARSCKHOL ST.", "Exampleton", None, None), ("2", "2898 W Maggnolia Ln", "Exampleton", None, None), ("3", "12 Old Smaple Rd", "Exampleton", None, None), ("4", "7 Harbor Sample St", "Exampleton", None, None), ("5", "2898 W Mangrove Ln", "Exampleton", None, None)]
    got = {(r.id_l, r.id_r) for r in addresses.match_addresses(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()}
    assert got == {("a", "1"), ("b", "2"), ("c", "3"), ("d", "4")}


def test_addresses_misspelt_place(spark):
    schema = "id string, address string, city string, lat string, lng string"
    left = [("a", "471 Branabkil Avenue", "Darurrridge", None, None), ("b", "20 Larandhol Street", "Goraywcik", "30", "-100"), ("c", "5 High Street", "Darurridge", "30", "-100"), ("d", "9 Low Street", "Elsewhere", None, None)]
    right = [("1", "471 Branabkil Avenue", "Darurridge", "30", "-100"), ("2", "20 Larandhol St", "Goraywick", None, None), ("3", "5 High St", "Darurridgge", "40", "-90"), ("4", "9 Low Street", "Darurridge", None, None)]
    got = {(r.id_l, r.id_r) for r in addresses.match_addresses(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()}
    assert got == {("a", "1"), ("b", "2")}


def test_history_goes_on_in_a_new_index(spark):
    day, d = datetime(2026, 7, 1, 5), lambda n: date(2026, 9, n)
    schema = "seq long, key string, source string, show_title string, organization string, venue string, street string, city string, start_date date, end_date date, loaded_at timestamp"
    telling = lambda n, key, start: (n, key, "mti", "Grand Show", "Sample Players", "Hall", "1 Low St", "Exampleton", d(start), d(start + 4), day)
    weights = {f: {"same": 3.0, "near": 2.0, "differ": -4.0, "absent": 0.0} for f in history.FIELDS}
    batch = lambda *rows: history.prepared(history.compared(spark.createDataFrame(list(rows), schema)).withColumn("likelier", F.array().cast("array<string>")))
    folder = work_dir(spark)
    first = history.HistoryIndex(spark, folder, weights)
    first.accept(batch(telling(10, "mti:1", 1), telling(20, "mti:2", 5)))
    first.accept(batch(telling(30, "mti:1", 20)).limit(0))
    assert first.duplicates().count() == 0
    second = history.HistoryIndex(spark, folder, weights)
    # 30 repeats a key and, by its run, lies near both; 5 comes late with a smaller number: all become its cluster
    second.accept(batch(telling(30, "mti:1", 3)))
    assert {(r.seq_a, r.seq_b) for r in second.duplicates().collect()} == {(10, 30), (10, 20)}
    second.accept(batch(telling(5, "mti:2", 5)))
    assert {(r.seq_a, r.seq_b) for r in second.duplicates().collect()} == {(5, 10), (5, 20), (5, 30)}
    third = history.HistoryIndex(spark, folder, weights)
    third.accept(batch(telling(40, "mti:1", 1)))
    assert {(r.seq_a, r.seq_b) for r in third.duplicates().collect()} == {(5, 10), (5, 20), (5, 30), (5, 40)}


def test_deletion_join_finds_what_the_segment_join_finds(spark):
    draw = random.Random(7)
    slip = lambda t: (lambda i: draw.choice((t[:i] + t[i + 1 :], t[:i] + "x" + t[i:], t[:i] + t[i + 1 : i + 2] + t[i : i + 1] + t[i + 2 :])))(draw.randrange(len(t)))
    first = ["".join(draw.choice("abcd") for _ in range(draw.randrange(2, 12))) + draw.choice(("", "ford", "wick", "field")) for _ in range(60)]
    texts = sorted({*first, *map(slip, first), *(slip(slip(t)) for t in first)} - {""})
    rows = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate([*texts, *texts[::2]])], "i long, t string, b int")
    found = lambda join: {tuple(r) for r in join(rows, "i", "t", ["b"]).collect()}
    assert len(found(names.segment_join)) > 20 and found(names.deletion_join) == found(names.segment_join)


def test_addresses_by_pairs_or_by_forms(spark):
    schema = "id string, address string, city string, lat string, lng string"
    make = lambda rows, folder: addresses.address_records(spark.createDataFrame([(i, a, "Exampleton", None, None) for i, a in rows], schema), folder, id="id", address="address", city="city", lat="lat", lng="lng")
    left = [("a", "12 Barsckhol St"), ("b", "12 Old Samlpe Rd"), ("c", "12 7th Ave"), ("d", "12 Of The Old Oak Inn Yard"), ("e", "Low Rd & High St"), ("f", "12 Mangrove Ln"), ("g", "13 Elm St")]
    right = [("1", "12 Bareckhlo Str"), ("2", "12 Old Smaple Rd"), ("3", "12 Seventh Ave"), ("4", "12 Of The Old Oak Inn"), ("5", "High St & Low Rd"), ("6", "12 Magnolia Ln"), ("7", "14 Elm St")]

    def got(pair_cost: float) -> set[tuple[str, str]]:
        folder = work_dir(spark)
        return {(r.id_l, r.id_r) for r in addresses.same_building(make(left, folder), make(right, folder), folder, pair_cost=pair_cost).collect()}

    # short words that make up most of a street are found by its forms too
    assert got(0) == got(1e9) == {("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("e", "5")}


def test_addresses_are_parsed_once(spark, monkeypatch):
    plans, keep = {}, addresses.written

    def seen(df, folder, name, *more, **options):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return keep(df, folder, name, *more, **options)

    monkeypatch.setattr(addresses, "written", seen)
    rows = spark.createDataFrame([("a", "12 Sample St", "Exampleton", None, None), ("b", "Hall", "Exampleton", None, None)], "id string, address string, city string, lat string, lng string")
    assert {(r.id_l, r.id_r) for r in addresses.match_addresses(rows, rows).collect()} == {("a", "a")}
    assert plans["addresses"].count("ArrowEvalPython") == 1


def test_places_with_common_parts_do_not_meet(spark, monkeypatch):
    met, near = [], names._near_texts
    monkeypatch.setattr(names, "_near_texts", lambda texts, pairs, most: (met.append(pairs.count()), near(texts, pairs, most))[1])
    towns = [f"{t}wick" for t in ("alber", "corin", "dunam", "edgem", "farol", "gilda", "hosto", "ivern")] + ["alebrwick"]
    rows = spark.createDataFrame([(t, "5 High Street", t, None, None) for t in towns], "id string, address string, city string, lat string, lng string")
    assert {(r.id_l, r.id_r) for r in addresses.match_addresses(rows, rows).collect()} == {*((t, t) for t in towns), ("alberwick", "alebrwick"), ("alebrwick", "alberwick")}
    assert met == [1]
