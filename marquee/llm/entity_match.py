"""Matching organizations across sources without a shared key: a cascade of exact rules.

Each rule joins two sources on its own combination of attributes, from strict to weak. Records that
a rule has matched for a pair of sources are anti-joined before the next rule; what stays of them is
one representative of each combination and source, as the target of records still open. The
confidence of a link is the precision of its rule: the share of its matches that independent
evidence (tokens known of both records, such as the hosts of their sites) calls right, smoothed
towards the precision of all rules together.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import state_code, strip
from ..operators.components import connected_components
from ..session import apart, drop_written, small, work_dir, written
from . import names


@dataclass(frozen=True)
class Rule:
    """A combination of attributes that must be present and equal on both sides."""

    name: str
    on: tuple[str, ...]
    #: Attribute of which all records that share the combination may have one value only.
    single: str = ""


#: From strict to weak. ``name`` is core, kind and given name; ``bare`` leaves the given name out;
#: ``sort`` is the kind, or says that a long name has none; ``near_*`` holds the forms of a text that
#: lack one letter, so one edit still joins exactly.
RULES = (
    Rule("name, place, state, building", ("name", "place", "state", "site")),
    Rule("name, place, state", ("name", "place", "state")),
    Rule("name, place", ("name", "place"), single="state"),
    Rule("name, state, building", ("name", "state", "site")),
    Rule("near name, kind, place, state", ("near_core", "sort", "place", "state")),
    Rule("initial, bare name, place, state", ("bare", "first", "place", "state")),
    Rule("name, near place, state", ("name", "near_place", "state")),
    Rule("initials, place, building", ("letters", "place", "site")),
    Rule("near name, kind, place", ("near_core", "sort", "place"), single="state"),
    Rule("name, near place", ("name", "near_place"), single="state"),
    Rule("initials, place, state", ("letters", "place", "state"), single="bare_full"),
)
#: The catalogues whose records are matched with one another.
SOURCES = ("concord", "mti", "trw")
#: Labelled matches that every rule starts with, as right as those of all rules together are.
EXTRA = 5.0
#: Share of right matches where nothing is labelled.
UNLABELLED = 0.8
#: Letters from which on a name that states no kind may be met by near forms.
KINDLESS = 8
#: Letters from which on a text has near forms.
NEAR_FROM = 5
#: Bits that sources, and pairs of them, are told by where combinations are looked through; more of them share bits.
BITS = 62


def records(rows: DataFrame) -> DataFrame:
    """``key, source, node`` and the attributes the rules use; one row per key and spelling.

    ``rows`` has ``key, source, organization, street, city, state`` and may have ``known_as``, an array of
    names under which evidence is kept. Rows without a key, source or organization take no part. ``node`` is
    the same for equal attributes of one source.
    """
    text = lambda c: strip(F.col(c)).alias(c)
    known_as = F.col("known_as") if "known_as" in rows.columns else F.lit(None).cast("array<string>").alias("known_as")
    raw = rows.select("key", "source", known_as, text("organization"), text("street"), text("city"), state_code(F.col("state")).alias("state")).filter(
        F.col("key").isNotNull() & F.col("source").isNotNull() & (F.col("organization") != ""))
    # an organization's rows come together, so a worker takes each of its spellings apart once
    raw = raw.repartition("organization", "city").distinct()
    some = lambda c: F.when(c != "", c)
    p = F.col("p")
    parts = raw.withColumn("p", names.name_parts("organization")).withColumn("place", names.locality("city")).withColumn("site", names.building("street"))
    full = parts.select(
        "key", "source", "known_as", some(F.col("place")).alias("place"), some(F.col("state")).alias("state"), "site",
        F.when((p["acronym"] == "") & (F.concat(p["core"], p["kind"]) != ""), F.concat_ws("|", p["core"], p["kind"], p["given"])).alias("name"),
        F.when((p["acronym"] == "") & (p["core"] != ""), p["core"]).alias("core"), F.when(p["kind"] != "", p["kind"]).when(F.length(p["core"]) >= KINDLESS, "-").alias("sort"),
        F.when((p["acronym"] == "") & (p["core"] != ""), F.concat_ws("|", p["core"], p["kind"])).alias("bare"),
        some(F.left(p["given"], F.lit(1))).alias("first"),
        F.when(p["acronym"] != "", p["acronym"]).when(F.length(p["initials"]) >= 2, p["initials"]).alias("letters"),
        F.when(p["acronym"] == "", F.concat_ws("|", p["core"], p["kind"])).alias("bare_full"),
    )
    attributes = [c for c in full.columns if c not in ("key", "source", "known_as")]
    return full.withColumn("node", F.xxhash64("source", *(F.coalesce(F.col(c), F.lit("\x00")) for c in attributes)))


def _form(text: Column, at: Column) -> Column:
    """``text`` without its letter number ``at``; all of it for 0."""
    return F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.length(text)))


def _pairs(sources: tuple[str, ...]) -> list[tuple[int, int, int]]:
    """Number, lower and higher code of each pair of sources; codes begin with 1."""
    return [(i * (len(sources) + 1) + j, i, j) for j in range(1, len(sources) + 1) for i in range(1, j)]


def _held(nodes: DataFrame, rule: Rule, number: int, sources: tuple[str, ...], done: DataFrame | None, folder: str) -> DataFrame:
    """``h, g, code, node`` and ``single`` where the rule asks for it: two hashes of each combination that a node has.

    Near forms are looked through by spelling before they are gone into by node: the nodes that share the plain attributes
    and the spelling have the same forms. Of the combinations of a near rule only those are given, with all their nodes, that two sources
    hold and a node still open for the two (``done`` has the others), or that may be such; so what is written is little. A combination
    has at most as many spellings as one letter can be put into its form.
    """
    near = next((c for c in rule.on if c.startswith("near_")), None)
    plain = [c for c in rule.on if c != near]
    whole = reduce(lambda x, y: x & y, (F.col(c).isNotNull() for c in plain))
    single = [F.when(F.col(rule.single).isNotNull(), F.xxhash64(rule.single)).alias("single")] if rule.single else []
    own = ["code", "node", *(["single"] if single else [])]
    h, g = F.xxhash64(F.lit(number), *plain), F.xxhash64(*plain, F.lit(number))
    if not near:
        return nodes.filter(whole).select(h.alias("h"), g.alias("g"), "code", "node", *single)
    text = F.col(near.removeprefix("near_"))
    spelled = nodes.filter(whole & (F.length(text) >= NEAR_FROM)).select("code", "node", *single, text.alias("text"), h.alias("p"), g.alias("q")).withColumn("spelling", F.xxhash64("p", "q", "text"))
    bit = lambda n: 1 << n % BITS
    of = lambda c, bits: reduce(lambda x, y: x.when(c == y[0], F.lit(y[1]).cast("long")), bits.items(), F.when(F.lit(False), F.lit(0).cast("long")))
    pairs, codes = _pairs(sources), range(1, len(sources) + 1)
    opened = of(F.col("code"), {c: reduce(lambda x, y: x | y, (bit(n) for n, (_, i, j) in enumerate(pairs) if c in (i, j)), 0) for c in codes})
    seen = spelled.select("spelling", "p", "text", "node", of(F.col("code"), {c: bit(c) for c in codes}).alias("codes"), opened.alias("open"))
    if done is not None and len(pairs) <= BITS:  # else a bit may stand for a pair that is still open
        closed = done.groupBy("node").agg(F.bit_or(of(F.col("pair"), {k: bit(n) for n, (k, _, _) in enumerate(pairs)})).alias("closed"))
        seen = seen.join(apart(closed), "node", "left").withColumn("open", F.col("open").bitwiseAND(F.bitwise_not(F.coalesce("closed", F.lit(0).cast("long")))))
    groups = seen.groupBy("spelling", "p", "text").agg(F.bit_or("codes").alias("codes"), F.bit_or("open").alias("open"))
    form = _form(F.col("text"), F.col("at"))
    forms = groups.select("*", F.explode(F.sequence(F.lit(0), F.length("text"))).alias("at")).select("spelling", "at", "codes", "open", F.xxhash64("p", form).alias("h"))
    by = Window.partitionBy("h")
    forms = forms.withColumns({"codes": F.bit_or("codes").over(by), "open": F.bit_or("open").over(by)})
    has = lambda c, n: F.col(c).bitwiseAND(F.lit(n).cast("long")) == F.lit(n).cast("long")
    sought = reduce(lambda x, y: x | y, (has("codes", bit(i) | bit(j)) & has("open", bit(n)) for n, (_, i, j) in enumerate(pairs)), F.lit(False))
    found = forms.filter(sought).select("spelling", "at").join(apart(spelled), "spelling")
    return written(found.select(F.xxhash64("p", form).alias("h"), F.xxhash64(form, "q").alias("g"), *own), folder, "held")


def _targets(held: DataFrame, rule: Rule, sources: tuple[str, ...]) -> DataFrame:
    """``h, g, pair, lower, a, b``: the combinations that both sources of a pair hold, with the smallest node of either.

    A combination is aggregated once for all sources, which combines map-side; where the rule asks for a single value,
    a pair with several in its two sources is left out.
    """
    of = lambda f, c, i: f(F.when(F.col("code") == i, F.col(c))).alias(f"{f.__name__}_{c}_{i}")
    codes = range(1, len(sources) + 1)
    sums = held.groupBy("h", "g").agg(*(of(F.min, "node", i) for i in codes), *(of(f, "single", i) for i in codes for f in (F.min, F.max) if rule.single))

    def told(pair: int, i: int, j: int) -> Column:
        a, b = F.col(f"min_node_{i}"), F.col(f"min_node_{j}")
        both = a.isNotNull() & b.isNotNull()
        if rule.single:
            both = both & F.coalesce(F.least(f"min_single_{i}", f"min_single_{j}") == F.greatest(f"max_single_{i}", f"max_single_{j}"), F.lit(True))
        return F.when(both, F.struct(F.lit(pair).alias("pair"), F.lit(i).alias("lower"), a.alias("a"), b.alias("b")))

    return sums.select("h", "g", F.inline(F.array_compact(F.array(*(told(*p) for p in _pairs(sources))))))


def labelled(links: DataFrame, evidence: DataFrame) -> DataFrame:
    """``rule, labelled, right``: matches ``rule, node, other`` of which both records have tokens in ``evidence``
    (``node, token``), and those of them that share one. Each match counts once."""
    match = links.select("rule", "node", "other").distinct()
    side = lambda c, mine: match.join(apart(evidence.withColumnRenamed("node", c)), c).select(*match.columns, "token", F.lit(mine).alias("a"), F.lit(not mine).alias("b"))
    tokens = side("node", True).unionByName(side("other", False)).groupBy(*match.columns, "token").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    each = tokens.groupBy(*match.columns).agg(F.max("a").alias("a"), F.max("b").alias("b"), F.max(F.col("a") & F.col("b")).alias("right"))
    return each.filter("a and b").groupBy("rule").agg(F.count(F.lit(1)).alias("labelled"), F.count_if("right").alias("right"))


def cascade(rows: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, sources: tuple[str, ...] = SOURCES, evidence: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, links and rule precisions.

    Links are ``node, pair, rep, other, rule``: under rule number ``rule`` the node, open till then in
    the pair of sources or standing for what was matched, met a combination that both sources hold, which ``rep``, its smallest node of
    either source, stands for; ``other`` is the one of the other source. A rule hashes its combinations once for
    each node, not for each of its pairs, and aggregates them, which combines map-side; so a combination of a million records gives
    a million links, not their square. What it joins with these are the records still open
    and those that stand for a combination matched before; what it matches is anti-joined from these,
    but for the one record of each source that stands for the combination from now on. So another
    spelling still finds the ones matched before it, and a combination without an open record is not taken up.
    Rules are worked off one by one, so that only one rule's combinations are on disk at a time.
    """
    spark = rows.sparkSession
    known = written(records(rows), folder, "records")
    code = F.array_position(F.array(*map(F.lit, sources)), F.col("source")).cast("int")
    # a node is the hash of its source and attributes
    nodes = written(known.withColumn("code", code).filter(F.col("code") > 0).drop("key", "known_as", "source").distinct(), folder, "nodes")
    links, done = [], None
    for number, rule in enumerate(rules):
        held = _held(nodes, rule, number, sources, done, folder)
        hits = held.join(apart(_targets(held, rule, sources)), ["h", "g"]).filter((F.col("code") == F.col("lower")) | (F.col("code") == F.col("pair") % (len(sources) + 1))).select(
            "h", "g", "pair", "node", "a", "b", (F.col("code") == F.col("lower")).alias("low"))
        # ``done`` has the pairs in which a node is matched, and whether it is gone from them or stands for a combination
        hits = hits.withColumn("open", F.lit(True)) if done is None else hits.join(apart(done), ["node", "pair"], "left").filter("gone IS NULL OR NOT gone").select(*hits.columns, F.isnull("gone").alias("open"))
        hits = written(hits, folder, "hits")
        sought = hits.filter("open").select("h", "g", "pair").distinct()
        met = hits.join(apart(sought), ["h", "g", "pair"], "left_semi")
        matched = written(met.select("node", "pair", F.explode(F.array("a", "b")).alias("rep"), F.when(F.col("low"), F.col("b")).otherwise(F.col("a")).alias("other")).distinct().withColumn(
            "rule", F.lit(number)), folder, "links")
        links.append(matched)
        for over in (hits, held):
            if hasattr(over, "path"):
                drop_written(spark, over.path)
        if number + 1 < len(rules):
            # what is matched goes, but for the nodes that stand for a combination: they stay as targets
            before, done = done, matched.groupBy("node", "pair").agg((~F.max(F.col("node") == F.col("rep"))).alias("gone"))
            done = written(done if before is None else before.unionByName(done).groupBy("node", "pair").agg(F.max("gone").alias("gone")), folder, "open")
            if before is not None:
                drop_written(spark, before.path)
        # shuffle files of a rule done go only when the driver collects its garbage
        spark.sparkContext._jvm.System.gc()
    every = reduce(DataFrame.unionByName, links)
    titles = rows.sparkSession.createDataFrame([(i, r.name) for i, r in enumerate(rules)], "rule int, rule_name string")
    if evidence is None:
        counts = every.select("rule", F.lit(0).cast("long").alias("labelled"), F.lit(0).cast("long").alias("right")).limit(0)
    else:
        counts = labelled(every, known.select("node", F.explode("known_as").alias("known_as")).distinct().join(apart(evidence), "known_as").select("node", "token").distinct())
    measures = titles.join(apart(counts), "rule", "left").select("rule", "rule_name", F.coalesce("labelled", F.lit(0)).alias("labelled"), F.coalesce("right", F.lit(0)).alias("right"))
    measures = written(measures, folder, "measures", measured=True)
    total = measures.agg((F.sum("right") + EXTRA * UNLABELLED).alias("r"), (F.sum("labelled") + EXTRA).alias("n")).first()
    precisions = measures.withColumn("confidence", (F.col("right") + EXTRA * total["r"] / total["n"]) / (F.col("labelled") + EXTRA))
    precisions.measured = measures.measured
    return known, every, precisions


def matched_records(rows: DataFrame, rules: tuple[Rule, ...] = RULES, sources: tuple[str, ...] = SOURCES, evidence: DataFrame | None = None) -> DataFrame:
    """``key, source, entity, rule_name, confidence``: each record's organization over all sources.

    ``confidence`` is that of the strictest rule that linked the record, measured on ``evidence``
    (``known_as, token``) where it is given; an unlinked record is its own entity with null rule and confidence.
    """
    folder = work_dir(rows.sparkSession)
    known, links, precisions = cascade(rows, folder, rules, sources, evidence)
    groups = connected_components(links.select(F.col("node").alias("a"), F.col("rep").alias("b")), folder)
    best = links.groupBy("node").agg(F.min("rule").alias("rule")).join(small(precisions), "rule").select("node", "rule", "confidence")
    # joined by node first, of which there are fewer than records
    told = best.join(small(groups, groups), "node", "left").select("node", "component", "rule", "confidence")
    members = known.select("key", "source", "node").join(apart(told), "node", "left").groupBy("key", "source", F.coalesce("component", "node").alias("entity")).agg(
        F.max_by("rule", "confidence").alias("rule"), F.max("confidence").alias("confidence"))
    return members.join(small(precisions.select("rule", "rule_name"), precisions), "rule", "left").select("key", "source", "entity", "rule_name", "confidence")


def cross_source_pairs(members: DataFrame, *, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """``key_a, key_b``: keys of different sources with one entity, smaller key first.

    Joined on entity and the partner's source, so an entity that fills a third of one source
    and is missing from the others costs nothing.
    """
    m = written(members.select("key", "source", "entity").distinct(), work_dir(members.sparkSession), "members")
    a = m.withColumn("partner", F.explode(F.filter(F.array(*map(F.lit, sources)), lambda x: x > F.col("source")))).select(F.col("key").alias("x"), "entity", F.col("partner").alias("source"))
    pairs = a.join(apart(m.select(F.col("key").alias("y"), "entity", "source")), ["entity", "source"]).filter(F.col("x") != F.col("y"))
    return pairs.select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()
