"""One surviving value per field of each duplicate group, by Bayesian fusion with copy detection.

A claim is a value that a source states for a field of a key. Sources have accuracies and pairs
of sources a probability that one copies the other, judged mainly by the false values they
share. A vote counts by its source's accuracy and is discounted by the votes it may have been
copied from; the value with the largest posterior survives. Accuracies, dependences and
posteriors are estimated in turns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.web import email_rejection, site_url
from ..session import apart, work_dir, written

#: Most sources a run may have: the driver holds a number for each pair of them.
MOST_SOURCES = 500


@dataclass
class SourceModel:
    """Accuracy of each source and copy probability of each pair (names in order)."""

    accuracy: dict[str, float] = field(default_factory=dict)
    copied: dict[tuple[str, str], float] = field(default_factory=dict)


@dataclass(frozen=True)
class FusionSettings:
    false_values: float = 10.0  # wrong values a field can take
    copy_rate: float = 0.8  # share of a copier's values that are copied
    copy_prior: float = 0.1
    rounds: int = 3
    start_accuracy: float = 0.8


def _lookup(table: dict[str, float], key: Column, default: float) -> Column:
    if not table:
        return F.lit(default)
    pairs = F.create_map(*(F.lit(x) for item in sorted(table.items()) for x in item))
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def vote_score(sources: Column, model: SourceModel, settings: FusionSettings) -> Column:
    """Log-odds of a value from the sources that state it, most accurate first, copies discounted."""
    limit = lambda a: min(max(a, 0.02), 0.98)
    weight = {s: math.log(settings.false_values * limit(a) / (1 - limit(a))) for s, a in model.accuracy.items()}
    plain = math.log(settings.false_values * settings.start_accuracy / (1 - settings.start_accuracy))
    keep = {f"{a}~{b}": math.log(max(1e-6, 1 - settings.copy_rate * p)) for (a, b), p in model.copied.items()}
    rank = lambda s: _lookup(weight, s, plain)
    ordered = F.array_sort(F.transform(sources, lambda s: F.struct((-rank(s)).alias("w"), s.alias("s"))))
    pair = lambda x, y: F.concat_ws("~", F.least(x, y), F.greatest(x, y))

    def counted(x: Column, i: Column) -> Column:
        kept = F.aggregate(F.slice(ordered, F.lit(1), i), F.lit(0.0), lambda acc, y: acc + _lookup(keep, pair(x["s"], y["s"]), 0.0))
        return -x["w"] * F.exp(kept)

    return F.aggregate(F.transform(ordered, counted), F.lit(0.0), lambda acc, x: acc + x)


def _posteriors(values: DataFrame, model: SourceModel, settings: FusionSettings) -> DataFrame:
    """``values`` with ``score`` and ``p``, its share of the item's posterior; no array of an item's values is built."""
    scored = values.withColumn("score", F.col("log_prior") + vote_score(F.col("sources"), model, settings))
    top = scored.groupBy("key", "field").agg(F.max("score").alias("top"))
    scored = scored.join(apart(top), ["key", "field"]).withColumn("e", F.exp(F.greatest(F.col("score") - F.col("top"), F.lit(-700.0))))
    total = scored.groupBy("key", "field").agg(F.sum("e").alias("total"))
    return scored.join(apart(total), ["key", "field"]).withColumn("p", F.col("e") / F.col("total")).drop("e", "total", "top")


def estimated_sources(values: DataFrame, settings: FusionSettings = FusionSettings()) -> SourceModel:
    """Accuracies and dependences after ``settings.rounds`` turns over all values.

    ``values`` has ``key, field, value, sources, log_prior``. Only sums by source and by pair of
    sources reach the driver; more than ``MOST_SOURCES`` sources are refused.
    """
    model = SourceModel()
    n = settings.false_values
    for _ in range(settings.rounds):
        p = _posteriors(values, model, settings)
        one = p.select(F.explode("sources").alias("a"), F.lit(None).cast("string").alias("b"), F.col("p").alias("t"), (1 - F.col("p")).alias("f"))
        both = p.withColumn("a", F.explode("sources")).withColumn("b", F.explode("sources")).filter(F.col("a") < F.col("b")).select("a", "b", F.col("p").alias("t"), (1 - F.col("p")).alias("f"))
        sums = one.unionByName(both).groupBy("a", "b").agg(F.sum("t").alias("t"), F.sum("f").alias("f"), F.count(F.lit(1)).alias("c"))
        by_item = values.select("key", "field", F.explode("sources").alias("a")).distinct()
        shared = by_item.join(apart(by_item.withColumnRenamed("a", "b")), ["key", "field"]).filter(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("items"))
        rows = sums.join(shared, ["a", "b"], "left").limit(MOST_SOURCES * MOST_SOURCES + 1).collect()
        if len([r for r in rows if r["b"] is None]) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        accuracy = {r["a"]: (r["t"] + 2 * settings.start_accuracy) / (r["c"] + 2) for r in rows if r["b"] is None}
        copied = {}
        for r in rows:
            if r["b"] is None:
                continue
            a1, a2 = (min(max(accuracy[r[k]], 0.02), 0.98) for k in ("a", "b"))
            alone = (a1 * a2, (1 - a1) * (1 - a2) / n)
            alone = (*alone, max(1e-9, 1 - sum(alone)))
            mean, c = (a1 + a2) / 2, settings.copy_rate
            linked = (mean * c + alone[0] * (1 - c), (1 - mean) * c + alone[1] * (1 - c), alone[2] * (1 - c))
            seen = (r["t"], r["f"], max(0.0, (r["items"] or 0) - r["c"]))
            odds = sum(k * math.log(x / y) for k, x, y in zip(seen, linked, alone)) + math.log(settings.copy_prior / (1 - settings.copy_prior))
            copied[r["a"], r["b"]] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        model = SourceModel(accuracy, copied)
    return model


def fused(claims: DataFrame, settings: FusionSettings = FusionSettings()) -> DataFrame:
    """``key, field, kept, posterior, source, values`` from claims ``key, field, value, source, log_prior``.

    A claim whose ``log_prior`` is null cannot be true: it counts among the field's different
    values but is never kept. Null keys and blank or null values are no claims; a null source is
    one of its own name. Equal posteriors go to the greater value as a string. Fields with a
    single value keep it without estimating anything. ``source`` is the most accurate of those that state the kept value.
    """
    folder = work_dir(claims.sparkSession)
    stated = claims.filter(F.col("key").isNotNull() & (strip(F.col("value")) != ""))
    values = stated.groupBy("key", "field", "value").agg(
        F.array_sort(F.collect_set(F.coalesce("source", F.lit("")))).alias("sources"), F.max("log_prior").alias("log_prior"))
    values = written(values, folder, "values")
    count = values.groupBy("key", "field").agg(F.count(F.lit(1)).alias("values"))
    possible = values.filter(F.col("log_prior").isNotNull())
    disputed = written(possible.join(apart(count.filter(F.col("values") > 1).select("key", "field")), ["key", "field"], "left_semi"), folder, "disputed")
    model = estimated_sources(disputed, settings)
    best = _posteriors(disputed, model, settings).groupBy("key", "field").agg(F.max_by(F.struct("value", "p", "sources"), F.struct("score", "value")).alias("k"))
    top = lambda sources: F.array_min(F.transform(sources, lambda s: F.struct((-_lookup(model.accuracy, s, settings.start_accuracy)).alias("a"), s.alias("s"))))["s"]
    kept = best.select("key", "field", F.col("k.value").alias("kept"), F.col("k.p").alias("posterior"), top(F.col("k.sources")).alias("source"))
    sole = possible.join(apart(count.filter(F.col("values") == 1)), ["key", "field"]).select("key", "field", F.col("value").alias("kept"), F.lit(1.0).alias("posterior"), top(F.col("sources")).alias("source"))
    return kept.unionByName(sole).join(apart(count), ["key", "field"])


def surviving_records(kept: DataFrame) -> DataFrame:
    """``key, name, website, website_source, email``: one record per key from the rows of :func:`fused`.

    ``website_source`` is the source of the kept website. A field without a value to keep is blank; a key
    without any has no record.
    """
    field = lambda name, c="kept": F.coalesce(F.max(F.when(F.col("field") == name, F.col(c))), F.lit("")).alias(name if c == "kept" else "website_source")
    return kept.groupBy("key").agg(field("name"), field("website"), field("website", "source"), field("email"))


def registry_claims(orgs: DataFrame, *, by_rule: bool = True) -> DataFrame:
    """Claims of registry rows for ``name``, ``website`` and ``email``.

    Without ``by_rule`` all usable values are equally likely beforehand, and only votes, accuracies and
    copying decide.

    Prior odds carry what is known beside the votes. A site or address that the checks reject
    cannot be true; among the others each day later it was checked outweighs any votes (blank
    days are the oldest). A name without both cases cannot be the one to show; among the others
    each letter more outweighs any votes. So votes decide between equals.
    """
    step = 1e4 if by_rule else 0.0  # more than all votes for a value can add up to
    day = F.coalesce(F.datediff(F.expr("try_to_date(trim(contact_checked), 'yyyy-M-d')"), F.lit("1900-01-01").cast("date")), F.lit(0))
    letters = F.col("name").rlike(r"\p{Lu}") & F.col("name").rlike(r"\p{Ll}")
    claim = lambda name, value, ok, prior: F.struct(F.lit(name).alias("field"), value.alias("value"), F.when(ok, prior * step).cast("double").alias("log_prior"))
    return orgs.select("key", F.coalesce(F.nullif(strip(F.col("website_source")), F.lit("")), F.lit("unknown")).alias("source"), F.explode(F.array(
        claim("name", F.col("name"), letters, F.length("name")),
        claim("website", F.col("website"), site_url(F.col("website")) != "", day),
        claim("email", F.col("email"), email_rejection(F.col("email")) == "", day),
    )).alias("c")).select("key", "source", "c.*")
