"""Variant spellings of organization names: a pigeonhole segment join and what follows from it.

Two strings within ``k`` edits, cut one of them into ``k + 1`` segments: at least one segment
appears in the other unchanged, shifted by at most ``k``. The index holds the segments of every
name; each name looks up its substrings at the positions that can matter; a banded edit distance
then verifies the candidates.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import apart, small, work_dir, written
from . import canon
from .udfs import batch_udf

_NAME = "core string, kind string, given string, initials string, acronym string"


@batch_udf(_NAME)
def name_parts(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([canon.name_parts(n) for n in names], columns=["core", "kind", "given", "initials", "acronym"])


@batch_udf("string")
def locality(cities: pd.Series) -> pd.Series:
    return cities.map(canon.locality)


@batch_udf("boolean")
def within_edits(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
    """Edit distance check; true where a text is null."""
    return pd.Series([x is None or canon.edits(x, y, k) <= k for x, y, k in zip(a, b, most)], dtype=bool)


#: Letters from which on a text may differ by so many edits: none below the first.
EDIT_LENGTHS = (4, 12)


def allowed_edits(n: Column, most: int = len(EDIT_LENGTHS)) -> Column:
    """Edits that two spellings, the shorter of ``n`` letters, may differ by: none under 4 letters, 1 under 12, else 2."""
    return F.least(F.lit(most), sum(((n >= length).cast("int") for length in EDIT_LENGTHS), F.lit(0)))


def _cut(i: int, n: Column, parts: int) -> Column:
    """Letters before the ``i``-th of ``parts`` segments of a text of ``n`` letters."""
    return F.floor(n * i / parts).cast("int")


def _indexed(t: Column, n: Column, k: int) -> list[tuple[int, Column]]:
    """Segment number and letters of what stands for a text in the index: its ``k + 1`` segments and, for each cut between
    two, both as they are when the letters on either side of the cut are swapped."""
    begin = [_cut(i, n, k + 1) for i in range(k + 2)]
    whole = [(i, F.substring(t, begin[i] + 1, begin[i + 1] - begin[i])) for i in range(k + 1)]
    swapped = []
    for i in range(k):
        at = begin[i + 1]  # the letters at and at + 1 change places
        swapped.append((i, F.concat(F.substring(t, begin[i] + 1, at - begin[i] - 1), F.substring(t, at + 1, F.lit(1)))))
        swapped.append((i + 1, F.concat(F.substring(t, at, F.lit(1)), F.substring(t, at + 2, begin[i + 2] - at - 1))))
    return whole + swapped


def _probed(t: Column, m: Column, most: int) -> list[tuple[Column, Column, int, Column]]:
    """When, indexed length, segment number and letters of each lookup of a text of ``m`` letters.

    Of ``k`` edits there is a segment that has none, with as many edits before it as segments, or
    fewer after it than segments; that bounds how far it can be shifted from either end.
    """
    found = []
    for k in range(1, most + 1):
        for more in range(k + 1):
            n = m - more
            for i in range(k + 1):
                for shift in range(max(-i, more - (k - i)), min(i, more + k - i) + 1):
                    found.append((allowed_edits(n, most) == k, n, i, F.substring(t, _cut(i, n, k + 1) + shift + 1, _cut(i + 1, n, k + 1) - _cut(i, n, k + 1))))
    return found


def segment_join(rows: DataFrame, id: str, text: str, block: list[str], folder: str | None = None, *, most: int = 2) -> DataFrame:
    """``a, b`` with ``a < b``: smallest ids of the distinct texts of one block that are within their allowed edits.

    A text is cut into ``k + 1`` segments, so that ``k`` edits leave one of them whole; swapped
    neighbours count as one edit, and for a swap across a cut the index also holds the segments as
    the swap makes them. Entries are hashes of block, length of the indexed text, segment number and
    letters; only they and the ids of texts are joined, and the texts are fetched for distinct
    candidates, where the banded edit distance decides. Equal texts share one entry, so a block full
    of copies does not meet itself: pairs of the other rows are not told, so where rows of one text differ in
    what is asked of a pair next, give them one id and fetch the rows by it.
    Null or blank texts match nothing; null block columns match nothing.
    """
    folder = folder or work_dir(rows.sparkSession)
    base = rows.filter(F.coalesce(F.length(text), F.lit(0)) > 0)
    for c in block:
        base = base.filter(F.col(c).isNotNull())
    texts = base.groupBy(F.xxhash64(*block).alias("block"), F.col(text).alias("t")).agg(F.min(id).alias("rep"))
    texts = texts.withColumn("n", F.length("t")).filter(allowed_edits(F.col("n"), most) > 0).withColumn("tid", F.xxhash64("block", "t"))
    texts = written(texts, folder, "texts")
    t, n = F.col("t"), F.col("n")
    k = allowed_edits(n, most)
    entry = lambda length, i, letters: F.xxhash64("block", length, F.lit(i), letters)
    choice = F
    for size in range(1, most + 1):
        choice = choice.when(k == size, F.array(*(entry(n, i, s) for i, s in _indexed(t, n, size))))
    index = texts.select(F.col("tid").alias("l"), F.explode(F.array_distinct(choice)).alias("entry"))
    lookups = F.array_compact(F.array(*(F.when(when, entry(length, i, s)) for when, length, i, s in _probed(t, n, most))))
    probe = texts.select(F.col("tid").alias("r"), F.explode(F.array_distinct(lookups)).alias("entry"))
    met = index.join(apart(probe), "entry").filter(F.col("l") != F.col("r")).select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r")).distinct()
    return _near_texts(texts, met, most)


def _near_texts(texts: DataFrame, met: DataFrame, most: int) -> DataFrame:
    """``a, b``: ids of those of the pairs ``l, r`` of texts of one block that are within their allowed edits."""
    side = lambda c: apart(texts.select(F.col("tid").alias(c), F.struct("block", "t", "n", "rep").alias(f"{c}x")))
    pairs = met.join(side("l"), "l").join(side("r"), "r").select(
        F.col("lx.t").alias("lt"), F.col("rx.t").alias("rt"), F.col("lx.rep").alias("lrep"), F.col("rx.rep").alias("rrep"),
        allowed_edits(F.least("lx.n", "rx.n"), most).alias("k"), (F.col("lx.block") == F.col("rx.block")).alias("together"))
    pairs = pairs.filter(F.col("together")).withColumn("far", F.levenshtein("lt", "rt", 2 * most)).filter(F.col("far").between(0, 2 * F.col("k")))
    # a swap is two edits of the plain distance: only where that is too far is the other one asked
    doubt = F.col("far") > F.col("k")
    near = pairs.filter(within_edits(F.when(doubt, F.col("lt")), F.when(doubt, F.col("rt")), "k"))
    return near.select(F.least("lrep", "rrep").alias("a"), F.greatest("lrep", "rrep").alias("b")).distinct()


@batch_udf("array<string>")
def _lacking(texts: pd.Series, most: pd.Series) -> pd.Series:
    """Beginnings of each text that lack up to so many letters."""

    def of(text: str, k: int) -> list[str]:
        found = {text[:LETTERS]}
        for _ in range(k):
            found = {f for form in found for f in canon.deletions(form)}
        return sorted(found)

    return pd.Series([of(t, k) for t, k in zip(texts, most)], dtype=object)


#: Letters of a text whose forms are indexed by :func:`deletion_join`.
LETTERS = 12


def deletion_join(rows: DataFrame, id: str, text: str, block: list[str], folder: str | None = None, *, most: int = 2) -> DataFrame:
    """The pairs of :func:`segment_join`, found by forms that lack letters.

    Texts within ``k`` edits, swaps included, share a form that lacks up to ``k`` letters of either
    one's beginning. A text has more forms than segments (up to 13 under 12 letters, 79 from there on), but hardly any
    two texts share one that are not near. So this is for blocks with many texts of common parts, such as all place
    names: there the pairs that share a segment grow as the square of the texts.
    """
    folder = folder or work_dir(rows.sparkSession)
    base = rows.filter(F.coalesce(F.length(text), F.lit(0)) > 0)
    for c in block:
        base = base.filter(F.col(c).isNotNull())
    texts = base.groupBy(F.xxhash64(*block).alias("block"), F.col(text).alias("t")).agg(F.min(id).alias("rep"))
    texts = texts.withColumn("n", F.length("t")).filter(allowed_edits(F.col("n"), most) > 0).withColumn("tid", F.xxhash64("block", "t"))
    texts = written(texts, folder, "texts")
    forms = texts.select("tid", "block", _lacking("t", allowed_edits(F.col("n"), most)).alias("forms")).select("tid", F.explode(F.transform("forms", lambda f: F.xxhash64("block", f))).alias("entry"))
    met = forms.withColumnRenamed("tid", "l").join(apart(forms.withColumnRenamed("tid", "r")), "entry").filter(F.col("l") < F.col("r")).select("l", "r").distinct()
    return _near_texts(texts, met, most)


def likelier_texts(rows: DataFrame, text: str, block: list[str], folder: str | None = None, *, join: Callable = segment_join) -> DataFrame:
    """``*block, text, likelier``: each distinct text that has commoner ones within its allowed edits, and these.

    Of two near texts only the rarer one names the other (equal counts: the greater string), so a
    common text lists nothing, however many slips of it there are, and any near pair shares a text.
    """
    counted = rows.filter(F.coalesce(F.length(text), F.lit(0)) > 0).groupBy(*block, text).agg(F.count(F.lit(1)).alias("_n")).withColumn("_all", F.lit(0))
    pairs = join(counted.withColumn("_id", F.struct((-F.col("_n")).alias("n"), text, *block)), "_id", text, block or ["_all"], folder)
    return pairs.select(*(F.col("b")[c].alias(c) for c in (*block, text)), F.col("a")[text].alias("_a")).groupBy(*block, text).agg(F.sort_array(F.collect_set("_a")).alias("likelier"))


@batch_udf("string")
def building(streets: pd.Series) -> pd.Series:
    """House number and street, or crossing, of an address; null where it names neither."""
    return streets.map(lambda s: (lambda p: f"{p[1]} {p[2]}" if p[0] else None)(canon.address_parts(s)))


def organization_spellings(
    orgs: DataFrame, *, key: str = "key", name: str = "name", city: str = "city", state: str = "state", street: str = "street"
) -> DataFrame:
    """Distinct spellings: ``spelling`` (an id), its canonical parts, ``site`` and the ``key`` it stands under.

    A blank or null name falls back to the first part of the key. Rows without a key are left out.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    raw = orgs.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.when(blank(name) == "", F.split(F.col(key), r"\|")[0]).otherwise(blank(name)).alias("name"),
        blank(city).alias("city"), F.upper(blank(state)).alias("state"), blank(street).alias("street"),
    ).distinct()
    parts = raw.withColumn("p", name_parts("name")).withColumn("place", locality("city")).withColumn("site", building("street"))
    return parts.select("key", "state", "place", "site", "p.*").distinct().withColumn(
        "spelling", F.xxhash64("state", "place", "core", "kind", "given", "acronym"))


def linked_organizations(
    orgs: DataFrame, *, key: str = "key", name: str = "name", city: str = "city", state: str = "state", street: str = "street"
) -> DataFrame:
    """``key, organization``: every registry key with the id of the organization it stands for.

    Links between spellings of one state: names of one place and kind within their edits
    (segment join over the distinguishing words), places within their edits under one name
    (segment join over the place), an initial for a given name, and an acronym of which just one
    organization of the building, or else of the place, has the letters. A given name must agree or be missing on one
    side; each pair of spellings is asked for it. Spellings are distinct first, so copies cost nothing; linked ones are merged by
    connected components and a key follows its spellings.
    """
    folder = work_dir(orgs.sparkSession)
    parts = written(organization_spellings(orgs, key=key, name=name, city=city, state=state, street=street), folder, "spellings")
    spellings = parts.drop("key", "initials", "site").dropDuplicates(["spelling"])
    subject = F.when(F.col("core") == "", F.col("given")).otherwise(F.col("core"))
    slim = spellings.filter(F.col("acronym") == "").withColumn("subject", subject).select(
        "spelling", "given", "state", "place", "kind", "subject", F.xxhash64("state", "place", "kind", "subject").alias("group"))
    slim = written(slim, folder, "named")
    # both segment joins are one: names in blocks of place and kind, places in blocks of name and kind. Its rows are groups
    # of equal names, since the given names of all spellings of two groups are compared, not those of one of each
    entry = lambda mark, text, *by: F.struct(F.xxhash64(F.lit(mark), "state", "kind", *by).alias("block"), F.col(text).alias("text"))
    near = segment_join(slim.select("group", F.inline(F.array(entry("name", "subject", "place"), entry("place", "place", "subject")))), "group", "text", ["block"], folder)
    # a spelling is found under its given name, its initial and any; a blank one asks for any, an initial for all that
    # begin with it, another for its equals: every pair that agrees meets in one of two directions, by an exact join
    given, meets = F.col("given"), lambda group, form: F.xxhash64(group, form).alias("meets")
    form = F.when(given == "", "*").when(F.length(given) == 1, F.concat(F.lit("^"), given)).otherwise(F.concat(F.lit("="), given))
    forms = F.array_distinct(F.array(F.lit("*"), F.concat(F.lit("^"), F.left(given, F.lit(1))), F.concat(F.lit("="), given)))
    asks = slim.select("group", form.alias("form"), F.col("spelling").alias("a"))
    found = slim.select("group", F.explode(forms).alias("form"), F.col("spelling").alias("b")).select(meets("group", "form"), "b")
    both = near.select(F.inline(F.array(F.struct(F.col("a").alias("group"), F.col("b").alias("other")), F.struct(F.col("b").alias("group"), F.col("a").alias("other")))))
    asked = asks.select(meets("group", "form"), "a").unionByName(asks.join(apart(both), "group").select(meets("other", "form"), "a"))
    agreed = asked.join(apart(found), "meets").filter(F.col("a") != F.col("b")).select("a", "b")
    groups = connected_components(agreed, folder)
    known = written(spellings.select("spelling").join(small(groups), F.col("spelling") == groups["node"], "left").select(
        "spelling", F.coalesce("component", "spelling").alias("organization")), folder, "groups", measured=True)

    letters = parts.filter(F.col("acronym") == "").join(small(known), "spelling").select(
        "state", "place", "site", F.col("initials").alias("acronym"), "organization").distinct()
    only = lambda *keys: letters.groupBy(*keys).agg(F.min("organization").alias("low"), F.max("organization").alias("high")).filter(F.col("low") == F.col("high"))
    short = parts.filter(F.col("acronym") != "").select("state", "place", "site", "acronym", "spelling").distinct()
    on_site = short.join(apart(only("state", "place", "acronym", "site")), ["state", "place", "acronym", "site"])
    in_place = short.join(apart(only("state", "place", "acronym")), ["state", "place", "acronym"])
    adopted = on_site.select("spelling", F.lit(0).alias("order"), "low").unionByName(in_place.select("spelling", F.lit(1).alias("order"), "low")).groupBy(
        "spelling").agg(F.min(F.struct("order", "low"))["low"].alias("adopted"))
    final = known.join(apart(adopted), "spelling", "left").select("spelling", F.coalesce("adopted", "organization").alias("organization"))
    # spellings under one key mean one organization
    by_key = written(parts.select("key", "spelling").distinct().join(apart(final), "spelling").select("key", "organization").distinct(), folder, "keys")
    firsts = by_key.groupBy("key").agg(F.min("organization").alias("m"), F.max("organization").alias("x"))
    bridges = by_key.join(apart(firsts.filter(F.col("m") != F.col("x"))), "key").select(F.col("m").alias("a"), F.col("organization").alias("b"))
    merged = connected_components(bridges, folder)
    return firsts.join(small(merged), F.col("m") == F.col("node"), "left").select("key", F.coalesce("component", "m").alias("organization"))


def same_organization_pairs(members: DataFrame) -> DataFrame:
    """``key_a, key_b``: the distinct keys of one organization, in pairs, smaller first."""
    a = members.select(F.col("key").alias("key_a"), "organization")
    b = members.select(F.col("key").alias("key_b"), "organization")
    return a.join(apart(b), "organization").filter(F.col("key_a") < F.col("key_b")).select("key_a", "key_b").distinct()
