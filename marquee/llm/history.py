"""Duplicates of new batches against all accepted history, without reprocessing the history.

State in the shared folder is one ledger: blocking keys of the accepted tellings, their compared
fields, native keys and hashes of whole tellings, each with its representative, and the mapping of
representatives that were merged since (union-find with compressed paths). A batch probes the
blocking keys of the spans of time it tells of, candidate pairs are scored with learned weights, and
only the clusters it touches are merged. A misspelt title is indexed and probed under its own
spelling and under the commoner ones it may stand for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..functions.text import strip
from ..operators.components import connected_components
from ..session import BROADCAST_LIMIT, ROW_BYTES, Ledger, apart, drop_written, release_driver_memory, small, work_dir, written
from . import canon, names
from .udfs import batch_udf

#: Days by which two tellings of one run may differ, and days of a date block.
DAYS_APART = 2
#: Compared fields; dates, source, title and edition are conditions, not evidence.
FIELDS = ("org", "venue", "place", "site")
LEVELS = ("same", "near", "differ", "absent")
#: Log-odds (base 2) from which a pair counts as one production.
THRESHOLD = 3.0
#: Share of pairs with one title, source and run that are one production, before any evidence.
PRIOR = 0.05
#: Pseudo-pairs added to each count of the weights.
EXTRA = 5.0
#: Bits that a title read as another spelling costs, for each side that has to be read so.
SLIP = 1.0
#: Rows of a native key that one window takes when weights are learned.
KEY_ROWS = 10_000
_LETTERS = 6
#: Day slots of one span, by which the ledger's blocking keys are sorted and read.
SPAN_SLOTS = 32

ROW = T.StructType([T.StructField("seq", T.LongType()), T.StructField("source", T.StringType()), T.StructField("native", T.StringType()), T.StructField("title", T.StringType()), T.StructField("edition", T.StringType()),
    *(T.StructField(f, T.StringType()) for f in FIELDS), T.StructField("d1", T.IntegerType()), T.StructField("d2", T.IntegerType()),
    T.StructField("likelier", T.ArrayType(T.StringType()))])


@batch_udf("title string, edition string")
def _title(titles: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([canon.title_parts(t) for t in titles], columns=["title", "edition"])


@batch_udf("string")
def _words(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: canon.locality(t))


def compared(rows: DataFrame, *also: str) -> DataFrame:
    """The canonical fields of raw productions, as in ``ROW`` but for ``likelier``, and the columns ``also``; rows without ``seq`` are left out."""
    day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date"))
    text = lambda c: strip(F.col(c)).alias(c)
    some = lambda c: F.when(c != "", c)
    raw = rows.filter(F.col("seq").isNotNull()).select(
        F.col("seq").cast("long").alias("seq"), F.coalesce("source", F.lit("")).alias("source"), F.lower(strip(F.col("key"))).alias("native"),
        text("show_title"), text("organization"), text("venue"), text("city"), text("street"), day("start_date").alias("d1"), day("end_date").alias("d2"), *also)
    spelled = lambda p: F.trim(F.concat_ws(" ", p["core"], p["kind"], p["given"], p["acronym"]))
    return (
        raw.withColumn("p", names.name_parts("organization")).withColumn("t", _title("show_title"))
        .withColumn("place", _words("city")).withColumn("site", names.building("street")).withColumn("hall", _words("venue"))
        .select("seq", "source", some(F.col("native")).alias("native"), F.col("t.title").alias("title"), F.col("t.edition").alias("edition"), some(spelled(F.col("p"))).alias("org"),
                F.when(F.lower("venue") == F.lower("organization"), some(spelled(F.col("p")))).otherwise(some(F.col("hall"))).alias("venue"), some(F.col("place")).alias("place"), "site", "d1", "d2", *also)
    )


def _level(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), "absent").when(a == b, "same").when(F.levenshtein(a, b, 2) >= 0, "near").otherwise("differ")


def learned_weights(rows: DataFrame) -> dict[str, dict[str, float]]:
    """Log2 of m/u for each level of each field.

    m is counted over rows that tell one native key again, u over rows of one source and title
    under different native keys, both paired with their predecessor in an order by hash; all rows
    take part. Only the 32 counts reach the driver. ``EXTRA`` pairs are added to each count.
    """
    def counted(df: DataFrame, by: list[str], same_key: bool) -> list[Column]:
        order = W.partitionBy(*by).orderBy(F.xxhash64("seq"), "seq")
        paired = df.select("native", *FIELDS, *(F.lag(f).over(order).alias(f"_{f}") for f in ("native", *FIELDS)))
        paired = paired.filter(F.col("_native").isNotNull() & ((F.col("native") == F.col("_native")) == F.lit(same_key)))
        return paired.agg(*(F.count_if(_level(F.col(f), F.col(f"_{f}")) == lv).alias(f"{f}~{lv}") for f in FIELDS for lv in LEVELS)).first().asDict()

    keyed = rows.filter(F.col("native").isNotNull())
    # a key of very many rows is spread over slices, so that none of them is one task's window
    heavy = keyed.groupBy("source", "native").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > KEY_ROWS)
    spread = keyed.join(heavy, ["source", "native"], "left").withColumn("slice", F.pmod(F.xxhash64("seq"), F.coalesce(F.ceil(F.col("n") / KEY_ROWS), F.lit(1)).cast("long")))
    m = counted(spread, ["source", "native", "slice"], True)
    u = counted(keyed.withColumn("slice", F.pmod(F.xxhash64("native"), F.lit(64))), ["source", "title", "slice"], False)
    weights: dict[str, dict[str, float]] = {}
    for f in FIELDS:
        told = [lv for lv in LEVELS if lv != "absent"]
        total = lambda c: sum(c[f"{f}~{lv}"] + EXTRA for lv in told)  # noqa: B023, E731
        weights[f] = {lv: math.log2(((m[f"{f}~{lv}"] + EXTRA) / total(m)) / ((u[f"{f}~{lv}"] + EXTRA) / total(u))) for lv in told} | {"absent": 0.0}
    return weights


def with_likelier_titles(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` with ``likelier``: the commoner titles of the same source and edition within the title's allowed edits."""
    told = written(names.likelier_texts(rows.select("source", "edition", "title"), "title", ["source", "edition"], folder), folder, "titles", measured=True)
    return rows.join(small(told), ["source", "edition", "title"], "left")


def _blocks(probe: bool) -> Column:
    """Blocking keys with ``span`` and ``slip``: source, title or a likelier one (``slip`` 1), edition, a run's first or
    last days, and place, organization or venue."""
    none = F.array().cast("array<struct<span:int,block:bigint,slip:int>>")
    titles = F.concat(F.array(F.struct(F.col("title").alias("t"), F.lit(0).alias("slip"))), F.transform(
        F.coalesce("likelier", F.array().cast("array<string>")), lambda t: F.struct(t.alias("t"), F.lit(1).alias("slip"))))

    def keys(mark: str, day: Column, by: Column) -> Column:
        slot = F.floor(day / (DAYS_APART + 1))
        slots = F.sequence(slot - 1, slot + 1) if probe else F.array(slot)
        of = lambda t, s: F.struct(
            F.floor(s / SPAN_SLOTS).cast("int").alias("span"), F.xxhash64(F.lit(mark), "source", t["t"], "edition", by, s).alias("block"), t["slip"].alias("slip"))
        return F.when(day.isNotNull() & by.isNotNull(), F.flatten(F.transform(titles, lambda t: F.transform(slots, lambda s: of(t, s))))).otherwise(none)

    by = {"p": F.col("place"), "o": F.left(F.col("org"), F.lit(_LETTERS)), "v": F.col("venue")}
    return F.array_distinct(F.concat(*(keys(m + k, F.col(d), c) for m, d in (("s", "d1"), ("e", "d2")) for k, c in by.items())))


def prepared(rows: DataFrame, *by: str) -> DataFrame:
    """Rows as in ``ROW`` in the form that :meth:`HistoryIndex.accept` takes: ``seq``, hashes of the native key and of the
    whole telling (null where there is none) with the first row of the batch that has them, the compared ``fields``, the
    blocking keys to index and those to probe. Columns ``by`` part the rows into batches and are kept."""
    dated = F.col("d1").isNotNull() | F.col("d2").isNotNull()
    native = F.when(F.col("native").isNotNull(), F.xxhash64(F.lit("native"), "source", "native"))
    telling = F.when(dated & (F.col("org").isNotNull() | F.col("venue").isNotNull()), F.xxhash64(
        "source", "title", "edition", *(F.coalesce(F.col(f), F.lit("\x00")) for f in FIELDS), F.coalesce("d1", F.lit(0)), F.coalesce("d2", F.lit(0))))
    out = rows.select("seq", native.alias("native"), telling.alias("telling"), F.struct(*FIELDS, "d1", "d2").alias("fields"), _blocks(False).alias("own"), _blocks(True).alias("probe"), *by)
    for k in ("native", "telling"):
        # an aggregate and a join, not a window: a hot key combines before its shuffle and its join is split
        first = out.filter(F.col(k).isNotNull()).groupBy(*by, k).agg(F.min("seq").alias(f"{k}_first"))
        out = out.join(apart(first), [*by, k], "left")
    return out


def _log_odds(weights: dict[str, dict[str, float]]) -> str:
    """SQL of a pair's score; ``a`` and ``b`` are the two tellings' fields, ``slips`` how many titles were read otherwise."""
    level = lambda f, w: (
        f"CASE WHEN a.{f} IS NULL OR b.{f} IS NULL THEN {w['absent']!r}D WHEN a.{f} = b.{f} THEN {w['same']!r}D WHEN levenshtein(a.{f}, b.{f}, 2) >= 0 THEN {w['near']!r}D ELSE {w['differ']!r}D END")
    start = math.log2(PRIOR / (1 - PRIOR)) + 8.0  # 8 bits: one title, source and run among all rows of a block
    return " + ".join([f"{start!r}D - {SLIP!r}D * slips", *(level(f, weights[f]) for f in FIELDS)])


#: One run at one venue: a first or last day agrees, neither contradicts, nor does the venue.
_RUN_AGREES = f"""
    (coalesce(abs(a.d1 - b.d1) <= {DAYS_APART}, false) OR coalesce(abs(a.d2 - b.d2) <= {DAYS_APART}, false))
    AND NOT coalesce(abs(a.d1 - b.d1) > {DAYS_APART}, false) AND NOT coalesce(abs(a.d2 - b.d2) > {DAYS_APART}, false)
    AND (a.venue IS NULL OR b.venue IS NULL OR a.venue = b.venue OR levenshtein(a.venue, b.venue, 2) >= 0)"""

#: Rows of a batch with the representatives of their native key and telling: as accepted, else the first of the batch.
_KNOWN = """
WITH hits AS (SELECT /*+ {few}(b) */ e.k, min(e.rep) AS rep FROM {exact} e LEFT SEMI JOIN (SELECT explode(array_compact(array(native, telling))) AS k FROM {batch}) b ON e.k = b.k GROUP BY e.k)
SELECT /*+ {few}(n, t) */ r.*, array_compact(array(coalesce(n.rep, native_first), coalesce(t.rep, telling_first))) AS links,
  n.k IS NULL AND coalesce(native_first = seq, false) AS new_native, t.k IS NULL AND coalesce(telling_first = seq, false) AS fresh
FROM {batch} r LEFT JOIN hits n ON r.native = n.k LEFT JOIN hits t ON r.telling = t.k"""

#: Links of a batch's rows: by key or whole telling, and by the score of pairs met under a blocking key. Candidates are ids only, each pair once.
_LINKS = """
WITH fresh AS (SELECT seq, fields, own, probe FROM {told} WHERE fresh),
entries AS (SELECT block AS k, slip, seq FROM (SELECT seq, inline(own) FROM fresh) UNION ALL SELECT k, slip, seq FROM {blocks} WHERE span IN ({spans})),
probes AS (SELECT block AS k, slip, seq FROM (SELECT seq, inline(probe) FROM fresh)),
met AS (SELECT /*+ {few_probes}(p) */ p.seq AS a_seq, e.seq AS b_seq, min(e.slip + p.slip) AS slips FROM entries e JOIN probes p ON e.k = p.k WHERE p.seq > e.seq GROUP BY p.seq, e.seq),
theirs AS (SELECT seq, fields, seq AS rep FROM fresh UNION ALL SELECT seq, fields, rep FROM {rows}),
pairs AS (SELECT /*+ {few_texts}(x), MERGE(y) */ a_seq, slips, x.fields AS a, y.fields AS b, y.rep FROM met JOIN fresh x ON a_seq = x.seq JOIN theirs y ON b_seq = y.seq)
SELECT seq AS x, explode(links) AS y FROM {told} UNION ALL SELECT a_seq, rep FROM pairs WHERE {agrees} AND {score} >= {threshold}"""

#: The same where representatives have been merged since: theirs now.
_MOVED_LINKS = """
SELECT /*+ {few_moved}(m) */ x, coalesce(m.now, y) AS y FROM {links} LEFT JOIN {moved} m ON y = m.old"""

#: What the ledger takes up: a batch's rows under their representatives, and representatives merged into smaller ones,
#: which are the nodes of the groups that are no rows of the batch.
_ADDED = """
SELECT kind, span, k, slip, seq, fields, rep FROM (SELECT seq, rep, inline(concat(
    array(named_struct('kind', IF(seq IS NULL, 'moved', 'member'), 'span', int(NULL), 'k', coalesce(seq, old), 'slip', int(NULL), 'fields', {none})),
    IF(new_native, array(named_struct('kind', 'exact', 'span', int(NULL), 'k', native, 'slip', int(NULL), 'fields', {none})), array()),
    IF(fresh, concat(
      array(named_struct('kind', 'exact', 'span', int(NULL), 'k', telling, 'slip', int(NULL), 'fields', {none}), named_struct('kind', 'row', 'span', int(NULL), 'k', seq, 'slip', int(NULL), 'fields', fields)),
      transform(own, b -> named_struct('kind', 'block', 'span', b.span, 'k', b.block, 'slip', b.slip, 'fields', {none}))), array())))
  FROM (SELECT /*+ {few_groups}(g) */ t.*, g.node AS old, coalesce(g.component, t.seq) AS rep FROM {told} t FULL JOIN {groups} g ON t.seq = g.node WHERE t.seq IS NOT NULL OR g.node <> g.component))"""

_ABSORBED = """
SELECT /*+ {few_rows}(t) */ node AS k, component AS rep FROM (SELECT * FROM {groups} WHERE node <> component) LEFT ANTI JOIN {told} t ON node = t.seq"""

#: Paths are compressed: what was merged into an absorbed representative names its new one.
_COMPRESSED = """
SELECT /*+ {few_groups}(a) */ 'moved' AS kind, m.old AS k, a.rep FROM {moved} m JOIN {absorbed} a ON m.now = a.k"""


@dataclass(frozen=True)
class Extent:
    """What a batch is counted to have: rows, probed blocking keys, bytes of compared texts, and the spans of its probes.

    The spans are as many as the calendar has, not as the batch has rows.
    """

    rows: int
    probes: int
    texts: int
    spans: tuple[int, ...]

    @staticmethod
    def columns() -> list[Column]:
        texts = sum((F.coalesce(F.octet_length(f"fields.{f}"), F.lit(0)) for f in FIELDS), F.lit(0))
        return [F.count(F.lit(1)).alias("rows"), F.sum(F.size("probe")).alias("probes"), F.sum(texts).alias("texts"), F.array_distinct(F.flatten(F.collect_set(F.array_distinct("probe.span")))).alias("spans")]

    @classmethod
    def of(cls, row: Row) -> Extent:
        return cls(row["rows"], row["probes"] or 0, row["texts"] or 0, tuple(sorted(row["spans"])))


def _filled(query: str, **texts: str) -> str:
    for name, text in texts.items():
        query = query.replace(f"{{{name}}}", text)
    return query


class HistoryIndex:
    """Accepted rows and their clusters; :meth:`accept` takes the next batch.

    The ledger in ``folder`` has five kinds of rows, each with its ``rep``: ``block`` (a blocking key
    ``k`` in a ``span`` of time and the telling ``seq`` under it), ``row`` (the compared fields of a
    telling), ``exact`` (hash of a native key or of a whole telling), ``member`` (an accepted row) and
    ``moved`` (a representative that was merged into a smaller one). A batch reads the blocking keys
    of its spans only, and fields only of the tellings it met; nothing is rewritten but by the
    ledger's own merging of runs.
    A telling with the same fields as an accepted one is linked by its hash and neither probes
    nor is indexed, so copies cost one lookup each, also where they are a third of all rows.
    Rows without dates are linked by their native key only; a blank native key links nothing.
    Batches may come in any size, empty ones too. A new index on the folder of an old one goes on with it.
    """

    def __init__(self, spark: SparkSession, folder: str, weights: dict[str, dict[str, float]]):
        self.spark, self.folder, self.weights, self.batches = spark, folder, weights, 0
        fields = ",".join(f"{f}:string" for f in FIELDS)
        self.ledger = Ledger(spark, folder, "history", f"span int, k bigint, slip int, seq bigint, fields struct<{fields},d1:int,d2:int>, rep bigint", ("span", "k"))
        self.moved = self.ledger.read("moved").count()

    def _latest(self) -> DataFrame:
        """``old, now`` of merged representatives; a later merge only ever names a smaller one."""
        return self.ledger.read("moved").groupBy(F.col("k").alias("old")).agg(F.min("rep").alias("now"))

    def accept(self, batch: DataFrame, extent: Extent | None = None) -> None:
        """Probe, score, link, merge and index the rows of ``batch`` (see :func:`prepared`; distinct ``seq``).

        ``extent`` is counted where it is not given. The plans of two batches are the same up to the
        sizes that decide on broadcasts, so that their compiled code is used again.
        """
        extent = extent or Extent.of(batch.agg(*Extent.columns()).first())
        if not extent.rows:
            return
        self.batches += 1
        folder = f"{self.folder}/batch-{self.batches}"
        sql, moved = self.spark.sql, self._latest()
        # sides that meet the ledger are broadcast where that is proven small, so that it is not shuffled; others are hashed
        fits = lambda rows, more=0: rows * (ROW_BYTES + 24) + more <= BROADCAST_LIMIT
        few = lambda rows: "BROADCAST" if fits(rows) else "MERGE"
        hashed = lambda rows, more=0: "SHUFFLE_HASH" if fits(rows, more) else "MERGE"
        told = written(sql(_filled(_KNOWN, few=few(2 * extent.rows)), batch=batch, exact=self.ledger.read("exact")), folder, "batch")
        linking = _filled(_LINKS, spans=", ".join(map(str, extent.spans)) or "NULL", agrees=_RUN_AGREES, score=_log_odds(self.weights), threshold=str(THRESHOLD),
            few_probes=few(extent.probes), few_texts=hashed(2 * extent.rows, extent.texts))
        links = sql(linking, told=told, blocks=self.ledger.read("block"), rows=self.ledger.read("row"))
        if self.moved:
            links = sql(_filled(_MOVED_LINKS, few_moved=few(self.moved)), links=links, moved=moved)
        # only rows of the batch and representatives they touch take part
        groups = connected_components(links, folder, a="x", b="y")
        few_groups = hashed(groups.counted)
        fields = told.schema["fields"].dataType.simpleString()
        added = sql(_filled(_ADDED, none=f"cast(NULL AS {fields})", few_groups=few_groups), told=told, groups=groups)
        if self.moved:
            absorbed = sql(_filled(_ABSORBED, few_rows=hashed(extent.rows)), groups=groups, told=told)
            added = added.unionByName(sql(_filled(_COMPRESSED, few_groups=few_groups), absorbed=absorbed, moved=moved), allowMissingColumns=True)
        seen = Observation()
        self.ledger.append(added.observe(seen, F.count_if(F.col("kind") == "moved").alias("moved")))
        self.moved += seen.get["moved"] or 0
        drop_written(self.spark, folder)
        release_driver_memory(self.spark)

    def duplicates(self) -> DataFrame:
        """``seq_a, seq_b``: each row that tells a known production, with its first row."""
        rows = self.ledger.read("member").select("seq", "rep").distinct()
        now = rows.join(small(self._latest(), size=self.moved * (ROW_BYTES + 16)), rows["rep"] == F.col("old"), "left")
        return now.select(F.coalesce("now", "rep").alias("seq_a"), F.col("seq").alias("seq_b")).filter(F.col("seq_a") != F.col("seq_b"))


def linked_batches(rows: DataFrame, *, batch_day: str = "loaded_at") -> DataFrame:
    """``seq_a, seq_b`` after accepting ``rows`` day by day, in the order of ``batch_day``.

    The weights are learned on the first batch; which titles are likelier is counted over all rows,
    once per distinct title. A repeated ``seq`` counts once. A null day goes with the first batch. The
    driver reads the days with their numbers of rows and spans, not rows.
    """
    spark = rows.sparkSession
    folder = work_dir(spark)
    day = F.to_date(F.col(batch_day))
    lowest = rows.agg(F.min(day)).first()[0]
    if lowest is None:
        return spark.createDataFrame([], "seq_a long, seq_b long")
    once = rows.dropDuplicates(["seq"]).withColumn("_day", F.coalesce(day, F.lit(lowest)))
    told = written(compared(once, "_day").withColumnRenamed("_day", "day"), folder, "compared")
    ready = with_likelier_titles(told, folder)
    weights = learned_weights(told.filter(F.col("day") == F.lit(lowest)))
    staged = written(prepared(ready, "day").repartition("day", F.pmod("seq", F.lit(4))), folder, "staged", "day")
    days = staged.groupBy("day").agg(*Extent.columns()).orderBy("day").collect()
    release_driver_memory(spark)
    index = HistoryIndex(spark, folder, weights)
    for d in days:
        index.accept(staged.filter(F.col("day") == F.lit(d["day"])).drop("day"), Extent.of(d))
    return index.duplicates()
