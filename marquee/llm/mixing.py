"""Mixing sources to target shares of the total size: subset-sum budget fitting.

The budgets follow from the largest total that no source's capped size limits. A source takes
all its documents as often as its budget allows; what is left of the budget is met by a choice
of documents: lengths are thinned out evenly, and a bounded-knapsack over the exact lengths of
the remaining documents finds counts that meet the last part of the budget, to the token if they
can. Which documents of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import apart, small, work_dir, written

#: Buckets of the hash by which documents of one length are ranked.
BUCKETS = 4096
#: Copies of one row that are written out at a time.
COPIES = 1 << 16
#: Lengths of the longest document that are left to the knapsack.
SLACK = 4


def fitted_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their sum is as near under ``budget`` as can be."""
    take = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    order = np.argsort(lengths, kind="stable")
    lengths, counts = lengths[order], counts[order]
    slack = SLACK * int(lengths[-1])
    thin = max(0, budget - slack)
    share = thin / total
    before = np.floor(np.cumsum(counts) * share).astype(np.int64)
    first = np.minimum(np.diff(np.concatenate([[0], before])), counts)
    while int((lengths * first).sum()) > budget:  # rounding may overshoot: give back the longest taken
        first[np.flatnonzero(first)[-1]] -= 1
    rest = budget - int((lengths * first).sum())
    spare = counts - first
    # bounded knapsack over sums 0..rest; powers of two stand for several documents of a length
    reached = np.zeros(rest + 1, dtype=bool)
    reached[0] = True
    by = np.full(rest + 1, -1, dtype=np.int64)
    items: list[tuple[int, int]] = []
    for i in np.flatnonzero((lengths > 0) & (lengths <= rest) & (spare > 0)):
        many, power = min(int(spare[i]), rest // int(lengths[i])), 1
        while many > 0:
            n = min(power, many)
            step = n * int(lengths[i])
            new = np.zeros_like(reached)
            new[step:] = reached[: rest + 1 - step]
            new &= ~reached
            by[new] = len(items)
            items.append((int(i), n))
            reached |= new
            many, power = many - n, power * 2
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = items[by[at]]
        first[i] += n
        at -= n * int(lengths[i])
    take[order] = first
    return take


def mixed(docs: DataFrame, targets: DataFrame, *, id: str = "doc_id", tokens: str = "n_tokens", seed: int = 17) -> DataFrame:
    """``doc_id, source, n_tokens, repeats, target_share, actual_share`` of the documents to take.

    ``targets`` has ``source, target_share, max_repeats``, one row per source. ``repeats`` is how
    often a document is used, from 1 to its source's ``max_repeats``. Sources without a target,
    null sources and documents without tokens are not used; a source of positive share without
    documents makes every budget 0 and the result empty. Rows of a repeated id are documents of
    their own. The histogram of lengths, not the documents, is what a source's one task sees.
    """
    folder = work_dir(docs.sparkSession)
    wanted = targets.filter((F.col("target_share") > 0) & (F.col("max_repeats") > 0)).select("source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("long").alias("max_repeats"))
    wanted = written(wanted, folder, "targets", measured=True)
    used = docs.select(F.col(id).alias("doc_id"), "source", F.col(tokens).cast("long").alias("n_tokens")).filter(F.col("n_tokens") > 0)
    # equal rows are one with a number of copies, so that a null or repeated id is no heavy bucket
    used = used.join(small(wanted.select("source"), wanted), "source", "left_semi").groupBy("doc_id", "source", "n_tokens").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "h", F.xxhash64(F.lit(seed), "doc_id", "source", "n_tokens")).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    used = written(used, folder, "documents")
    buckets = written(used.groupBy("source", "n_tokens", "bucket").agg(F.sum("copies").alias("n")), folder, "buckets")
    sizes = buckets.groupBy("source").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("have"))
    budget = wanted.join(apart(sizes), "source", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    total = F.min(F.col("have") * F.col("max_repeats") / F.col("target_share")).over(W.partitionBy(F.lit(0)))  # one row per source
    budget = budget.withColumn("budget", F.floor(total * F.col("target_share") + 1e-6).cast("long"))
    budget = budget.withColumn("rounds", F.least(F.col("max_repeats"), F.floor(F.try_divide(F.col("budget"), F.col("have"))).cast("long"))).withColumn(
        "rest", F.col("budget") - F.col("rounds") * F.col("have"))
    budget = written(budget.filter(F.col("have") > 0), folder, "budgets", measured=True)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        row = part.iloc[0]
        rest = int(row["rest"]) if row["rounds"] < row["max_repeats"] else 0
        take = fitted_counts(part["n_tokens"].to_numpy(), part["n"].to_numpy(), rest)
        return pd.DataFrame({"source": part["source"], "n_tokens": part["n_tokens"], "take": take})

    lengths = buckets.groupBy("source", "n_tokens").agg(F.sum("n").alias("n")).join(small(budget), "source")
    takes = lengths.groupBy("source").applyInPandas(fit, "source string, n_tokens long, take long")
    # two-level rank: whole hash buckets below the mark, and a rank inside the one that holds it
    running = W.partitionBy("source", "n_tokens").orderBy("bucket")
    marks = buckets.join(apart(takes.filter(F.col("take") > 0)), ["source", "n_tokens"]).withColumn("upto", F.sum("n").over(running)).withColumn(
        "part", F.least(F.col("n"), F.greatest(F.lit(0), F.col("take") - F.col("upto") + F.col("n")))).filter(F.col("part") > 0)
    marks = written(marks.select("source", "n_tokens", "bucket", "n", "part"), folder, "marks")
    placed = used.join(apart(marks), ["source", "n_tokens", "bucket"], "left")
    inside = W.partitionBy("source", "n_tokens", "bucket").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = placed.filter(F.col("part") < F.col("n")).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("copies"), F.col("part") - F.sum("copies").over(inside) + F.col("copies"))))
    clear = placed.filter(F.col("part").isNull() | (F.col("part") == F.col("n"))).withColumn("extra", F.when(F.col("part").isNull(), 0).otherwise(F.col("copies")).cast("long"))
    each = cut.unionByName(clear).withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), "copies", F.lit(COPIES).cast("long")))).withColumn(
        "copy", F.explode(F.sequence("first", F.least("copies", F.col("first") + COPIES - 1))))
    chosen = each.join(small(budget.select("source", "target_share", "rounds"), budget), "source").withColumn(
        "repeats", F.col("rounds") + (F.col("copy") <= F.col("extra")).cast("long")).filter(F.col("repeats") > 0)
    chosen = written(chosen.select("doc_id", "source", "n_tokens", "repeats", "target_share"), folder, "chosen")
    got = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("got"))
    shares = got.withColumn("actual_share", F.col("got") / F.sum("got").over(W.partitionBy(F.lit(0)))).select("source", "actual_share")  # one row per source
    return chosen.join(small(shares, budget), "source").select("doc_id", "source", "n_tokens", "repeats", "target_share", "actual_share")
