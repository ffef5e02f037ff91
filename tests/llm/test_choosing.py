import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import fusion, mixing, packing, tokens


def test_fusion_discounts_copies(spark):
    rows, truth = [], {}
    for i in range(60):
        key, right, wrong = f"k{i}", "right", f"wrong{i}"
        truth[key] = right
        for s in ("good1", "good2", "good3", "good4")[: 2 if i % 6 == 3 else 4]:
            rows.append((key, "f", right, s, 0.0))
        for s in ("bad", "copy1", "copy2"):
            rows.append((key, "f", wrong if i % 3 == 0 else right, s, 0.0))
    rows += [("z", "f", "only", None, 0.0), ("z", "f", "only", None, 0.0), ("y", "f", " ", "good1", 0.0), (None, "f", "v", "good1", 0.0), ("x", "f", "never", "good1", None), ("x", "f", "maybe", "bad", 0.0)]
    df = spark.createDataFrame(rows, "key string, field string, value string, source string, log_prior double").withColumn("kept", F.lit("clash"))
    got = {r.key: r.kept for r in fusion.fused(df).collect()}
    assert got == truth | {"z": "only", "x": "maybe"}
    assert fusion.fused(df.limit(0)).count() == 0


def test_registry_claims(spark):
    rows = [("k", "ACME STAGE", "www.old.org", "mti", "a@old.org", "2026-01-01"), ("k", "Acme Stage", "www.new.org", "", "noreply@new.org", "2026-02-01"), ("k", "The Acme Stage", "http://localhost", None, "b@new.org", ""), ("k", None, "", None, None, None)]
    df = spark.createDataFrame(rows, "key string, name string, website string, website_source string, email string, contact_checked string")
    got = {r.field: r.kept for r in fusion.fused(fusion.registry_claims(df)).collect()}
    assert got == {"name": "The Acme Stage", "website": "www.new.org", "email": "a@old.org"}


def test_surviving_records(spark):
    rows = [("k", "Acme Stage", "www.acme.org", "mti", "a@acme.org", "2026-01-01"), ("k", "ACME", "www.acme.org", "trw", "", "2026-02-01"), ("n", "", "", "", "", "")]
    df = spark.createDataFrame(rows, "key string, name string, website string, website_source string, email string, contact_checked string")
    got = [tuple(r) for r in fusion.surviving_records(fusion.fused(fusion.registry_claims(df))).collect()]
    assert got == [("k", "Acme Stage", "www.acme.org", "mti", "a@acme.org")]


def test_fused_registry_outvotes_copies(spark):
    rows = []
    for i in range(60):
        truth, wrong = f"www.right{i}.org", f"www.wrong{i}.org"
        rows += [(f"k{i}", "X", f"www.slip{i}{s}.org" if (i + j) % 7 == 1 else truth, s, "", "2026-01-01") for j, s in enumerate(("mti", "concord", "third"))]
        rows += [(f"k{i}", "X", truth if i % 4 else wrong, s, "", "2026-03-01") for s in ("trw", "copy1", "copy2")]
    df = spark.createDataFrame(rows, "key string, name string, website string, website_source string, email string, contact_checked string")
    kept = {r.key: r for r in fusion.fused(fusion.registry_claims(df, by_rule=False)).filter("field = 'website'").collect()}
    right = [i for i in range(60) if f"k{i}" not in kept or kept[f"k{i}"].kept == f"www.right{i}.org"]
    assert len(right) == 60 and all(0 < r.posterior <= 1 for r in kept.values())


def test_null_ids_are_spread_over_shards(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), (F.col("id") % 97 + 1).alias("n_tokens"))
    out = packing.packed(df, 512, shard_items=500)
    assert out.count() == 3000 and out.agg(F.sum("tokens")).first()[0] == df.agg(F.sum("n_tokens")).first()[0]
    shards = out.select(F.pmod(F.floor(F.col("pack") / (1 << 32)), F.lit(1 << 28)).alias("s")).distinct().count()
    assert shards > 3


def test_mix_repeated_rows_are_documents_of_their_own(spark):
    docs = spark.createDataFrame([(None, "a", 10)] * 60 + [(i, "a", 10) for i in range(40)] + [(i, "b", 10) for i in range(50)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    got = mixing.mixed(docs, targets).collect()
    assert sum(r.source == "a" for r in got) == 50 and sum(r.source == "b" for r in got) == 50 and all(r.repeats == 1 for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_best_two_fit(seed):
    rnd = np.random.default_rng(seed)
    sizes = rnd.integers(0, 101, 300) if seed else np.array([100] * 7 + [0] * 3)
    bins = packing.best_two_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sizes[b].sum() <= 100 for b in bins)
    assert len(bins) <= -(-sizes.sum() // 100) * 1.1 + 1
    assert packing.best_two_fit(np.array([], dtype=int), 10) == []


def test_packs(spark):
    rows = [(i, (i * 37) % 400) for i in range(500)] + [(1000, 2600), (1000, 5), (1001, None), (None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long").withColumn("pack", F.lit("clash"))
    out = packing.packed(df, 512, shard_items=100).collect()
    assert sum(r.tokens for r in out) == sum(t or 0 for _, t in rows)
    filled = {}
    for r in out:
        filled[r.pack] = filled.get(r.pack, 0) + r.tokens
    assert max(filled.values()) <= 512 and sum(filled.values()) / (512 * len(filled)) > 0.97
    assert sorted(r.part for r in out if r.doc == "1000" and r.parts > 1) == list(range(6)) and all(r.parts == 1 for r in out if r.doc != "1000")
    assert packing.packed(df.limit(0), 512).count() == 0


def test_fitted_counts():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        lengths = rnd.permutation(np.unique(rnd.integers(1, 90, 12)))
        counts = rnd.integers(1, 5, len(lengths))
        budget = int(rnd.integers(0, (lengths * counts).sum() + 5))
        reach = {0}
        for n, c in zip(lengths, counts):
            reach = {s + k * int(n) for s in reach for k in range(c + 1)}
        take = mixing.fitted_counts(lengths, counts, budget)
        total = int((take * lengths).sum())
        assert (take >= 0).all() and (take <= counts).all() and total <= budget
        if budget <= mixing.SLACK * lengths.max():
            assert total == max(s for s in reach if s <= budget)


def test_mix(spark):
    rows = [(i, "big", 50 + i % 13) for i in range(900)] + [(1000 + i, "small", 30 + i % 7) for i in range(60)] + [(5, None, 9), (6, "other", 9), (7, "big", None), (8, "big", 0), (9, "big", 51), (9, "big", 51)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").withColumn("repeats", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 2)], "source string, target_share double, max_repeats int")
    out = mixing.mixed(docs, targets)
    got = out.collect()
    tokens_of = {s: sum(r.n_tokens * r.repeats for r in got if r.source == s) for s in ("big", "small")}
    assert tokens_of["small"] == 2 * sum(30 + i % 7 for i in range(60)) and abs(tokens_of["big"] / sum(tokens_of.values()) - 0.7) < 1e-3
    assert {r.source for r in got} == {"big", "small"} and all(1 <= r.repeats <= (2 if r.source == "small" else 1) for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixed(docs.repartition(3), targets).collect()))
    assert mixing.mixed(docs.limit(0), targets).count() == 0


def test_tokens(spark):
    text = "a few words, <|endoftext|> and more " * 3000
    piece, tokens.PIECE = tokens.PIECE, 1000
    try:
        assert tokens.count_tokens(text) == len(tokens.encoding(tokens.DEFAULT_VOCABULARY).encode_ordinary(text))
    finally:
        tokens.PIECE = piece
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word")], "doc_id long, text string")
    assert [r.n_tokens for r in tokens.with_tokens(df).orderBy("doc_id").collect()] == [0, 0, 1]
