import random
from functools import reduce

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import quality

TEXTS = [
    None, "", " ", "\n\n", "One sentence of plain words, and the end of it.", "- a\n- b\n- c\n- d", "a\tb\tc\nd\te\tf\n1\t2\t3", "Name: X\nRole: Y\n\nName: Z\nRole: W\n", "loading... " * 30,
    "T h e l e t t e r s a r e a p a r t h e r e", "x" * 500, "| a | b |\n| c | d |\n", "no end\r\nof line\rhere and there", "In ^h1 ~nd, th~ y#^nge~# p|ay^r 1#k|d",
]


def figures(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("clash"))
    return {r.doc_id: r.asDict() for r in quality.quality_statistics(df, **options).collect()}


def test_chunks_agree_with_whole_texts(spark):
    rnd = random.Random(7)
    words = ["the", "of", "and", "curtain", "le", "a", "Ghost", "x1", "été"]
    seams = [" ", "\n", "\r\n", ", ", "; ", ".\n- ", "\t", "|", "  ", ". ", " / "]
    made = ["".join(rnd.choice(words) + rnd.choice(seams) for _ in range(rnd.randrange(1, 160))) for _ in range(25)]
    rows = list(enumerate(TEXTS + made))
    whole = figures(spark, rows, chunk_chars=1 << 16)
    for size in (5, 37):
        cut = figures(spark, rows, chunk_chars=size, max_chars=1 << 12)
        for i, text in rows:
            assert whole[i] == cut[i], (i, text, size, {k: (whole[i][k], cut[i][k]) for k in whole[i] if whole[i][k] != cut[i][k]})


PIECES = st.sampled_from(["the ", "of", "curtain", "é", "Σ", "-", "*", "1. ", "a) ", ": ", ":", ";", ",", " ", "  ", "/", " / ", "\n", "\r\n", "\r", "\u2028", "\u0085", "\t", "|", ".", "!", "…", "Ã", "Â", "â€", "#", "^", "1", "(", ")", "&", "{", "}", "😀", "x" * 45])


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=40), st.lists(st.integers(0, 1 << 30), min_size=1, max_size=6))
def test_merge_is_exact_and_associative(parts, cuts):
    rules = quality.QualityRules()
    text = "".join(parts)
    at = sorted({c % (len(text) + 1) for c in cuts} | {0, len(text)})
    at = [c + (text[c - 1 : c + 1] == "\r\n" if 0 < c < len(text) else 0) for c in at]
    pieces = [text[a:b] for a, b in zip(at, at[1:]) if a < b]
    sums, _ = quality.measured(pa.array([text]), rules, whole=True)
    want = {k: int(v[0]) for k, v in sums.items()}
    state = lambda: quality.measured(pa.array(pieces), rules, whole=False)[1]
    left = reduce(lambda a, b: quality.merged(a, b, rules), state())
    right = reduce(lambda b, a: quality.merged(a, b, rules), reversed(state()))
    assert quality.closed(left, rules) == want and quality.closed(right, rules) == want


def test_variety_reads_whole_lines_and_words():
    rules = quality.QualityRules()
    long = [f"{'same beginning of a line ' * 3}{i}" for i in range(40)]
    words = [f"{'w' * 40}{chr(97 + i)}" for i in range(20)]
    sums, _ = quality.measured(pa.array(["\n".join(long), " ".join(words), "\n".join(f"line {i % 500}" for i in range(3000))]), rules, whole=True)
    assert list(sums["line_variety"][:2]) == [40, 1] and sums["word_variety"][1] == 20
    assert 350 < sums["line_variety"][2] < 700


def test_line_ends_of_two_letters(spark):
    whole, cut = (figures(spark, [(1, "Name: A\r\n" * 16)], **o)[1] for o in ({}, {"chunk_chars": 8, "max_chars": 1 << 12}))
    assert whole == cut and whole["blanks"] == 1


def test_edges_and_classes(spark):
    got = figures(spark, [(1, None), (2, ""), (None, "a b"), (3, "The end."), (3, "The end.")])
    assert got[1]["words"] == got[2]["words"] == 0 and got[1]["mean_word_length"] == 0.0 and got[None]["words"] == 2
    assert (got[3]["words"], got[3]["lines"], got[3]["ended"], got[3]["word_chars"], got[3]["common"]) == (2, 1, 1, 6, 1)
    prose = "The house was full and the play went on until the end of the night. It was a good evening for all of us, they said."
    rows = [(0, prose), (1, "- one\n- two\n- three\n- four"), (2, "a,b,c\n1,2,3\n4,5,6"), (3, "#### ==== ~~~~ #### ~~~~ ===="), (4, "")]
    out = quality.classified(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text_class for r in out.collect()} == {0: "prose", 1: "list", 2: "table", 3: "junk", 4: "junk"}
    assert quality.quality_statistics(spark.createDataFrame([], "doc_id long, text string")).count() == 0
