import random
from datetime import date, timedelta

from marquee.operators.intervals import periods_and_gaps

SCHEMA = "key string, start_date date, end_date date, kind string, from_day string"
D0 = date(2026, 1, 1)


def brute(rows, min_rows):
    days = {}
    count = {}
    for k, s, e, *_ in rows:
        if k is None or s is None or e is None or e < s:
            continue
        count[k] = count.get(k, 0) + 1
        days.setdefault(k, set()).update(s + timedelta(i) for i in range((e - s).days + 1))
    out = set()
    for k, held in days.items():
        if count[k] < min_rows:
            continue
        ordered = sorted(held)
        starts = [d for d in ordered if d - timedelta(1) not in held]
        ends = [d for d in ordered if d + timedelta(1) not in held]
        out |= {(k, "period", str(s), str(e)) for s, e in zip(starts, ends)}
        out |= {(k, "gap", str(e + timedelta(1)), str(s - timedelta(1))) for e, s in zip(ends, starts[1:])}
    return out


def got(spark, rows, min_rows=2):
    df = spark.createDataFrame(rows, SCHEMA)
    out = [tuple(r) for r in periods_and_gaps(df, "key", "start_date", "end_date", min_rows=min_rows).collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_against_days(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(1500):
        s = D0 + timedelta(rnd.randrange(9000)) if rnd.random() < 0.95 else None
        e = s + timedelta(rnd.choice([-3, 0, 1, 5, 40, 300])) if s and rnd.random() < 0.95 else None
        rows.append((rnd.choice(["hot"] * 8 + ["a", "b", None, "", "c"]), s, e, "x", "y"))
    rows += rows[:50]
    assert got(spark, rows) == brute(rows, 2)


def test_edges(spark):
    d = lambda n: D0 + timedelta(n)
    assert got(spark, []) == set()
    assert got(spark, [("k", d(0), d(1), "", ""), ("k", None, d(9), "", ""), ("k", d(5), d(4), "", "")]) == set()
    touching = [("k", d(0), d(1), "", ""), ("k", d(2), d(3), "", ""), ("k", d(5), d(5), "", "")]
    assert got(spark, touching) == {("k", "period", "2026-01-01", "2026-01-04"), ("k", "period", "2026-01-06", "2026-01-06"), ("k", "gap", "2026-01-05", "2026-01-05")}
    same = [("k", d(0), d(0), "", "")] * 2
    assert got(spark, same) == {("k", "period", "2026-01-01", "2026-01-01")}
