import random

import pytest

from marquee.operators.components import connected_components
from marquee.session import work_dir


@pytest.mark.parametrize("task_edges", [0, 1000])
def test_components(spark, task_edges):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3), (500, 501), (500, 501)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for u, v in edges:
        if u is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, work_dir(spark), task_edges=task_edges).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(df.limit(0), work_dir(spark), task_edges=task_edges).count() == 0
