"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import ROW_BYTES, written

#: Edges up to which one task finishes the graph: at 16 bytes each, a few megabytes.
TASK_EDGES = 200_000


def _union_find(batches):
    """Roots of all nodes of a small edge list, smallest node first; runs in one task."""
    import pyarrow as pa

    parent: dict = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    kind = None
    for batch in batches:
        kind = batch.schema.field("u").type
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(n) for n in nodes], kind)], ["node", "component"])


def connected_components(edges: DataFrame, folder: str, *, a: str = "a", b: str = "b", max_rounds: int = 50, task_edges: int = TASK_EDGES) -> DataFrame:
    """``node, component``: the smallest node of the component of each node on an edge.

    Alternating large-star and small-star rounds: each rewires the edges round a node to the
    smallest neighbour, until no edge changes; the number of rounds grows with the logarithm of
    the longest path. Every round is two aggregations keyed by node and is written to ``folder``
    to cut the lineage. A node with very many edges is safe: its smallest neighbour is a plain
    aggregate and its edges are never gathered into an array. Loops and repeated edges are fine;
    edges with a null end are ignored; no edges give no rows. A graph counted to have at most
    ``task_edges`` edges is finished by union-find in one task; the result is the same. The result's
    ``counted`` bounds its rows and ``measured`` its bytes (see :func:`~marquee.session.small`);
    they hold for numeric nodes.
    """
    work = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(
        F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct()

    def stored(df: DataFrame) -> tuple[DataFrame, tuple]:
        """The written table and a digest of its rows, taken while it is written."""
        seen = Observation()
        watched = df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        table = written(watched, folder, "edges")
        return table, (seen.get.get("n", 0), seen.get.get("h"))

    def star(df: DataFrame, large: bool) -> DataFrame:
        both = df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.filter(F.col("v") < F.col("u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.filter(F.col("u") != F.col("v")).distinct()

    work, before = stored(work)
    if before[0] <= task_edges:
        kind = work.schema["u"].dataType.simpleString()
        # not written: over the written edges it is one short task, for each use
        return _counted(work.coalesce(1).mapInArrow(_union_find, f"node {kind}, component {kind}"), before[0])
    for _ in range(max_rounds):
        if not before[0]:
            break
        work, now = stored(star(star(work, True), False))
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return _counted(work.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        work.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), before[0])


def _counted(groups: DataFrame, edges: int) -> DataFrame:
    """``groups`` with the most rows it can have, and the most memory, from the counted edges."""
    groups.counted = 2 * edges
    groups.measured = groups.counted * (ROW_BYTES + 16)
    return groups
