"""Filling containers of fixed capacity with items: best two fit.

A bin is filled greedily with the largest item that fits. Then its smallest item is taken out if
two unpacked items fill the widened gap more tightly than it did. Items are spread over shards
of bounded size by a hash; each shard is packed by one task, and the items of badly filled bins
go into fewer shards of a next round, so that only a last shard can leave slack.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir, written

#: Items per shard, the fill below which a bin's items are packed again, and rounds.
SHARD_ITEMS = 8_000
GOOD_FILL = 0.98
ROUNDS = 4


def best_two_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of positions into ``sizes``; all sizes are from 0 to ``capacity``."""
    order = np.argsort(sizes, kind="stable")
    stacks: dict[int, list[int]] = {}
    for position in order:
        stacks.setdefault(int(sizes[position]), []).append(int(position))
    count = np.zeros(capacity + 1, dtype=np.int64)
    for size, stack in stacks.items():
        count[size] = len(stack)
    grid = np.arange(capacity + 1)
    bins: list[list[int]] = []
    left = int(count[1:].sum())
    while left:
        inside: list[int] = []
        gap = capacity
        present = np.flatnonzero(count[1:]) + 1
        while gap > 0 and len(present):
            fit = np.searchsorted(present, gap, side="right") - 1
            if fit < 0:
                break
            size = int(present[fit])
            inside.append(size)
            count[size] -= 1
            gap -= size
            if not count[size]:
                present = present[present != size]
        if gap and len(present) and len(inside) > 1:
            small = inside[-1] if inside[-1] == min(inside) else min(inside)
            room = gap + small
            first = present[: np.searchsorted(present, room, side="left")]
            if len(first):
                largest = np.maximum.accumulate(np.where(count[: room + 1] > 0, grid[: room + 1], 0))
                second = largest[room - first]
                twin = (second == first) & (count[first] < 2)
                if twin.any():
                    below = largest[np.maximum(first[twin] - 1, 0)]
                    second = second.copy()
                    second[twin] = below
                total = np.where(second > 0, first + second, 0)
                best = int(np.argmax(total))
                if total[best] > small:
                    inside.remove(small)
                    count[small] += 1
                    for size in (int(first[best]), int(second[best])):
                        inside.append(size)
                        count[size] -= 1
        left = int(count[1:].sum())
        bins.append([stacks[s].pop() for s in inside])
    if stacks.get(0):
        if not bins:
            bins.append([])
        bins[-1].extend(stacks[0])
    return bins


def _pack_shards(items: DataFrame, capacity: int) -> DataFrame:
    """Columns of ``items`` plus ``bin`` and ``filled``; one task per shard."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc", "part", "row"], kind="stable").reset_index(drop=True)
        sizes = part["tokens"].to_numpy()
        number, filled = np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=np.int64)
        for i, inside in enumerate(best_two_fit(sizes, capacity)):
            number[inside], filled[inside] = i, sizes[inside].sum()
        return part.assign(bin=number, filled=filled)

    return items.groupBy("shard").applyInPandas(pack, items.schema.simpleString()[7:-1].replace(":", " ", len(items.columns)) + ", bin long, filled long")


def packed(items: DataFrame, capacity: int, *, id: str = "doc_id", tokens: str = "n_tokens", shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``doc, part, parts, tokens, pack``: each item once, or in parts if it exceeds the capacity.

    Only an item above ``capacity`` is split: into full parts and a rest. Null sizes count as 0;
    empty items share the last bin of their shard. Rows of a repeated id are items of their own;
    null ids are kept. ``pack`` numbers are unique, not dense.
    """
    folder = work_dir(items.sparkSession)
    size = F.coalesce(F.col(tokens), F.lit(0)).cast("long")
    # ids may be null or repeated: a row is known by its own number, and by that it is spread
    whole = items.select(F.col(id).cast("string").alias("doc"), F.greatest(size, F.lit(0)).alias("size"), F.monotonically_increasing_id().alias("row"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int")
    pieces = whole.withColumn("parts", parts).select("doc", "row", "parts", "size", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(
        "doc", "row", "part", "parts", F.least(F.lit(capacity), F.col("size") - F.col("part").cast("long") * capacity).cast("long").alias("tokens"))
    rest = written(pieces, folder, "items")
    done = []
    for turn in range(ROUNDS):
        count = rest.count()
        if not count:
            break
        shards = max(1, -(-count // shard_items))
        sharded = rest.withColumn("shard", F.pmod(F.xxhash64("row", "part", F.lit(turn)), F.lit(shards)).cast("int"))
        result = written(_pack_shards(sharded, capacity).withColumn("turn", F.lit(turn)), folder, "packs")
        last = shards == 1 or turn == ROUNDS - 1
        done.append(result if last else result.filter(F.col("filled") >= GOOD_FILL * capacity))
        if last:
            break
        rest = result.filter(F.col("filled") < GOOD_FILL * capacity).select("doc", "row", "part", "parts", "tokens")
    if not done:
        return pieces.drop("row").withColumn("pack", F.lit(0).cast("long"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    number = (F.col("turn").cast("long") * (1 << 28) + F.col("shard")) * (1 << 32) + F.col("bin")
    return out.select("doc", "part", "parts", "tokens", number.alias("pack"))
