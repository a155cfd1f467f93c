"""Connected components of a table of links, without collecting links anywhere.

Each round first contracts the links inside every partition by union-find, so that a partition passes on a spanning
forest at most, and then hooks roots to the smallest neighbour's root and halves the paths. Depth falls by a constant
factor a round, so the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphforge.llm.common import Workspace, lookup


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over the links a-b: each node that is not its tree's smallest, with that smallest."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(ids)))
    n = len(a)
    for x, y in zip(at[:n].tolist(), at[n:].tolist(), strict=True):
        while up[x] != x:
            up[x] = x = up[up[x]]
        while up[y] != y:
            up[y] = y = up[up[y]]
        if x < y:
            up[y] = x
        elif y < x:
            up[x] = y
    for i in range(len(up)):  # a parent is always smaller, so one pass in order reaches the roots
        up[i] = up[up[i]]
    root = np.array(up, np.int64)
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[moved], ids[root[moved]]


def contract(links: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Links (a, b) of each partition replaced by a spanning forest of theirs, in chunks of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_a, held_b, n = [], [], 0

        def flush() -> tuple[np.ndarray, np.ndarray]:
            return forest(np.concatenate(held_a), np.concatenate(held_b))

        for batch in batches:
            held_a.append(batch.column(0).to_numpy())
            held_b.append(batch.column(1).to_numpy())
            n += batch.num_rows
            if n >= chunk:
                x, y = flush()
                if len(x) > chunk // 2:  # little was gained: pass it on and start anew
                    yield pa.record_batch({"a": x, "b": y})
                    held_a, held_b, n = [], [], 0
                else:
                    held_a, held_b, n = [x], [y], len(x)
        if n:
            x, y = flush()
            if len(x):
                yield pa.record_batch({"a": x, "b": y})

    return links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "a long, b long")


def components(work: Workspace, links: DataFrame, name: str = "cc") -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node that links reach from it.

    Links with a null end, and links of a node to itself, count for nothing. An empty table gives an empty table. Nodes that
    very many others point to are looked up without a shuffle (see `lookup`).
    """
    links = links.where("a is not null and b is not null and a <> b")
    left = work.write(contract(links), f"{name}_links0")
    grown: list[DataFrame] = []
    k = 0
    while not left.isEmpty():
        # Each node takes the smallest of its neighbours that is below it as parent; pointer jumping then flattens the trees.
        both = left.union(left.select(F.col("b"), F.col("a"))).toDF("node", "other")
        parents = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("up"))
        parents = work.write(parents, f"{name}_up{k}_0")
        jump = 0
        while True:
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
            nxt = work.write(lookup(work, parents, above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), f"{name}_up{k}_{jump + 1}")
            work.drop(f"{name}_up{k}_{jump}")
            jump += 1
            parents = nxt.select("node", "up")
            if nxt.where("moved").isEmpty():
                break
        grown.append(parents)
        on_a, on_b = parents.toDF("a", "ra"), parents.toDF("b", "rb")
        half = work.write(lookup(work, left, on_a, "a"), f"{name}_half")
        nxt = lookup(work, half, on_b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        left = work.write(contract(nxt.repartition("a", "b")), f"{name}_links{k + 1}")
        work.drop(f"{name}_links{k}", f"{name}_half")
        k += 1
    if not grown:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = grown[0].toDF("node", "root")
    for i, up in enumerate(grown[1:]):
        found = work.write(lookup(work, found, up.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root")), f"{name}_found{i}")
    return found
