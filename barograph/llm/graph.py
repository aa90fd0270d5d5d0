"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.session import WorkArea


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component, for links ``a``–``b`` among nodes 0 to n - 1."""
    label = np.arange(n)
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while (label != (up := label[label])).any():
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def forest(links: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the same nodes as the links of a task, each node to the smallest that it reaches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = roots(len(nodes), at[: len(a)], at[len(a) :])
        own = label != np.arange(len(nodes))
        return nodes[label[own]], nodes[own]

    for batch in links:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        count += batch.num_rows
        if count > 1_000_000:
            held = [joined()]
            if len(held[0][0]) > 500_000:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, held.pop())), ["a", "b"])
            count = sum(len(x[0]) for x in held)
    if held:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, joined())), ["a", "b"])


def components(area: WorkArea, links: DataFrame, name: str, forests: bool = False) -> DataFrame:
    """node and component (smallest node reachable) for every node of ``links`` (a, b: long).

    Each task first replaces its links by a forest, unless ``forests`` says that the Python step which finds
    them has done so: a second Python step in one stage takes a second worker for every task. Then large-star and small-star rounds link every node to the
    smallest of its neighbours until no link changes. A round joins each link with one row per node. These rows are
    staged first: where they are few, the join is a broadcast of known size, and where they are many, a join of two plain
    shuffles, in which adaptive execution can split a node of many links.
    """
    links = links.select("a", "b") if forests else links.select("a", "b").mapInArrow(forest, "a long, b long")
    links = area.stage(links.filter("a <> b"), f"{name}-links-0")
    step = 0
    while True:
        step += 1
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
        least = area.stage(least, f"{name}-least-{step}-large")
        large = both.filter("b > a").join(least, F.col("a") == F.col("node")).select(F.col("low").alias("a"), "b")
        large = area.stage(large.filter("a <> b").distinct(), f"{name}-links-{step}-large")
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), "low")
        low = area.stage(low, f"{name}-least-{step}")
        joined = down.join(low, F.col("u") == F.col("node"))
        small = joined.select(F.col("low").alias("a"), F.col("v").alias("b")).union(low.select(F.col("low").alias("a"), F.col("node").alias("b")))
        small = area.stage(small.filter("a <> b").distinct(), f"{name}-links-{step}")
        # Done when every node has one link and no node is at both a lower and an upper end.
        state = small.select(F.col("a").alias("n"), F.lit(1).alias("top"), F.lit(0).alias("under")).union(small.select("b", F.lit(0), F.lit(1)))
        per_node = state.groupBy("n").agg(F.max("top").alias("top"), F.sum("under").alias("under"))
        if per_node.filter("under > 1 OR (top = 1 AND under > 0)").isEmpty():
            break
        links = small
    return small.select(F.col("b").alias("node"), F.col("a").alias("component")).union(small.select("a", "a").distinct())
