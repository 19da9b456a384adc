"""Connected components of a table of links, without gathering them anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import narrow, stored

POINTERS = pa.schema([("node", pa.int64()), ("root", pa.int64())])


#: Links that a task joins at a time.
HELD = 200_000
BROADCAST_ROWS = 500_000


def _roots(a: np.ndarray, z: np.ndarray) -> pa.RecordBatch:
    """Each node of these links that is not the smallest it reaches by them, with that smallest."""
    nodes, at = np.unique(np.concatenate([a, z]), return_inverse=True)
    a, z = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[z])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[z], low)
        new = np.minimum(new, new[new])
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], schema=POINTERS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links become pointers of each node to the smallest node it reaches among those held together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= HELD:
            yield _roots(*(np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1)))
            held = []
    if held:
        yield _roots(*(np.concatenate([x.column(k).to_numpy() for x in held]) for k in (0, 1)))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root: for each node of links (a, b) that is not the smallest of its component, the smallest.

    Each round joins links within tasks, gives a node that points to several roots the smallest, and links the others to that. What points to a
    node that points on is moved to where that points, so that chains over many tasks get shorter in every round. Rounds are written; they end when no node points to several roots, or to a node that points on."""
    edges = links.select(F.col("a").cast("long").alias("node"), F.col("b").cast("long").alias("root")).where("node != root")
    while True:
        # Every node comes once from what is held together, so none has many rows.
        local = edges.mapInArrow(_joined, "node long, root long").repartition("node")
        both = local.join(local.groupBy("node").agg(F.min("root").alias("least")), "node")
        lower = F.when(F.col("root") == F.col("least"), F.col("node")).otherwise(F.col("root"))
        edges = stored(both.select(lower.alias("node"), F.col("least").alias("root")), f"{name}-round")
        seen = edges.select("node", "root", F.lit(0).alias("aim")).unionByName(edges.select(F.col("root").alias("node"), F.col("root"), F.lit(1).alias("aim")))
        wrong = seen.groupBy("node").agg(F.min(F.when(F.col("aim") == 0, F.col("root"))).alias("low"), F.max(F.when(F.col("aim") == 0, F.col("root"))).alias("high"), F.max("aim").alias("aim"))
        if wrong.where("low < high OR (aim = 1 AND low IS NOT NULL)").isEmpty():
            return stored(edges.distinct(), f"{name}-done")
        onward = wrong.where("aim = 1 AND low IS NOT NULL").select(F.col("node").alias("root"), "low")
        edges = edges.join(narrow(onward, BROADCAST_ROWS), "root", "left").select("node", F.coalesce("low", "root").alias("root"))
