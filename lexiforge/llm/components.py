"""Connected components by alternating large and small stars, with checkpoints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each batch as stars around the smallest node of its components."""
    for batch in batches:
        u, v = (c.to_numpy() for c in batch.columns)
        nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
        root = np.arange(len(nodes))
        a, b = ends[: len(u)], ends[len(u) :]
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            while not np.array_equal(root, root[root]):
                root = root[root]
            if np.array_equal(root, before):
                break
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    ``edges`` has two bigint columns.  Nulls and loops are no edges.
    """
    u, v = edges.columns
    start = edges.select(F.greatest(u, v).cast("long").alias("u"), F.least(u, v).cast("long").alias("v"))
    start = start.filter("u is not null and v is not null and u > v")
    now = materialize(start.mapInArrow(_contract, "u long, v long").distinct(), "components")
    mark = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("k", "m"))
        now = materialize(small.filter("u <> v").distinct(), "components")
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == tuple(sums):
            return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), F.least("u", "component").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = tuple(sums)
