"""Connected components of links between 64-bit nodes, as Spark joins and aggregations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest links that connect what the links a-b connect: each node and the least of its group."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        for side in (left, right):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (columns a, b): the root is the least node reached.

    Every round hands the least label over each link, to the node and to its present root, and
    then replaces labels by their own labels, so paths shorten by a factor each round. Labels
    only fall: equal sums mean that nothing changed. Links of a node with many of them meet its
    one label in a join whose large side Spark can split; minima are combined before shuffles.
    """
    both = stored(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    total = F.sum(F.col("root").cast("decimal(38,0)"))
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "labels"
    )
    before = labels.agg(total).head()[0]
    while True:
        offered = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("low"))
            .join(labels, "node")
        )
        lower = (
            offered.select(
                F.explode(
                    F.array(
                        F.struct("node", F.least("low", "root").alias("root")),
                        F.struct(F.col("root").alias("node"), F.least("low", "root").alias("root")),
                    )
                ).alias("x")
            )
            .groupBy("x.node")
            .agg(F.min("x.root").alias("root"))
        )
        lower = stored(lower, "lower")
        their = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = stored(lower.join(their, "root").select("node", F.col("next").alias("root")), "labels")
        after = labels.agg(total).head()[0]
        if after == before:
            return labels
        before = after
