"""Connected components of a link table, for any number of links.

Alternating large-star and small-star steps: every step is a grouped minimum
and a join, so no component is ever gathered in one task.  Each round is
written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.llm.common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its least neighbour."""
    if large:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # written before the join, so that Spark can split a hot node there
    least = materialize(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    joined = near.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.explode(F.array(
            F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b"))))
            .alias("l")).select("l.*")
    return out.where("a != b").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component): component is the least node reachable; nodes without
    links are not listed.  Links are (a, b) longs in any order, repeats allowed."""
    links = materialize(links.select("a", "b").where("a != b").distinct(), "links")
    before = _state(links)
    while before[0]:
        links = materialize(_star(_star(links, True), False), "stars")
        after = _state(links)
        if after == before:
            break
        before = after
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each node's component among the n nodes of one block, by
    label spreading over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
