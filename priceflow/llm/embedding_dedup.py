"""Embedding near-duplicates by an inverted multi-index (operator 9).

Vectors are compared only within a label and a length.  Equal vectors are one
class.  Each half of the unit vectors has a codebook of its own (k-means on at
most ``SAMPLE`` classes); the pair of nearest centroids is a class's home cell
in the product grid.  The codebooks' size grows with the label, so that a hot
label has as few vectors to a cell as any other.  A class visits cells in the
order of d1 + d2 by the multi-sequence traversal: a heap over the two sorted
distance lists, so its memory is a vector's own lists and not the grid.  Cells
that the geometry rules out are left out: a vector of the cell would be farther
than the threshold allows from this one.  How many cells are visited is set on
the sample: neighbours just at the threshold, in random directions, must be
found with ``TARGET_RECALL``.  The exact mode traverses the least distances to
the cells instead and ends only at the threshold, so that no link is lost.

Each visited cell is verified exactly, in double precision, block by block;
large cells are split into blocks of ``BLOCK`` homes and visitors.  A pair that
both sides could find is counted by the visitor only if the home does not visit
the visitor's cell, else each side counts for itself, so no pair needs to be
written out.  Blocks give partial counts and a spanning forest of their links.

A vector that is null, of length 0, zero, or holds null or non-finite
components, and a vector with a null label, links with nothing: no links, its
own component.  Rows with the same id are vectors of their own; a null id takes
part, and a component's name is its smallest id that is not null.  An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.llm import common
from priceflow.llm.components import components, spanning

THRESHOLD = 0.98
SAMPLE = 8192
TARGET_RECALL = 0.995
PER_CELL = 64
BLOCK = 2048
SEED = 11


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    random = np.random.default_rng(SEED)
    centres = x[random.choice(len(x), k, replace=False)]
    for _ in range(12):
        near = squared(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1))


def multi_sequence(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of places in two ascending lists, by ascending sum: (i, j) enters the heap
    once (i - 1, j) and (i, j - 1) have left it, so it holds at most one pair a row."""
    heap, left = [(float(a[0] + b[0]), 0, 0)], {}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield i, j
        left[i] = j
        if i + 1 < len(a) and (j == 0 or left.get(i + 1, -1) >= j - 1):
            heapq.heappush(heap, (float(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or left.get(i - 1, -1) >= j + 1):
            heapq.heappush(heap, (float(a[i] + b[j + 1]), i, j + 1))


class Index:
    """Two codebooks of ``k`` centroids and the number of cells to visit (None: all that
    the geometry does not rule out, so that no link is lost)."""

    def __init__(self, sample: np.ndarray, k: int, threshold: float, exact: bool = False):
        self.threshold = threshold
        x = unit(sample)
        self.half = max(1, x.shape[1] // 2)
        self.k = k = min(k, len(x))
        self.books = [kmeans(np.ascontiguousarray(part), k) for part in (x[:, :self.half], x[:, self.half:])]
        self.visits = None if exact else self._needed(x)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(x[:, :self.half], self.books[0]), squared(x[:, self.half:], self.books[1])

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """Home cell, and the cells to visit in multi-sequence order, of unit vectors.

        With a number of visits the sequences are the distances to the centroids; without,
        the least distances to their cells, and the traversal ends at the threshold.
        """
        halves = self.distances(x)
        home = halves[0].argmin(1) * self.k + halves[1].argmin(1)
        gaps = [self._gap(d, book) for d, book in zip(halves, self.books)]
        keys = gaps if self.visits is None else halves
        orders = [np.argsort(key, axis=1, kind="stable") for key in keys]
        reach = 2 - 2 * self.threshold + 1e-9
        out = []
        for r in range(len(x)):
            (first, second), row = (o[r] for o in orders), []
            apart, other = gaps[0][r][first], gaps[1][r][second]
            for n, (i, j) in enumerate(multi_sequence(keys[0][r][first], keys[1][r][second])):
                if n == self.visits or (self.visits is None and apart[i] + other[j] > reach):
                    break
                if apart[i] + other[j] <= reach:
                    row.append(int(first[i]) * self.k + int(second[j]))
            out.append(row)
        return home, out

    @staticmethod
    def _gap(d: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Squared distance to the border between the nearest cell and each cell."""
        near = d.argmin(1)
        apart = np.sqrt(squared(book, book))[near]
        gap = (d - d[np.arange(len(d)), near][:, None]) / np.maximum(2 * apart, 1e-12)
        return np.where(apart > 1e-9, gap, 0) ** 2

    def _needed(self, x: np.ndarray) -> int:
        """Visits that find TARGET_RECALL of neighbours just at the threshold."""
        random = np.random.default_rng(SEED)
        x = x[:2048]
        noise = random.normal(size=x.shape)
        noise = unit(noise - (noise * x).sum(1)[:, None] * x)
        other = unit(self.threshold * x + np.sqrt(1 - self.threshold ** 2) * noise)
        homes = [d.argmin(1) for d in self.distances(other)]
        d1, d2 = self.distances(x)
        rows = np.arange(len(x))
        cost, ascending = d1[rows, homes[0]] + d2[rows, homes[1]], np.sort(d2, axis=1)
        # cells before the neighbour's: one search in the second list for each entry of the first
        rank = [int(np.searchsorted(ascending[r], cost[r] - d1[r], "left").sum()) for r in rows]
        return int(np.quantile(rank, TARGET_RECALL, method="higher")) + 1


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _stack(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def classes(vectors: DataFrame) -> DataFrame:
    """(cid, label, dim, vec, m, first_id): one row per distinct comparable vector."""
    vec = F.col("embedding")
    good = (F.col("label").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
            & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(vec, lambda x: x != 0))
    rows = vectors.select("vec_id", "label", "embedding").where(F.coalesce(good, F.lit(False)))
    grouped = rows.groupBy("label", F.col("embedding").alias("vec")).agg(
        F.count("*").alias("m"), F.min("vec_id").alias("first_id"))
    return common.materialize(grouped.select(
        F.monotonically_increasing_id().alias("cid"), "label", F.size("vec").alias("dim"), "vec", "m", "first_id"),
        "embedding-classes")


def link_classes(found: DataFrame, threshold: float = THRESHOLD, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cid, links) partial counts of linked vectors in other classes, and links (a, b)
    that span every block's components."""
    spark = found.sparkSession
    groups = found.groupBy("label", "dim").agg(F.count("*").alias("n"))
    side = F.lit(2).cast("double") ** F.least(F.lit(8.0), F.greatest(F.lit(0.0), F.rint(
        F.log2(F.greatest(F.lit(1.0), F.col("n") / PER_CELL)) / 2)))
    groups = common.materialize(groups.withColumn("k", side.cast("int")), "embedding-groups")
    size = groups.agg(F.max("dim").alias("width"), F.collect_set("k").alias("sides")).first()  # at most 9 sizes
    width = max(2, size["width"] or 2)
    if not size["sides"]:
        return (spark.createDataFrame([], "cid bigint, links bigint"), spark.createDataFrame([], "a bigint, b bigint"))
    sample = found.orderBy(F.xxhash64("cid")).limit(SAMPLE).select("vec").toPandas()["vec"]  # bounded by the parameter
    sample = _stack(sample, width)
    indexes = {k: Index(sample, k, threshold, exact) for k in size["sides"]}

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            for k, own in rows.groupby("k", sort=True):
                for lo in range(0, len(own), 1024):
                    part = own.iloc[lo:lo + 1024]
                    home, visits = indexes[int(k)].cells(unit(_stack(part["vec"], width)))
                    yield part.drop(columns="k").assign(home=home.astype("int32"), visits=visits)

    common.ship(spark)
    sized = found.drop("first_id").join(groups.drop("n"), ["label", "dim"]).select(
        "cid", "label", "dim", "vec", "m", "k")
    placed = common.materialize(sized.mapInPandas(
        place, "cid bigint, label int, dim int, vec array<float>, m bigint, home int, visits array<int>"),
        "embedding-index")
    key = ["label", "dim", "cell"]
    visitors = placed.withColumn("cell", F.explode("visits"))
    homes = placed.toDF(*placed.columns).withColumn("cell", F.col("home"))  # columns of its own
    n_homes = homes.groupBy(*key).agg(F.count("*").alias("n_homes"))
    n_visitors = visitors.groupBy(*key).agg(F.count("*").alias("n_visitors"))
    sizes = common.materialize(n_homes.join(n_visitors, key).select(
        *key, F.ceil(F.col("n_homes") / BLOCK).cast("int").alias("home_blocks"),
        F.ceil(F.col("n_visitors") / BLOCK).cast("int").alias("visitor_blocks")), "embedding-cells")

    def blocks(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(sizes, key)
        mine = F.pmod(F.xxhash64("cid"), F.col(f"{own}_blocks")).cast("int")
        return rows.select("cid", "label", "dim", "vec", "m", "home", "visits", "cell", mine.alias(f"{own}_block"),
                           F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"))

    def verify(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Homes against visitors of one block of one cell."""
        if left.empty or right.empty:
            return pd.DataFrame({"cid": [], "links": [], "a": [], "b": []}, dtype="Int64")
        h, v = _stack(left["vec"], width), _stack(right["vec"], width)
        cosine = (v @ h.T) / np.linalg.norm(v, axis=1)[:, None] / np.linalg.norm(h, axis=1)
        hc, vc = left["cid"].to_numpy(), right["cid"].to_numpy()
        p, q = np.nonzero(cosine >= threshold)
        other = vc[p] != hc[q]
        p, q = p[other], q[other]
        visits = [set(x) for x in left["visits"]]
        v_home = right["home"].to_numpy()
        back = np.array([v_home[i] in visits[j] for i, j in zip(p, q)], bool)
        ids, at = np.unique(np.concatenate((vc, hc)), return_inverse=True)
        links = np.bincount(at[p], left["m"].to_numpy()[q], len(ids))
        links += np.bincount(at[len(vc) + q], np.where(back, 0, right["m"].to_numpy()[p]), len(ids))
        root = spanning(len(ids), at[p], at[len(vc) + q])
        some = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return pd.DataFrame({"cid": ids[some], "links": links[some].astype(int), "a": ids[some], "b": ids[root[some]]})

    group = [*key, "home_block", "visitor_block"]
    out = blocks(homes, "home", "visitor").groupBy(*group).cogroup(
        blocks(visitors, "visitor", "home").groupBy(*group)).applyInPandas(
        verify, "cid bigint, links bigint, a bigint, b bigint")
    out = common.materialize(out, "embedding-links")
    return out.select("cid", "links"), out.select("a", "b")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, exact: bool = False) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector.

    ``exact`` visits every cell that the geometry allows instead of a set number.
    """
    vectors = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                             F.col("label").cast("int").alias("label"),
                             F.col("embedding").cast("array<float>").alias("embedding"))
    found = classes(vectors)
    links, edges = link_classes(found, threshold, exact)
    totals = links.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(edges).withColumnRenamed("node", "cid")
    named = found.join(joined, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    table = named.join(names, "component").join(totals, "cid", "left").select(
        "label", F.col("vec").alias("embedding"), "component_id",
        (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    rows = vectors.withColumn("key", F.xxhash64("embedding"))
    table = table.withColumn("key", F.xxhash64("embedding"))
    out = rows.join(table, (rows["label"] == table["label"]) & (rows["key"] == table["key"])
                    & (rows["embedding"] == table["embedding"]), "left")
    linked = table["n_links"].isNotNull()
    component = F.when(linked, table["component_id"]).otherwise(rows["vec_id"])
    return out.select(rows["vec_id"], F.coalesce(table["n_links"], F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(rows["vec_id"]).alias("kept"))
