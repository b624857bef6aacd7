"""Merkle manifest of a table, by nested intervals (operator 13).

A document's leaf is the sha256 of its id, source, lang, n_chars and text.  The
leaves of a source, in order of id, are the leaves of the source's tree; the
roots of the sources, in order of source, are the leaves of the top tree.
Every node carries the interval [lo, hi) of leaf ranks that it covers.  While
a tree has several nodes, every ``FANOUT`` consecutive ones become the hash of
their digests (a shorter last run too, even of one node).

Levels are built by grouping nodes by the bucket lo / FANOUT ** level: groups
of at most ``FANOUT`` rows, however hot a source is.  Ancestors are attached
from the top down, one join per level: a node meets the one node of the next
level in its bucket whose interval contains its own, and the children of that
node before and after the node's interval (the interval difference) are its
siblings on the left and on the right.  The last step, to the documents,
unfolds each lowest node's children in place.  A path of FANOUT - 1 digests a
level is carried per lowest node, not per document.

Leaf ranks are counted in slices of the order, so no task holds a source.

Defined results: leaves of a source ascend by id, a null id first, and equal
ids by leaf; equal rows are equal leaves, and stand next to each other.  A null
source is a tree of its own, the first.  Nulls hash as ``-``, empty texts as
``0:``.  A null id is never tampered with.  A table of one row has that row's
leaf as root, and an empty table gives no rows.  Only the five columns of a
leaf are read; other columns make no difference.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceflow.llm.common import materialize
from priceflow.operators.numbering import sequence_number

FANOUT = 16
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATH = "array<struct<left:string,right:string>>"


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """sha256 of the row's fields, each with its length, a null as '-'."""
    return F.sha2(F.concat(*[_field(replaced.get(c, F.col(c))) for c in LEAF_COLUMNS]), 256)


def is_tampered() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, changed): changed is the leaf after tampering."""
    changed = F.when(is_tampered(), leaf_digest(text=F.translate("text", UPPER, UPPER.lower())))
    leaf = leaf_digest()
    return docs.select(*LEAF_COLUMNS).select("doc_id", "source", leaf.alias("leaf"),
                                             F.coalesce(changed, leaf).alias("changed"))


def _runs(nodes: DataFrame, tree: list[str], size: int, extra: tuple[str, ...]) -> DataFrame:
    """Runs of consecutive nodes: (tree, bucket, children in order, single, lo, hi, digest).

    A first bucket with a single child is its tree's end: the child is the root, and
    the run is no node of its own.
    """
    child = F.struct("lo", "hi", "digest", *extra)
    runs = (nodes.groupBy(*tree, F.floor(F.col("lo") / size).alias("bucket"))
            .agg(F.sort_array(F.collect_list(child)).alias("children")))
    digests = F.array_join(F.transform("children", lambda c: c["digest"]), "")
    return runs.select(
        *tree, "bucket", "children", ((F.col("bucket") == 0) & (F.size("children") == 1)).alias("single"),
        F.get("children", F.lit(0))["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
        F.sha2(digests, 256).alias("digest"))


def build(leaves: DataFrame, tree: list[str], leaf_count: int, name: str,
          extra: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, from the leaves up, and (tree, root).

    ``leaves`` holds (tree, lo, hi, digest, extra); ``leaf_count`` is the size of the
    largest tree.  The runs of level k are FANOUT ** k leaf ranks wide.
    """
    levels, roots, nodes, size = [], [], leaves, FANOUT
    while True:
        runs = materialize(_runs(nodes, tree, size, () if levels else extra), f"{name}-{len(levels) + 1}")
        levels.append(runs)
        roots.append(runs.where("single").select(*tree, F.get("children", F.lit(0))["digest"].alias("root")))
        if size // FANOUT >= leaf_count:  # one node was left in every tree
            return levels, reduce(DataFrame.unionByName, roots)
        nodes, size = runs.where("NOT single"), size * FANOUT


def step(children: Column, lo: Column, hi: Column) -> Column:
    """Siblings of the node [lo, hi): its parent's children before and after it."""
    def text(kept: Column) -> Column:
        return F.array_join(F.transform(kept, lambda c: c["digest"]), "")

    return F.struct(text(F.filter(children, lambda c: c["hi"] <= lo)).alias("left"),
                    text(F.filter(children, lambda c: c["lo"] >= hi)).alias("right"))


def child_path(children: Column, single: Column, path: Column, lo: Column, hi: Column) -> Column:
    """Path of a run's child [lo, hi): one step more than the run's, unless it is the root."""
    return F.when(single, path).otherwise(F.concat(F.array(step(children, lo, hi)), path))


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def attach(levels: list[DataFrame], tree: list[str], starts: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """The lowest runs with their paths and the ``carried`` columns of ``starts``.

    ``starts`` holds (tree, path, carried): where the path of a tree's root begins.  From
    the top: a run that holds a root takes that; any other joins the run of the next
    level that its bucket names and whose interval contains its own.
    """
    above = None
    for runs in reversed(levels):
        ends = runs.where("single").alias("n").join(starts.alias("s"), _same("n", "s", tree)).select(
            "n.*", "s.path", *[f"s.{c}" for c in carried])
        if above is None:
            above = ends
            continue
        here = runs.where("NOT single").withColumn("up", F.floor(F.col("bucket") / FANOUT))
        parent = above.withColumnRenamed("bucket", "up")
        joined = here.alias("n").join(parent.alias("p"), _same("n", "p", [*tree, "up"])
                                      & (F.col("p.lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("p.hi")))
        path = child_path(F.col("p.children"), F.col("p.single"), F.col("p.path"), F.col("n.lo"), F.col("n.hi"))
        above = joined.select("n.*", path.alias("path"), *[f"p.{c}" for c in carried]).drop("up").unionByName(ends)
    return above


def unfold(runs: DataFrame, names: tuple[str, ...], carried: tuple[str, ...]) -> DataFrame:
    """One row per child of the lowest runs, with its own path: no shuffle."""
    child = F.transform("children", lambda c: F.struct(
        *[c[x].alias(x) for x in names],
        child_path(F.col("children"), F.col("single"), F.col("path"), c["lo"], c["hi"]).alias("path")))
    return runs.select(*carried, F.inline(child))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, path, changed): path is bottom-up."""
    found = materialize(leaves(docs), "merkle-leaves")
    # a hot source is cut into slices; equal (source, doc_id, leaf) are equal rows
    ranked = sequence_number(found, ["source"], ["doc_id", "leaf"], "hi")
    ranked = materialize(ranked.select("source", "doc_id", "changed", F.col("leaf").alias("digest"),
                                       (F.col("hi") - 1).alias("lo"), "hi"), "merkle-ranks")
    largest = ranked.agg(F.max("hi")).first()[0]
    if largest is None:
        return found.select("doc_id", "source", "leaf", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"),
                            F.array().cast(PATH).alias("path"), "changed")
    levels, subroots = build(ranked, ["source"], largest, "merkle-source", ("doc_id", "changed"))

    # the top tree: its leaves are the sources' roots
    tops = sequence_number(materialize(subroots, "merkle-subroots"), [], ["source"], "hi")
    tops = materialize(tops.select(F.lit(0).alias("tree"), "source", F.col("root").alias("digest"),
                                   (F.col("hi") - 1).alias("lo"), "hi"), "merkle-tops")
    top_levels, roots = build(tops, ["tree"], tops.count(), "merkle-top", ("source",))
    start = roots.select("tree", "root", F.array().cast(PATH).alias("path"))
    sources = unfold(attach(top_levels, ["tree"], start, ("root",)), ("source", "digest"), ("root",))
    sources = materialize(sources.withColumnRenamed("digest", "subroot"), "merkle-sources")

    runs = attach(levels, ["source"], sources, ("subroot", "root"))
    rows = unfold(runs, ("doc_id", "digest", "changed"), ("source", "subroot", "root"))
    return rows.select("doc_id", "source", F.col("digest").alias("leaf"), "subroot", "root", "path", "changed")


def verify(rows: DataFrame) -> DataFrame:
    """manifest + proof digest, the root folded from the changed leaf, and the verdict."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("path", F.col("changed"),
                         lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))
    return rows.select("*", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
