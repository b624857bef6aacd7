"""Near-duplicate documents by MinHash and a multi-index Hamming join (operator 3).

A document's set is its distinct 5-word shingles (lower-cased A-Z, words split
at ASCII white space; a text of one to four words is one shingle).  Equal sets
are one class.  A class's signature has ``HASHES`` symbols of 16 bits.

Signatures of two sets at the similarity threshold differ in more than
``radius`` places with a probability below ``MISS``; all pairs within the radius
are found by pigeonhole: the signature is split into radius // 2 + 1 chunks, so
one of them has at most one error, and every chunk is indexed once per place
left out, which enumerates its allowed errors.

Buckets of the index do not become pairs.  First each class is compared with
one neighbour, that class of its buckets which shares the most buckets with
others (what a group was copied from comes first); what links is joined into
components.  A pair inside a component can add nothing, so only buckets with
several components stay open.  Their classes are put into blocks of about
``BLOCK`` with the same neighbour, and blocks that meet in an open bucket are
compared as a whole, by matrix products over their full sets, inside one task;
only links that span what they join are written.  Every link is confirmed on
full sets, so the components are those of all links.

Null and empty texts have no shingles and link with nothing: their component is
their own id.  Repeated rows and equal sets fall into one class.  Null ids take
part, but a component is named by its smallest id that is not null; ``kept``
marks rows whose id is that name (also null against null).  An empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.llm import common
from priceflow.llm.components import components, spanning

WORDS = 5
HASHES = 64
MISS = 1e-6
BLOCK = 256
_random = np.random.default_rng(5)
MULTIPLY = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
PLACE = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def radius(percent: int) -> int:
    """Least r with P(more than r of the symbols differ | similarity) < MISS."""
    p, tail, r = 1 - percent / 100, 1.0, -1
    while tail >= MISS:
        r += 1
        tail -= comb(HASHES, r) * p ** r * (1 - p) ** (HASHES - r)
    return r


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    starts, _, h = common.words(data, offsets, common.SPACED, common.LOWER)
    bounds = common.per_text(starts, offsets).tolist()
    joined = np.zeros(0, np.uint64)
    if len(h) >= WORDS:
        joined = common.mix(sum((h[k:len(h) - WORDS + 1 + k] * PLACE[k] for k in range(1, WORDS)),
                                h[:len(h) - WORDS + 1] * PLACE[0]))
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo >= WORDS:
            out.append(np.unique(joined[lo:hi - WORDS + 1]))
        elif hi > lo:
            short = (h[lo:hi] * PLACE[:hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(common.mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES 16-bit symbols per set that is not empty."""
    every = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint16)
    for k in range(HASHES):
        least = np.minimum.reduceat(every * MULTIPLY[k] + ADD[k], at)
        out[:, k] = common.mix(least) >> np.uint64(48)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.pieces(batch):
            sets = shingle_sets(*common.text_buffer(part.column(1)))
            full = [i for i, s in enumerate(sets) if len(s)]
            symbols: list[bytes | None] = [None] * len(sets)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full])):
                    symbols[i] = row.tobytes()
            low = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            high = np.array([common.mix(s ^ ADD[0]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(low),
                 pa.array(high), pa.array(symbols, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "low", "high", "symbols"])


def _index(bounds: list[int]):
    """(key, cid): one key per chunk and left-out place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                cid = part.column(0).to_numpy()
                rows = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, HASHES)
                rows = rows.astype(np.uint64) + np.uint64(1)
                for c, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    terms = rows[:, a:b] * (MULTIPLY[a:b] ^ ADD[c])
                    whole = terms.sum(axis=1, dtype=np.uint64)
                    for k in range(b - a):
                        key = common.mix((whole - terms[:, k]) ^ (ADD[a + k] + np.uint64(c)))
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(cid)],
                                                         names=["key", "cid"])

    return run


def _confirm(percent: int):
    """Links among rows (a, b, text_a, text_b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None  # neighbours in a join often share their first class
        for batch in batches:
            for part in common.pieces(batch, "text_b"):
                firsts = part.column(0).to_pylist()
                seconds = shingle_sets(*common.text_buffer(part.column(3)))
                linked = []
                for i, (first, other) in enumerate(zip(firsts, seconds)):
                    if first != last:
                        last, kept = first, shingle_sets(*common.text_buffer(part.column(2).slice(i, 1)))[0]
                    both = len(np.intersect1d(kept, other, assume_unique=True))
                    linked.append(100 * both >= percent * (len(kept) + len(other) - both))
                yield part.filter(pa.array(linked, pa.bool_())).select(["a", "b"])

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections among the sets of one block, by matrix products."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    often = count[column] > 1
    column, owner = column[often], owner[often]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    column = np.cumsum(np.concatenate(([0], column[1:] != column[:-1]))) if len(column) else column
    out = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        a, b = np.searchsorted(column, (lo, lo + 8192))
        table = np.zeros((len(sets), 8192), np.float32)
        table[owner[a:b], column[a:b] - lo] = 1
        out += table @ table.T
    return out


def _compare_blocks(percent: int):
    """Spanning links among the classes of a pair of blocks that are in different components."""
    def links(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        cid, component = (np.array([r[k] for r in rows], np.int64) for k in (3, 4))
        side = np.array([r[2] == r[0] for r in rows])
        sets = shingle_sets(*common.text_buffer(pa.array([r[5] for r in rows], pa.string())))
        size = np.array([len(s) for s in sets], np.float64)
        both = shared_counts(sets).astype(np.float64)
        near = 100 * both >= percent * (size[:, None] + size - both)
        near &= component[:, None] != component
        if not side.all():
            near &= side[:, None] != side
        a, b = np.nonzero(near)
        root = spanning(len(rows), a, b)
        some = np.flatnonzero(root != np.arange(len(rows)))
        return cid[some], cid[root[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:2] != held[0][:2]:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, links(held))), names=["a", "b"])
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, links(held))), names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (and text_hash): one row per document."""
    r = radius(percent)
    chunks = r // 2 + 1
    bounds = [HASHES * c // chunks for c in range(chunks + 1)]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    signed = common.materialize(common.map_arrow(
        rows, _sign, "doc_id bigint, text_hash bigint, n_shingles bigint, low bigint, high bigint, symbols binary"),
        "minhash-signatures")
    same = ["n_shingles", "low", "high"]
    classes = common.materialize(
        signed.where("n_shingles > 0").groupBy(*same).agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one"),
            F.first("symbols").alias("symbols"))
        .select(F.monotonically_increasing_id().alias("cid"), "*"), "minhash-classes")

    index = common.map_arrow(classes.select("cid", "symbols"), _index(bounds), "key bigint, cid bigint")
    # written before the join, so that Spark can split a hot key there
    often = common.materialize(index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "minhash-often")
    shared = common.materialize(index.join(often, "key").select("key", "cid", "n"), "minhash-buckets")
    # the text that others were copied from shares the most buckets with them
    weight = shared.groupBy("cid").agg(F.sum("n").alias("weight"))
    centre = shared.join(weight, "cid").groupBy("key").agg(F.max(F.struct("weight", "cid")).alias("centre"))
    nearest = common.materialize(shared.select("key", "cid").join(centre, "key").groupBy("cid").agg(
        F.max("centre").alias("centre")).select("cid", F.col("centre.cid").alias("centre")), "minhash-centres")
    one = F.col("one")
    wanted = nearest.join(classes.select("cid", one["doc_id"].alias("id"), one["text_hash"].alias("hash")), "cid")
    # the text of one document per class that shares a bucket; of equal rows one, so that classes bound blocks
    texts = common.materialize(
        rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["id"]) & (rows["text_hash"] == wanted["hash"]))
        .select("cid", "centre", "text").dropDuplicates(["cid"]), "minhash-texts")

    def confirm(pairs: DataFrame) -> DataFrame:
        return common.map_arrow(pairs, _confirm(percent), "a bigint, b bigint")

    firsts = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")).join(
        nearest.select(F.col("centre").alias("a")).distinct(), "a", "left_semi")
    stars = texts.where("cid != centre").select(F.col("centre").alias("a"), F.col("cid").alias("b"),
                                              F.col("text").alias("text_b"))
    links = common.materialize(confirm(stars.join(firsts, "a").select("a", "b", "text_a", "text_b")), "minhash-links")
    joined = components(links)

    # pairs in different components that share a bucket
    named = shared.select("key", "cid").join(joined.withColumnRenamed("node", "cid"), "cid", "left").select(
        "key", "cid", F.coalesce("component", "cid").alias("component"))
    mixed = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    open_rows = common.materialize(named.join(mixed.select("key"), "key"), "minhash-open")
    members = open_rows.select("cid", "component").distinct().join(nearest, "cid")
    crowd = members.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    part = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    members = common.materialize(members.join(crowd, "centre").select(
        "cid", "component", F.xxhash64("centre", part).alias("block")), "minhash-members")
    meeting = common.materialize(
        open_rows.select("key", "cid").join(members.select("cid", "block"), "cid").select("key", "block").distinct(),
        "minhash-meeting")
    other = meeting.select(F.col("key").alias("k"), F.col("block").alias("other"))
    pairs = common.materialize(
        meeting.join(other, (F.col("key") == F.col("k")) & (F.col("block") <= F.col("other")))
        .select("block", "other").distinct(), "minhash-blocks")
    bodies = members.join(texts.select("cid", "text"), "cid")
    near, far = bodies.withColumnRenamed("block", "own"), bodies.toDF(*bodies.columns).withColumnRenamed("block", "own")
    columns = ["block", "other", F.col("own").alias("side"), "cid", "component", "text"]
    rows_of = near.join(pairs, near["own"] == pairs["block"]).select(*columns).unionByName(
        far.join(pairs, (far["own"] == pairs["other"]) & (pairs["block"] != pairs["other"])).select(*columns))
    dealt = rows_of.repartition(common.partitions(docs.sparkSession), "block", "other")
    more = common.materialize(common.map_arrow(
        dealt.sortWithinPartitions("block", "other"), _compare_blocks(percent), "a bigint, b bigint"), "minhash-more")
    joined = components(links.unionByName(more))

    # the document that stays: least id of the component (a null id last), then least hash
    rank = F.struct(F.col("one.doc_id").isNull().alias("none"), "one.doc_id", "one.text_hash")
    named = classes.join(joined.withColumnRenamed("node", "cid"), "cid", "left").select(
        *same, rank.alias("rank"), F.coalesce("component", "cid").alias("component"))
    names = named.groupBy("component").agg(F.min("rank").alias("keeper"))
    table = named.join(names, "component").select(*same, "keeper")
    out = signed.select("doc_id", "text_hash", *same).join(table, same, "left")
    keeper = F.col("keeper")
    component = F.when(keeper.isNotNull(), keeper["doc_id"]).otherwise(F.col("doc_id"))
    stays = keeper.isNull() | (keeper["doc_id"].eqNullSafe(F.col("doc_id")) & (keeper["text_hash"] == F.col("text_hash")))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"), stays.alias("stays"))


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each near-duplicate group, with its own columns only.

    Rows that repeat an id and its text are one document.
    """
    key, text_hash = F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       key.alias("id"), text_hash.alias("hash"))
    kept = near_duplicates(docs, percent).where("stays").select("doc_id", "text_hash").distinct()
    same = rows["id"].eqNullSafe(kept["doc_id"]) & (rows["hash"] == kept["text_hash"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "hash"]).select("row.*")
