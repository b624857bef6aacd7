"""Removal of repeated byte strings with per-shard suffix arrays (operator 7).

A byte goes if it lies in a ``LENGTH``-byte string of its text that also starts
anywhere else, in the same document or another; strings are judged on the input.

A corpus is not sorted whole: only what may repeat reaches a suffix array.

1. Anchors.  The anchor of a ``LENGTH``-byte window is its leftmost least hash
   of ``SEED`` bytes, so equal windows have equal anchors at equal places.  A
   run is a maximal row of windows with one anchor; it has the anchor's hash and
   a fingerprint of all its bytes.  One numpy pass, one narrow row per run.
2. Runs whose anchor hash occurs once in the corpus hold nothing that repeats.
   Runs with equal anchors and fingerprints repeat as a whole.  What is left are
   the edges of repeats: runs of a kind of their own whose anchor is shared.
3. Shards.  One text span per kind (a few hundred bytes) is sorted by anchor and
   cut into shards of about ``SHARD`` bytes.  A shard gets a suffix array by
   Larsson-Sadakane refinement (ranks by 8 bytes, then doubling, only groups
   still tied are sorted again) and common prefixes by Kasai's rule, run in many
   lanes of text at once.  Windows tied over ``LENGTH`` bytes repeat.
4. Merging.  A window's partners share its anchor, so only anchors cut by a
   shard's border are open.  For these every shard gives its windows' 128-bit
   digests, sorted and dealt by range; a range's runs are merged, and each run is
   looked up in the merged one by binary search.

Hot anchors are pre-counted before each shuffle and cut over shards and ranges,
so no group has to fit one task; a document's own runs are bounded by its text.

Null and empty texts lose nothing.  Repeated rows are documents of their own, so
a repeated text of ``LENGTH`` bytes goes whole; null ids take part.  Rows of one
(or null) id are told apart by a 128-bit hash of their texts.  Long texts
are read in overlapping pieces.  An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.llm import common

LENGTH = 200
SEED = 32
PIECE = 1 << 21
SHARD = 1 << 21
LANE = 128
_random = np.random.default_rng(3)
BYTES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _random.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_BITS = np.uint64(24)


def _seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each position, by doubling."""
    h, size = BYTES[data], 1
    for factor in FACTORS:
        if size == SEED:
            break
        h = h[:-size] * factor + h[size:]
        size *= 2
    return common.mix(h)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start in text, windows, anchor hash, fingerprint) of every run."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    seeds = _seed_hashes(data)
    low = (seeds >> PLACE_BITS << PLACE_BITS) | np.arange(len(seeds), dtype=np.uint64)
    width, size = LENGTH - SEED + 1, 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[:size - width], low[width - size:])
    anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int32)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    inside = np.flatnonzero(text[:n - LENGTH + 1] == text[LENGTH - 1:])
    if not len(inside):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    at = anchor[inside]
    first = np.ones(len(inside), bool)
    first[1:] = at[1:] != at[:-1]  # texts never share an anchor
    begin = np.flatnonzero(first)
    windows = np.diff(np.append(begin, len(inside)))
    start = inside[begin]
    power, inverse = common.powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    end = start + windows - 1 + LENGTH
    fingerprint = common.mix((sums[end] - sums[start]) * inverse[start] + windows.astype(np.uint64))
    return (text[start].astype(np.int64), start - offsets[text[start]], windows,
            seeds[at[begin]].view(np.int64), fingerprint.view(np.int64))


def _find_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "print", "doc_id", "text_hash", "place"]
    for batch in batches:
        for part in common.pieces(batch, "text", PIECE):
            data, offsets = common.text_buffer(part.column(2))
            cuts = [(data, offsets, 0)]
            if len(data) > PIECE and part.num_rows == 1:  # one long text
                cuts = [(data[lo:lo + PIECE + LENGTH - 1], np.array([0, len(data[lo:lo + PIECE + LENGTH - 1])]), lo)
                        for lo in range(0, len(data), PIECE)]
            for own, bounds, base in cuts:
                text, start, windows, anchor, fingerprint = runs(own, bounds)
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(fingerprint), part.column(0).take(rows), part.column(1).take(rows),
                     pa.array(((start + base) << 8) | windows)], names=names)


# ---------------------------------------------------------------- one shard


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order, by Larsson-Sadakane refinement; the end sorts first."""
    n = len(data)
    key = _eight(data)
    tail = np.arange(max(0, n - 7), n)[::-1]  # shorter than 8 bytes: before longer equals, never tied
    order = np.concatenate((tail, np.arange(n - len(tail))))
    order = order[np.argsort(key[order], kind="stable")]
    sorted_key, short = key[order], order > n - 8
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    edge = np.flatnonzero(np.concatenate(
        ([True], (sorted_key[1:] != sorted_key[:-1]) | short[1:] | short[:-1])))
    size = np.diff(np.append(edge, n))
    rank[order] = np.repeat(edge, size)
    depth = 8
    while True:
        tied = np.repeat(size > 1, size)
        if not tied.any():
            return order
        spots = np.flatnonzero(tied)
        rows = order[spots]
        nxt = rank[np.minimum(rows + depth, n)] + 1
        both = rank[rows] * (n + 1) + nxt
        by = np.argsort(both, kind="stable")
        rows, both = rows[by], both[by]
        order[spots] = rows  # groups keep their places
        new = np.concatenate(([True], both[1:] != both[:-1]))
        group = np.flatnonzero(new)
        count = np.diff(np.append(group, len(rows)))
        rank[rows] = np.repeat(spots[group], count)
        head = ~tied
        head[spots[group]] = True
        size = np.diff(np.append(np.flatnonzero(head), n))
        depth *= 2


def _eight(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number (zeros beyond the end)."""
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(data)]
    return out


def common_prefixes(data: np.ndarray, order: np.ndarray, cap: int = 2 * LENGTH) -> np.ndarray:
    """Common prefix (up to ``cap``) of each suffix with the one before it in order.

    Kasai's rule (the prefix of the next position is at most one shorter) runs
    along many lanes of the text side by side.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    key = np.concatenate((_eight(data), np.zeros(cap + 16, np.uint64)))
    by_position = np.zeros(n, np.int64)
    lanes = np.arange(0, n, LANE)
    length = np.zeros(len(lanes), np.int64)
    for step in range(LANE):
        at = lanes + step
        live = np.flatnonzero(at < n)
        at = at[live]
        other = before[at]
        length[live] = np.maximum(length[live] - 1, 0)
        length[live[other < 0]] = 0
        grow = live[other >= 0]
        p, q = at[other >= 0], other[other >= 0]
        while len(grow):
            h = length[grow]
            differ = key[np.minimum(p + h, n)] ^ key[np.minimum(q + h, n)]
            same = np.zeros(len(grow), np.int64)
            for k in range(8):
                same += differ < np.uint64(1) << np.uint64(8 * k)
            h = np.minimum(np.minimum(h + same, n - np.maximum(p, q)), cap)
            length[grow] = h
            more = (same == 8) & (h < cap) & (h < n - np.maximum(p, q))
            grow, p, q = grow[more], p[more], q[more]
        by_position[at] = length[live]
    return by_position[order]


def repeated_windows(data: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Positions marked ``real`` whose LENGTH bytes start at two real positions or more."""
    order = suffix_array(data)
    group = np.cumsum(common_prefixes(data, order) < LENGTH)
    counts = np.bincount(group, real[order].astype(np.int64), group[-1] + 1 if len(group) else 0)
    out = np.zeros(len(data), bool)
    out[order] = counts[group] >= 2
    return out & real


def _spans_of_true(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


FOUND = "doc_id bigint, text_hash binary, first bigint, last bigint"


def _shards(ranges: int, limit: int):
    """Per shard of kinds sorted by anchor: windows found repeated, and open windows.

    Rows hold doc_id, text_hash, first and last window start of what is found, or
    (``digests`` not null) one digest range of the open windows.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.binary()), ("first", pa.int64()), ("last", pa.int64()),
        ("part", pa.int32()), ("digests", pa.list_(pa.binary())), ("docs", pa.list_(pa.int64())),
        ("hashes", pa.list_(pa.binary())), ("starts", pa.list_(pa.int64()))])

    def shard(rows: list[tuple], opened: set[int]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        starts = np.cumsum([0] + [len(r[5]) for r in rows[:-1]])
        real = np.zeros(len(data) + 1, np.int32)
        real[starts] += 1
        real[starts + [r[4] for r in rows]] -= 1
        again = repeated_windows(data, np.cumsum(real[:-1]).astype(bool))
        out: dict[str, list] = {name: [] for name in schema.names}

        def add(**values) -> None:
            for name in schema.names:
                out[name].append(values.get(name))

        open_rows: dict[int, list[tuple]] = {}
        for (anchor, doc, text_hash, start, n, span, copies), at in zip(rows, starts.tolist()):
            if copies == 1:
                for a, b in _spans_of_true(again[at:at + n]):
                    add(doc_id=doc, text_hash=text_hash, first=start + a, last=start + b - 1)
            if anchor in opened:
                for k in range(n):
                    digest = hashlib.blake2b(span[k:k + LENGTH], digest_size=16).digest()
                    ask = copies == 1 and not again[at + k]  # else only others ask for it
                    open_rows.setdefault(int.from_bytes(digest[:4]) * ranges >> 32, []).append(
                        (digest, doc, text_hash, start + k if ask else -1))
        for part, found in sorted(open_rows.items()):
            found.sort(key=lambda r: r[0])
            kept = [r for i, r in enumerate(found) if i == 0 or found[i - 1][0] != r[0]]
            add(part=part, digests=[r[0] for r in kept],
                docs=[r[1] for r in kept], hashes=[r[2] for r in kept], starts=[r[3] for r in kept])
        return pa.RecordBatch.from_pydict(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, opened, begun = 0, set(), False  # open: the partition's first and last anchor, and those a border cuts
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if not begun:
                    opened, begun = {row[0]}, True
                if size >= limit:
                    cut = {row[0]} if held[-1][0] == row[0] else set()
                    yield shard(held, opened | cut)
                    held, size, opened = [], 0, cut
                held.append(row)
                size += len(row[5])
        if held:
            yield shard(held, opened | {held[-1][0]})

    return run


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Open windows of one digest range that another shard has too."""
    found = [np.array([bytes(d) for d in run], "S16") for run in rows["digests"]]  # each sorted and distinct
    merged = np.sort(np.concatenate(found), kind="stable")
    out = []
    for run, docs, hashes, starts in zip(found, rows["docs"], rows["hashes"], rows["starts"]):
        shards = np.searchsorted(merged, run, "right") - np.searchsorted(merged, run, "left")
        for k in np.flatnonzero((shards > 1) & (np.asarray(starts) >= 0)).tolist():
            out.append((docs[k], hashes[k], starts[k], starts[k]))
    frame = pd.DataFrame(out, columns=["doc_id", "text_hash", "first", "last"])
    return frame.astype({"doc_id": "Int64", "first": "int64", "last": "int64"})


# ---------------------------------------------------------------- the corpus


def _cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text spans of the kinds listed per document."""
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.binary()),
                        ("start", pa.int64()), ("windows", pa.int32()), ("span", pa.binary()), ("copies", pa.int64())])
    for batch in batches:
        for part in common.pieces(batch, "text"):
            data, offsets = common.text_buffer(part.column(2))
            out: list[tuple] = []
            for i, (doc, text_hash, kinds) in enumerate(zip(
                    part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(3).to_pylist())):
                for kind in kinds:
                    start, n = kind["place"] >> 8, kind["place"] & 255
                    lo = offsets[i] + start
                    out.append((kind["anchor"], doc, text_hash, start, n, data[lo:lo + n - 1 + LENGTH].tobytes(),
                                kind["copies"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)


def repeated(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, text_hash, first, last): window starts whose LENGTH bytes repeat.

    ``docs`` has doc_id, text_hash (16 bytes) and text (not null).
    """
    n = common.partitions(docs.sparkSession)
    found = common.materialize(common.map_arrow(
        docs.select("doc_id", "text_hash", "text"), _find_runs,
        "anchor bigint, print bigint, doc_id bigint, text_hash binary, place bigint"), "suffix-runs")
    # written before the join: a side that is aggregated in the join's own stage keeps
    # Spark from splitting a hot anchor
    often = common.materialize(
        found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "suffix-often")
    shared = common.materialize(found.join(often, "anchor"), "suffix-shared")
    kinds = common.materialize(shared.groupBy("anchor", "print").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_hash", "place")).alias("one")), "suffix-kinds")
    whole = shared.join(kinds.where("copies > 1").select("anchor", "print"), ["anchor", "print"])
    start, windows = F.shiftright("place", 8), F.col("place").bitwiseAND(F.lit(255))
    whole = whole.select("doc_id", "text_hash", start.alias("first"), (start + windows - 1).alias("last"))
    mixed = common.materialize(
        kinds.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "suffix-mixed")
    edges = kinds.join(mixed, "anchor").select("one.doc_id", "one.text_hash", F.struct(
        "anchor", "copies", F.col("one.place").alias("place")).alias("kind"))
    edges = edges.groupBy("doc_id", "text_hash").agg(F.collect_list("kind").alias("kinds"))  # bounded by the text
    edges = edges.toDF("id", "hash", "kinds")
    texts = docs.join(edges, docs["doc_id"].eqNullSafe(edges["id"]) & (docs["text_hash"] == edges["hash"]))
    spans = common.materialize(common.map_arrow(
        texts.select("doc_id", "text_hash", "text", "kinds"), _cut_spans,
        "anchor bigint, doc_id bigint, text_hash binary, start bigint, windows int, span binary, copies bigint"),
        "suffix-spans")
    # rows that repeat give a kind of several copies more than once; one is enough
    once = spans.where("copies > 1").dropDuplicates(["anchor", "doc_id", "text_hash", "start"])
    spans = spans.where("copies = 1").unionByName(once)
    dealt = spans.repartitionByRange(n, "anchor", F.xxhash64("doc_id", "start")).sortWithinPartitions("anchor")
    judged = common.materialize(common.map_arrow(
        dealt, _shards(n, shard), "doc_id bigint, text_hash binary, first bigint, last bigint, part int, digests array<binary>,"
        " docs array<bigint>, hashes array<binary>, starts array<bigint>"), "suffix-shards")
    merged = judged.where("digests IS NOT NULL").groupBy("part").applyInPandas(_merge, FOUND)
    return (whole.unionByName(judged.where("digests IS NULL").select("doc_id", "text_hash", "first", "last"))
            .unionByName(merged))


def _remove(whole_characters: bool):
    """Texts without the bytes covered by repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            hits = batch.column(batch.schema.get_field_index("hits"))
            kept, sizes, gone, spans = [], [], [], []
            for text, found in zip(batch.column(at), hits):
                raw = (text.as_py() or "").encode()
                found = found.as_py() or []
                if found:
                    cover = np.zeros(len(raw) + 1, np.int32)
                    first = np.array([f["first"] for f in found])
                    last = np.array([f["last"] for f in found])
                    np.add.at(cover, first, 1)
                    np.add.at(cover, last + LENGTH, -1)
                    removed = _spans_of_true(np.cumsum(cover[:-1]) > 0)
                else:
                    removed = []
                if whole_characters:  # a character cut by a border stays
                    removed = [(a, b) for a, b in (_inward(raw, a, b) for a, b in removed) if a < b]
                out, last_end = [], 0
                for a, b in removed:
                    out.append(raw[last_end:a])
                    last_end = b
                out.append(raw[last_end:])
                kept.append(b"".join(out))
                sizes.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                spans.append(len(removed))
            columns = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] not in ("text", "hits")]
            names = [c for c in batch.schema.names if c not in ("text", "hits")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, pa.int64())], names=[*names, "kept_bytes", "n_bytes", "n_removed", "n_spans"])

    return run


def _inward(raw: bytes, a: int, b: int) -> tuple[int, int]:
    while a < b and raw[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def remove_repeats(docs: DataFrame, whole_characters: bool = False, shard: int = SHARD) -> DataFrame:
    """doc_id, row (the document's own columns), kept_bytes, n_bytes, n_removed, n_spans."""
    text = F.coalesce("text", F.lit(""))
    keys = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    keys = keys.withColumn("text_hash", F.unhex(F.md5(F.col("text").cast("binary"))))
    hits = repeated(keys.select("doc_id", "text_hash", "text"), shard)
    # rows that repeat find the same; one of each, so that a list is bounded by its text
    hits = hits.groupBy("doc_id", "text_hash", "first", "last").agg(F.count("*"))
    hits = hits.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("hits"))
    hits = hits.toDF("id", "hash", "hits")
    joined = keys.join(hits, keys["doc_id"].eqNullSafe(hits["id"]) & (keys["text_hash"] == hits["hash"]), "left")
    joined = joined.select("doc_id", "row", "text", "hits")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return common.map_arrow(joined, _remove(whole_characters),
                            f"doc_id bigint, row {kinds['row']}, kept_bytes binary, n_bytes bigint,"
                            " n_removed bigint, n_spans bigint")


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents without their repeated passages, in whole characters; the
    columns stay, and ``n_chars`` (if there is one) counts the text that is left."""
    cleaned = remove_repeats(docs, whole_characters=True).withColumn("text", F.col("kept_bytes").cast("string"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*[columns[c].alias(c) for c in docs.columns])
