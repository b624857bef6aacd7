"""Byte-level BPE encoding and decoding (operator 4).

Every distinct word is encoded once, whatever the corpus:

1. each task splits its texts into pre-tokens (the public pattern) and packs
   about ``CHUNK`` characters of documents into one row: the chunk's distinct
   pre-tokens, and every document as the sequence of their numbers (that is,
   each pre-token with its positions);
2. the chunks' pre-tokens are exploded and shuffled by a hash of their bytes:
   a row holds a chunk's pre-tokens of one of ``CELLS`` hash cells.  Equal ones
   meet in their cell, the merges run once, and each chunk gets the ids back;
3. chunks and ids are joined by chunk and the documents' ids reassembled by
   position.  Decoding looks the ids up in the token-byte table, whose size is
   the vocabulary's.

A word as common as a third of all tokens travels once per chunk, and cells are
streamed row by row, holding one cell's distinct words.

Null and empty texts have no ids.  Rows are encoded one by one, repeated rows
alike; null ids pass through; an empty table gives an empty result; other
columns are not read.  A text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.llm import common

CHUNK = 32_000_000
CELLS = 1 << 15
VOCABULARY = "byte_bpe_50k.tiktoken"
#: White space as the rank files' own splitter knows it: the Unicode property,
#: without the four separators that this library counts in.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def splitter(pattern: str = public_tokenizers.PATTERN) -> regex.Pattern:
    own = pattern.replace(r"[^\s", rf"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
    return regex.compile(own)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked neighbouring pair is merged first,
    the leftmost of equals, until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 200:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        at, best = -1, None
        for i, rank in enumerate(pairs):
            if rank is not None and (best is None or rank < best):
                at, best = i, rank
        if best is None:
            return [ranks[p] for p in parts]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and a linked list, for very long pre-tokens."""
    parts: list[bytes | None] = [word[i:i + 1] for i in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts):
            rank = ranks.get(parts[i] + parts[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= len(parts) or parts[j] != b:
            continue  # one of the two has been merged since
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[p] for p in parts if p is not None]


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays as one compressed value (lengths first)."""
    raw = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    sizes = np.array([len(r) for r in raw], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(raw))


def _unpack(value: bytes, n: int) -> list[memoryview]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(value))
    out, at = [], 8 * n
    for size in np.frombuffer(raw, np.int64, n).tolist():
        out.append(raw[at:at + size])
        at += size
    return out


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: all low bytes first, which compresses better."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _chunk_rows(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter(pattern).findall
        part = TaskContext.get().partitionId()
        made = 0
        number: dict[str, int] = {}
        ids: list[int | None] = []
        codes: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            words = [w.encode() for w in number]
            value = _pack(np.array([len(w) for w in words], np.int32), b"".join(words),
                          np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids]),
                          np.array([len(c) for c in codes], np.int64), _planes(np.concatenate(codes)))
            return pa.RecordBatch.from_pydict({"chunk": [(part << 32) + made], "value": [value]})

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                found = find(text)
                for word in found:
                    if word not in number:
                        number[word] = len(number)
                ids.append(doc)
                codes.append(np.fromiter(map(number.__getitem__, found), np.uint32, len(found)))
                size += len(text) + 1
                if size >= CHUNK:
                    yield row()
                    made += 1
                    number, ids, codes, size = {}, [], [], 0
        if ids:
            yield row()

    return run


def _split(lengths: np.ndarray, joined: bytes) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _by_cell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every word, and the words' order by cell."""
    cells = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(CELLS)
    return cells, np.argsort(cells, kind="stable")


def _chunk_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, chunk, lengths, words): the chunks' distinct pre-tokens by cell."""
    for batch in batches:
        for chunk, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            lengths, joined = _unpack(value.as_py(), 6)[:2]
            words = _split(np.frombuffer(lengths, np.int32), bytes(joined))
            cells, order = _by_cell(words)
            cells = cells[order]
            edges = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1]))) if len(cells) else []
            order, bounds = order.tolist(), [*map(int, edges), len(words)]
            parts = [[words[k] for k in order[a:b]] for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_pydict({
                "cell": cells[edges].astype(np.int32) if len(parts) else np.zeros(0, np.int32),
                "chunk": np.full(len(parts), chunk, np.int64),
                "lengths": pa.array([np.array([len(w) for w in p], np.int32).tobytes() for p in parts], pa.binary()),
                "words": pa.array([b"".join(p) for p in parts], pa.binary())})


def _encode_cells(ranks: dict[bytes, int]):
    """(chunk, cell, counts, ids) from rows sorted by cell; a cell's equal words are encoded once."""
    kind = id_type(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, encoded = None, {}
        for batch in batches:
            counts, ids = [], []
            for cell, lengths, joined in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if cell != last:
                    last, encoded = cell, {}
                found = []
                for word in _split(np.frombuffer(lengths, np.int32), joined):
                    if word not in encoded:
                        encoded[word] = merge(word, ranks)
                    found.append(encoded[word])
                counts.append(np.array([len(f) for f in found], np.int32).tobytes())
                ids.append(np.array([i for f in found for i in f], kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(0), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
                names=["chunk", "cell", "counts", "ids"])

    return run


def id_type(ranks: dict[bytes, int]) -> type:
    return np.uint16 if max(ranks.values()) < 1 << 16 else np.uint32


def _assemble(chunks: pd.DataFrame, cells: pd.DataFrame, kind: type) -> Iterator[tuple]:
    """(doc_id or None, ids) of every document of one chunk."""
    lengths, joined, ids, known, sizes, codes = _unpack(chunks["value"].iloc[0], 6)
    _, order = _by_cell(_split(np.frombuffer(lengths, np.int32), bytes(joined)))
    cells = cells.sort_values("cell")
    counts = np.frombuffer(b"".join(cells["counts"]), np.int32).astype(np.int64)
    table = np.frombuffer(b"".join(cells["ids"]), kind)
    n_ids, starts = np.empty_like(counts), np.empty_like(counts)
    n_ids[order] = counts
    starts[order] = np.cumsum(counts) - counts
    codes = _from_planes(codes)
    at = 0
    for doc, given, size in zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(known, bool).tolist(),
                                np.frombuffer(sizes, np.int64).tolist()):
        code = codes[at:at + size]
        at += size
        n = n_ids[code]
        ends = np.cumsum(n)
        places = np.repeat(starts[code] - (ends - n), n) + np.arange(ends[-1] if size else 0)
        yield (doc if given else None), table[places]


def decode(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _chunked(docs: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[bytes, int]]:
    """Chunks and their encoded words, both placed by chunk.

    Both branches read the same exchange of the chunks, so texts are split once.
    """
    spark = docs.sparkSession
    ranks = load_ranks(path)
    n = common.partitions(spark)
    chunks = common.map_arrow(docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text"),
                              _chunk_rows(public_tokenizers.PATTERN), "chunk bigint, value binary")
    chunks = chunks.repartition(n, "chunk")
    cells = chunks.toDF("chunk", "value").mapInArrow(
        _chunk_words, "cell int, chunk bigint, lengths binary, words binary")
    cells = cells.repartition(n, "cell").sortWithinPartitions("cell")
    encoded = cells.mapInArrow(_encode_cells(ranks), "chunk bigint, cell int, counts binary, ids binary")
    return chunks, encoded, ranks


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    chunks, encoded, ranks = _chunked(docs, path or public_tokenizers.path(VOCABULARY))
    kind = id_type(ranks)

    def assemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = list(_assemble(left, right, kind))
        return pd.DataFrame({"doc_id": pd.array([d for d, _ in rows], "Int64"),
                             "ids": [x.astype(np.int32) for _, x in rows]})

    return chunks.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInPandas(
        assemble, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, bytes) from (doc_id, ids)."""
    table = token_bytes(load_ranks(path or public_tokenizers.path(VOCABULARY)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            yield pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"),
                                "bytes": [decode(np.asarray(x), table) for x in rows["ids"]]})

    common.ship(encoded.sparkSession)
    return encoded.mapInPandas(run, "doc_id bigint, bytes binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes."""
    chunks, encoded, ranks = _chunked(docs, path or public_tokenizers.path(VOCABULARY))
    table, kind = token_bytes(ranks), id_type(ranks)

    def assemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = [(doc, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                 hashlib.sha256(decode(ids, table)).hexdigest()) for doc, ids in _assemble(left, right, kind)]
        out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return out.astype({"doc_id": "Int64"})

    return chunks.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInPandas(
        assemble, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
