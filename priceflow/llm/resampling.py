"""Target-distribution importance resampling (operator 12).

``features`` pre-tokenises every whole text: the untrained ``Split`` of the
``tokenizers`` library, over the text with A-Z lower-cased, returns words with
their offsets.  Windows over those offsets (from the first word's start to the
last word's end) are the features, runs of ``shortest`` to ``longest`` words;
each falls into the bucket crc32 modulo ``buckets``, and a text keeps its
bucket counts.  The counts of source and target texts are summed on Spark into
two histograms of ``buckets`` entries, from which each bucket gets its gain; a
text's weight is the floored mean of the gains of its features, and its score
adds Gumbel noise drawn from the hash of the id, so that the highest scores
are a sample without replacement with odds exp(weight / 1000).

``resample`` ranks the texts with at least ``MIN_WORDS`` words by score (ties
to the smaller id, a null id last) and draws the first ``percent`` of them.
The ranks come from slices of the order, so no task holds all texts.

Null and empty texts have no words, no features and weight 0, and are never
drawn.  A very long text is split into pieces between words and counted whole.
Repeated rows are ranked one by one; rows that tie on score and id are ranked
by weight, then by features, and beyond that are interchangeable.  A null id
draws its noise as an empty id does.  Empty tables give empty histograms: with
no target texts every bucket counts as equally likely there.  Only id and text
are read, so other columns make no difference.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from priceflow.llm import common
from priceflow.operators.numbering import sequence_number

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
PIECE = 1 << 20  # bytes of text handed to the splitter at once
CACHE = 1 << 19  # features whose bucket a task remembers


class Buckets(dict):
    """feature -> crc32 of its UTF-8 bytes modulo ``n``."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature.encode()) % self.n
        return bucket


def text_pieces(text: str) -> Iterator[str]:
    """The text with A-Z lower-cased, in pieces that end between words."""
    data = text.encode().lower()  # bytes.lower changes A-Z only
    while len(data) > PIECE:
        tail = np.frombuffer(data, np.uint8)
        gaps = np.flatnonzero(~common.LETTERS[tail[:PIECE]])
        if not len(gaps):
            gaps = PIECE + np.flatnonzero(~common.LETTERS[tail[PIECE:]])[:1]
            if not len(gaps):
                break
        cut = int(gaps[-1]) + 1  # just after a byte that no word holds
        yield data[:cut].decode()
        data = data[cut:]
    yield data.decode()


def text_buckets(text: str, splitter, buckets: Buckets, shortest: int, longest: int) -> tuple[int, list[int]]:
    """(number of words, bucket of every feature) of a whole text."""
    n_words, out, carried = 0, [], []
    for piece in text_pieces(text):
        words = [word for word, _ in splitter.pre_tokenize_str(piece)]
        n_words += len(words)
        if longest == 1:
            out += map(buckets.__getitem__, words)
            continue
        words = carried + words
        line = " ".join(words)
        ends, at = [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0] + [e + 1 for e in ends[:-1]]
        for n in range(shortest, longest + 1):
            # windows that lie in the carried words were counted with their own piece
            first = max(0, len(carried) - n + 1)
            out += [buckets[line[a:b]] for a, b in zip(starts[first:], ends[first + n - 1:])]
        carried = words[len(words) - min(longest - 1, len(words)):]
    return n_words, out


def features(docs: DataFrame, key: str, buckets: int = BUCKETS, shortest: int = 1, longest: int = 1) -> DataFrame:
    """(key, n_words, n_features, bucket counts) of each text; one scan."""
    if not 1 <= shortest <= longest:
        raise ValueError("runs of words need 1 <= shortest <= longest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        known = Buckets(buckets)
        for batch in batches:
            for part in common.pieces(batch):
                sizes, totals, found, counts = [], [], [], []
                for text in part.column(1).to_pylist():
                    n, own = text_buckets(text or "", splitter, known, shortest, longest)
                    ids, times = np.unique(np.array(own, np.int32), return_counts=True)
                    sizes.append(n)
                    totals.append(len(own))
                    found.append(ids)
                    counts.append(times.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                    names=[key, "n_words", "n_features", "buckets", "counts"])

    return common.map_arrow(docs.select(F.col(key).cast("bigint").alias(key), "text"), run,
                            f"`{key}` bigint, n_words bigint, n_features bigint, buckets array<int>, counts array<int>")


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: summed in each task, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            counts = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            sums += np.bincount(ids, counts, buckets).astype(np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "n": sums[at]})

    counted = common.map_arrow(rows.select("buckets", "counts"), run, "bucket int, n bigint")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most `buckets` rows
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy(int)] = found["n"].to_numpy(np.int64)
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed target share over the smoothed source share)."""
    n, s, t = len(source), source.astype(float), target.astype(float)
    ratio = (t + 1) * (float(source.sum()) + n) / ((s + 1) * (float(target.sum()) + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(rows: DataFrame, key: str, gains: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight): floored mean of the gains of a text's features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column(2).to_numpy(zero_copy_only=False)
            ids, counts = batch.column(3), batch.column(4)
            value = gains[ids.flatten().to_numpy(zero_copy_only=False)] * counts.flatten().to_numpy(zero_copy_only=False)
            sums = np.concatenate(([0], np.cumsum(value)))
            ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))
            mean = (sums[ends] - sums[np.concatenate(([0], ends[:-1]))]) // np.maximum(total, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(mean.astype(np.int64))],
                names=[key, "n_words", "n_features", "weight"])

    return common.map_arrow(rows.select(key, "n_words", "n_features", "buckets", "counts"), run,
                            f"`{key}` bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(key: str, seed: int = SEED):
    """floor(-1000 ln(-ln u)) for u from the first 8 hex digits of sha256('seed:id')."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5).cast("double")) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", target_key: str = "item_id",
             buckets: int = BUCKETS, shortest: int = 1, longest: int = 1, min_words: int = MIN_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank); rank is null for texts not drawn."""
    counted = common.materialize(features(docs, key, buckets, shortest, longest), "resampling-features")
    wanted = features(target, target_key, buckets, shortest, longest)
    gains = bucket_gains(histogram(counted, buckets), histogram(wanted, buckets))
    scored = weights(counted, key, gains).withColumn("score", (F.col("weight") + gumbel(key, seed)).cast("bigint"))
    # written with a number of its own per row, so that equal rows fall into different slices of the order
    scored = scored.withColumns({
        "__row": F.monotonically_increasing_id(), "__down": -F.col("score"), "__noid": F.col(key).isNull()})
    scored = common.materialize(scored, "resampling-scores")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    ranked = sequence_number(able, [], ["__down", "__noid", key, "weight", "n_features", "__row"], "rank")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    return ranked.unionByName(rest).select(key, "n_words", "n_features", "weight", "score", rank)
