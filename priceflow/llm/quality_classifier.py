"""Quality scores by regularised quadratic discriminant analysis (operator 11).

Every text becomes ``STATISTICS``: counts and rates of its words, letters,
marks, lines and repetitions, each transformed so that its spread is stable
(logarithms of sizes, square roots of rates, with ``FEW_WORDS`` or
``FEW_CHARACTERS`` added to a rate's base).  Training rows, labelled and
outside the held-out fold, are summed up on Spark as class counts, sums and
products, with no cap on their number; only these sums reach the driver, and
their size is fixed by the number of statistics.  Statistics are standardised
over all training rows.  Each class has its mean and its covariance, shrunk
towards the covariance pooled within classes (weight (d + 1) / (n + d + 1) for
d statistics and n rows) and then by ``RIDGE`` towards the identity.  The Cholesky factor of
each is worked out once, inverted and shipped with its log-determinant; a
text's score is the logistic of the difference of the two Gaussian
log-densities (Mahalanobis terms and determinants) plus the log prior odds,
tempered by ``TEMPER`` because the statistics are not exactly Gaussian.

Held out are rows whose crc32 of the id as text is divisible by 5; their
labels are never read.  Labels, lang, source and doc_id never enter a score.
Several label rows of one id count as low quality if any is; null labels are
ignored.  One text per labelled id (the one with the least statistics) and
each set of statistics once (the lower label) enter the fit, so repeated rows
have no weight of their own.  Null and empty texts have all statistics 0 and
are scored like any other.  A null id is not held out and never labelled.
With labels of one class only, all texts get that class's share of 1 or 0;
without labels 0.5.  An empty table gives an empty result.  Other columns
pass through; those named like the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from priceflow.llm import common

FOLDS = 5
RIDGE = 0.02
TEMPER = 0.25
FEW_WORDS = 10
FEW_CHARACTERS = 60
THRESHOLD = 0.3

STATISTICS = (
    "words", "word_length", "word_length_spread", "upper", "digits", "symbols", "exclamations", "full_stops",
    "bare_marks", "short_words", "adjacent_repeats", "repeats", "commonest_word", "lines", "duplicate_lines",
    "wide_letters",
)


def _flags(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode("ascii"))] = True
    return table


UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
ALPHA = UPPER | _flags("abcdefghijklmnopqrstuvwxyz")
DIGIT = _flags("0123456789")
SYMBOL = _flags("#*$%&|<>^~_=+@\\/{}[]")
CONTINUATION = (np.arange(256) & 0xC0) == 0x80  # not the first byte of a character
WIDE = np.arange(256) >= 0xC0  # the first byte of a character beyond ASCII


def _totals(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of flagged bytes in each stretch [offsets[i], offsets[i + 1])."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets)).astype(float)


def _repeated(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: occurrences beyond the first of each value, and of its commonest value."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(o)))
    again = np.bincount(o[at], size - 1, n)
    most = np.zeros(n)
    np.maximum.at(most, o[at], size)
    return again, most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts x STATISTICS) transformed statistics of the texts in a buffer."""
    n = len(offsets) - 1
    starts, ends, hashes = common.words(data, offsets, common.SPACED)
    bounds = common.per_text(starts, offsets)
    words = np.diff(bounds).astype(float)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    characters = ends - starts - _between(CONTINUATION[data], starts, ends)
    per_word = np.maximum(words, 1)
    per_rate = words + FEW_WORDS  # a rate over few words is drawn towards 0
    length = np.bincount(owner, characters, n)
    spread = np.bincount(owner, characters.astype(float) ** 2, n) / per_word - (length / per_word) ** 2
    letters = _totals(ALPHA[data], offsets) + FEW_CHARACTERS
    size = length + FEW_CHARACTERS
    bare = _between(ALPHA[data] | DIGIT[data] | WIDE[data], starts, ends) == 0
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    again, most = _repeated(owner, hashes, n)

    # lines with a word, told apart by the hashes of their words in order
    line = np.cumsum(data == 10)
    line = (line[starts] if len(starts) else np.zeros(0, np.int64)) + owner  # a new text is a new line too
    first = np.ones(len(line), bool)
    first[1:] = line[1:] != line[:-1]
    at = np.flatnonzero(first)
    place = np.arange(len(line)) - np.repeat(at, np.diff(np.append(at, len(line))))
    mixed = common.mix(hashes + place.astype(np.uint64) * common.MULTIPLIER)
    print_ = np.add.reduceat(mixed, at) if len(at) else np.zeros(0, np.uint64)
    lines = np.bincount(owner[at], minlength=n).astype(float)
    line_again, _ = _repeated(owner[at], print_, n)

    root = np.sqrt
    return np.stack([
        np.log1p(words), np.log1p(length / per_word), np.log1p(root(np.maximum(spread, 0))),
        root(_totals(UPPER[data], offsets) / letters), root(_totals(DIGIT[data], offsets) / size),
        root(_totals(SYMBOL[data], offsets) / size), root(_totals(data == ord("!"), offsets) / size),
        root(_totals(data == ord("."), offsets) / per_rate), root(np.bincount(owner, bare, n) / per_rate),
        root(np.bincount(owner, characters <= 3, n) / per_rate), root(np.bincount(owner, same, n) / per_rate),
        again / per_rate, root(most / per_rate), np.log1p(words / np.maximum(lines, 1)),
        root(line_again / np.maximum(lines, 1)), root(_totals(WIDE[data], offsets) / size),
    ], axis=1)


def _between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    places = np.flatnonzero(flags)
    return np.searchsorted(places, ends) - np.searchsorted(places, starts)


@dataclass
class Gaussian:
    """One class: mean, inverse Cholesky factor of its covariance, log-determinant."""

    mean: np.ndarray
    whiten: np.ndarray
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return -0.5 * ((z * z).sum(axis=1) + self.log_det)


@dataclass
class Model:
    """Discriminant over standardised statistics; without two classes, a constant."""

    constant: float = 0.5
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    classes: tuple[Gaussian, Gaussian] | None = None
    log_prior: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.constant)
        z = (x - self.center) / self.scale
        low, high = self.classes
        margin = TEMPER * (high.log_density(z) - low.log_density(z)) + self.log_prior
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _covariance(products: np.ndarray, mean: np.ndarray, n: float) -> np.ndarray:
    out = products / n - np.outer(mean, mean)
    return (out + out.T) / 2


def discriminant(sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    """Model from each class's (count, sum, sum of outer products)."""
    counts = {k: n for k, (n, _, _) in sums.items() if n > 0}
    if len(counts) < 2:
        return Model(float(next(iter(counts))) if counts else 0.5)
    total = sum(counts.values())
    center = sum(s for _, s, _ in sums.values()) / total
    whole = _covariance(sum(p for _, _, p in sums.values()), center, total)
    scale = np.sqrt(np.maximum(np.diag(whole), 1e-12))
    scale[scale < 1e-5] = 1.0  # a statistic that never varies says nothing
    d = len(center)
    means, spreads = [], []
    for k in (0, 1):
        n, s, p = sums[k]
        means.append((s / n - center) / scale)
        spreads.append(_covariance(p, s / n, n) / np.outer(scale, scale))
    pooled = (counts[0] * spreads[0] + counts[1] * spreads[1]) / total
    classes = []
    for k in (0, 1):
        own, n = spreads[k], counts[k]
        rho = (d + 1) / (n + d + 1)  # as if d + 1 rows of the pooled spread had been seen too
        shrunk = (1 - RIDGE) * ((1 - rho) * own + rho * pooled) + RIDGE * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        classes.append(Gaussian(means[k], np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum())))
    return Model(counts[1] / total, center, scale, (classes[0], classes[1]),
                 float(np.log(counts[1] / counts[0])))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__id, text) -> (__id, x)."""
    for batch in batches:
        for part in common.pieces(batch):
            x = statistics(*common.text_buffer(part.column(1)))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([part.column(0), values.cast(pa.list_(pa.float64()))], names=["__id", "x"])


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(quality, x) rows of a task -> one row of sums per class."""
    d = len(STATISTICS)
    sums = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        quality = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for k in (0, 1):
            own = x[quality == k]
            sums[k] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
    for k in (0, 1):
        if sums[k, 0]:
            yield pa.RecordBatch.from_pydict({
                "quality": np.full(sums.shape[1], k, np.int32), "place": np.arange(sums.shape[1], dtype=np.int32),
                "value": sums[k]})


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(quality, x): one row per labelled text outside the held-out fold."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 0))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("__id")).agg(
        F.min(F.col("quality").cast("int")).alias("quality"))
    measured = common.map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("__id"), "text"), _measure,
                                "__id bigint, x array<double>")
    # a repeated id is reduced before it is joined
    measured = measured.where("__id IS NOT NULL").groupBy("__id").agg(F.min("x").alias("x"))
    return measured.join(known, "__id").groupBy("x").agg(F.min("quality").alias("quality")).select("quality", "x")


def fold() -> F.Column:
    """crc32 of the id as text, modulo ``FOLDS`` (null for a null id)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Class moments of all training rows, summed on Spark."""
    rows = common.map_arrow(training_rows(docs, labels), _sum_up, "quality int, place int, value double")
    found = rows.groupBy("quality", "place").agg(F.sum("value").alias("value")).toPandas()  # 2 x (1 + d + d * d) rows
    d = len(STATISTICS)
    sums = {}
    for k in (0, 1):
        v = np.zeros(1 + d + d * d)
        own = found[found["quality"] == k]
        v[own["place"].to_numpy(int)] = own["value"].to_numpy(float)
        sums[k] = (float(v[0]), v[1:1 + d], v[1 + d:].reshape(d, d))
    return discriminant(sums)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs + score of each whole text; one scan."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "score"])
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch):
                column = part.column(part.schema.get_field_index("text"))
                x = statistics(*common.text_buffer(column))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(x))], names=schema.names)

    return common.map_arrow(docs, run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs + score, held_out and predicted."""
    names = {"score", "held_out", "predicted"}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    return score(docs, fit(docs, labels)).withColumns({
        "held_out": F.coalesce(fold() == 0, F.lit(False)),
        "predicted": (F.col("score") >= THRESHOLD).cast("int")})
