"""Toxic passages by maximum-scoring segments (operator 2).

Training (on labelled rows outside the held-out fold, at most ``SAMPLE`` rows,
taken in hash order; equal texts once): every word, and its first 4 and 5
bytes, is a feature.  A feature's score is the log-odds of occurring in toxic
against other texts under an informative Dirichlet prior (each feature's own
overall rate, ``PRIOR`` of the observed mass); it enters the lexicon if its
z-score reaches ``MIN_Z`` and its log-odds ``MIN_ODDS``.

Scoring: a word scores as the most specific of its features in the lexicon,
once in a segment (a word said again there adds nothing, in another segment it
counts anew); any other word costs ``DRIFT``.  One linear scan finds all maximal
scoring segments of the whole text.  Segment scores S are calibrated by extreme-value
statistics: lambda solves E[exp(lambda s)] = 1 for the word scores of
non-toxic training texts, and a text of n words has
E(S) = K n exp(-lambda S) chance segments of score S.  Segments with E below
``SIGNIFICANT`` are passages.  The text's evidence is the sum over segments of
max(0, -ln E), which a logistic curve, fitted on the same sample, turns into a
score between 0 and 1.

Held out are rows whose crc32 of the id as text leaves 2 modulo 4; their labels
are never read.  Several label rows of one id count as toxic if any is; null
labels are ignored.  Null and empty texts have no evidence and get the lowest
score.  A null id is not held out and never labelled.  Without labels the
lexicon is empty and all texts get the same low score.  Other columns pass
through untouched.
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

SAMPLE = 8000
PREFIXES = (4, 5)
PRIOR = 0.1
MIN_Z = 3.0
MIN_ODDS = 3.0
DRIFT = -0.7
K = 0.1
SIGNIFICANT = 0.01
THRESHOLD = 0.3

SPANS = "array<struct<first_word:bigint, last_word:bigint, score:double, e_value:double>>"


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    scores: np.ndarray
    decay: float = 1.0  # lambda
    slope: float = 1.0
    offset: float = -3.0

    def words(self, heads: list[np.ndarray]) -> np.ndarray:
        """Score of every word: the first of its features that the lexicon has."""
        out = np.full(len(heads[0]), DRIFT)
        if len(self.features):
            for h in heads:
                at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
                found = (self.features[at] == h) & (out == DRIFT)
                out[found] = self.scores[at[found]]
        return out

    def e_value(self, score: float, n: int) -> float:
        return K * max(n, 1) * float(np.exp(-min(self.decay * score, 700.0)))

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> float:
        return sum(max(0.0, self.decay * s - np.log(K * max(n, 1))) for _, _, s in segments)

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.offset, -60, 60))))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) in one linear scan.

    Candidates are kept as (first, last, sum before, sum after); a new positive
    word joins back while that raises the score of an earlier candidate.
    """
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float]] = []
    lower: list[int] = []  # for each candidate, the nearest earlier one with a smaller start sum
    for i in np.flatnonzero(scores > 0).tolist():
        first, left, right = i, float(sums[i]), float(sums[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = lower[j]
            if j < 0 or stack[j][3] >= right:
                stack.append((first, i, left, right))
                lower.append(j)
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:], lower[j:]
    return [(a, b, right - left) for a, b, left, right in stack]


def segments(scores: np.ndarray, words: np.ndarray) -> list[tuple[int, int, float]]:
    """Maximal segments in which a word said again adds nothing.

    A word counts again in another segment: repeats are set to 0 within each
    segment of the full scores, and what is left of it is scanned anew.
    """
    out = []
    for a, b, score in maximal_segments(scores):
        own = scores[a:b + 1]
        known = np.flatnonzero(own > 0)
        _, first = np.unique(words[a:b + 1][known], return_index=True)
        if len(first) == len(known):
            out.append((a, b, score))
            continue
        own = own.copy()
        own[np.delete(known, first)] = 0
        out += [(a + x, a + y, z) for x, y, z in maximal_segments(own)]
    return out


def _heads(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word bounds per text; hashes of the words, then of their longest prefixes."""
    starts, _, whole, *heads = common.words(data, offsets, common.LETTERS, common.LOWER, PREFIXES)
    return common.per_text(starts, offsets), [whole, *reversed(heads)]


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most SAMPLE labelled rows outside the held-out fold."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                         & (common.crc_remainder() != 2))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("__id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE)  # bounded by the parameter
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("bigint").alias("__id"), text.alias("text")).join(
        F.broadcast(known), "__id")
    return found.groupBy("text").agg(F.max("toxic").alias("toxic")).select("text", "toxic")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each class that have a feature: (feature, toxic, other); feature 0 counts texts."""
    for batch in batches:
        for part in common.pieces(batch):
            bounds, heads = _heads(*common.text_buffer(part.column(0)))
            toxic = part.column(1).to_pylist()
            of = np.repeat(np.arange(part.num_rows), np.diff(bounds))
            label = np.array(toxic, np.int64)
            pairs = np.concatenate([np.stack((h, of.astype(np.uint64)))[:, h != 0] for h in heads], axis=1)
            order = np.lexsort((pairs[1], pairs[0]))
            feature, text = pairs[0][order], pairs[1][order].astype(np.int64)
            new = np.ones(len(feature), bool)
            new[1:] = (feature[1:] != feature[:-1]) | (text[1:] != text[:-1])
            feature, y = feature[new], label[text[new]]
            edge = np.ones(len(feature), bool)
            edge[1:] = feature[1:] != feature[:-1]
            at = np.flatnonzero(edge)
            t = np.add.reduceat(y, at) if len(at) else np.zeros(0, np.int64)
            n = np.diff(np.append(at, len(feature)))
            yield pa.RecordBatch.from_pydict({
                "feature": np.append(feature[at], np.uint64(0)).view(np.int64),
                "toxic": np.append(t, label.sum()), "texts": np.append(n, len(label))})


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon, decay and logistic curve from the bounded sample."""
    sample = common.materialize(_sample(docs, labels), "toxicity-sample")
    counted = common.map_arrow(sample, _count_features, "feature bigint, toxic bigint, texts bigint")
    counted = common.materialize(
        counted.groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("texts").alias("n")), "toxicity-counts")
    total = counted.where("feature = 0").first()
    if total is None or not 0 < total["t"] < total["n"]:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    n_t, n_o = float(total["t"]), float(total["n"] - total["t"])
    t, o, prior = F.col("t"), F.col("n") - F.col("t"), F.col("n") * PRIOR
    rate = n_t / (n_t + n_o)
    up_t, up_o = t + prior * rate, o + prior * (1 - rate)
    mass_t, mass_o = n_t * (1 + PRIOR), n_o * (1 + PRIOR)
    odds = lambda up, mass: F.log(up / (mass - up + 1))
    scored = counted.where("feature != 0").select(
        "feature", (odds(up_t, mass_t) - odds(up_o, mass_o)).alias("score"),
        F.sqrt(1 / up_t + 1 / up_o).alias("sd"))
    # at least a few training texts stand behind every entry: bounded by the sample
    lexicon = scored.where((F.col("score") > MIN_Z * F.col("sd")) & (F.col("score") > MIN_ODDS)).select("feature", "score").toPandas()
    features = lexicon["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(features)
    model = Model(features[order], lexicon["score"].to_numpy(float)[order])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch):
                bounds, heads = _heads(*common.text_buffer(part.column(0)))
                values = np.round(model.words(heads), 3)
                out = {"toxic": part.column(1).to_pylist(), "values": [], "counts": []}
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    v, c = np.unique(values[lo:hi], return_counts=True)
                    out["values"].append(v.tolist())
                    out["counts"].append(c.tolist())
                yield pa.RecordBatch.from_pydict(out, pa.schema([
                    ("toxic", pa.int32()), ("values", pa.list_(pa.float64())), ("counts", pa.list_(pa.int64()))]))

    measured = common.map_arrow(sample, measure, "toxic int, values array<double>, counts array<bigint>")
    background = (measured.where("toxic = 0")
                  .select(F.explode(F.arrays_zip("values", "counts")).alias("x"))
                  .groupBy("x.values").agg(F.sum("x.counts").alias("n")).toPandas())
    model.decay = _decay(background["values"].to_numpy(float), background["n"].to_numpy(float), model.scores)
    seen = score(sample, model).select("toxic", "evidence").toPandas()  # at most SAMPLE rows
    model.slope, model.offset = _logistic(np.log1p(seen["evidence"].to_numpy(float)), seen["toxic"].to_numpy(float))
    return model


def _decay(values: np.ndarray, counts: np.ndarray, scores: np.ndarray) -> float:
    """lambda > 0 with E[exp(lambda s)] = 1; half an occurrence is added for the lexicon."""
    if not len(scores):
        return 1.0
    values = np.concatenate((values, [np.median(scores)]))
    p = np.concatenate((counts, [0.5]))
    p /= p.sum()
    lo, hi = 1e-6, 50.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if (p * np.exp(np.minimum(mid * values, 600))).sum() > 1 else (mid, hi)
    return float(np.clip(lo, 0.05, 5.0))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by penalised Newton steps."""
    w, a = np.array([1.0, -3.0]), np.stack((x, np.ones_like(x)), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + 0.1 * (w - [1.0, -3.0])
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2), grad)
    return max(float(w[0]), 1e-3), float(w[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs + evidence, score and passages of each whole text; one scan."""
    extra = T.StructType.fromDDL(f"evidence double, score double, passages {SPANS}")
    names = {"evidence", "score", "passages"}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    schema = T.StructType(docs.schema.fields + extra.fields)
    span = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()),
                               ("score", pa.float64()), ("e_value", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch):
                column = part.column(part.schema.get_field_index("text"))
                bounds, heads = _heads(*common.text_buffer(column))
                values = model.words(heads)
                positive = np.searchsorted(np.flatnonzero(values > 0), bounds)
                evidence, passages = [], []
                for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    found = segments(values[lo:hi], heads[0][lo:hi]) if positive[i] < positive[i + 1] else []
                    rated = [(a, b, s, model.e_value(s, hi - lo)) for a, b, s in found]
                    evidence.append(float(model.evidence(found, hi - lo)))
                    passages.append([{"first_word": a, "last_word": b, "score": s, "e_value": e}
                                     for a, b, s, e in rated if e <= SIGNIFICANT])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(evidence, pa.float64()),
                     pa.array([model.probability(x) for x in evidence], pa.float64()), pa.array(passages, span)],
                    names=schema.names)

    return common.map_arrow(docs, run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs + evidence, score, passages, held_out and predicted."""
    scored = score(docs, fit(docs, labels))
    return scored.withColumns({
        "held_out": F.coalesce(common.crc_remainder() == 2, F.lit(False)),
        "predicted": (F.col("score") >= THRESHOLD).cast("int")})


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, with their own columns only."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    scored = score(docs.select(row, "text"), fit(docs, labels))
    return scored.where(F.col("score") < THRESHOLD).select("__row.*")
