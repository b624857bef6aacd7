"""Document scores by masked pseudo-likelihood (operator 10).

Every word is predicted from the two words on either side of it, its own place
masked, and the conditional log-probabilities are summed over the document.

The vocabulary is every distinct word of the corpus (a full 64-bit hash), with
its count, in a distributed table that grows with the corpus.  Words fall into
classes (the ``ALONE`` commonest words alone, the others in ``BANDS`` bands of
about equal mass by falling count), and a band into ``PARTS`` leaves by hash:
log p(word | both sides) = log p(class | both sides) + log p(leaf | class, both
sides) + log p(word | leaf).  The last part is the corpus counts; the others are
a small network: one embedding of leaves per place of the window, a tanh layer
and a softmax over classes and over each band's leaves.

Texts are coded once, in chunks of about ``PIECE`` bytes with a dictionary of
their distinct words.  The dictionaries are shuffled once, as packed rows by hash
cell: a cell's task adds up its words over all chunks and answers each chunk with
the sums of its own words, once per chunk however often a chunk says them; then
the leaves are put in place.

Training reads all documents in ``ROUNDS`` rounds.  In a round every task
starts from the common weights and takes gradient steps (Adagrad, batches of
``BATCH`` words) over its own part; the tasks' weights are then averaged, by
their numbers of words, in a grouped aggregation.  The network has a fixed size,
and words of one leaf are told apart by their counts, not by context.

Null and empty texts have no words, log-probability 0 and a null mean.  Rows
are scored one by one, repeated rows alike; null ids stay null; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceflow.llm import common

ALONE = 40
BANDS = 23
PARTS = 32
CLASSES = ALONE + BANDS
LEAVES = ALONE + BANDS * PARTS
PAD = LEAVES
WINDOW = (-2, -1, 1, 2)
WIDTH = 16
ROUNDS = 2
BATCH = 8192
RATE = 0.1
SEED = 7
PIECE = 1 << 21
CELL = 1 << 21  # dictionary words of all chunks in a hash cell
ROW = 1 << 14  # vocabulary words in a row of the tallied table
SLICE = 512

SHAPES = ((len(WINDOW), LEAVES + 1, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,),
          (BANDS, WIDTH, PARTS), (BANDS, PARTS))


# ---------------------------------------------------------------- the vocabulary


def _narrow(words: np.ndarray) -> type:
    return np.uint16 if len(words) <= 1 << 16 else np.uint32


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: ids, each text's bounds, words as places in the chunk's sorted dictionary."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in common.pieces(batch, "text", PIECE):
            data, offsets = common.text_buffer(part.column(1))
            starts, _, hashes = common.words(data, offsets, common.SPACED)
            words, tokens, n = np.unique(hashes, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (
                     common.per_text(starts, offsets).astype(np.int64), tokens.astype(_narrow(words)), words,
                     n.astype(np.uint32)))], names=["chunk", "docs", "bounds", "tokens", "words", "counts"])
            chunk += 1


def code(docs: DataFrame) -> DataFrame:
    return common.materialize(common.map_arrow(
        docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text"), _code,
        "chunk bigint, docs array<bigint>, bounds binary, tokens binary, words binary, counts binary"), "lm-coded")


def _cell_of(words: np.ndarray, cells: int) -> np.ndarray:
    return (words.view(np.uint64) >> np.uint64(24)) % np.uint64(cells)


def _by_cell(words: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, cells that occur, bounds): the words in order of their cells."""
    cell = _cell_of(words, cells)
    order = np.argsort(cell, kind="stable")
    found, first = np.unique(cell[order], return_index=True)
    return order, found.astype(np.int32), np.append(first, len(words))


def _packed(chunk, words: np.ndarray, n: np.ndarray, cells: int) -> pa.RecordBatch:
    order, found, bounds = _by_cell(words, cells)
    words, n = words[order], n[order].astype(np.int64)
    cut = lambda x: pa.array([x[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array([chunk] * len(found), pa.int64()), cut(words), cut(n)],
                                      names=["cell", "chunk", "words", "n"])


PACKED = "cell int, chunk bigint, words binary, n binary"
VOCABULARY = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))
TALLIED = "cell int, chunk bigint, n binary, vocabulary array<struct<word:bigint,n:bigint>>"


def dictionaries(coded: DataFrame, cells: int, counted: bool = True) -> DataFrame:
    """Every chunk's distinct words and their numbers there, a row per hash cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, words, n = (c[i].as_py() for c in batch.columns)
                words, n = np.frombuffer(words, np.int64), np.frombuffer(n, np.uint32)
                yield _packed(chunk, words, n if counted else np.zeros(len(words)), cells)

    return common.map_arrow(coded.select("chunk", "words", "counts"), run, PACKED)


def _pack_table(counts: DataFrame, cells: int) -> DataFrame:
    """(word, n) rows as rows per hash cell, without a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _packed(None, *(c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns), cells)

    return common.map_arrow(counts.select("word", "n"), run, PACKED)


def _tally(key: tuple, rows: pa.Table) -> pa.Table:
    """The sums of one cell's words: rows without a chunk that hold them, ROW words each,
    and for each chunk those of its own words, in its order."""
    parts = [np.frombuffer(w, np.int64) for w in rows.column("words").to_pylist()]
    ends = np.cumsum([len(p) for p in parts])
    words, place = np.unique(np.concatenate(parts), return_inverse=True)
    n = np.concatenate([np.frombuffer(x, np.int64) for x in rows.column("n").to_pylist()])
    total = np.bincount(place, n, len(words)).astype(np.int64)
    cuts = pa.array(np.append(np.arange(0, len(words), ROW), len(words)), pa.int32())
    whole = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays([pa.array(words), pa.array(total)], ["word", "n"]))
    out = [(chunk, total[place[end - len(part):end]].tobytes())
           for chunk, part, end in zip(rows.column("chunk").to_pylist(), parts, ends) if chunk is not None]
    cell = key[0].as_py()
    names = ["cell", "chunk", "n", "vocabulary"]
    return pa.concat_tables([
        pa.table([pa.array([cell] * len(whole), pa.int32()), pa.nulls(len(whole), pa.int64()),
                  pa.nulls(len(whole), pa.binary()), whole.cast(VOCABULARY)], names),
        pa.table([pa.array([cell] * len(out), pa.int32()), pa.array([c for c, _ in out], pa.int64()),
                  pa.array([x for _, x in out], pa.binary()), pa.nulls(len(out), VOCABULARY)], names)])


def tally(rows: DataFrame) -> DataFrame:
    """Cells are sized by the dictionaries (``cells_for``), so a group fits its task at every size."""
    common.ship(rows.sparkSession)
    return rows.groupBy("cell").applyInArrow(_tally, TALLIED)


def cells_for(coded: DataFrame) -> int:
    """Hash cells of at most about CELL dictionary words each, and one a task at least."""
    total = coded.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    return max(common.partitions(coded.sparkSession), total // 8 // CELL)


def _table(tallied: DataFrame) -> DataFrame:
    """(word, n) of every distinct word, out of the tallied cells."""
    return tallied.where("chunk IS NULL").select(F.inline("vocabulary"))


def count_words(coded: DataFrame) -> DataFrame:
    """(word, n) of every distinct word; occurrences are added up per chunk before the shuffle."""
    return _table(common.materialize(tally(dictionaries(coded, cells_for(coded))), "lm-words"))


def corpus_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every distinct word in all texts."""
    return count_words(code(docs))


class Leaves:
    """What gives a word of some count its leaf, and the mass of each leaf; of fixed size."""

    def __init__(self, counts: DataFrame):
        levelled = counts.withColumn("level", F.floor(F.log2("n") * 16).cast("int"))
        top = levelled.orderBy(F.desc("n"), "word").limit(ALONE).toPandas()  # bounded by the parameter
        levels = levelled.groupBy("level").agg(
            F.sum("n").alias("n"), F.min("n").alias("least")).orderBy("level").toPandas()  # at most 64 * 16 rows
        self.least = levels["least"].to_numpy(np.int64)
        self.share = levels["n"].to_numpy(float)  # of each level
        np.subtract.at(self.share, np.searchsorted(levels["level"], top["level"]), top["n"].to_numpy(float))
        self.above = self.share[::-1].cumsum()[::-1] - self.share
        alone = top["word"].to_numpy(np.int64)
        self.order = np.argsort(alone)
        self.alone = alone[self.order]
        self.mass = np.zeros(LEAVES)
        leaf_of = self.of

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mass = np.zeros(LEAVES)
            for batch in batches:
                n = batch.column(1).to_numpy()
                mass += np.bincount(leaf_of(batch.column(0).to_numpy(), n), n, LEAVES)
            yield pa.RecordBatch.from_pydict({"leaf": np.arange(LEAVES, dtype=np.int32), "n": mass})

        sums = common.map_arrow(counts.select("word", "n"), count, "leaf int, n double").groupBy("leaf").agg(
            F.sum("n").alias("n")).toPandas()  # at most LEAVES rows
        self.mass[sums["leaf"].to_numpy(int)] = sums["n"]

    def of(self, words: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Leaf of every word; a word that the corpus did not have (n = 0) is in the last band."""
        out = ALONE + (BANDS - 1) * PARTS + (words & (PARTS - 1))
        if not len(self.alone):
            return out
        level = np.maximum(np.searchsorted(self.least, n, "right") - 1, 0)
        cut = (words.view(np.uint64) >> np.uint64(11)) / float(1 << 53)  # a level is cut by hash
        place = (self.above[level] + cut * self.share[level]) / max(self.share.sum(), 1.0)
        band = np.where(n > 0, np.minimum((place * BANDS).astype(np.int64), BANDS - 1), BANDS - 1)
        out += (band - BANDS + 1) * PARTS
        at = np.minimum(np.searchsorted(self.alone, words), len(self.alone) - 1)
        return np.where(self.alone[at] == words, self.order[at], out)


class Tokens:
    """The counts of every word as a table, and their leaves."""

    def __init__(self, counts: DataFrame):
        self.table, self.leaves = counts, Leaves(counts)


def _put(leaves: Leaves, cells: int):
    """Leaves in place, and each text's summed log p(word | leaf)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bounds, words = (np.frombuffer(batch.column(k)[i].as_py(), np.int64) for k in (1, 3))
                places = np.frombuffer(batch.column(2)[i].as_py(), _narrow(words))
                n = np.zeros(len(words), np.int64)
                if len(words):
                    known = sorted(batch.column(4)[i].as_py(), key=lambda x: x["cell"])
                    n[_by_cell(words, cells)[0]] = np.concatenate([np.frombuffer(x["n"], np.int64) for x in known])
                leaf = leaves.of(words, n)
                half = np.where(n == 0, 0.5, 0.0)
                member = np.minimum(np.log((n + half) / (leaves.mass[leaf] + half)), 0.0)
                sums = np.concatenate(([0.0], np.cumsum(member[places])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                     pa.array([leaf.astype(np.uint16)[places].tobytes()], pa.binary()),
                     pa.array([np.diff(sums[bounds]).tobytes()], pa.binary())],
                    names=["docs", "bounds", "leaves", "member"])

    return run


def _placed(coded: DataFrame, tallied: DataFrame, leaves: Leaves, cells: int) -> DataFrame:
    """The chunks with leaves: docs, bounds, leaves, member."""
    known = tallied.where("chunk IS NOT NULL").groupBy("chunk").agg(
        F.collect_list(F.struct("cell", "n")).alias("known"))  # one chunk's words
    joined = coded.select("chunk", "docs", "bounds", "tokens", "words").join(known, "chunk", "left")
    return common.materialize(common.map_arrow(
        joined.select("docs", "bounds", "tokens", "words", "known"), _put(leaves, cells),
        "docs array<bigint>, bounds binary, leaves binary, member binary"), "lm-placed")


def place(coded: DataFrame, tokens: Tokens) -> DataFrame:
    """The chunks with the leaves that a vocabulary gives to their words."""
    cells = cells_for(coded)
    rows = dictionaries(coded, cells, counted=False).unionByName(_pack_table(tokens.table, cells))
    return _placed(coded, tally(rows), tokens.leaves, cells)


# ---------------------------------------------------------------- the network


def _logits(hidden: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """A column per row of ``hidden``, less its largest value."""
    out = weights.T @ hidden.T
    out += bias[:, None]
    out -= out.max(axis=0)
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _log_of(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-softmax at one place of every column."""
    own = logits[target, np.arange(len(target))]
    return own - np.log(np.exp(logits, out=logits).sum(axis=0))


def _class_of(leaf: np.ndarray) -> np.ndarray:
    return np.where(leaf < ALONE, leaf, ALONE + (leaf - ALONE) // PARTS)


def _by_band(leaf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(band, rows, part) of the rows whose leaf is in a band."""
    rows = np.flatnonzero(leaf >= ALONE)
    band, part = np.divmod(leaf[rows] - ALONE, PARTS)
    order = np.argsort(band, kind="stable")
    cuts = np.searchsorted(band[order], np.arange(BANDS + 1))
    for b in range(BANDS):
        some = order[cuts[b]:cuts[b + 1]]
        if len(some):
            yield b, rows[some], part[some]


class Network:
    """Window network over leaves; parameters as one flat vector."""

    def __init__(self, flat: np.ndarray):
        self.parts, at = [], 0
        for shape in SHAPES:
            n = int(np.prod(shape))
            self.parts.append(flat[at:at + n].astype(np.float32).reshape(shape))
            at += n
        self.embed, self.bias, self.out, self.out_bias, self.inner, self.inner_bias = self.parts

    @staticmethod
    def initial() -> np.ndarray:
        random = np.random.default_rng(SEED)
        biases = {1, 3, 5}
        return np.concatenate([(np.zeros(s) if k in biases else random.normal(0, 0.1, s)).ravel()
                               for k, s in enumerate(SHAPES)])

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def hidden(self, context: np.ndarray) -> np.ndarray:
        hidden = self.bias + self.embed[0][context[0]]
        for k in range(1, len(WINDOW)):
            hidden += self.embed[k][context[k]]
        return np.tanh(hidden, out=hidden)

    def log_p(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log p(leaf | both sides) of the masked words."""
        hidden = self.hidden(context)
        out = _log_of(_logits(hidden, self.out, self.out_bias), _class_of(target)).astype(float)
        for b, rows, part in _by_band(target):
            out[rows] += _log_of(_logits(hidden[rows], self.inner[b], self.inner_bias[b]), part)
        return out

    def step(self, context: np.ndarray, target: np.ndarray, memory: list[np.ndarray]) -> None:
        hidden = self.hidden(context)
        error = _softmax(_logits(hidden, self.out, self.out_bias))
        error[_class_of(target), np.arange(len(target))] -= 1
        error /= len(target)
        back = np.ascontiguousarray((self.out @ error).T)
        grads = [None, None, (error @ hidden).T, error.sum(axis=1), np.zeros_like(self.inner), np.zeros_like(self.inner_bias)]
        for b, rows, part in _by_band(target):
            own = hidden[rows]
            error = _softmax(_logits(own, self.inner[b], self.inner_bias[b]))
            error[part, np.arange(len(rows))] -= 1
            error /= len(target)
            back[rows] += (self.inner[b] @ error).T
            grads[4][b], grads[5][b] = (error @ own).T, error.sum(axis=1)
        back *= 1 - hidden * hidden
        grads[1] = back.sum(axis=0)
        for k in range(len(WINDOW)):  # only rows that occur have a gradient
            order = np.argsort(context[k], kind="stable")
            near = context[k][order]
            first = np.flatnonzero(np.concatenate(([True], near[1:] != near[:-1])))
            grad, near = np.add.reduceat(back[order], first, axis=0), near[first]
            seen = memory[0][k][near] + grad * grad
            memory[0][k][near] = seen
            self.embed[k][near] -= RATE * grad / (np.sqrt(seen) + 1e-6)
        for p, g, m in zip(self.parts[1:], grads[1:], memory[1:]):
            m += g * g
            p -= RATE * g / (np.sqrt(m) + 1e-6)


def windows(leaves: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Leaves at the window's places around every word, PAD beyond the text."""
    reach = max(WINDOW)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.arange(len(leaves)) + (text + 1) * reach  # reach pads before, between and after texts
    padded = np.full(len(leaves) + (len(bounds) + 1) * reach, PAD, np.uint16)
    padded[at] = leaves
    return np.stack([padded[at + w] for w in WINDOW])


def _mean(key: tuple, rows: pa.Table) -> pa.Table:
    """Mean of one slice of the weights by the tasks' numbers of words."""
    weights = np.stack([np.frombuffer(w, np.float64) for w in rows.column("weights").to_pylist()])
    mean = np.average(weights, axis=0, weights=rows.column("n").to_numpy())
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "weights": pa.array([mean.tobytes()], pa.binary())})


def learn(placed: DataFrame) -> np.ndarray:
    """The averaged weights after ROUNDS rounds over all chunks."""
    weights = Network.initial()
    for _ in range(ROUNDS):
        def steps(batches: Iterator[pa.RecordBatch], start=weights) -> Iterator[pa.RecordBatch]:
            network, seen = Network(start), 0
            memory = [np.full(s, 1e-4, np.float32) for s in SHAPES]
            for batch in batches:
                for i in range(batch.num_rows):
                    bounds, leaves = (c[i].as_py() for c in batch.columns)
                    leaves = np.frombuffer(leaves, np.uint16).astype(np.intp)
                    context = windows(leaves, np.frombuffer(bounds, np.int64))
                    for lo in range(0, len(leaves), BATCH):
                        network.step(context[:, lo:lo + BATCH], leaves[lo:lo + BATCH], memory)
                    seen += len(leaves)
            if seen:
                flat = network.flat().astype(np.float64)
                parts = [flat[lo:lo + SLICE].tobytes() for lo in range(0, len(flat), SLICE)]
                yield pa.RecordBatch.from_pydict({"slice": np.arange(len(parts), dtype=np.int32), "weights": parts,
                                                  "n": np.full(len(parts), seen, np.int64)})

        learned = common.map_arrow(placed.select("bounds", "leaves"), steps, "slice int, weights binary, n bigint")
        mean = learned.groupBy("slice").applyInArrow(_mean, "slice int, weights binary").toPandas()
        if len(mean):  # as many values as the network has weights
            weights = np.concatenate([np.frombuffer(w, np.float64) for w in mean.sort_values("slice")["weights"]])
    return weights


def train(docs: DataFrame, tokens: Tokens) -> np.ndarray:
    return learn(place(code(docs), tokens))


def rate(placed: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, log_prob (summed over all words) and mean_log_prob."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("log_prob", pa.float64()), ("mean_log_prob", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(weights)
        for batch in batches:
            for i in range(batch.num_rows):
                bounds, leaves, member = (np.frombuffer(batch.column(k)[i].as_py(), t)
                                          for k, t in ((1, np.int64), (2, np.uint16), (3, np.float64)))
                leaves = leaves.astype(np.intp)
                context, sums = windows(leaves, bounds), np.zeros(len(leaves) + 1)
                for lo in range(0, len(leaves), BATCH):
                    target = leaves[lo:lo + BATCH]
                    sums[lo + 1:lo + 1 + len(target)] = network.log_p(context[:, lo:lo + BATCH], target)
                sums = np.cumsum(sums)
                n = np.diff(bounds)
                total = sums[bounds[1:]] - sums[bounds[:-1]] + member
                mean = np.divide(total, n, out=np.zeros(len(n)), where=n > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, pa.array(n, pa.int64()), pa.array(total), pa.array(mean, mask=n == 0)],
                    schema=schema)

    return common.map_arrow(placed.select("docs", "bounds", "leaves", "member"), run,
                            "doc_id bigint, n_tokens bigint, log_prob double, mean_log_prob double")


def score(docs: DataFrame, tokens: Tokens, weights: np.ndarray) -> DataFrame:
    return rate(place(code(docs), tokens), weights)


def score_documents(docs: DataFrame) -> DataFrame:
    coded = code(docs)
    cells = cells_for(coded)
    # one shuffle of the dictionaries counts the corpus and answers every chunk
    tallied = common.materialize(tally(dictionaries(coded, cells)), "lm-words")
    placed = _placed(coded, tallied, Leaves(_table(tallied)), cells)
    return rate(placed, learn(placed))
