"""Quality rules as a bitmask ledger (operator 8, DataFrame functions only).

``ledger`` evaluates every rule once per text and stores the measurements and
one bit per failed rule.  ``apply_policy`` turns bits into a verdict: a policy
is a named, versioned set of rules, so a new version re-reads only the ledger.
``ablation`` counts, by bitwise aggregation, what each rule rejects, alone and
with the others, and what dropping it would bring back.

Null and empty texts have no words and fail ``too_few_words``.  Rows are
judged one by one, so repeated rows, null ids and extra columns make no
difference: other columns pass through, and a column whose name is one of the
ledger's is replaced.  An empty table gives an empty ledger.

A repeated window is found by the 64-bit hash of its eight words, compared
within one text only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: name -> condition of failure over the measurements; the bit is the position.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines AND n_dup_lines >= 3"),
    ("shouting", "100 * n_shouted > 50 * n_words"),
    ("long_words", "word_chars > 40 * n_words"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: versioned policies: the rules whose failure rejects a text
POLICIES = {
    "base-1": ["too_few_words", "repeated_windows"],
    "strict-1": [name for name, _ in RULES],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_shouted", "n_repeat_words"]


def _removed(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _adjacent_repeats(sorted_windows: Column) -> Column:
    """Windows that occur twice or more, from their sorted (hash, start) list."""
    same = lambda i, j: sorted_windows[i]["h"] == sorted_windows[j]["h"]
    n = F.size(sorted_windows)
    return F.filter(sorted_windows, lambda x, i: ((i > 0) & same(F.greatest(i - 1, F.lit(0)), i))
                    | ((i + 1 < n) & same(F.least(i + 1, n - 1), i)))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs + measurements + ``fail_bits``; one scan, no shuffle."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    rows = docs.withColumns({
        "__words": F.regexp_extract_all(body, F.lit(f"({WORD})"), F.lit(1)),
        "__lines": lines,
        "word_chars": F.length(F.translate(body, " \t\n\x0b\f\r", "")).cast("long"),
        "n_symbols": _removed(body, SYMBOLS),
    })
    words = F.col("__words")
    rows = rows.withColumns({
        "n_words": F.size(words).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_shouted": F.size(F.filter(words, lambda w: w.endswith("!!"))).cast("long"),
        "__windows": F.when(
            F.size(words) > WINDOW,
            F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                        lambda i: F.xxhash64(F.slice(words, i, WINDOW)))),
    })
    windows = F.col("__windows")
    # only texts in which a window comes back are sorted
    rows = rows.withColumn("__sorted", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("__hits", F.array_sort(F.transform(
        _adjacent_repeats(F.col("__sorted")), lambda x: x["i"])))
    hits = F.col("__hits")
    covered = F.transform(hits, lambda x, k: F.when(
        k + 1 < F.size(hits), F.least(F.lit(WINDOW), hits[F.least(k + 1, F.size(hits) - 1)] - x)).otherwise(WINDOW))
    rows = rows.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    bits = reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES])
    rows = rows.withColumn("fail_bits", bits.cast("long"))
    return rows.drop("__words", "__lines", "__windows", "__sorted", "__hits")


def policy_mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def apply_policy(rows: DataFrame, policy: str, name: str = "kept") -> DataFrame:
    """ledger + boolean ``name``: no rule of the policy failed."""
    return rows.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(policy_mask(policy))) == 0)


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: rows it rejects, rejects alone, and kept without it."""
    mask = policy_mask(policy)
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask))
    counted = rows.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))  # at most 2**rules rows
    bit = F.col("bit")
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit"))
                                for r in POLICIES[policy]])).alias("r")
    return (counted.select("bits", "n", rules).select("bits", "n", "r.*")
            .groupBy("rule")
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("rejected"),
                 F.sum(F.when(F.col("bits") == bit, F.col("n")).otherwise(0)).alias("rejected_alone"),
                 F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(bit)) == 0, F.col("n")).otherwise(0))
                 .alias("kept_without")))


def filter_documents(docs: DataFrame, policy: str = "strict-1") -> DataFrame:
    """The documents that pass the policy, with their own columns only."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text"))
    judged = apply_policy(ledger(packed), policy, "__kept").select("__row", "__kept")
    # a filter directly above would be pushed down with the whole ledger copied into it
    judged = judged.select(F.inline(F.array(F.struct("__row", "__kept"))))
    return judged.where("__kept").select("__row.*")
