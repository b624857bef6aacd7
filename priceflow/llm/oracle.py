"""DuckDB SQL of the queries that SQL can express over the given tables.

Each statement follows the query's contract in plain relational steps (rows
per word window, shingle or vector pair), not the operator's method.
"""

from __future__ import annotations

from priceflow.llm import merkle, quality_rules, resampling

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


def quality_sql() -> str:
    """op8: word windows as rows; the rules as the ledger states them."""
    bits = " + ".join(f"CASE WHEN {rule} THEN {quality_rules.BITS[name]} ELSE 0 END"
                      for name, rule in quality_rules.RULES)
    base, strict = (quality_rules.policy_mask(p) for p in ("base-1", "strict-1"))
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT rid, doc_id, t, {_WORDS} AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM split)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM again) GROUP BY rid),
measured AS (
  SELECT doc_id, cast(len(w) AS BIGINT) AS n_words,
         cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         cast(len(lines) AS BIGINT) AS n_lines,
         cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         cast(len(list_filter(w, lambda x: ends_with(x, '!!'))) AS BIGINT) AS n_shouted,
         cast(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.rid = c.rid),
judged AS (SELECT *, cast({bits} AS BIGINT) AS fail_bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {base}) <> 0 AS base_failed,
       (fail_bits & {strict}) = 0 AS kept, fail_bits FROM judged"""


_REACH = """
reach(node, other) AS (
  SELECT rid, rid FROM nodes UNION SELECT reach.node, e.b FROM reach JOIN edges e ON reach.other = e.a)"""


def near_duplicate_sql(percent: int = 85) -> str:
    """op3: shingles as rows, links counted over shared shingles, then reachability."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents)),
shingles AS (
  SELECT DISTINCT rid, s FROM (
    SELECT rid, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)
    UNION ALL SELECT rid, array_to_string(w, ' ') FROM split WHERE len(w) BETWEEN 1 AND 4)),
nodes AS (SELECT rid, doc_id, coalesce(n, 0) AS n FROM split LEFT JOIN (
  SELECT rid, count(*) AS n FROM shingles GROUP BY rid) USING (rid)),
shared AS (
  SELECT x.rid AS a, y.rid AS b, count(*) AS n_both FROM shingles x JOIN shingles y ON x.s = y.s AND x.rid <> y.rid
  GROUP BY x.rid, y.rid),
edges AS (
  SELECT a, b FROM shared JOIN nodes p ON p.rid = a JOIN nodes q ON q.rid = b
  WHERE 100 * n_both >= {percent} * (p.n + q.n - n_both)),
{_REACH}
SELECT x.doc_id, cast(any_value(x.n) AS BIGINT) AS n_shingles, min(y.doc_id) AS component_id,
       x.doc_id = min(y.doc_id) AS kept
FROM reach JOIN nodes x ON x.rid = node JOIN nodes y ON y.rid = other GROUP BY x.rid, x.doc_id"""


def embedding_sql(threshold: float = 0.98) -> str:
    """op9: every pair of a label, then reachability."""
    return f"""
WITH RECURSIVE nodes AS (
  SELECT row_number() OVER () AS rid, vec_id, label, cast(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (SELECT * FROM nodes WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL)) = 0
         AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
edges AS (
  SELECT x.rid AS a, y.rid AS b FROM good x JOIN good y ON x.label = y.label AND len(x.v) = len(y.v) AND x.rid <> y.rid
  WHERE list_cosine_similarity(x.v, y.v) >= {threshold}),
{_REACH}
SELECT x.vec_id, cast(any_value(coalesce(l.n, 0)) AS BIGINT) AS n_links, min(y.vec_id) AS component_id,
       x.vec_id = min(y.vec_id) AS kept
FROM reach JOIN nodes x ON x.rid = node JOIN nodes y ON y.rid = other
LEFT JOIN (SELECT a, count(*) AS n FROM edges GROUP BY a) l ON l.a = x.rid GROUP BY x.rid, x.vec_id"""


def _bytes(hexed: str) -> str:
    """The bytes of a text given as ``hex(encode(text))``."""
    def digit(at):
        return f"(strpos('0123456789ABCDEF', substr({hexed}, {at}, 1)) - 1)"

    return f"list_transform(range(1, length({hexed}), 2), lambda i: cast({digit('i')} * 16 + {digit('i + 1')} AS BIGINT))"


def _crc32(bytes_: str) -> str:
    """Unsigned crc32 of a list of bytes, bit by bit."""
    eight = ("list_reduce(list_prepend(xor(c, y), range(8)),"
             " lambda v, k: xor(v >> 1, cast(3988292384 AS BIGINT) * (v & 1)))")
    full = "cast(4294967295 AS BIGINT)"
    return f"xor(list_reduce(list_prepend({full}, {bytes_}), lambda c, y: {eight}), {full})"


def resampling_sql() -> str:
    """op12: words as rows, buckets of the distinct words, gains by bucket."""
    n, percent = resampling.BUCKETS, resampling.PERCENT
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{merkle.UPPER}', '{merkle.UPPER.lower()}'),"
             r" '(?:[0-9a-z]|[^\x00-\x7F])+')")
    h = f"cast('0x' || substr(sha256('{resampling.SEED}:' || coalesce(cast(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
source_words AS (SELECT rid, x, count(*) AS n FROM (SELECT rid, unnest(w) AS x FROM docs) GROUP BY rid, x),
target_words AS (SELECT x, count(*) AS n FROM (SELECT unnest({words}) AS x FROM benchmark) GROUP BY x),
known AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM source_words UNION SELECT x FROM target_words)),
placed AS (SELECT x, {_crc32("b")} % {n} AS bucket FROM (SELECT x, {_bytes("h")} AS b FROM known)),
s AS (SELECT bucket, sum(n) AS s FROM source_words JOIN placed USING (x) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM target_words JOIN placed USING (x) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + {n}::DOUBLE)
    / ((s + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + {n}::DOUBLE)))) AS gain
  FROM s LEFT JOIN t USING (bucket)),
sums AS (SELECT rid, sum(n * gain) AS g FROM source_words JOIN placed USING (x) JOIN gains USING (bucket) GROUP BY rid),
weighed AS (
  SELECT rid, doc_id, cast(len(w) AS BIGINT) AS n_features,
         cast(floor(coalesce(g, 0) / greatest(len(w), 1)) AS BIGINT) AS weight FROM docs LEFT JOIN sums USING (rid)),
scored AS (SELECT *, weight + cast(floor(-1000 * ln(-ln(({h} + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM weighed),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id, weight, n_features, rid) AS rank
  FROM scored WHERE n_features >= {resampling.MIN_WORDS})
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM ranked) * {percent} // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (rid)"""


def merkle_sql() -> str:
    """op13: every level of both trees by recursion, then each document's steps."""
    k, columns = merkle.FANOUT, merkle.LEAF_COLUMNS

    def field(c):
        v = f"cast({c} AS VARCHAR)"
        return f"coalesce(strlen({v}) || ':' || {v}, '-')"

    lowered = f"translate(text, '{merkle.UPPER}', '{merkle.UPPER.lower()}')"
    leaf = "sha256(" + " || ".join(field(c) for c in columns) + ")"
    changed = "sha256(" + " || ".join(field(lowered if c == "text" else c) for c in columns) + ")"
    ids = _bytes("hex(encode(cast(doc_id AS VARCHAR)))")

    def levels(name, leaves):
        return f"""
{name} AS (
  SELECT tree, 0 AS level, r, n, digest FROM {leaves}
  UNION ALL SELECT tree, level + 1, r // {k}, (n + {k - 1}) // {k}, sha256(string_agg(digest, '' ORDER BY r))
  FROM {name} WHERE n > 1 GROUP BY tree, level, r // {k}, n),
{name}_steps AS (
  SELECT a.tree, a.level, a.r, coalesce(string_agg(b.digest, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS lft,
         coalesce(string_agg(b.digest, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS rgt
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.r // {k} = b.r // {k}
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.r)"""

    return f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         {leaf} AS leaf, CASE WHEN {_crc32("b")} % 5 = 0 THEN {changed} ELSE {leaf} END AS changed
  FROM (SELECT *, CASE WHEN doc_id IS NOT NULL THEN {ids} END AS b FROM documents)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY tree) AS n FROM docs),
leaves AS (SELECT tree, r, n, leaf AS digest FROM ranked),
{levels("low", "leaves")},
subroots AS (SELECT tree AS r, digest FROM low WHERE n = 1),
tops AS (SELECT 0 AS tree, r, (SELECT count(*) FROM subroots) AS n, digest FROM subroots),
{levels("top", "tops")},
steps AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY part, level) AS k, lft, rgt FROM (
    SELECT rid, 0 AS part, level, lft, rgt FROM ranked d JOIN low_steps s
      ON d.tree = s.tree AND s.r = d.r // cast(power({k}, s.level) AS BIGINT)
    UNION ALL SELECT rid, 1, level, lft, rgt FROM ranked d JOIN top_steps s
      ON s.r = d.tree // cast(power({k}, s.level) AS BIGINT))),
folded AS (
  SELECT rid, cast(0 AS BIGINT) AS k, changed AS digest FROM ranked
  UNION ALL SELECT f.rid, s.k, sha256(s.lft || f.digest || s.rgt) FROM folded f JOIN steps s ON s.rid = f.rid AND s.k = f.k + 1),
last AS (SELECT rid, arg_max(digest, k) AS folded_root FROM folded GROUP BY rid),
proofs AS (SELECT rid, sha256(string_agg(lft || rgt, '' ORDER BY k)) AS proof FROM steps GROUP BY rid),
whole AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM ranked d JOIN subroots s ON s.r = d.tree JOIN last USING (rid) LEFT JOIN proofs USING (rid) CROSS JOIN whole"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_minhash_dedup": near_duplicate_sql(),
        "op8_quality_rules": quality_sql(),
        "op9_embedding_dedup": embedding_sql(),
        "op12_resampling": resampling_sql(),
        "op13_merkle_manifest": merkle_sql(),
    }
