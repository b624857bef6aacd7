"""MinHash, suffix-array and embedding near-dedup, sharding, packing, pipeline."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from llm_cases import documents, empty, prose, texts
from pyspark.sql import functions as F

from priceflow.llm import components, embedding_dedup, minhash_dedup, packing, sharding, suffix_dedup


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group(0).lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def brute_components(rows, percent):
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = roots(len(rows), links)
    least = {}
    for (doc, _), r in zip(rows, root):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [(doc, len(s), least.get(r) if s else doc) for (doc, _), s, r in zip(rows, sets, root)]


def edited(base, seed, edits):
    r, words = random.Random(seed), base.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = "w" + str(r.randrange(10 ** 6))
    return " ".join(words)


def near_rows():
    base, other = prose(50, 160), prose(51, 30)
    rows = [(100 + i, edited(base, i, i % 9)) for i in range(60)]
    rows += [(300 + i, edited(other, i, i % 3)) for i in range(20)]
    rows += [(500 + i, prose(60, 60) + " " + prose(600 + i, 200)) for i in range(15)]  # a shared passage
    return rows + texts()


@pytest.mark.parametrize("percent", [85, 80])
def test_minhash_components_equal_brute_force(spark, percent):
    rows = near_rows()
    out = minhash_dedup.near_duplicates(documents(spark, rows), percent)
    got = collections.Counter(map(tuple, out.select("doc_id", "n_shingles", "component_id", "kept").collect()))
    want = collections.Counter((d, n, c, d == c) for d, n, c in brute_components(rows, percent))
    assert got == want


def test_minhash_keeps_one_document_of_each_group(spark):
    rows = near_rows()
    docs = documents(spark, rows)
    kept = minhash_dedup.deduplicate(docs, 80)
    assert kept.columns == docs.columns
    want = brute_components(rows, 80)
    groups = {c for _, n, c in want if n}
    with_words = [r.doc_id for r in kept.collect() if shingles(r.text)]
    assert len(with_words) == len(groups) and {d for d in with_words if d is not None} == groups - {None}
    assert minhash_dedup.deduplicate(empty(spark)).count() == 0


def test_radius_and_block_counts():
    assert minhash_dedup.radius(85) < minhash_dedup.radius(80) < minhash_dedup.HASHES
    sets = [np.unique(np.array(s, np.uint64)) for s in ([1, 2, 3], [2, 3, 4], [], [9], [3, 9])]
    want = [[len(set(a) & set(b)) for b in sets] for a in sets]
    got = minhash_dedup.shared_counts(sets)
    off = ~np.eye(len(sets), dtype=bool)
    assert (got[off] == np.array(want)[off]).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 150)]
    out = dict(map(tuple, components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert {out[i] for i in range(41)} == {0} and {out[100 + i] for i in range(60)} == {100}
    assert out[200] == 100 and 7 in out


def brute_removed(rows, length=suffix_dedup.LENGTH):
    raws = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (doc, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((doc, len(raw), int(gone.sum()), len(suffix_dedup._spans_of_true(gone)),
                    hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [suffix_dedup.SHARD, 3000])
def test_suffix_dedup_equals_brute_force(spark, shard):
    passage = prose(70, 80)
    rows = [(i, t) for i, t in texts() if i != 14]
    rows += [(1000 + i, prose(700 + i, 30 + i) + " " + passage[i % 50:300 + i] + " " + prose(800 + i, 25))
             for i in range(60)]
    rows += [(2000, "ab" * 400), (2001, "ab" * 300 + "c"), (2002, prose(71, 400)), (2003, prose(71, 400)[7:900])]
    out = suffix_dedup.remove_repeats(documents(spark, rows), shard=shard)
    got = collections.Counter(map(tuple, out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)).collect()))
    assert got == collections.Counter(brute_removed(rows))


def test_suffix_array_prefixes_and_long_texts():
    random_ = np.random.default_rng(1)
    for letters in (1, 2, 5, 250):
        data = random_.integers(0, letters, 400).astype(np.uint8)
        data = np.concatenate([data, data[30:200], np.zeros(20, np.uint8)])
        raw, order = data.tobytes(), suffix_dedup.suffix_array(data)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        lcp = suffix_dedup.common_prefixes(data, order)
        for k in range(1, len(raw)):
            a, b, n = order[k - 1], order[k], 0
            while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n] and n < 2 * suffix_dedup.LENGTH:
                n += 1
            assert lcp[k] == n
    data = random_.integers(97, 101, 5000).astype(np.uint8)
    whole = suffix_dedup.runs(data, np.array([0, 5000]))
    assert whole[2].sum() == 5000 - suffix_dedup.LENGTH + 1 and (whole[2] <= 169).all()


def test_suffix_dedup_cleans_whole_characters(spark):
    rows = [(1, "ä" + "é" * 300 + "b"), (2, "ü" + "é" * 300 + "c"), (3, "kept as it is"), (4, None)]
    docs = documents(spark, rows)
    out = suffix_dedup.clean_documents(docs)
    assert out.columns == docs.columns
    clean = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert clean[1] == ("äb", 2) and clean[2] == ("üc", 2) and clean[3] == ("kept as it is", 13) and clean[4] == ("", 0)
    assert suffix_dedup.clean_documents(empty(spark)).count() == 0


def vectors(spark):
    random_ = np.random.default_rng(4)
    base = random_.normal(size=(12, 16))
    rows, n = [], 0
    for g in range(12):
        for k in range(25):
            v = base[g] + random_.normal(size=16) * [0.0, 0.05, 0.1, 0.4][k % 4]
            rows.append((n, [float(np.float32(x)) for x in v], g % 3))
            n += 1
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, rows[0][1], None),
             (904, [], 1), (905, rows[0][1], 0), (905, rows[0][1], 0), (906, [x * 2 for x in rows[0][1]], 0),
             (907, rows[0][1][:8], 0), (908, [None] + rows[0][1][1:], 0), (909, rows[0][1], 2)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows],
                                       "vec_id bigint, embedding array<float>, label int, kept string")


def test_embedding_links_equal_brute_force(spark):
    rows, table = vectors(spark)
    good = [r[1] is not None and len(r[1]) > 0 and r[2] is not None and None not in r[1]
            and np.isfinite(r[1]).all() and any(r[1]) for r in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a], rows[b]
            if good[a] and good[b] and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.float32(x[1]).astype(float), np.float32(y[1]).astype(float)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.98:
                    links.append((a, b))
    count = collections.Counter(i for l in links for i in l)
    root = roots(len(rows), links)
    least = {}
    for r, (doc, *_) in zip(root, rows):
        least[r] = min(doc, least.get(r, doc))
    want = collections.Counter((r[0], count[i], least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(rows))
    got = collections.Counter(map(tuple, embedding_dedup.near_duplicates(table).select(
        "vec_id", "n_links", "component_id", "kept").collect()))
    found, true = (sum(k[1] * c for k, c in x.items()) for x in (got, want))
    assert found <= true and found >= 0.9 * true
    assert sum((got & want).values()) >= 0.97 * len(rows)
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_sharding_is_even_gapless_and_by_ring(spark):
    rows = [(i, "t" * (i % 7)) for i in range(500)] + [(7, "hot")] * 300 + [(None, None)] * 5
    out = sharding.shard_documents(documents(spark, rows), 8).collect()
    assert len(out) == len(rows)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    sizes = [len(v) for v in slots.values()]
    assert set(slots) == set(range(8)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(r.size == 1 for r in out if r.doc_id is None)
    # no row overtakes a shard with room: rows of shards that were never full stay at home
    ring = sharding.ring(8, 64)
    points = [p for p, _ in ring]
    home = collections.Counter()
    stayed = collections.Counter()
    for r in out:
        h = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16)
        owner = ring[np.searchsorted(points, h) % len(points)][1]
        home[owner] += 1
        stayed[owner] += owner == r.shard
    for s in range(8):
        assert stayed[s] == min(home[s], sizes[list(slots).index(s)])
    assert sharding.shard_documents(empty(spark), 8).count() == 0


def test_packing_fits_and_covers(spark):
    docs = documents(spark)
    out = [r.asDict() for r in packing.pack_documents(docs).collect()]
    counts = collections.Counter(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts())
    assert sum(r["length"] for r in out) == sum(n * c for n, c in counts.items())
    bins = collections.defaultdict(list)
    for r in out:
        if r["length"]:
            bins[r["bin_id"]].append(r)
        else:
            assert r["bin_id"] is None and r["capacity"] is None
    for rows in bins.values():
        rows.sort(key=lambda r: r["offset"])
        at = 0
        for r in rows:
            assert r["offset"] == at
            at += r["length"]
        fits = [c for c in packing.LENGTHS if c >= at]
        assert rows[0]["capacity"] == fits[0]  # downsized to its contents
    assert packing.pack_documents(empty(spark)).count() == 0


def test_packing_is_best_fit_and_no_worse_than_one_length():
    # one long sequence is cheaper than two short ones; what fits a short one is downsized
    assert packing.pack_sizes([200, 100, 56, 56], (256, 512)) == ([0, 0, 0, 0], [512])
    assert packing.pack_sizes([200, 56], (256, 512)) == ([0, 0], [256])
    random_ = random.Random(2)
    for _ in range(20):
        sizes = sorted((random_.randint(1, 2048) for _ in range(200)), reverse=True)
        bins, capacity = packing.pack_sizes(sizes)
        used = np.bincount(bins, sizes)
        assert (used <= np.array(capacity)).all()
        price = sum(map(packing.cost, capacity))
        for least in (0, *packing.LENGTHS):
            alone = packing._best_fit(sizes, packing.LENGTHS, least)[1]
            assert price <= sum(packing.cost(min(c for c in packing.LENGTHS if c >= u)) for u in alone) + 1e-9


def test_pipeline_stages_hand_on_documents(spark, tmp_path):
    import corpus_pipeline
    rows = near_rows()
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 1)], "doc_id bigint, toxic int, quality int").write.parquet(
        str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "minhash_dedup", "suffix_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert sorted(out.columns) == sorted(docs.columns), name
        assert out.count() <= docs.count()
        docs = out.cache()
    packed = corpus_pipeline.run(spark, str(tmp_path))
    want = sum(len((r.text or "").split()) for r in docs.collect())
    assert packed.agg(F.sum("length")).first()[0] == want


def test_suffix_dedup_tells_null_ids_apart(spark):
    # two texts of one 32-bit hash, the second too short for the first one's repeats
    texts = spark.range(200000).select("id", F.concat(F.lit("short "), F.col("id")).alias("short"), F.concat(
        F.lit(prose(90, 60) + " "), F.col("id")).alias("long"))
    short = texts.select("short", F.hash("short").alias("h"))
    pair = texts.select("long", F.hash("long").alias("h")).join(short, "h").orderBy("h").first()
    assert pair is not None
    rows = [(None, pair.long), (None, pair.short), (1, pair.long + " more")]
    out = suffix_dedup.remove_repeats(documents(spark, rows))
    got = collections.Counter(map(tuple, out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)).collect()))
    assert got == collections.Counter(brute_removed(rows))


def test_suffix_dedup_finds_repeated_rows_once(spark, monkeypatch):
    passage = prose(91, 60)
    rows = [(None, prose(92, 100) + " " + passage)] * 30 + [(5, prose(93, 50) + " " + passage)]
    seen = []
    monkeypatch.setattr(suffix_dedup.common, "map_arrow", lambda df, run, schema, real=suffix_dedup.common.map_arrow: (
        seen.append(df) or df if "hits" in df.columns else real(df, run, schema)))
    joined = suffix_dedup.remove_repeats(documents(spark, rows))
    hits = [[tuple(h) for h in r.hits] for r in joined.where("hits IS NOT NULL").collect()]
    assert seen and len(hits) == 31 and all(len(h) == len(set(h)) for h in hits)
    monkeypatch.undo()
    out = suffix_dedup.remove_repeats(documents(spark, rows))
    got = collections.Counter(map(tuple, out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)).collect()))
    assert got == collections.Counter(brute_removed(rows))


def test_minhash_compares_one_text_of_a_repeated_row(spark, monkeypatch):
    base = prose(94, 120)
    words = base.split()
    rows = [(None, base)] * 40 + [(2, " ".join(words[:60] + ["changed"] + words[61:]))]
    written = {}
    real = minhash_dedup.common.materialize
    monkeypatch.setattr(minhash_dedup.common, "materialize",
                        lambda df, name: written.setdefault(name, real(df, name)))
    out = minhash_dedup.near_duplicates(documents(spark, rows), 80)
    assert out.count() == 41 and {r.component_id for r in out.collect()} == {2}
    assert written["minhash-texts"].count() == 2 and written["minhash-links"].count() == 1
