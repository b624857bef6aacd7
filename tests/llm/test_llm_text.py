"""Licence scan, toxicity, byte-level BPE, quality rules, LM scores."""

import base64
import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import tiktoken
from llm_cases import documents, empty, prose, texts

from priceflow.llm import byte_bpe, license_scan, lm_score, quality_rules, toxicity


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group(0).lower(), text or "")


def test_license_scan_equals_brute_force(spark):
    got = sorted(map(tuple, license_scan.scan(documents(spark)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=repr)
    want = []
    for doc, text in texts():
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places = [(k, label) for phrase, label in license_scan.BASE.items() for k in range(len(words))
                  if words[k:k + len(phrase.split())] == phrase.split()]
        want.append((doc, len(words), len(places), min((k for k, _ in places), default=None),
                     max((k for k, _ in places), default=None), ",".join(sorted({x for _, x in places}))))
    assert got == sorted(want, key=repr)
    assert license_scan.scan(empty(spark)).count() == 0


def test_license_labels_and_score(spark):
    rows = {r.doc_id: r for r in license_scan.scan(documents(spark)).collect()}
    assert rows[19].labels == "apache,apache-2.0" and rows[19].score == 1.0
    assert rows[18].labels == "cc-by,mit"
    assert rows[1].labels == "" and rows[1].score < 0.5 and rows[5].score == 0.0
    half = "unless required by applicable law or agreed to in writing software is something else entirely"
    partial = license_scan.scan(documents(spark, [(1, half)])).first()
    assert 0.2 < partial.score < 0.8 and partial.labels == "" and partial.spans


def test_maximal_segments_equal_brute_force():
    def brute(scores):
        """Best segment, leftmost longest; then the same left and right of it."""
        best = None
        for a in range(len(scores)):
            for b in range(a, len(scores)):
                s = sum(scores[a:b + 1])
                if s > 0 and (best is None or s > best[2] + 1e-9):
                    best = (a, b, s)
        if best is None:
            return []
        a, b, s = best
        right = [(x + b + 1, y + b + 1, z) for x, y, z in brute(scores[b + 1:])]
        return brute(scores[:a]) + [best] + right

    random = np.random.default_rng(0)
    for _ in range(200):
        scores = random.choice([-3.0, -1.5, -0.7, 1.1, 2.3], random.integers(1, 12))
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(scores)]
        assert got == [(a, b, round(s, 6)) for a, b, s in brute(scores.tolist())]


def toxic_rows():
    rows, labels = [], []
    for i in range(240):
        words = prose(1000 + i, 60).split()
        bad = i % 4 == 1
        if bad:
            for k in (10, 11, 30):
                words[k] = ("zapfoo" + words[k]) if i % 8 == 1 else "rotter"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_is_accurate_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    table = spark.createDataFrame(labels + [(0, None), (None, 1), (1, 0)], "doc_id bigint, toxic int")
    out = {r.doc_id: r for r in toxicity.score_documents(documents(spark, rows + [(900, None), (901, "")]), table).collect()}
    held = [(i, t) for i, t in labels if out[i].held_out]
    assert 30 < len(held) < 100
    assert sum(out[i].predicted == t for i, t in held) / len(held) >= 0.95
    assert out[900].score == out[901].score == min(r.score for r in out.values()) and out[900].predicted == 0
    spans = [p for i, t in held if t and out[i].passages for p in out[i].passages]
    assert spans and all(9 <= p.first_word <= p.last_word <= 31 for p in spans)


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    scored = toxicity.score_documents(documents(spark), none)
    assert scored.count() == len(texts()) and scored.where("predicted = 1").count() == 0
    assert toxicity.score_documents(empty(spark), none).count() == 0
    rows, labels = toxic_rows()
    docs = documents(spark, rows)
    kept = toxicity.drop_toxic(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert kept.columns == docs.columns and 170 <= kept.count() <= 190


def encoding():
    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library_and_round_trips(spark, monkeypatch):
    enc = encoding()
    docs = documents(spark)
    got = collections.Counter(map(tuple, byte_bpe.digests(docs).collect()))
    want = collections.Counter()
    for doc, text in texts():
        ids = enc.encode_ordinary(text or "")
        want[doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want
    decoded = byte_bpe.decode_ids(byte_bpe.encode(docs))
    assert sorted(bytes(r.bytes).decode() for r in decoded.collect()) == sorted(t or "" for _, t in texts())
    assert byte_bpe.digests(empty(spark)).count() == 0


def test_merges_of_long_pieces():
    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    enc = encoding()
    for text in ("x" * 3000, "ab" * 700, "aaaaab" * 150, prose(5, 200).replace(" ", "")):
        assert byte_bpe.merge(text.encode(), ranks) == enc.encode_ordinary(text)
    odd = "".join(chr(c) for c in (*range(1, 256), 0x1680, 0x2000, 0x2028, 0x202F, 0x3000, 0x180E, 0xFEFF))
    odd = " ".join(odd) + odd
    split = byte_bpe.splitter().findall(odd)
    assert "".join(split) == odd
    assert [i for w in split for i in byte_bpe.merge(w.encode(), ranks)] == enc.encode_ordinary(odd)
    assert base64.b64encode(b"a")


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    seen, covered = collections.Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_quality_measures_equal_brute_force(spark):
    rows = quality_rules.apply_policy(quality_rules.ledger(documents(spark)), "base-1", "ok")
    got = collections.Counter(map(tuple, rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ok").collect()))
    want = collections.Counter()
    for doc, text in texts():
        m = measures(text)
        want[(doc, *m, not (m[0] < 20 or 100 * m[4] > 30 * m[0]))] += 1
    assert got == want


def test_quality_policy_ablation_and_filter(spark):
    docs = documents(spark)
    rows = quality_rules.ledger(docs).select("fail_bits").collect()
    mask = quality_rules.policy_mask("strict-1")
    for r in quality_rules.ablation(quality_rules.ledger(docs), "strict-1").collect():
        bit = quality_rules.BITS[r.rule]
        bits = [x.fail_bits & mask for x in rows]
        assert r.rejected == sum(b & bit != 0 for b in bits)
        assert r.rejected_alone == sum(b == bit for b in bits)
        assert r.kept_without == sum(b & ~bit == 0 for b in bits)
    kept = quality_rules.filter_documents(docs, "base-1")
    assert kept.columns == docs.columns
    want = [t for _, t in texts() if measures(t)[0] >= 20 and 100 * measures(t)[4] <= 30 * measures(t)[0]]
    assert sorted(r.text for r in kept.collect()) == sorted(want)
    assert quality_rules.filter_documents(empty(spark)).count() == 0


def test_lm_prefers_the_corpus_to_shuffled_words(spark):
    import random
    r = random.Random(3)
    starts = ["the red", "a green", "my old", "the new"]
    ends = ["house stands here", "car drives away", "dog sleeps well", "cat eats fish"]
    rows = [(i, " . ".join(f"{r.choice(starts)} {r.choice(ends)}" for _ in range(40))) for i in range(120)]
    shuffled = []
    for i, text in rows[:30]:
        words = text.split()
        r.shuffle(words)
        shuffled.append((1000 + i, " ".join(words)))
    docs = documents(spark, rows)
    tokens = lm_score.Tokens(lm_score.corpus_counts(docs))
    weights = lm_score.train(docs, tokens)
    both = documents(spark, rows[:30] + shuffled + [(5000, None), (5001, "")])
    out = {x.doc_id: x for x in lm_score.score(both, tokens, weights).collect()}
    real = np.mean([out[i].mean_log_prob for i, _ in rows[:30]])
    mixed = np.mean([out[i].mean_log_prob for i, _ in shuffled])
    assert real > mixed + 0.5
    assert out[5000].log_prob == 0.0 and out[5000].mean_log_prob is None and out[5001].n_tokens == 0
    one = out[0]
    assert one.n_tokens == len(rows[0][1].split()) and abs(one.log_prob - one.mean_log_prob * one.n_tokens) < 1e-6


def test_lm_scores_every_row(spark):
    assert lm_score.score_documents(documents(spark)).count() == len(texts())
    assert lm_score.score_documents(empty(spark)).count() == 0


def test_lm_counts_every_distinct_word(spark):
    rows = [(i, " ".join(f"word{i}x{k}" for k in range(10000)) + " the the") for i in range(8)]
    counts = lm_score.corpus_counts(documents(spark, rows))
    assert counts.count() == 80001  # more than 65,536
    assert counts.agg({"n": "max"}).first()[0] == 16 and counts.where("n = 1").count() == 80000


def test_lm_context_decides_within_a_band(spark):
    random = np.random.default_rng(3)
    pairs = [(f"left{k}", f"right{k}") for k in range(100)]  # all alike in count, so of a few bands
    rows = [(i, " ".join(" ".join(pairs[k]) for k in random.integers(0, 100, 1500))) for i in range(120)]
    docs = documents(spark, rows)
    tokens = lm_score.Tokens(lm_score.corpus_counts(docs))
    weights = lm_score.train(docs, tokens)
    wrong = [(1000 + i, " ".join(w if w.startswith("left") else f"right{(int(w[5:]) + 7) % 100}" for w in t.split()))
             for i, t in rows[:30]]
    out = {x.doc_id: x.mean_log_prob for x in lm_score.score(documents(spark, rows[:30] + wrong), tokens, weights).collect()}
    assert np.mean([out[i] for i, _ in rows[:30]]) > np.mean([out[i] for i, _ in wrong]) + 0.2


def test_license_template_that_goes_on_in_another(spark):
    notice = "Licensed under the Apache License, Version 2.0. The code is free"
    longer = "x " + license_scan.TEMPLATES["apache-2.0"][1] + " y"
    rows = {r.doc_id: r for r in license_scan.scan(documents(spark, [(1, notice), (2, longer)])).collect()}
    assert rows[1].labels == "apache,apache-2.0"
    assert [(s.first_word, s.last_word) for s in rows[1].spans if s.template == "apache-2.0" and s.cover == 1.0] == [(0, 7)]
    # the short template ends inside the long one: both are whole
    assert sorted((s.first_word, s.last_word) for s in rows[2].spans if s.cover == 1.0) == [(1, 8), (1, 22)]


def test_toxicity_finds_a_second_passage_of_the_same_words():
    names = ["zap", "rot", "vex", "gob"]
    words = [f"clean{k}" for k in range(400)]
    for k, name in enumerate(names):
        words[5 + 40 * k] = name  # first singly and far apart
    words[300:304] = words[350:354] = names
    hashes = np.array([lm_score.common.word_hash(w) for w in words], np.uint64)
    lexicon = np.sort(np.array([lm_score.common.word_hash(w) for w in names], np.uint64))
    model = toxicity.Model(lexicon, np.full(4, 4.0))
    found = toxicity.segments(model.words([hashes]), hashes)
    dense = [(a, b) for a, b, s in found if model.e_value(s, len(words)) <= toxicity.SIGNIFICANT]
    assert dense == [(300, 303), (350, 353)]
    again = np.array([hashes[5]] * 50, np.uint64)  # one word over and over is one occurrence
    assert max(s for _, _, s in toxicity.segments(model.words([again]), again)) == 4.0
