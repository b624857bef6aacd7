"""Long texts, several packing groups, the pipeline on odd tables."""

import collections
import re

import corpus_pipeline
import pytest
from llm_cases import documents, empty, prose, texts

from priceflow.llm import common, license_scan, lm_score, merkle, packing, quality_classifier, resampling

LONG = prose(21, 700) + " "  # about 4 KB


@pytest.fixture(scope="module")
def long_rows():
    whole = LONG * 1100  # over 4 MB: more than one piece, hash block and splitter piece
    assert len(whole) > 4 << 20
    return [(1, whole + "Released under the MIT License."), (2, "x" * (3 << 20)), (3, "short text"), (4, whole)]


def test_a_licence_at_the_end_of_a_long_text(spark, long_rows):
    rows = {r.doc_id: r for r in license_scan.scan(documents(spark, long_rows)).collect()}
    n = len(long_rows[0][1].split())
    assert rows[1].n_words == n and rows[1].first_word == n - 2 and rows[1].labels == "mit"
    assert (rows[2].n_words, rows[2].labels) == (1, "") and rows[4].labels == ""


def test_statistics_of_long_texts(spark, long_rows):
    labels = spark.createDataFrame([(1, 1), (4, 1), (2, 0), (3, 0)], "doc_id bigint, quality int")
    out = quality_classifier.score_documents(documents(spark, long_rows), labels).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)


def test_features_of_long_texts(spark, long_rows):
    rows = {r.doc_id: r for r in resampling.features(documents(spark, long_rows), "doc_id", 97, 1, 2).collect()}
    for doc, text in long_rows:
        n = len(re.findall("[0-9a-z]+", text.lower()))
        assert (rows[doc].n_words, rows[doc].n_features) == (n, 2 * n - 1) and sum(rows[doc].counts) == 2 * n - 1


def test_manifest_and_scores_of_long_texts(spark, long_rows):
    assert all(r.verified or r.doc_id for r in merkle.verify(merkle.manifest(documents(spark, long_rows))).collect())
    rows = {r.doc_id: r for r in lm_score.score_documents(documents(spark, long_rows)).collect()}
    assert all(rows[i].n_tokens == len(t.split()) and rows[i].log_prob < 0 for i, t in long_rows)
    assert rows[1].n_tokens > rows[4].n_tokens > 700000


def plain_best_fit(sizes, lengths):
    """Capacities of the cheapest packing, by plain loops."""
    best = None
    for least in (0, *lengths):
        bins = []  # [capacity, used]
        for i, size in enumerate(sizes):
            open_ = [b for b in bins if b[0] - b[1] >= size]
            if open_:
                min(open_, key=lambda b: b[0] - b[1])[1] += size
                continue
            able = [c for c in lengths if c >= max(size, least)]
            rest = sum(sizes[i + 1:])
            capacity = min(able, key=lambda c: (packing.cost(c) / (size + min(c - size, rest)), c)) if not least else able[0]
            bins.append([capacity, size])
        fitted = sorted(min(c for c in lengths if c >= used) for _, used in bins)
        price = sum(map(packing.cost, fitted))
        if best is None or price < best[0] - 1e-9:
            best = (price, fitted)
    return best


def test_every_group_is_packed_as_cheaply_as_by_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 30)
    rows = texts() + [(500 + i, prose(i, 20 + 37 * (i % 60))) for i in range(180)]
    out = packing.pack_documents(documents(spark, rows)).where("length > 0").collect()
    groups = collections.defaultdict(lambda: (collections.Counter(), {}))
    for r in out:
        sizes, capacity = groups[r.bin_id >> 32]
        sizes[r.length] += 1
        capacity[r.bin_id] = r.capacity
    assert len(groups) >= 4
    for sizes, capacity in groups.values():
        price, _ = plain_best_fit(sorted(sizes.elements(), reverse=True), packing.LENGTHS)
        assert abs(sum(map(packing.cost, capacity.values())) - price) < 1e-6


def table(spark, root, docs, labels=()):
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, table(spark, tmp_path, empty(spark))).count() == 0


def test_pipeline_keeps_clean_texts_whatever_the_other_columns(spark, tmp_path):
    rows = [(i, f"{prose(i, 60)}\n{prose(900 + i, 60)}") for i in range(40)] + [(50, None), (51, "")]
    labels = [(i, 1, 0) for i in range(40)]
    plain = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    clashing = plain.selectExpr("*", "'a' AS Score", "'b' AS kept", "'c' AS n_words", "'d' AS text_hash", "'e' AS component_id",
                                "'f' AS __id", "'g' AS chunk")
    got = [sorted((r.doc_id, r.n_tokens, r.length) for r in corpus_pipeline.run(
        spark, table(spark, tmp_path / name, df, labels)).collect()) for name, df in (("a", plain), ("b", clashing))]
    assert got[0] == got[1] == [(i, 120, 120) for i in range(40)]
    assert common.BLOCK
