import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from addrloom.llm.quality_classifier import BLOCK, SAMPLE_BYTES, _training_blocks, features, fit, labelled_sample, quality_scores
from tests.llm.conftest import prose


def bad(seed):
    rnd = random.Random(seed)
    return " ".join(w + rnd.choice(["###", "&&&", "%%%"]) for w in prose(seed, 60).split())


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, prose(i, 60) if i % 3 else bad(i), i % 3 and 1) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return rows, docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")


def scores(docs, labels):
    return {r["doc_id"]: r for r in quality_scores(docs, labels).collect()}


def test_accuracy_on_held_out_rows(labelled):
    rows, docs, labels = labelled
    got = scores(docs, labels)
    tested = [(got[i], q) for i, _, q in rows if got[i]["held_out"]]
    assert {i for i, r in got.items() if r["held_out"]} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == q for r, q in tested) >= 0.95 * len(tested)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_labels_of_held_out_rows_are_not_used(labelled):
    _, docs, labels = labelled
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS string)) % 5 = 0, 1 - quality, quality) AS quality")
    assert scores(docs, labels) == scores(docs, turned)


def test_odd_rows(table, odd_rows, labelled, spark):
    _, _, labels = labelled
    docs = table(odd_rows)
    got = quality_scores(docs, labels).collect()
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(i) for i, _ in odd_rows)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    none = labels.where("doc_id < 0").selectExpr("*", "1 AS toxic")
    assert {r["predicted"] for r in quality_scores(docs, none).collect()} == {1}
    assert quality_scores(table([]), labels).count() == 0
    odd_labels = spark.createDataFrame([(None, 1), (1, None), (None, None), (2, 7), (4, 1), (4, 0), (7, 0)], "doc_id long, quality int")
    assert quality_scores(docs, odd_labels).count() == len(odd_rows)


def test_features_without_text():
    assert features(b"", b"good words here", b"bad words there") == (0.0, 1.0)


def test_the_sample_is_bounded_in_rows(spark):
    """One id on very many rows counts once, and so do more ids than are asked for."""
    docs = spark.range(3_000).selectExpr("IF(id < 2000, 1, id) AS doc_id", "CAST(concat('text ', id) AS BINARY) AS data")
    labels = spark.range(3_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    sample = labelled_sample(docs, labels, 100)
    assert sample.groupBy("quality").count().where("count > 100").isEmpty()
    own = {r["own_id"]: r["data"] for r in labelled_sample(docs, labels, 3_000).collect()}
    assert set(own) == {i for i in [1, *range(2_000, 3_000)] if zlib.crc32(str(i).encode()) % 5}
    assert 0 < sample.count() <= 200
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, labelled_sample(docs, labels, 100).collect()))


def test_the_sample_has_the_smallest_hashes(spark):
    docs = spark.range(2_000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS data").withColumn("data", F.col("data").cast("binary"))
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 3 = 0 AS INT) AS quality")
    hashes = labels.selectExpr("doc_id", "quality", "xxhash64(doc_id) AS h").collect()
    want = set()
    for quality in (0, 1):
        own = sorted((r["h"], r["doc_id"]) for r in hashes if r["quality"] == quality and zlib.crc32(str(r["doc_id"]).encode()) % 5)
        want |= {i for _, i in own[:50]}
    assert {r["own_id"] for r in labelled_sample(docs, labels, 50).collect()} == want


def test_dictionaries_see_blocks_of_the_whole_text(spark):
    long = b"".join(bytes([65 + n]) * BLOCK for n in range(20)) + b"end"
    rows = [(n, long) for n in range(40)] + [(100, b"short"), (101, b""), (102, b"x" * SAMPLE_BYTES)]
    got = {r["own_id"]: bytes(r["d"]) for r in spark.createDataFrame(rows, "own_id long, data binary").selectExpr("own_id", f"{_training_blocks()} AS d").collect()}
    assert (got[100], got[101], got[102]) == (b"short", b"", b"x" * SAMPLE_BYTES)
    seen = set()
    for n in range(40):
        assert len(got[n]) in (SAMPLE_BYTES, SAMPLE_BYTES - BLOCK + 3)
        blocks = [got[n][at : at + BLOCK] for at in range(0, len(got[n]), BLOCK)]
        assert blocks == sorted(blocks) and len(set(blocks)) == 4 and all(b in long for b in blocks)
        seen |= set(blocks)
    assert len(seen) == 21


def test_scores_are_those_of_features_and_weights(labelled):
    rows, docs, labels = labelled
    good, low, weights = fit(docs.selectExpr("doc_id", "CAST(text AS BINARY) AS data"), labels)
    got = scores(docs, labels)
    for i, text, _ in rows[:60]:
        difference, share = features(text.encode(), good, low)
        z = weights[0] + weights[1] * 10 * difference + weights[2] * share + weights[3] * share**2 + weights[4] * math.exp(-20 * share)
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
