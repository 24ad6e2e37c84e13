"""Quality by compression: which of two dictionaries makes a text smaller.

One zstandard dictionary is built from good, one from bad labelled text. A text is cut in
blocks, each is compressed with both, and the sizes are summed: short blocks keep the
dictionary's share of the result alike in short and long texts. The normalised difference,
``(good - bad) / (good + bad)``, and the compressed share of the text, which tells endless
repetition that neither dictionary helps with, are calibrated by logistic regression on
labelled rows that the dictionaries have not seen.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.rows import mapped, texts, utf8
from addrloom.operators.staging import staged

# Bounds of the labelled sample: rows per label, half for the dictionaries and half for the
# calibration, and bytes taken of each, in blocks, for the dictionaries.
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 8_192
DICTIONARY_BYTES = 112_640
BLOCK = 2_048
LEVEL = 3
THRESHOLD = 0.3
FOLDS = 5


def held_out(column: str = "doc_id"):
    """Rows that labels are never learnt from; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % FOLDS == 0, F.lit(False))


@functools.lru_cache(4)
def _compressors(good: bytes, bad: bytes) -> tuple:
    return tuple(
        zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False
        )
        for d in (good, bad)
    )


def features(data: bytes, good: bytes, bad: bytes) -> tuple[float, float]:
    """The normalised difference of the compressed sizes, and their share of the text."""
    if not data:
        return 0.0, 1.0
    a, b = _compressors(good, bad)
    sizes = [0, 0]
    for start in range(0, len(data), BLOCK):
        block = data[start : start + BLOCK]
        sizes[0] += len(a.compress(block))
        sizes[1] += len(b.compress(block))
    return (sizes[0] - sizes[1]) / (sizes[0] + sizes[1]), min(sizes) / len(data)


def _terms(pairs: np.ndarray) -> np.ndarray:
    """What the calibration sees of the features."""
    difference, share = pairs[:, 0], np.clip(pairs[:, 1], 0.0, 1.5)
    return np.column_stack([np.ones(len(pairs)), 10 * difference, share, share**2, np.exp(-20 * share)])


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + ridge * np.eye(len(w)), gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """At most ``sample_rows`` labelled texts of each label, none of them held out.

    Those of the smallest hashes of their ids; of several labels of an id the larger holds, of
    several texts of an id the one of the smallest hash. Ids are first held to a hash that
    about so many of a label lie below, so what is sorted does not grow with the labels.
    """
    known = staged(
        labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("own_id"), "quality").where(~held_out("own_id"))
        .groupBy("own_id").agg(F.max("quality").alias("quality")).withColumn("place", F.xxhash64("own_id"))
    )
    enough = sample_rows + 10 * math.isqrt(sample_rows) + 10
    chosen = known.limit(0)
    for row in known.groupBy("quality").count().collect():
        below = min(2**63 - 1, -(2**63) + 2**64 * enough // row["count"])
        near = known.where((F.col("quality") == row["quality"]) & (F.col("place") <= below))
        chosen = chosen.union(near.orderBy("place", "own_id").limit(sample_rows))
    own = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("own_id"))  # bounded by its size
    one = F.min(F.struct(F.xxhash64("data"), F.col("data"))).alias("least")
    return own.groupBy("own_id", "quality").agg(one).select("own_id", "quality", "least.data")


def _training_blocks(data: str = "data") -> str:
    """The text if it is short, else as many of its blocks as are taken, by their hashes."""
    last = f"(length({data}) - 1) div {BLOCK}"
    by_hash = f"array_sort(transform(sequence(0L, {last}), i -> struct(xxhash64(own_id, i) AS hash, i AS number)))"
    numbers = f"array_sort(transform(slice({by_hash}, 1, {SAMPLE_BYTES // BLOCK}), b -> b.number))"
    block = f"substring({data}, CAST(i * {BLOCK} + 1 AS INT), {BLOCK})"
    return f"aggregate({numbers}, CAST('' AS BINARY), (taken, i) -> concat(taken, {block}))"


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little to train on, the raw samples."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[bytes, bytes, list[float]]:
    """Two dictionaries and the calibration's weights. ``docs`` has doc_id and data.

    Texts come to the driver in bounded number and size, for the dictionaries; for the
    calibration only their features do. Without labels of both kinds the score is the share
    of good ones.
    """
    sample = labelled_sample(docs, labels, sample_rows).withColumn("part", F.expr("pmod(xxhash64(own_id, 'part'), 2)"))
    sample = staged(sample)
    parts = sample.where("part = 0").select("own_id", "quality", F.expr(_training_blocks()).alias("data")).collect()
    parts.sort(key=lambda row: (row["own_id"], bytes(row["data"])))
    good, bad = (_dictionary([bytes(r["data"]) for r in parts if r["quality"] == q and r["data"]]) for q in (1, 0))

    def row(data: bytes) -> tuple:
        return features(data, good, bad)

    rest = mapped(sample.where("part = 1").select("own_id", "quality", "data"), "difference double, share double", row, ["own_id", "quality"]).collect()
    rest.sort()
    if len({r["quality"] for r in rest}) < 2:
        known = [r["quality"] for r in rest] or [1]
        odds = (sum(known) + 0.5) / (len(known) - sum(known) + 0.5)
        return good, bad, [math.log(odds), 0.0, 0.0, 0.0, 0.0]
    x = _terms(np.array([(r["difference"], r["share"]) for r in rest]))
    return good, bad, logistic_fit(x, np.array([float(r["quality"]) for r in rest])).tolist()


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (1 is good) and predicted.

    ``labels`` has doc_id and quality. Whole texts are scored; a null text is an empty one.
    Repeated rows give repeated results, a null id is not held out, an empty table gives an
    empty one.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, sample_rows))

    def row(data: bytes) -> tuple:
        good, bad, weights = model.value
        z = float((_terms(np.array([features(data, good, bad)])) @ np.array(weights))[0])
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        return score, int(score >= THRESHOLD)

    scored = mapped(rows.withColumn("held_out", held_out()), "score double, predicted int", row, ["doc_id", "held_out"])
    return scored
