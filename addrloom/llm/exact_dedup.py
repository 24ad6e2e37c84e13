"""Exact dedup by two passes over a Bloom filter that knows what was set twice.

The first pass sets the bits of each text's hash; see ``bloom`` for how the tasks' bitmaps
merge. In the second pass a hash with any bit not set twice is alone: its row passes
straight through. Only the others, true repeats and a few false ones, are shuffled and
grouped exactly. Bits that two different hashes share only add false ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrloom.llm.bloom import MAX_FILTER_BYTES, make_filter, with_maybe
from addrloom.llm.rows import texts, whole_row
from addrloom.operators.staging import staged

_DIGEST = "unhex(sha2(coalesce(text, ''), 256)) AS digest"


def possibly_repeated(digests: DataFrame, rows: int, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Add ``maybe``: whether another row may have the same ``digest``; false is sure."""
    return with_maybe(digests, make_filter(digests, rows, "twice", max_filter_bytes))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group and its largest doc_id stays; a null text is an empty one, and
    a null id is smaller than any. Of rows that repeat id and text one is kept. An empty
    table gives an empty result. The texts are read once; what goes on is their hashes.
    """
    hashed = staged(texts(docs, id_col, text_col).selectExpr("doc_id", "monotonically_increasing_id() AS row_number", _DIGEST))
    tested = staged(possibly_repeated(hashed, hashed.count(), max_filter_bytes))
    alone = tested.where("NOT maybe").selectExpr(
        "doc_id", "doc_id AS keep_id", "1L AS group_size", "true AS kept", "lower(hex(digest)) AS text_sha256"
    )
    shuffled = tested.where("maybe")
    groups = shuffled.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row_number")).alias("stays"), F.count("*").alias("group_size")
    )
    # Written, so that the join has two plain exchanges and Spark can split a crowded digest.
    groups = staged(groups)
    grouped = shuffled.join(groups, "digest").selectExpr(
        "doc_id",
        "stays.doc_id AS keep_id",
        "group_size",
        "row_number = stays.row_number AS kept",
        "lower(hex(digest)) AS text_sha256",
    )
    return alone.union(grouped)


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they are.

    The texts are read twice, for the filter and with it. Rows of texts without a copy pass
    straight through. Of the others a map task sends on one per text at most, so that a
    crowded text is a row per task.
    """
    columns = texts(docs, id_col, text_col).selectExpr(_DIGEST)
    made = make_filter(columns, docs.count(), "twice", max_filter_bytes)
    rows = docs.select(whole_row(docs), docs[id_col].alias("id"), docs[text_col].alias("text")).selectExpr("row", "id", _DIGEST)
    tested = with_maybe(rows, made)
    largest = Window.partitionBy("digest").orderBy(F.desc_nulls_last("id"))
    stays = tested.where("maybe").withColumn("place", F.row_number().over(largest)).where("place = 1")
    return tested.where("NOT maybe").select("row").union(stays.select("row")).select("row.*")
