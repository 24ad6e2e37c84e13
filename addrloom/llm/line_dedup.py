"""Line dedup in DataFrame operations, from texts to keep bitmaps.

Line hashes are range-partitioned and sorted by hash, document and position, so that the
first line of each document streams past as the row whose predecessor is another document.
A hash may have a third of all lines: the documents are dealt to groups and a range holds a
hash's lines of one group, so that such a hash covers many ranges and only its counts meet.
What comes out per document is a compressed bitmap: 64-bit words of dropped lines, words
without any left out. Texts do not move to meet them where that can be told: a Bloom bitmap
of the documents with a bitmap, in 64-bit words that are joined by broadcast, lets all other
texts pass where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrloom.llm.rows import texts
from addrloom.operators.staging import staged

MIN_DOCUMENTS = 10
# Groups that the lines of one hash are dealt to, by document.
GROUPS = 64
# The Bloom bitmap's size follows the documents that lose lines up to this bound, as it is
# broadcast (2^20 rows of two numbers). Beyond it more texts meet the list itself.
BITS_PER_DOCUMENT = 16
MAX_WORDS = 1 << 20

_BLANK = "' \\t\\n\\u000b\\f\\r'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Java's lower() also changes other letters, but it is fast where there are none.
_KEY = (
    f"CASE WHEN octet_length(line) = char_length(line) THEN lower(btrim(line, {_BLANK})) "
    f"ELSE translate(btrim(line, {_BLANK}), '{_UPPER}', '{_LOWER}') END"
)
_LINES = "split(text, '\\n', -1)"
# Two hashes of a key, with seeds of their own.
KEY_HASHES = ["line_hash", "line_check"]


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, the hashes of ``KEY_HASHES`` and ``position`` of every line with a key.

    The key is the line without white space at its ends, A-Z lower-cased. It is known by 128
    bits: a rare line is taken for a frequent one with odds of frequent keys / 2^128. The
    text's 64 bits only tell rows of equal ids apart.
    """
    lines = texts(docs, id_col, text_col).selectExpr("doc_id", "coalesce(text, '') AS text")
    return (
        lines.selectExpr("doc_id", "xxhash64(text) AS text_hash", f"posexplode({_LINES}) AS (position, line)")
        .selectExpr("doc_id", "text_hash", "position", f"{_KEY} AS key")
        .where("key <> ''")
        .selectExpr("doc_id", "text_hash", "xxhash64(key) AS line_hash", "xxhash64(1, key) AS line_check", "position")
    )


def _first_lines(hashes: DataFrame, groups: int) -> DataFrame:
    """Lines in ranges of hash and group, sorted by document and position; ``first`` marks
    a document's first one of its hash."""
    dealt = hashes.selectExpr("*", f"pmod(hash(doc_id, text_hash), {groups}) AS dealt")
    order = ["doc_id", "text_hash", "position"]
    ranged = dealt.repartitionByRange("line_hash", "dealt").sortWithinPartitions(*KEY_HASHES, "dealt", *order)
    within = Window.partitionBy(*KEY_HASHES, "dealt").orderBy(*order)
    same = (F.lag("text_hash").over(within) == F.col("text_hash")) & F.lag("doc_id").over(within).eqNullSafe(F.col("doc_id"))
    return ranged.withColumn("first", ~F.coalesce(same, F.lit(False)))


def drop_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    keep_first: bool = False,
    groups: int = GROUPS,
) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``dropped``: words (number, bits) of the lines that go.

    Lines whose key is found in at least ``min_documents`` documents go, everywhere or, with
    ``keep_first``, but for the first one by document and position. Rows that repeat an id
    and its text are one document. Documents that lose no line have no row.
    """
    hashes = staged(line_hashes(docs, id_col, text_col))
    place = F.struct(F.col("doc_id"), F.col("text_hash"), F.col("position"))
    counted = (
        _first_lines(hashes, groups)
        .groupBy(*KEY_HASHES)
        .agg(F.count_if("first").alias("documents"), F.min(place).alias("kept_place"))
        .where(F.col("documents") >= min_documents)
    )
    counted = staged(counted)  # two plain exchanges below: Spark can split a crowded line
    if keep_first:
        gone = hashes.join(counted, KEY_HASHES).where(~place.eqNullSafe(F.col("kept_place")))
    else:
        gone = hashes.join(counted.select(*KEY_HASHES), KEY_HASHES)
    words = (
        gone.select("doc_id", "text_hash", "position").distinct()
        .groupBy("doc_id", "text_hash", F.expr("position div 64").alias("number"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(position % 64 AS INT)))").alias("bits"))
    )
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("number", "bits"))))
    return words.groupBy("doc_id", "text_hash").agg(entries.alias("dropped"))


def _tested(rows: DataFrame, maps: DataFrame, max_words: int) -> DataFrame:
    """``rows`` with ``maybe``: false where no row of ``maps`` has their id and text for sure."""
    wanted = max(1, maps.count() * BITS_PER_DOCUMENT // 64)
    words = min(max_words, 1 << (wanted - 1).bit_length())

    def place(*names: str) -> str:
        return f"pmod(xxhash64({', '.join(names)}), {64 * words}L)"

    known = (
        maps.selectExpr(f"{place('doc_id', 'text_hash')} AS place")
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits"))
    )
    placed = rows.selectExpr("*", f"{place('doc_id', 'text_hash')} AS place").selectExpr("*", "place div 64 AS word")
    tested = placed.join(F.broadcast(known), "word", "left")  # at most max_words rows
    return tested.selectExpr(*rows.columns, "shiftright(coalesce(bits, 0L), CAST(place % 64 AS INT)) % 2 <> 0 AS maybe")


def without_common_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    keep_first: bool = False,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_lines``, ``n_dropped`` and the ``kept`` text.

    A null text is an empty one and has one empty line; lines without a key always stay,
    those that stay are joined by a line break. Rows that repeat an id and its text get the
    same result each and count as one document; a null id is an id like any other. An empty
    table gives an empty one. Texts that lose no line pass without a shuffle, but for those
    that the bitmap of at most ``max_words`` words takes for others; no result depends on it.
    """
    maps = staged(drop_bitmaps(docs, id_col, text_col, min_documents, keep_first))
    rows = texts(docs, id_col, text_col).selectExpr("doc_id", "coalesce(text, '') AS text").selectExpr("*", "xxhash64(text) AS text_hash")
    tested = _tested(rows, maps, max_words)
    n_lines = f"CAST(size({_LINES}) AS BIGINT) AS n_lines"
    whole = tested.where("NOT maybe").selectExpr("doc_id", n_lines, "0L AS n_dropped", "text AS kept")
    met = tested.where("maybe").join(
        maps.toDF("own_id", "own_hash", "dropped"), F.expr("text_hash = own_hash AND doc_id <=> own_id"), "left"
    )
    goes = "shiftright(coalesce(element_at(dropped, CAST(i div 64 AS BIGINT)), 0L), i % 64) % 2 <> 0"
    cut = met.selectExpr(
        "doc_id",
        n_lines,
        "coalesce(aggregate(map_values(dropped), 0L, (n, word) -> n + bit_count(word)), 0L) AS n_dropped",
        f"CASE WHEN dropped IS NULL THEN text ELSE array_join(filter({_LINES}, (line, i) -> NOT {goes}), '\\n') END AS kept",
    )
    return whole.union(cut)


def common_line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """As ``without_common_lines``, with the SHA-256 of the kept text in its place."""
    kept = without_common_lines(docs, id_col, text_col, min_documents)
    return kept.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(kept, 256) AS kept_sha256")
