"""Near-duplicate classes by SimHash, with candidates from pigeonring chains.

A 64-bit fingerprint is a ring of five segments. If two fingerprints differ in at most 4
bits, some segment starts a chain whose differences, summed over its first l segments, are
at most ``floor(l * 4 / 5)`` for every l: none in the first, one in the first two, and so
on. The first two conditions are an equality on a key: the first segment, and the second
one cut in four pieces of which three must agree. The others are tested in numpy, one
segment after another, before the whole difference counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.bloom import make_filter, with_maybe
from addrloom.llm.components import components
from addrloom.llm.rows import mapped, texts, utf8, whole_row
from addrloom.operators.staging import staged

WORDS = 4
SEED = 42
MAX_BITS = 4
# Fingerprints of one key that meet in one task; larger groups are cut in tiles, and
# every pair of tiles meets.
TILE = 16_384

_WIDTHS = (13, 13, 13, 13, 12)
_PIECES = 4
_BYTE_AT = np.arange(8) * 256
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _segments() -> list[np.uint64]:
    masks, at = [], 0
    for width in _WIDTHS:
        masks.append(np.uint64(((1 << width) - 1) << at))
        at += width
    return masks


def _key_masks() -> np.ndarray:
    """For each segment and each piece of the next one: the bits that must agree."""
    masks, starts = [], np.cumsum((0, *_WIDTHS))
    for i in range(len(_WIDTHS)):
        following = (i + 1) % len(_WIDTHS)
        cuts = [int(starts[following]) + _WIDTHS[following] * p // _PIECES for p in range(_PIECES + 1)]
        for piece in range(_PIECES):
            left_out = ((1 << cuts[piece + 1]) - 1) ^ ((1 << cuts[piece]) - 1)
            masks.append((int(SEGMENTS[i]) | int(SEGMENTS[following])) & ~left_out)
    return np.array(masks, np.uint64)


SEGMENTS = _segments()
KEY_MASKS = _key_masks()


def fingerprint(data: bytes) -> tuple[int]:
    """SimHash of the 4-word shingles of a text, A-Z lower-cased, as a signed 64-bit number."""
    words = data.lower().split()
    if not words:
        return (0,)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    if len(words) <= WORDS:
        hashes = [digest(line, SEED)]
    else:
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[WORDS - 1 :].tolist(), strict=False)]
    counts = np.zeros((8, 8), np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[first : first + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.bincount((part + _BYTE_AT).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = np.packbits((2 * counts > len(hashes)).ravel(), bitorder="little")
    return (int(bits.view("<i8")[0]),)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` of every row; texts without words, null ones too, have 0."""
    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    return mapped(rows, "fp bigint", fingerprint, ["doc_id"])


def _chain_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        number = np.arange(len(KEY_MASKS), dtype=np.uint64)
        keys = (fps[:, None] & KEY_MASKS) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
        keys = ((keys * np.uint64(0xBF58476D1CE4E5B9)) & ~np.uint64(31)) | number
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps, len(KEY_MASKS)).view(np.int64))], ["key", "fp"]
        )


def near(difference: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which differences pass the chain from their first segment and the whole test."""
    alive = np.arange(len(difference))
    spent = np.zeros(len(difference), np.int64)
    for length in range(1, len(SEGMENTS) + 1):
        segment = np.array(SEGMENTS)[(first[alive] + length - 1) % len(SEGMENTS)]
        spent = spent + np.bitwise_count(difference[alive] & segment)
        ok = spent <= length * MAX_BITS // len(SEGMENTS)
        alive, spent = alive[ok], spent[ok]
    found = np.zeros(len(difference), bool)
    found[alive] = True
    return found


def _links_of_run(fps: np.ndarray, first: int) -> tuple[list, list]:
    """Links that connect what is connected among the fingerprints of one key.

    Each found fingerprint leaves the rest, so a dense group costs a few passes over it.
    """
    rest, a, b = fps, [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            hit = near(rest ^ at, np.full(len(rest), first))
            found = rest[hit]
            if len(found):
                a.append(np.full(len(found), at, np.uint64))
                b.append(found)
                queue.extend(found)
                rest = rest[~hit]
    return a, b


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal group columns; input is sorted by them."""
    names = ["key", "tile", "other_tile", "fp"]
    carried = [np.zeros(0, np.int64)] * 4

    def linked(columns: list[np.ndarray]) -> pa.RecordBatch:
        key, fps = columns[0], columns[3].view(np.uint64)
        new = np.ones(len(key), bool)
        if len(key):
            new[1:] = (key[1:] != key[:-1]) | (columns[1][1:] != columns[1][:-1]) | (columns[2][1:] != columns[2][:-1])
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(key)))
        first = (key & 31) // _PIECES
        a, b = [], []
        pairs = starts[lengths == 2]  # most runs that have anything to compare
        hit = pairs[near(fps[pairs] ^ fps[pairs + 1], first[pairs])] if len(pairs) else pairs
        a.append(fps[hit])
        b.append(fps[hit + 1])
        longer = lengths > 2
        for start, length in zip(starts[longer].tolist(), lengths[longer].tolist(), strict=True):
            more_a, more_b = _links_of_run(fps[start : start + length], int(first[start]))
            a += more_a
            b += more_b
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    for batch in batches:
        columns = [np.concatenate([c, batch.column(n).to_numpy(zero_copy_only=False)]) for c, n in zip(carried, names, strict=True)]
        if not len(columns[0]):
            continue
        same = np.ones(len(columns[0]), bool)
        for column in columns[:3]:
            same &= column == column[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        carried = [c[cut:] for c in columns]
        if cut:
            yield linked([c[:cut] for c in columns])
    if len(carried[0]):
        yield linked(carried)


def fingerprint_links(fps: DataFrame, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` that join every two distinct fingerprints at 4 or fewer bits.

    Not all pairs are listed: within a key only as many as connect what is connected. A
    key with more than ``tile`` fingerprints is cut in tiles and each pair of tiles is a
    group of its own, so no task holds more than two tiles of a key.
    """
    keys = staged(fps.select("fp").distinct().mapInArrow(_chain_keys, "key bigint, fp bigint"))
    large = keys.groupBy("key").count().where(F.col("count") > tile).selectExpr("key", f"CAST(ceil(count / {tile}) AS INT) AS tiles")
    groups = (
        keys.join(large, "key", "left")
        .selectExpr("key", "fp", "coalesce(tiles, 1) AS tiles", "CAST(pmod(xxhash64(fp), coalesce(tiles, 1)) AS INT) AS own")
        .selectExpr("key", "fp", "own", "explode(sequence(0, tiles - 1)) AS met")
        .selectExpr("key", "CAST(least(own, met) AS BIGINT) AS tile", "CAST(greatest(own, met) AS BIGINT) AS other_tile", "fp")
    )
    together = groups.repartition("key", "tile", "other_tile").sortWithinPartitions("key", "tile", "other_tile", "fp")
    return together.mapInArrow(_links, "a bigint, b bigint")


def _rooted(nodes: DataFrame, tile: int) -> DataFrame:
    """``nodes`` (fp and more columns) with the root that each one's links reach."""
    reached = components(fingerprint_links(nodes, tile), "a", "b")
    joined = nodes.join(reached, nodes["fp"] == reached["node"], "left")
    return staged(joined.select(*nodes.columns, F.coalesce("root", "fp").alias("root")))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (hex) and ``component_id``.

    Two texts are linked if their fingerprints differ in at most 4 bits; ``component_id`` is
    the smallest id that links reach. Equal fingerprints are one node, so copies cost
    nothing. Texts without words share fingerprint 0. A null id keeps its row and is never a
    ``component_id`` unless a class has no other. Repeated rows give repeated results and
    an empty table gives an empty one.
    """
    own = staged(fingerprints(docs, id_col, text_col))
    rooted = _rooted(own.groupBy("fp").agg(F.min("doc_id").alias("least")), tile)
    # Written, so that a class with very many fingerprints can be split in the join.
    least = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return own.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_class_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` that represent their class, with their columns as they are.

    It is the row of the class's smallest id; a class without ids, and one whose smallest id
    is repeated, keeps one row. Rows are written once with their fingerprints. Those that a
    Bloom filter of the rows that go does not know pass straight through; only the rest is
    shuffled, to meet the list itself.
    """
    tagged = mapped(docs.select(whole_row(docs), docs[id_col].alias("doc_id")), "fp bigint", fingerprint, ["row", "doc_id"], f"row.{text_col}")
    tagged = tagged.withColumn("row_number", F.monotonically_increasing_id())
    tagged = staged(tagged.withColumn("digest", F.unhex(F.md5(F.col("row_number").cast("string")))))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_number")).alias("least")
    nodes = tagged.groupBy("fp").agg(least)
    stays = _rooted(nodes, tile).groupBy("root").agg(F.min("least").alias("least")).select("least.row_number")
    goes = staged(tagged.select("row_number", "digest").join(stays, "row_number", "left_anti"))
    tested = with_maybe(tagged.select("row", "row_number", "digest"), make_filter(goes, goes.count(), "once"))
    checked = tested.where("maybe").join(goes.select("row_number"), "row_number", "left_anti")
    return tested.where("NOT maybe").select("row").union(checked.select("row")).select("row.*")
