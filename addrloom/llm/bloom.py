"""Bloom filters built by map tasks and merged by blocks, with a bitmap of what was set twice.

A task sets the bits of its digests in two bitmaps: ``once`` and, for a bit that is already
set, ``twice``. Bitmaps merge bit by bit without order:
``twice = twice1 | twice2 | (once1 & once2)``. Blocks of them travel compressed, so a task
sends some bits a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, StructField, StructType

BITS_PER_ROW = 16
# A filter's size follows the rows up to this bound, as it is broadcast. Beyond it more
# rows test positive; as they are looked at exactly, no result depends on it.
MAX_FILTER_BYTES = 64 << 20
_BLOCK_BYTES = 1 << 17
_HASHES = 2


def _places(digests: pa.Array, bits: int) -> list[np.ndarray]:
    """The bit numbers of each digest, by hash function.

    The functions have halves of the bitmap of their own: a row must not meet itself.
    """
    raw = np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(len(digests), -1)
    numbers = raw[:, : 8 * _HASHES].copy().view("<u8")
    part = bits // _HASHES
    return [(numbers[:, i] % np.uint64(part)).astype(np.int64) + i * part for i in range(_HASHES)]


def _or_into(once: np.ndarray, twice: np.ndarray, places: np.ndarray) -> None:
    """Set bits, and in ``twice`` those that were set before or come again."""
    numbers, counts = np.unique(places, return_counts=True)
    masks = (np.uint8(1) << (numbers & 7).astype(np.uint8)).astype(np.uint8)
    at = numbers >> 3
    again = (counts > 1) | ((once[at] & masks) > 0)
    np.bitwise_or.at(twice, at[again], masks[again])
    np.bitwise_or.at(once, at, masks)


def _block(number: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    packer = zstandard.ZstdCompressor(level=1)
    packed = {name: pa.array([packer.compress(bits.tobytes())], pa.binary()) for name, bits in (("once", once), ("twice", twice))}
    return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), **packed})


def _set_bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            if batch.num_rows:
                for places in _places(batch.column("digest"), bits):
                    _or_into(once, twice, places)
        for start in range(0, bits // 8, _BLOCK_BYTES):
            end = start + _BLOCK_BYTES
            if once[start:end].any():
                yield _block(start // _BLOCK_BYTES, once[start:end], twice[start:end])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the blocks of a number, which come one after another."""
    opener = zstandard.ZstdDecompressor()
    number = once = twice = None
    for batch in batches:
        for block, a, b in zip(*(batch.column(n).to_pylist() for n in ("block", "once", "twice")), strict=True):
            new_once, new_twice = (np.frombuffer(opener.decompress(x), np.uint8) for x in (a, b))
            if block != number:
                if number is not None:
                    yield _block(number, once, twice)
                number, once, twice = block, new_once.copy(), new_twice.copy()
            else:
                twice |= new_twice | (once & new_once)
                once |= new_once
    if number is not None:
        yield _block(number, once, twice)


@dataclass(frozen=True)
class Filter:
    """The compressed blocks of one of the bitmaps, on every executor."""

    blocks: Broadcast
    bits: int

    def bitmap(self) -> np.ndarray:
        opener, bitmap = zstandard.ZstdDecompressor(), np.zeros(self.bits // 8, np.uint8)
        for number, packed in self.blocks.value:
            block = np.frombuffer(opener.decompress(packed), np.uint8)
            bitmap[number * _BLOCK_BYTES : number * _BLOCK_BYTES + len(block)] = block
        return bitmap


def make_filter(digests: DataFrame, rows: int, which: str, max_filter_bytes: int = MAX_FILTER_BYTES) -> Filter:
    """A filter of the column ``digest`` (16 random bytes or more, not null).

    ``which`` is "once", for what occurs, or "twice", for what may occur twice. ``rows`` only
    steers its size.
    """
    wanted = max(8 * _BLOCK_BYTES * _HASHES, BITS_PER_ROW * rows)
    bits = min(1 << (wanted - 1).bit_length(), 8 * max_filter_bytes)
    kind = "block bigint, once binary, twice binary"
    blocks = digests.select("digest").mapInArrow(_set_bits(bits), kind)
    merged = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_merge, kind)
    return Filter(digests.sparkSession.sparkContext.broadcast([tuple(row) for row in merged.select("block", which).collect()]), bits)


def with_maybe(df: DataFrame, made: Filter) -> DataFrame:
    """Add ``maybe``: false for a row whose ``digest`` is not in the filter for sure."""
    bits = made.bits

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = made.bitmap()
        for batch in batches:
            maybe = np.ones(batch.num_rows, bool)
            if batch.num_rows:
                for places in _places(batch.column("digest"), bits):
                    maybe &= (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], [*batch.schema.names, "maybe"])

    return df.mapInArrow(test, StructType([*df.schema.fields, StructField("maybe", BooleanType())]))
