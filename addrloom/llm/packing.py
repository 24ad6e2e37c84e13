"""Packing token pieces into sequences by bounded-space online best-fit.

A task takes its pieces one after another. Open bins lie on stacks by free space, and a
bitset of one bit per size tells which stacks hold any: shifting it by the piece's length
and taking the lowest bit finds the fullest bin that fits. At most a fixed number of bins
is open; to open another one the fullest is closed. Pieces are placed as they arrive, in
the order of a hash; none waits for another.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from addrloom.llm.bpe import Encoder, packed, read_vocabulary
from addrloom.llm.rows import mapped, texts, utf8
from addrloom.operators.staging import staged

SEQUENCE = 1024
END = 2
OPEN_BINS = 4096
# A task's open bins are closed when its pieces end, so tasks should have many pieces.
PIECES_PER_TASK = 500_000


@functools.lru_cache(2)
def fast_encoder(content: str) -> Encoder:
    """An encoder that leaves all but special strings to a library."""
    return Encoder(content, library=True)


class OpenBins:
    """Best-fit over at most ``most`` open bins of a size."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most, self.count, self.made = size, most, 0, 0
        self.bits = 0
        self.stacks: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.count -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        """Bin number and offset for a piece of 1 to ``size`` tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.size, self.made
            self.made += 1
        left = free - length
        if left:
            self.stacks[left].append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.size - free


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """Start and length of each piece: all full but the first, which takes what is over."""
    first = length % size or size
    return [(0, first), *((start, size) for start in range(first, length, size))]


def token_pieces(
    docs: DataFrame, id_col: str, text_col: str, path: str | None, size: int, end: int
) -> DataFrame:
    """``doc_id`` and its pieces as an array of (piece, start, length, ids_crc32)."""
    content = read_vocabulary(docs, path)
    last = packed([end])

    def row(data: bytes) -> tuple:
        ids = fast_encoder(content.value).encode(data.decode()) + last
        pieces = cut(len(ids) // 4, size)
        return (
            [
                {"piece": i, "start": start, "length": length, "ids_crc32": zlib.crc32(ids[4 * start : 4 * (start + length)])}
                for i, (start, length) in enumerate(pieces)
            ],
        )

    kind = "pieces array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
    return mapped(texts(docs, id_col, text_col).select("doc_id", utf8().alias("data")), kind, row, ["doc_id"])


def pack(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``size``.

    Pieces are dealt to tasks by a hash of all columns and each task packs its own in a
    fixed order, so a repeated task gives the same result; equal rows may change places.
    Sequence numbers have the task in their upper bits.
    """
    tasks = max(1, -(-pieces.count() // pieces_per_task))
    order = F.xxhash64(*pieces.columns)
    dealt = pieces.withColumn("dealt", order).repartition(tasks, "dealt").withColumn("task", F.spark_partition_id())
    given = pieces.columns
    names = [*given, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        for batch in batches:
            base = batch.column("task")[0].as_py() << 40 if batch.num_rows else 0
            placed = [bins.put(length) for length in batch.column("length").to_pylist()]
            kept = [batch.column(c) for c in given]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([base + n for n, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], names
            )

    schema = StructType([*pieces.schema.fields, *StructType.fromDDL("sequence_id bigint, offset bigint").fields])
    return dealt.sortWithinPartitions("dealt", *pieces.columns).mapInArrow(run, schema)


def packed_sequences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    size: int = SEQUENCE,
    end: int = END,
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A text's ids and an end id are one piece, cut only if longer than a sequence. A null text
    is an empty one and has its end id only. A null id keeps its pieces, repeated rows have
    theirs each, and an empty table gives an empty result.
    """
    rows = token_pieces(docs, id_col, text_col, path, size, end)
    flat = staged(rows.select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*"))
    return pack(flat, size, open_bins)
