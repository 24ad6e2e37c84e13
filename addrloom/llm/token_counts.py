"""Token counts from lengths of pre-tokens, looked up in two tiers within the map task.

The first tier is broadcast: a compact table of the pre-tokens that are frequent in a sample,
with their numbers of tokens. What it lacks is encoded and remembered by the worker. No
pre-token is shuffled, and the sample decides about speed alone.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from addrloom.llm.bpe import Remembered, Vocabulary, library_ids, read_vocabulary, split
from addrloom.llm.rows import mapped, texts, utf8

LIMIT = 1024
# The table's bound, and about how many rows the sample has.
FREQUENT = 50_000
SAMPLE_ROWS = 2_000


class Lengths:
    """Numbers of tokens by pre-token: the frequent ones, then those the worker has met."""

    def __init__(self, content: str, frequent: tuple[str, bytes]) -> None:
        self.vocabulary = Vocabulary(content)
        ids = library_ids(self.vocabulary)
        self.learnt = Remembered(lambda new: [len(ids(piece)) for piece in new])
        pieces, lengths = frequent
        self.frequent = dict(zip(pieces.split("\0"), lengths, strict=False)) if lengths else {}

    def of(self, text: str) -> int:
        total = 0
        frequent = self.frequent
        for segment, special in self.vocabulary.segments(text):
            if special is not None:
                total += 1
                continue
            first = list(map(frequent.get, pieces := split(segment)))
            missed = [piece for piece, n in zip(pieces, first, strict=True) if n is None]
            total += sum(filter(None, first)) + sum(self.learnt.of(missed))
        return total


@functools.lru_cache(2)
def lengths(content: str, frequent: tuple[str, bytes]) -> Lengths:
    return Lengths(content, frequent)


def frequent_lengths(docs: DataFrame, content, sample_rows: int, most: int) -> tuple[str, bytes]:
    """Joined pre-tokens and one byte for the length of each, at most ``most`` of them.

    The sample's rows, a number that does not grow with the table, meet in one task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = lengths(content.value, ("", b"")), Counter()
        for batch in batches:
            for value in batch.column("data"):
                for segment, special in own.vocabulary.segments(value.as_py().decode()):
                    if special is None:
                        counts.update(split(segment))
        pieces = [p for p, _ in counts.most_common(most) if "\0" not in p]
        top = [(p, counts[p], n) for p, n in zip(pieces, own.learnt.of(pieces), strict=True) if n < 256]
        columns = list(zip(*top, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(columns[0]), pa.string()), pa.array(list(columns[1]), pa.int64()), pa.array(list(columns[2]), pa.int32())],
            ["piece", "times", "tokens"],
        )

    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select("data").sample(share, seed=1).repartition(1)
    found = sample.mapInArrow(count, "piece string, times bigint, tokens int").collect()
    found.sort(key=lambda row: (-row["times"], row["piece"]))
    return "\0".join(row["piece"] for row in found[:most]), bytes(row["tokens"] for row in found[:most])


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    limit: int = LIMIT,
    sample_rows: int = SAMPLE_ROWS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens and whether that is over the limit.

    A null text is an empty one and has no tokens. Repeated rows give repeated results, a null
    id stays null, an empty table gives an empty one.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    content = read_vocabulary(docs, path)
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(rows, content, sample_rows, frequent))

    def row(data: bytes) -> tuple:
        n = lengths(content.value, table.value).of(data.decode())
        return len(data), n, n > limit

    return mapped(rows, "n_bytes bigint, n_tokens bigint, over_limit boolean", row, ["doc_id"])
