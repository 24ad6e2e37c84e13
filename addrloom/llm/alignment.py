"""Which tokens of two tokenizers stand for the same text, and how often.

Tokenizer A is a byte-level BPE file, B a sentencepiece model. A text's tokens are laid
beside each other by their byte offsets. Where both end at one place a group ends; tokens
whose bytes overlap are linked.

Most groups hold one token of each with the same bytes. For these an identity map from A's
ids to B's is made beforehand: their links are counted in vectors as long as A's vocabulary,
which tasks send whole and which are summed. Only the pairs that are left enter a shuffle, as
counts per batch. To look the counts up again, the vectors and the pairs that make up more
than a fixed share of all links, of which there are at most as many, are broadcast; the other
pairs are joined, and as none of them is frequent no key of this join is crowded.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from addrloom.llm.bpe import Remembered, Together, Vocabulary, begins_a_piece, chunks, default_path, library_ids, read_vocabulary
from addrloom.llm.rows import texts, utf8
from addrloom.operators.staging import staged

# Pairs with at least this share, 1 in so many, of the pairs of all documents are broadcast.
FREQUENT = 1 << 16
# Texts are aligned together up to about this many bytes; a longer one on its own.
TOGETHER = 1 << 18
_VECTOR_PART = 1 << 12


def default_piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pair:
    """Both tokenizers, the bytes of their tokens and the identity map."""

    def __init__(self, content: str, model: bytes) -> None:
        import sentencepiece

        own = Vocabulary(content)
        special = set(own.special.values())
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = own.bytes_by_id()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.n_a, self.n_b = len(self.bytes_a), len(self.bytes_b)
        same: dict[bytes, int] = {}
        for i, piece in enumerate(self.bytes_b):
            if piece and (piece not in same or self.b.is_byte(same[piece])):
                same[piece] = i
        # B's id with the bytes of A's, or -1.
        self.identity = np.array([-1 if i in special else same.get(piece, -1) for i, piece in enumerate(self.bytes_a)], np.int64)
        # Where no piece holds a space behind other characters, words can be encoded on their own.
        self.by_words = not any(b" " in piece.lstrip(b" ") for piece in self.bytes_b)
        a = Together(library_ids(own), self.bytes_a, begins_a_piece)
        # B adds the space that a word begins with.
        b = Together(lambda text: self.b.encode(text[1:]), self.bytes_b, lambda word: self.by_words and " " not in word[1:])
        self.length_a, self.length_b = a.lengths, b.lengths
        self.a_of, self.b_of = Remembered(a), Remembered(b)
        # The ids as text, with what follows them within a group and at an end.
        names = [str(i).encode() for i in range(max(self.n_a, self.n_b))]
        self.said = [n + mark for mark in (b",", b"|", b";") for n in names]
        self.names = len(names)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.b.is_control(i) else piece.replace("▁", " ").encode()

    def tokens(self, text: str) -> tuple[bytes, bytes] | None:
        """Packed ids of A and B, or None where their bytes are not a space and the text."""
        if not text:
            return None
        spaced = " " + text
        words = [spaced]
        if self.by_words and "  " not in spaced and spaced[-1] != " ":
            words = [f" {word}" for word in text.split(" ")]
        a, b = self.a_of.of(chunks(spaced)), self.b_of.of(words)
        return None if None in a or None in b else (b"".join(a), b"".join(b))

    def aligned(self, found: list[tuple[bytes, bytes]]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, groups_sha256, and the distinct links with
        how often each occurs: those of the identity map by A's id, the others by pair."""
        sizes_a, sizes_b = (np.array([len(ids[i]) // 4 for ids in found], np.int64) for i in (0, 1))
        a, b = (np.frombuffer(b"".join([ids[i] for ids in found]), "<u4").astype(np.int64) for i in (0, 1))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # A text ends where its last tokens end; all texts are one row of bytes.
        stops = ends_a[np.cumsum(sizes_a) - 1]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.diff(np.searchsorted(cuts, stops, "right"), prepend=0)

        # Between two neighbouring ends lies the overlap of exactly one token of each.
        ends = np.union1d(ends_a, ends_b)
        n_links = np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
        linked_a, linked_b = a[np.searchsorted(ends_a, ends)], b[np.searchsorted(ends_b, ends)]
        text = np.repeat(np.arange(len(found)), n_links)
        same = self.identity[linked_a] == linked_b
        regular = self._counted(text[same], linked_a[same], self.n_a, len(found))
        others = self._counted(text[~same], linked_a[~same] * self.n_b + linked_b[~same], self.n_a * self.n_b, len(found))
        hashes = self._said(a, b, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), sizes_a + sizes_b)
        return list(zip(sizes_a.tolist(), sizes_b.tolist(), n_groups.tolist(), n_links.tolist(), hashes, *regular, *others, strict=True))

    @staticmethod
    def _counted(text: np.ndarray, key: np.ndarray, keys: int, n: int) -> tuple[list, list]:
        """Per text its distinct keys and how often each occurs."""
        both, times = np.unique(text * keys + key, return_counts=True)
        at = np.searchsorted(both // keys, np.arange(1, n))
        return np.split(both % keys, at), np.split(times, at)

    def _said(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The hash of each text's groups, ``a1,a2|b1;...``."""
        groups = int(group_a[-1]) + 1
        many_a, many_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        before_a, before_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        codes = np.empty(len(a) + len(b), np.int64)
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        # A's tokens stand after the groups before, B's after A's of the group too.
        codes[np.arange(len(a)) + before_b[group_a]] = a + np.where(last_a, self.names, 0)
        codes[np.arange(len(b)) + before_a[group_b] + many_a[group_b]] = b + np.where(last_b, 2 * self.names, 0)
        out, at, said = [], 0, self.said.__getitem__
        for size in sizes.tolist():
            out.append(hashlib.sha256(b"".join(map(said, codes[at : at + size].tolist()))[:-1]).hexdigest())
            at += size
        return out


@functools.lru_cache(2)
def pair(content: str, model: bytes) -> Pair:
    """One per worker process."""
    return Pair(content, model)


_NUMBERS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_LINKS = "regular array<int>, regular_times array<int>, pairs array<bigint>, pair_times array<int>"
_NOTHING = (0, 0, 0, 0, "", [], [], [], [])


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, the numbers of tokens, groups and links, groups_sha256, and
    its distinct links: ``regular`` (A's ids, linked to the B id of the same bytes) and ``pairs``
    (A's id times B's vocabulary, plus B's id), each with how often they occur in the text.

    Null and empty texts have no tokens, nor have texts that a tokenizer changes: zeros, an
    empty groups_sha256 and no links. Repeated rows give repeated results, a null id stays
    null, an empty table gives an empty one.
    """
    content = read_vocabulary(docs, path)
    model = docs.sparkSession.sparkContext.broadcast(Path(piece_path or default_piece_path()).read_bytes())
    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(f"{_NUMBERS}, {_LINKS}").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(content.value, model.value)
        for batch in batches:
            found: list[tuple[int, tuple[bytes, bytes]]] = []
            held, start = 0, 0

            def aligned(end: int) -> pa.RecordBatch:
                rows = dict(zip([i for i, _ in found], both.aligned([ids for _, ids in found]), strict=True)) if found else {}
                made = [rows.get(i, _NOTHING) for i in range(start, end)]
                columns = [pa.array(list(c), f.type) for c, f in zip(zip(*made, strict=True), list(arrow)[1:], strict=True)]
                return pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, end - start), *columns], schema=arrow)

            for i, value in enumerate(batch.column("data")):
                data = value.as_py()
                ids = both.tokens(data.decode())
                if ids is not None:
                    found.append((i, ids))
                held += len(data) + 100
                if held >= TOGETHER:
                    yield aligned(i + 1)
                    found, held, start = [], 0, i + 1
            if start < batch.num_rows:
                yield aligned(batch.num_rows)

    return rows.mapInArrow(run, schema)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def identity_counts(links: DataFrame, size: int) -> np.ndarray:
    """In how many rows each id is in ``regular``: a vector as long as the vocabulary.

    Each task sends its vector once, in parts; the parts are summed where they meet.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("regular")), minlength=size)
        yield _parts({i: total[i * _VECTOR_PART : (i + 1) * _VECTOR_PART] for i in range(-(-size // _VECTOR_PART))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                new = np.frombuffer(counts, np.int64)
                sums[part] = sums[part] + new if part in sums else new
        if sums:
            yield _parts(sums)

    kind = "part int, counts binary"
    summed = links.select("regular").mapInArrow(count, kind).repartition("part").mapInArrow(add, kind).collect()
    total = np.zeros(-(-size // _VECTOR_PART) * _VECTOR_PART, np.int64)
    for part, counts in summed:
        new = np.frombuffer(bytes(counts), np.int64)
        total[part * _VECTOR_PART : part * _VECTOR_PART + len(new)] += new
    return total[:size]


def _parts(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array(sums, pa.int32()), "counts": pa.array([s.tobytes() for s in sums.values()], pa.binary())})


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair`` and ``docs``, in how many rows it is in ``pairs``; batches are counted first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs = np.unique(_flat(batch.column("pairs")), return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(keys, pa.int64()), "docs": pa.array(docs, pa.int64())})

    return links.select("pairs").mapInArrow(count, "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs"))


def sizes(path: str | None = None, piece_path: str | None = None) -> tuple[int, int]:
    """How many ids A and B have."""
    both = pair(*_contents(path, piece_path))
    return both.n_a, both.n_b


def _contents(path: str | None, piece_path: str | None) -> tuple[str, bytes]:
    return Path(path or default_path()).read_text(encoding="utf-8"), Path(piece_path or default_piece_path()).read_bytes()


def with_link_counts(links: DataFrame, n_a: int, n_b: int, frequent: int = FREQUENT) -> DataFrame:
    """Add ``n_best`` and ``count_sum`` to ``alignments`` that were written once.

    ``count_sum`` adds, over the links, in how many rows of the table their pair is linked;
    ``n_best`` counts the links whose pair is linked in most rows of those of its A id.
    """
    spark = links.sparkSession
    identity = identity_counts(links, n_a)
    counts = staged(pair_counts(links))
    best = identity.copy()
    # At most as many rows as A has ids.
    for a, most in counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("docs")).collect():
        best[a] = max(best[a], most)
    total = counts.agg(F.sum("docs")).first()[0] or 0
    # At most ``frequent`` pairs can each be that large a part of the total.
    is_frequent = F.col("docs") * frequent >= total
    common = np.array(sorted(map(tuple, counts.where(is_frequent).collect())), np.int64).reshape(-1, 2)
    known = spark.sparkContext.broadcast((identity, best, common[:, 0].copy(), common[:, 1].copy()))
    added = "n_best bigint, count_sum bigint, rare array<struct<pair:bigint,times:int,best:bigint>>"
    kept = [c for c in links.columns if c not in ("regular", "regular_times", "pairs", "pair_times")]
    schema = StructType([*(links.schema[c] for c in kept), *StructType.fromDDL(added).fields])
    rare_type = to_arrow_schema(schema).field("rare").type

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity, best, pairs, docs = known.value
        for batch in batches:
            n = batch.num_rows

            def by_row(name: str) -> np.ndarray:
                return np.repeat(np.arange(n), batch.column(name).value_lengths().to_numpy(zero_copy_only=False))

            a, times = _flat(batch.column("regular")), _flat(batch.column("regular_times")).astype(np.int64)
            n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
            row = by_row("regular")
            np.add.at(n_best, row, times * (identity[a] == best[a]))
            np.add.at(count_sum, row, times * identity[a])

            key, times = _flat(batch.column("pairs")), _flat(batch.column("pair_times")).astype(np.int64)
            row, at = by_row("pairs"), np.searchsorted(pairs, key)
            met = np.zeros(len(key), bool)
            inside = at < len(pairs)
            met[inside] = pairs[at[inside]] == key[inside]
            number = docs[at[met]]
            np.add.at(n_best, row[met], times[met] * (number == best[key[met] // n_b]))
            np.add.at(count_sum, row[met], times[met] * number)

            rest = ~met
            ends = np.searchsorted(row[rest], np.arange(n + 1))
            values = pa.StructArray.from_arrays(
                [pa.array(key[rest]), pa.array(times[rest].astype(np.int32)), pa.array(best[key[rest] // n_b])], fields=list(rare_type.value_type)
            )
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, type=rare_type)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best), pa.array(count_sum), rare], schema=to_arrow_schema(schema))

    looked = staged(links.mapInArrow(look_up, schema).withColumn("row_number", F.monotonically_increasing_id()))
    rest = looked.select("row_number", F.explode("rare").alias("r")).select("row_number", "r.*")
    found = (
        rest.join(counts.where(~is_frequent), "pair").groupBy("row_number")
        .agg(F.expr("sum(times * CAST(docs = best AS INT))").alias("more_best"), F.expr("sum(times * docs)").alias("more"))
    )
    return looked.drop("rare").join(found, "row_number", "left").select(
        *kept, F.expr("n_best + coalesce(more_best, 0L)").alias("n_best"), F.expr("count_sum + coalesce(more, 0L)").alias("count_sum")
    )


def pair_table(links: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """All linked pairs of ids of the corpus: a, b and ``docs``, in how many rows they are linked.

    Of the identity map's pairs ``b`` is null: it is the B id with the bytes of ``a``.
    """
    identity = identity_counts(links, n_a)
    own = [(int(a), int(identity[a])) for a in np.flatnonzero(identity)]
    same = links.sparkSession.createDataFrame(own, "a bigint, docs bigint").selectExpr("a", "CAST(NULL AS BIGINT) AS b", "docs")
    return same.union(pair_counts(links).selectExpr(f"pair div {n_b} AS a", f"pair % {n_b} AS b", "docs"))


def alignment_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    piece_path: str | None = None,
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    See ``alignments`` for texts without tokens and ``with_link_counts`` for the counts. A row
    is a document: repeated rows count each. A null id stays null; an empty table gives an
    empty one.
    """
    links = staged(alignments(docs, id_col, text_col, path, piece_path))
    counted = with_link_counts(links, *sizes(path, piece_path), frequent)
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
