"""Repeated passages: every byte covered by a 200-byte string that also starts elsewhere.

Whole suffix arrays of a corpus are out of reach, so places that cannot repeat are left out
first. Every window of 200 bytes has an anchor, the 40-byte string of smallest hash in it; equal
windows have equal anchors. Consecutive windows of one anchor form a block. Blocks of
anchors met once are dropped. If a block, bytes and all, is met twice, all its windows
repeat, and nothing but its hash has to travel. What is left are anchors with different
blocks around them: the ends of repeated passages. One block of each kind comes together per
anchor, and there an enhanced suffix array says what repeats: suffixes are sorted by
prefix doubling, the ranks of each doubling give common prefixes of neighbours, and a scan
with a stack finds the intervals of the common-prefix tree. An interval whose occurrences all
follow the same byte is part of a longer repeat; the others are the maximal repeat groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.rows import texts, utf8
from addrloom.operators.staging import staged

LENGTH = 200
ANCHOR = 40
# Different blocks of an anchor that one task sorts; those of anchors with more are told
# apart window by window, by a shuffle on the window's hashes.
BLOCKS_PER_ANCHOR = 8_192
# Bytes that are hashed, or sorted, at a time.
BUFFER = 1 << 20
# Bytes, and the terminator, as symbols of 9 bits in a word of 64.
SYMBOLS = 7

_PLACE_BITS = np.uint64((1 << 24) - 1)


class _Powers:
    """Prefix hashes of bytes: polynomials modulo 2^64 over random values of the bytes."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.value = rng.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(rng.integers(0, 1 << 62, dtype=np.uint64)) * 8 + 5 & ((1 << 64) - 1)
        self.inverse_base = pow(self.base, -1, 1 << 64)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            ones = np.ones(n, np.uint64)
            ones[1:] = self.base
            self.power = np.cumprod(ones)
            ones[1:] = self.inverse_base
            self.inverse = np.cumprod(ones)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[: len(data)], out=sums[1:])
        return sums

    def strings(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.inverse[start])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


_FIRST, _SECOND = _Powers(11), _Powers(12)


def _anchored(data: np.ndarray, sums: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor's place for each window, the leftmost of equals, and all anchor hashes."""
    n = len(data) - anchor + 1
    h = _mixed((sums[anchor:] - sums[:n]) * _FIRST.inverse[:n])
    least = (h & ~_PLACE_BITS) | np.arange(n, dtype=np.uint64)
    width, span = length - anchor + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & _PLACE_BITS).astype(np.int64), h


def block_table(pieces: list[bytes], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Blocks of several texts: text number, first window, windows, anchor's place after the
    first window, anchor hash, block hash."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    sums, other = _FIRST.prefixes(data), _SECOND.prefixes(data)
    places, hashes = _anchored(data, sums, length, anchor)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[offsets[:-1]] += 1
    edge[offsets[1:] - length + 1] -= 1  # texts have at least one window
    window = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    at = places[window]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    low, high, at = window[first], window[last], at[first]
    shape = ((at - low) << 16 | (high - low)).astype(np.uint64)
    block = _mixed(_SECOND.strings(other, low, high + length) + shape * np.uint64(0x9E3779B97F4A7C15))
    text = np.searchsorted(offsets, low, "right") - 1
    return text, low - offsets[text], high - low + 1, at - low, hashes[at], block


def _slices(data: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A long text in buffers that overlap so that each window lies in one."""
    for start in range(0, max(1, len(data) - length + 1), BUFFER):
        yield start, data[start : start + BUFFER + length - 1]


_BLOCKS = "doc_id bigint, text_hash bigint, first bigint, windows int, anchor_at int, anchor bigint, block bigint"


def _blocks(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            rows: list[int] = []
            starts: list[int] = []
            pieces: list[bytes] = []
            held = 0

            def made() -> pa.RecordBatch:
                text, first, windows, at, anchors, blocks = block_table(pieces, length, anchor)
                row = pa.array(np.array(rows)[text])
                arrays = [
                    ids.take(row), hashes.take(row), pa.array(first + np.array(starts)[text]), pa.array(windows.astype(np.int32)),
                    pa.array(at.astype(np.int32)), pa.array(anchors.view(np.int64)), pa.array(blocks.view(np.int64)),
                ]
                return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _BLOCKS.split(", ")])

            for number, value in enumerate(batch.column("data")):
                data = value.as_py()
                if len(data) < length:
                    continue
                for start, piece in _slices(data, length):
                    rows.append(number)
                    starts.append(start)
                    pieces.append(piece)
                    held += len(piece)
                    if held >= BUFFER:
                        yield made()
                        rows, starts, pieces, held = [], [], [], 0
            if pieces:
                yield made()

    return run


def suffix_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` and the common prefix of each with the one before.

    A suffix stops at its end and sorts before those that go on from there: bytes become
    symbols above a terminator, 0, that stands after each end. Bytes of the next text would
    put it among suffixes that have more in common with each other than with it.
    """
    longest, stops = int((ends - starts).max()), np.unique(ends)
    symbols = np.insert(data.astype(np.uint64) + np.uint64(1), stops, 0)
    n, own = len(symbols), starts + np.searchsorted(stops, starts, "right")
    padded = np.concatenate([symbols, np.zeros(2 * longest + 24, np.uint64)])
    words = np.zeros(n + 2 * longest + 16, np.uint64)
    for j in range(SYMBOLS):
        words |= padded[j : j + len(words)] << np.uint64(9 * (SYMBOLS - 1 - j))
    ranks = {SYMBOLS: np.unique(words, return_inverse=True)[1].astype(np.int64)}
    span, size = SYMBOLS, len(words)
    while 2 * span <= longest:
        rank = ranks[span]
        shifted = np.concatenate([rank[span:], np.full(span, rank[-1])])
        span *= 2
        ranks[span] = np.unique(rank * size + shifted, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(ranks[span][own] * size + ranks[span][own + span], kind="stable")
    a, b = own[order[:-1]], own[order[1:]]
    common = np.zeros(len(a), np.int64)
    for span, rank in reversed(ranks.items()):
        common += span * (rank[a + common] == rank[b + common])
    for _ in range(SYMBOLS - 1):
        common += padded[a + common] == padded[b + common]
    rest = (ends - starts)[order]
    return order, np.concatenate([[0], np.minimum(common, np.minimum(rest[:-1], rest[1:]))])


def maximal_repeats(common: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """Left-diverse intervals of the common-prefix tree: (length, first, last, parent).

    ``common[i]`` belongs to suffixes i-1 and i; ``left[i]`` is the byte before suffix i, or
    negative where it is not known, which counts as different from any. Intervals come after
    those within them; ``parent`` is the number of the next interval around it, or -1.
    """
    changes = np.cumsum(np.concatenate([[0], (left[1:] != left[:-1]) | (left[1:] < 0)]))
    long = common >= least
    found: list[tuple[int, int, int, int]] = []
    for low in np.flatnonzero(long[1:] & ~long[:-1]).tolist():
        stack: list[list] = []  # length, first, and the groups within
        i = low + 1
        while True:
            value = int(common[i]) if i < len(common) and long[i] else 0
            first, inner = i - 1, []
            while stack and stack[-1][0] > value:
                length, first, within = stack.pop()
                within += inner
                inner = within
                if changes[i - 1] > changes[first] or left[first] < 0:
                    number = len(found)
                    found.append((length, first, i - 1, -1))
                    for child in inner:
                        found[child] = (*found[child][:3], number)
                    inner = [number]
            if not value:
                break
            if stack and stack[-1][0] == value:
                stack[-1][2] += inner
            else:
                stack.append([value, first, inner])
            i += 1
    return found


def group_rows(
    blocks: list[bytes], windows: list[int], least: int, lefts: list[int] | None = None, every: bool = False
) -> Iterator[tuple[int, int, int, int, int]]:
    """Occurrences in the maximal repeat groups of some blocks, each once, in its smallest
    group: (block, place, length, group, parent group). ``lefts`` has the byte before each
    block, or -1 where it is not known. With ``every``, a group whose occurrences all lie in
    smaller ones names one of them again, so that its length is known."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.array(windows, np.int64)
    owner = np.repeat(np.arange(len(blocks)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[owner] + place
    data = np.frombuffer(b"".join(blocks), np.uint8)
    order, common = suffix_array(data, starts, offsets[owner + 1])
    before = data[np.maximum(starts - 1, 0)].astype(np.int64)
    before[place == 0] = -1 if lefts is None else lefts
    after = list(range(len(order) + 1))  # the next suffix without a group, at or after this one

    def free(i: int) -> int:
        while after[i] != i:
            after[i] = after[after[i]]
            i = after[i]
        return i

    for number, (length, first, last, parent) in enumerate(maximal_repeats(common, before[order], least)):
        i = free(first)
        if every and i > last:
            at = order[first]
            yield int(owner[at]), int(place[at]), length, number, parent
        while i <= last:
            at = order[i]
            yield int(owner[at]), int(place[at]), length, number, parent
            after[i] = i + 1
            i = free(i)


_KEYS = ["doc_id", "text_hash"]
_GROUPS = "anchor bigint, group int, parent int, doc_id bigint, text_hash bigint, start bigint, length bigint, copies bigint"


def _groups(least: int):
    """Rows come sorted by anchor; whole anchors are sorted together, several at a time."""
    names = ["anchor", "copies", *_KEYS, "first", "windows", "bytes"]

    def solved(rows: list[tuple]) -> pa.RecordBatch | None:
        out = [
            (rows[b][0], group, parent, rows[b][2], rows[b][3], rows[b][4] + place, length, rows[b][1])
            for b, place, length, group, parent in group_rows([r[6] for r in rows], [r[5] for r in rows], least)
        ]
        if not out:
            return None
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5]
        columns = [c.split()[0] for c in _GROUPS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if held >= BUFFER and row[0] != waiting[-1][0]:
                    if (made := solved(waiting)) is not None:
                        yield made
                    waiting, held = [], 0
                waiting.append(row)
                held += len(row[6])
        if waiting and (made := solved(waiting)) is not None:
            yield made

    return run


def _cut_out(length: int):
    """The bytes of the blocks that a text is asked for."""
    fields = ["anchor", "copies", "blocks", "first", "windows"]
    names = ["anchor", "copies", "blocks", *_KEYS, "first", "windows", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.int32(), pa.binary()]
        for batch in batches:
            out = []
            for data, asked, *key in zip(*(batch.column(n) for n in ("data", "asked", *_KEYS)), strict=True):
                if not asked.is_valid:
                    continue
                text, key = data.as_py(), [k.as_py() for k in key]
                for block in asked.as_py():
                    anchor, copies, blocks, first, windows = (block[f] for f in fields)
                    out.append((anchor, copies, blocks, *key, first, windows, text[first : first + windows + length - 1]))
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _windows(length: int):
    """Every window of blocks with two hashes of its own."""
    names = [*_KEYS, "start", "hash", "other_hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (first, windows, data) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("first", "windows", "bytes")), strict=True)):
                raw, start = np.frombuffer(data, np.uint8), np.arange(windows)
                hashes = [p.strings(p.prefixes(raw), start, start + length).view(np.int64) for p in (_FIRST, _SECOND)]
                row = pa.array(np.full(windows, i))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(row) for k in _KEYS), pa.array(start + first), *map(pa.array, hashes)], names)

    return run


def _same_text(rows: DataFrame, other: DataFrame) -> DataFrame:
    """``rows`` with what ``other`` has for their id and text, if anything."""
    theirs = other.withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
    return rows.join(theirs, F.expr("text_hash = own_hash AND doc_id <=> own_id"), "left")


def repeat_tables(
    rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, blocks_per_anchor: int = BLOCKS_PER_ANCHOR
) -> tuple[DataFrame, DataFrame]:
    """Repeated spans (``doc_id``, ``text_hash``, ``start``, ``stop``), and the maximal groups.

    ``rows`` has doc_id, text_hash and the bytes in ``data``. The groups hold the
    occurrences in blocks that differ; ``copies`` counts the equal blocks that one stands for.
    """
    met = staged(rows.mapInArrow(_blocks(length, anchor), _BLOCKS))
    repeated = staged(
        met.groupBy("anchor").agg(F.count("*").alias("times"), F.min("block").alias("a"), F.max("block").alias("b"))
        .where("times > 1").selectExpr("anchor", "a <> b AS mixed")
    )
    met = staged(met.join(repeated, "anchor"))
    span = ["doc_id", "text_hash", "first AS start", f"first + windows + {length - 1} AS stop"]
    plain = met.where("NOT mixed").selectExpr(*span)

    mixed = met.where("mixed")
    kinds = staged(
        mixed.groupBy("anchor", "block").agg(F.count("*").alias("copies"), F.min(F.struct(*_KEYS, "first", "windows")).alias("one"))
    )
    copied = mixed.join(kinds.where("copies > 1").select("anchor", "block"), ["anchor", "block"]).selectExpr(*span)
    single = kinds.groupBy("anchor").agg(F.count("*").alias("blocks"), F.min("copies").alias("fewest"))
    single = staged(single.where("fewest = 1").select("anchor", "blocks"))
    asked = kinds.join(single, "anchor").selectExpr("one.doc_id", "one.text_hash", "struct(anchor, copies, blocks, one.first, one.windows) AS block")
    asked = asked.groupBy(*_KEYS).agg(F.collect_list("block").alias("asked"))
    cut = _same_text(rows, staged(asked)).select("data", "asked", *_KEYS).mapInArrow(
        _cut_out(length),
        "anchor bigint, copies bigint, blocks bigint, doc_id bigint, text_hash bigint, first bigint, windows int, bytes binary",
    )
    cut = staged(cut)

    few = cut.where(F.col("blocks") <= blocks_per_anchor).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "text_hash", "first")
    groups = staged(few.drop("blocks").mapInArrow(_groups(length), _GROUPS))
    windows = cut.where(F.col("blocks") > blocks_per_anchor).mapInArrow(
        _windows(length), "doc_id bigint, text_hash bigint, start bigint, hash bigint, other_hash bigint"
    )
    windows = staged(windows)
    often = staged(windows.groupBy("hash", "other_hash").count().where("count > 1").drop("count"))
    crowded = windows.join(often, ["hash", "other_hash"]).selectExpr(*_KEYS, "start", f"start + {length} AS stop")
    spans = plain.union(copied).union(groups.selectExpr(*_KEYS, "start", "start + length AS stop")).union(crowded)
    return spans, groups


def _without(data: bytes, spans: list | None) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    if not spans:
        return 0, 0, data
    edges = np.array([(s["start"], s["stop"]) for s in spans], np.int64)
    edges = edges[np.argsort(edges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(edges[:, 1])
    new = np.concatenate([[True], edges[1:, 0] > reach[:-1]])
    starts = edges[new, 0]
    stops = reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(reach) - 1]])]
    kept, at = [], 0
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        kept.append(data[at:start])
        at = stop
    return int((stops - starts).sum()), len(starts), b"".join([*kept, data[at:]])


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    blocks_per_anchor: int = BLOCKS_PER_ANCHOR,
    digest: bool = False,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the bytes left in ``kept``.

    With ``digest``, ``kept_sha256`` stands in for ``kept``. A null text is an empty one;
    texts shorter than the length lose nothing. Rows that repeat an id and its text are
    texts like any other, so all of theirs is repeated. A null id is an id like any other,
    and an empty table gives an empty one. Removal may cut a character of several bytes.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    rows = rows.select("doc_id", F.xxhash64("data").alias("text_hash"), "data")
    spans, _ = repeat_tables(rows, length, anchor, blocks_per_anchor)
    spans = staged(spans.groupBy(*_KEYS).agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    met = _same_text(rows, spans).select("doc_id", "data", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, found in zip(batch.column("data"), batch.column("spans"), strict=True):
                data = value.as_py()
                removed, runs, kept = _without(data, found.as_py())
                out.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest() if digest else kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary()]
            columns = zip(*out, strict=True) if out else [()] * 4
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", name])

    name = "kept_sha256" if digest else "kept"
    kind = "string" if digest else "binary"
    return met.mapInArrow(run, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {name} {kind}")


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``without_repeats`` with the SHA-256 of the remaining bytes."""
    return without_repeats(docs, id_col, text_col, digest=True)


def _cut_kinds(length: int):
    """The bytes of the kinds of blocks that a text is asked for."""
    names = ["anchor", "block", "copies", "blocks", "windows", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int64()] * 4, pa.int32(), pa.binary()]
        for batch in batches:
            out = []
            for data, asked in zip(batch.column("data"), batch.column("asked"), strict=True):
                if not asked.is_valid:
                    continue
                text = data.as_py()
                for one in asked.as_py():
                    first, windows = one["first"], one["windows"]
                    cut = text[first : first + windows + length - 1]
                    out.append((one["hashes"]["anchor"], one["hashes"]["block"], one["copies"], one["blocks"], windows, cut))
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


_SUFFIXES = "anchor bigint, block bigint, copies bigint, part bigint, place int, before int, windows int, bytes binary"
_FOUND = "anchor bigint, block bigint, part bigint, group int, parent int, place int, length int"


def _suffixes(length: int):
    """Each window of blocks, with what follows it in its block, dealt by the window's hash."""
    names = [c.split()[0] for c in _SUFFIXES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (windows, data) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("windows", "bytes")), strict=True)):
                raw, start = np.frombuffer(data, np.uint8), np.arange(windows)
                parts = _FIRST.strings(_FIRST.prefixes(raw), start, start + length).view(np.int64)
                before = np.concatenate([[-1], raw[: windows - 1]]).astype(np.int32)
                row = pa.array(np.full(windows, i))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(row) for c in names[:3]), pa.array(parts), pa.array(start.astype(np.int32)), pa.array(before),
                     pa.array(np.ones(windows, np.int32)), pa.array([data[k:] for k in range(windows)], pa.binary())], names
                )

    return run


def _kind_groups(least: int):
    """Groups of kinds of blocks, sorted by anchor and part; a kind met more than once repeats as a whole."""
    names = [c.split()[0] for c in _SUFFIXES.split(", ")]

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        both = rows + [r for r in rows if r[2] > 1]
        found = group_rows([r[7] for r in both], [r[6] for r in both], least, [r[5] for r in both], every=True)
        out = list(dict.fromkeys(
            (*both[b][:2], both[b][3], group, parent, both[b][4] + place, length) for b, place, length, group, parent in found
        ))
        kinds = [*[pa.int64()] * 3, *[pa.int32()] * 4]
        columns = zip(*out, strict=True) if out else [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _FOUND.split(", ")]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if held >= BUFFER and (row[0], row[3]) != (waiting[-1][0], waiting[-1][3]):
                    yield solved(waiting)
                    waiting, held = [], 0
                waiting.append(row)
                held += len(row[7])
        if waiting:
            yield solved(waiting)

    return run


def repeat_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    blocks_per_anchor: int = BLOCKS_PER_ANCHOR,
) -> DataFrame:
    """All occurrences in the maximal repeat groups within blocks, each in its smallest group.

    A group whose occurrences all lie in smaller ones names one of them again.
    A group is known by anchor, part and group; those of its inner groups, which name it as
    their parent, are its occurrences too. Equal blocks are sorted as one, or as two where
    there are more, and then all listed. Anchors with many different blocks are dealt by
    window, as what repeats starts with the same window. A repeat that is longer than its
    blocks has a group in each of them; groups are not joined across blocks.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    rows = rows.select("doc_id", F.xxhash64("data").alias("text_hash"), "data")
    met = staged(rows.mapInArrow(_blocks(length, anchor), _BLOCKS))
    repeated = staged(met.groupBy("anchor").count().where("count > 1").drop("count"))
    met = staged(met.join(repeated, "anchor"))
    kinds = staged(
        met.groupBy("anchor", "block").agg(F.count("*").alias("copies"), F.min(F.struct(*_KEYS, "first", "windows")).alias("one"))
    )
    sizes = kinds.groupBy("anchor").agg(F.count("*").alias("blocks"))
    asked = kinds.join(sizes, "anchor").selectExpr(
        "one.doc_id", "one.text_hash",
        "struct(struct(anchor, block) AS hashes, copies, blocks, one.first, one.windows) AS block",
    ).groupBy(*_KEYS).agg(F.collect_list("block").alias("asked"))
    cut = _same_text(rows, staged(asked)).select("data", "asked", *_KEYS).dropDuplicates(_KEYS).mapInArrow(
        _cut_kinds(length), "anchor bigint, block bigint, copies bigint, blocks bigint, windows int, bytes binary"
    )
    cut = staged(cut)
    few = cut.where(F.col("blocks") <= blocks_per_anchor).selectExpr(
        "anchor", "block", "copies", "0L AS part", "0 AS place", "-1 AS before", "windows", "bytes"
    )
    crowded = cut.where(F.col("blocks") > blocks_per_anchor).mapInArrow(_suffixes(length), _SUFFIXES)
    dealt = few.union(crowded).repartition("anchor", "part").sortWithinPartitions("anchor", "part", "block", "place")
    found = staged(dealt.mapInArrow(_kind_groups(length), _FOUND))
    return found.join(met, ["anchor", "block"]).selectExpr(
        "anchor", "part", "group", "parent", *_KEYS, "first + place AS start", "CAST(length AS BIGINT) AS length"
    )
