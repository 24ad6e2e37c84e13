"""Byte-level BPE: splitting text, merging by rank, decoding.

The vocabulary is a tokenizer file's JSON with its ``vocab``, ``merges`` and
``added_tokens``; its path is a parameter and its content is broadcast.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import struct
import sys
import unicodedata
from array import array
from collections.abc import Callable
from itertools import islice
from pathlib import Path

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.rows import mapped, texts, utf8

# Distinct chunks that a worker remembers; of pieces, half of that.
REMEMBERED = 1 << 20
# Pieces of more bytes are merged in a form that takes less memory for each.
LONG = 4096


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(moved)}


# Letters and numbers that Unicode 16 added, as the tokenizers library knows
# them and Python's tables may not yet.
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
LATER_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)


def _within(code: int, ranges: tuple) -> bool:
    return any(first <= code <= last for first, last in ranges)


def _ranges(test: Callable[[str], bool]) -> str:
    """A character class body of all characters that pass the test."""
    parts, start = [], None
    for code in range(sys.maxunicode + 2):
        hit = code <= sys.maxunicode and test(chr(code))
        if hit and start is None:
            start = code
        elif not hit and start is not None:
            parts.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(parts)


@functools.cache
def splitter() -> re.Pattern:
    """The byte-level split into words, numbers, signs and white space."""
    kind = unicodedata.category
    letter = _ranges(lambda c: kind(c)[0] == "L" or kind(c) == "Cn" and _within(ord(c), LATER_LETTERS))
    number = _ranges(lambda c: kind(c)[0] == "N" or kind(c) == "Cn" and _within(ord(c), LATER_NUMBERS))
    space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


@functools.cache
def _unlike() -> re.Pattern:
    """Characters that the fast split, whose tables are of another version, takes for others."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    kinds = [("L", r"\p{L}"), ("N", r"\p{N}")]
    said = {c: kind for kind, pattern in kinds for c in regex.findall(pattern, every)}
    later = {"L": LATER_LETTERS, "N": LATER_NUMBERS}

    def differs(c: str) -> bool:
        kind = unicodedata.category(c)
        own = kind[0] if kind[0] in "LN" else next((k for k in "LN" if kind == "Cn" and _within(ord(c), later[k])), None)
        return own != said.get(c)

    return re.compile(f"[{_ranges(differs)}]")


@functools.cache
def _fast_splitter() -> Callable[[str], list[str]]:
    space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{space}\p{{L}}\p{{N}}]+|[{space}]+(?![^{space}])|[{space}]+"
    ).findall


def split(text: str) -> list[str]:
    """The pieces of a text, as ``splitter`` gives them."""
    if text.isascii() or not _unlike().search(text):
        return _fast_splitter()(text)
    return splitter().findall(text)


_LOOSE_BLANK = re.compile(r" (?:\s|\Z)")
_BEFORE_A_WORD = re.compile(r"(?= \S)")


def chunks(text: str) -> list[str]:
    """Cut before each space that no white space follows: the splitter begins a piece there too,
    so that chunks can be split on their own."""
    if _LOOSE_BLANK.search(text):
        return _BEFORE_A_WORD.split(text)
    parts = text.split(" ")
    out = [f" {part}" for part in parts[1:]]
    return [parts[0], *out] if parts[0] else out


class Vocabulary:
    """Ids, merge ranks and special strings of a tokenizer file."""

    def __init__(self, content: str) -> None:
        file = json.loads(content)
        letters = byte_letters()
        self.ids: dict[str, int] = file["model"]["vocab"]
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
        # Per merge, by rank: the two symbols and the one made of them. A pair is one number.
        self.left, self.right = ([self.ids[pair[i]] for pair in pairs] for i in (0, 1))
        self.made = [self.ids[a + b] for a, b in pairs]
        self.rank = {a << 32 | b: rank for rank, (a, b) in enumerate(zip(self.left, self.right, strict=True))}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = self.ids[letter]
        self.first_rank = [[self.rank.get(a << 32 | b, -1) for b in self.first] for a in self.first]
        self.bytes_of = {
            i: bytes(letters[c] for c in token) for token, i in self.ids.items() if token not in self.special
        } | {i: token.encode() for token, i in self.special.items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def bytes_by_id(self) -> list[bytes]:
        return [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """The text between special strings, and each of those with its id."""
        if not any(s in text for s in self.special):
            return [(text, None)]
        out, at = [], 0
        for found in self._special.finditer(text):
            out += [(text[at : found.start()], None), ("", self.special[found.group()])]
            at = found.end()
        return [*out, (text[at:], None)]


def merge(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Merge one piece: a heap of merge ranks over a doubly linked list of symbols.

    The lowest rank, the leftmost of equals, goes first. A merge leaves entries behind whose
    symbols have changed; they are known by their pair and skipped when they come up. An
    entry is one number, the rank before the place.
    """
    n = len(piece)
    if n > LONG:
        return merge_long(piece, vocabulary)
    rank, first_rank = vocabulary.rank.get, vocabulary.first_rank
    heap = [found << 32 | i for i, (a, b) in enumerate(zip(piece, piece[1:])) if (found := first_rank[a][b]) >= 0]
    symbol = [vocabulary.first[b] for b in piece]
    if not heap:
        return symbol
    heapq.heapify(heap)
    lefts, rights, mades = vocabulary.left, vocabulary.right, vocabulary.made
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        found, i = entry >> 32, entry & 0xFFFFFFFF
        j = after[i]
        if symbol[i] != lefts[found] or j >= n or symbol[j] != rights[found]:
            continue
        made = mades[found]
        symbol[i], symbol[j] = made, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = rank(made << 32 | symbol[k])
            if found is not None:
                push(heap, found << 32 | i)
        h = before[i]
        if h >= 0:
            found = rank(symbol[h] << 32 | made)
            if found is not None:
                push(heap, found << 32 | h)
    return [s for s in symbol if s >= 0]


def merge_long(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """As ``merge``, for long pieces: the heap holds each rank once, its places are an array.

    That takes some 30 bytes for each of the piece's bytes. Places that a rank gains are put
    in order when it comes up; a lower rank that a merge brings about goes before the rest.
    """
    n = len(piece)
    rank, lefts, rights, mades = vocabulary.rank.get, vocabulary.left, vocabulary.right, vocabulary.made
    symbol = array("i", (vocabulary.first[b] for b in piece))
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    places: dict[int, array] = {}
    heap: list[int] = []

    def add(found: int, place: int) -> None:
        if found not in places:
            places[found] = array("q")
            heapq.heappush(heap, found)
        places[found].append(place)

    for i in range(n - 1):
        if (found := vocabulary.first_rank[piece[i]][piece[i + 1]]) >= 0:
            add(found, i)
    while heap:
        now = heapq.heappop(heap)
        ordered = np.sort(np.frombuffer(places.pop(now), np.int64))
        for number, i in enumerate(map(int, ordered)):
            j = after[i]
            if symbol[i] != lefts[now] or j >= n or symbol[j] != rights[now]:
                continue
            made = mades[now]
            symbol[i], symbol[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (found := rank(made << 32 | symbol[k])) is not None:
                    add(found, i)
            h = before[i]
            if h >= 0 and (found := rank(symbol[h] << 32 | made)) is not None:
                add(found, h)
            if heap and heap[0] <= now:
                if number + 1 < len(ordered):
                    for place in ordered[number + 1 :].tolist():
                        add(now, place)
                break
    return [s for s in symbol if s >= 0]


class Remembered:
    """What a function gave for chunks, some of which are asked for at a time.

    When full, the chunks become the older half, from which those that come again are taken
    over, and a new half begins; so frequent chunks stay. A long one hardly comes again and
    is made anew.
    """

    def __init__(self, make: Callable[[list[str]], list], most: int = REMEMBERED) -> None:
        self.make, self.most, self.older, self.newer = make, most // 2, {}, {}

    def of(self, parts: list[str]) -> list:
        """The results for the parts, in order."""
        if len(self.newer) >= self.most:
            self.older, self.newer = self.newer, {}
        known, older = self.newer, self.older
        unknown, long = [], []
        for part in set(parts).difference(known):
            if part in older:
                known[part] = older[part]
            else:
                unknown.append(part)
                if len(part) > 64:
                    long.append(part)
        if unknown:
            known.update(zip(unknown, self.make(unknown), strict=True))
        found = list(map(known.__getitem__, parts))
        for part in long:
            del known[part]
        return found


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if len(ids) > 100 else struct.pack(f"<{len(ids)}I", *ids)


class Together:
    """Encodes many chunks by one call of a library, and checks the tokens' bytes.

    ``joins`` tells which chunks keep their tokens when joined; where chunks end is seen from
    the tokens' lengths. A chunk whose tokens have other bytes than itself gives None.
    """

    def __init__(self, ids: Callable[[str], list[int]], bytes_of: list[bytes], joins: Callable[[str], bool]) -> None:
        self.ids, self.bytes_of, self.joins = ids, bytes_of, joins
        self.lengths = np.array(list(map(len, bytes_of)), np.int64)

    def one(self, chunk: str) -> bytes | None:
        ids = self.ids(chunk)
        return packed(ids) if b"".join(map(self.bytes_of.__getitem__, ids)) == chunk.encode() else None

    def __call__(self, new: list[str]) -> list[bytes | None]:
        joined = [chunk for chunk in new if self.joins(chunk)]
        made = dict(zip(joined, self._joined(joined), strict=True)) if joined else {}
        return [made[chunk] if chunk in made else self.one(chunk) for chunk in new]

    def _joined(self, new: list[str]) -> list[bytes | None]:
        text = "".join(new)
        ids = self.ids(text)
        if b"".join(map(self.bytes_of.__getitem__, ids)) == text.encode():
            flat = np.array(ids, "<u4")
            ends = np.cumsum(self.lengths[flat])
            stops = np.cumsum([len(chunk.encode()) for chunk in new])
            last = np.searchsorted(ends, stops)
            if (ends[last] == stops).all():
                raw, cuts = flat.tobytes(), [0, *(4 * last + 4).tolist()]
                return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return [self.one(chunk) for chunk in new]


def begins_a_piece(chunk: str) -> bool:
    """Whether a chunk keeps its tokens when others stand before it."""
    return len(chunk) > 1 and chunk[0] == " " and not chunk[1].isspace()


class Encoder:
    """Encodes whole texts to packed ids (little-endian unsigned 32-bit).

    Chunks and pieces that a worker has met are remembered. With ``library`` the tiktoken
    library encodes whole texts instead, which is as fast as remembering and takes no memory.
    """

    def __init__(self, content: str, library: bool = False) -> None:
        own = self.vocabulary = Vocabulary(content)
        self._pieces = Remembered(lambda new: [packed(merge(p.encode(), own)) for p in new], REMEMBERED // 2)
        self._chunks = Remembered(self._merged)
        self._library = library_ids(own) if library else None

    def _merged(self, new: list[str]) -> list[bytes]:
        split_up = list(map(split, new))
        pieces = iter(self._pieces.of([p for pieces in split_up for p in pieces]))
        return [b"".join(islice(pieces, len(own))) for own in split_up]

    def ordinary(self, text: str) -> bytes:
        """The ids of a text whose special strings are text like any other."""
        if self._library:
            return packed(self._library(text))
        return b"".join(self._chunks.of(chunks(text)))

    def encode(self, text: str) -> bytes:
        return b"".join([self.ordinary(part) if special is None else packed([special]) for part, special in self.vocabulary.segments(text)])

    def decode(self, ids: bytes) -> str:
        """Concatenate the vocabulary's strings; bytes that are no UTF-8 become U+FFFD."""
        ids = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def library_ids(vocabulary: Vocabulary) -> Callable[[str], list[int]]:
    """The tiktoken library's encoding by the same ranks and the same split."""
    import tiktoken

    specials = set(vocabulary.special.values())
    ranks = {token: i for i, token in vocabulary.bytes_of.items() if i not in specials}
    return tiktoken.Encoding("ranks", pat_str=splitter().pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@functools.lru_cache(2)
def encoder(content: str) -> Encoder:
    """One per worker process, which keeps what it has learnt between tasks."""
    return Encoder(content)


def read_vocabulary(docs: DataFrame, path: str | None):
    """The tokenizer file's text as a broadcast; its size is that of the file."""
    return docs.sparkSession.sparkContext.broadcast(Path(path or default_path()).read_text(encoding="utf-8"))


def round_trip(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text is an empty one and has no ids. Repeated rows give repeated results, a null
    id stays null, an empty table gives an empty one.
    """
    import hashlib

    content = read_vocabulary(docs, path)

    def row(data: bytes) -> tuple:
        own = encoder(content.value)
        ids = own.encode(data.decode())
        decoded = own.decode(ids).encode()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    return mapped(rows, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", row, ["doc_id"])


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id and ``ids``, an array of numbers."""
    content = read_vocabulary(docs, path)

    def row(data: bytes) -> tuple:
        return (np.frombuffer(encoder(content.value).encode(data.decode()), "<u4").tolist(),)

    return mapped(texts(docs, id_col, text_col).select("doc_id", utf8().alias("data")), "ids array<bigint>", row, ["doc_id"])


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Per row of ``tokens``: doc_id and ``text``; null ids give an empty text."""
    content = read_vocabulary(tokens, path)

    def row(ids: list[int]) -> tuple:
        return (encoder(content.value).decode(packed(ids)),)

    rows = tokens.select(
        tokens[id_col].alias("doc_id"), F.coalesce(tokens[ids_col].cast("array<bigint>"), F.array().cast("array<bigint>")).alias("data")
    )
    return mapped(rows, "text string", row, ["doc_id"])
