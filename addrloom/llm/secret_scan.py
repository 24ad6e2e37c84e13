"""Secrets in texts: fixed patterns, and literals that are assigned to sensitive names.

The second part lexes source and configuration syntax. At every ``=``, ``:``, ``:=`` or
``=>`` it reads the name before and the value after: quoted or bare literals and names,
joined by ``+``. In ``name: type = value`` the value belongs to the name. A name stands for
all that is assigned to it anywhere in the text; a sensitive name that takes its value from
another, also over several steps, passes its score to the literals where they are written.
The score adds what the name says and what the literal looks like.

Of an assignment only its name's hash and its value's place are kept, and values are lexed
when they are asked for, so that a text of nothing but assignments takes little memory.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.rows import mapped, texts, utf8, whole_row

# Kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18

# What the last words of a name say about its value.
NAME_SCORES = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "credential": 3, "credentials": 3,
    "token": 2, "apikey": 3, "auth": 2, "bearer": 2, "private": 2, "access": 1, "api": 1, "key": 1, "salt": 1,
}
LEAST_SCORE = 5.0
# A name whose words say less is not sensitive.
LEAST_NAME_SCORE = 2
MIN_LITERAL = 8
REDACTED = b"[REDACTED]"

_OPERATOR = re.compile(rb":=|=>|[=:]")
# Read backwards from the operator. Neither blanks nor names hold operators, so no byte is read for two of them.
_NAME_BEFORE = re.compile(rb"""[ \t]*+["'\]]{0,2}([A-Za-z0-9_.\-]*[A-Za-z_])""")
# A bare value holds no operator but for the padding at its end, so that a line is read once.
_TERM = re.compile(
    rb"""[ \t]*(?:[rbfuRBFU]?"(?P<double>(?:[^"\\\n]|\\.)*)"|[rbfuRBFU]?'(?P<single>(?:[^'\\\n]|\\.)*)'|(?P<bare>[A-Za-z0-9+/_.\-]++(?:={1,2}(?![A-Za-z0-9+/_.=\-]))?))"""
)
_PLUS = re.compile(rb"[ \t]*\+(?=[ \t]*[\"'A-Za-z_])")
# ``type =`` after a colon; a colon or an equals sign ends it, so that a line is read once.
_ANNOTATION = re.compile(
    rb"[ \t]*+&?(?:'[a-z]++[ \t]++)?(?:mut[ \t]++)?[\[\]*&?]*+[A-Za-z_][A-Za-z0-9_.]*+(?:[ \t]*+[|,<>\[\]&?*]++[ \t]*+[A-Za-z0-9_.]*+)*+[ \t]*+=(?![=>])"
)
# Before the ``=`` of an annotation these are no names that take the value.
_TYPES = frozenset(
    b"str string String bytes bytearray byte char int Int integer Integer long float double number bool boolean any Any object Object "
    b"None null undefined text Text CharSequence AnyStr Optional Final ClassVar List list Dict dict Set set Tuple tuple u8".split()
)
_LONGEST_WORD = max(map(len, NAME_SCORES))
_ANY_WORD = re.compile("|".join(NAME_SCORES).encode(), re.IGNORECASE)
_IDENTIFIER = re.compile(rb"[A-Za-z_][A-Za-z0-9_.]*\Z")
_PARTS = re.compile(rb"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_PLACEHOLDER = re.compile(rb"(?i)x+|\*+|<.*>|\$\{.*\}|.*(?:example|changeme|placeholder|your).*|none|null|true|false")


# Spans are rows of a number array: start, end, number of the kind, where the secret begins.
START, END, KIND, VALUE = range(4)
_NO_SPANS = np.zeros((0, 4), np.int64)


def _spans(numbers: array) -> np.ndarray:
    return np.frombuffer(numbers, np.int64).reshape(-1, 4) if numbers else _NO_SPANS


def base_spans(data: bytes) -> np.ndarray:
    """Matches of the fixed patterns, leftmost and without overlap within a kind."""
    found = array("q")
    if b"=" in data or b":" in data:
        for m in ASSIGN.finditer(data):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                found.extend((m.start(), m.end(), 0, m.start(2)))
    for kind, pattern, least in ((1, ACCESS, MIN_ACCESS), (2, HEX, 0)):
        for m in pattern.finditer(data):
            if m.end() - m.start() >= least:
                found.extend((*m.span(), kind, m.start()))
    return _spans(found)


def name_score(name: bytes) -> int:
    """The score of a name's words, in snake, kebab, dotted or camel case."""
    words = {w for m in _PARTS.finditer(name) if len(m.group()) <= _LONGEST_WORD and (w := m.group().decode().lower()) in NAME_SCORES}
    return sum(NAME_SCORES[w] for w in words)


_known_name_score = functools.lru_cache(1 << 12)(name_score)


def literal_score(value: bytes) -> float:
    """Up to 4: bits per character, and a point for digits among letters."""
    if len(value) < MIN_LITERAL or _PLACEHOLDER.fullmatch(value) or b" " in value:
        return 0.0
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in Counter(value).values())
    mixed = any(0x30 <= b <= 0x39 for b in value) and any(b > 0x39 for b in value)
    return min(bits, 3.0) + mixed


Term = tuple[str, int, int]


def terms(data: bytes, at: int) -> Iterator[Term]:
    """The literals and names joined by ``+`` from a place on: ('literal' or 'name', start, end)."""
    while term := _TERM.match(data, at):
        group = term.lastgroup
        start, end = term.span(group)
        plain = group == "bare" and _IDENTIFIER.match(data, start, end)
        yield ("name" if plain else "literal"), start, end
        plus = _PLUS.match(data, term.end())
        if not plus:
            return
        at = plus.end()


def assignments(data: bytes) -> Iterator[tuple[bytes, int]]:
    """Names, and where the terms assigned to them begin; there may be none."""
    backwards = data[::-1]
    annotated = -1  # the place of the last annotation's equals sign
    for operator in _OPERATOR.finditer(data):
        at = operator.end()
        if data[at : at + 1] in (b"=", b"/") or data[operator.start() - 1 : operator.start()] in (b"=", b"!", b"<", b">"):
            continue
        before = _NAME_BEFORE.match(backwards, len(data) - operator.start())
        if not before:
            continue
        name = before.group(1)[::-1]
        if operator.start() == annotated and name in _TYPES:
            continue
        if operator.group() == b":" and (annotation := _ANNOTATION.match(data, at)):
            annotated = annotation.end() - 1
            yield name, annotation.end()
            own = terms(data, at)
            if (first := next(own, None)) and next(own, None) is None and data[first[1] : first[2]] in _TYPES:
                continue
        yield name, at


class Constants:
    """The assignments of a text by name: 16 bytes for each."""

    def __init__(self, data: bytes, hashes: array, places: array) -> None:
        self.data = data
        hashes, self.places = np.frombuffer(hashes, np.int64), np.frombuffer(places, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], self.places[order]

    def terms(self, name: bytes) -> Iterator[Term]:
        """All that is assigned to a name."""
        first, last = np.searchsorted(self.hashes, hash(name), "left"), np.searchsorted(self.hashes, hash(name), "right")
        for number in range(first, last):
            yield from terms(self.data, int(self.places[number]))


def assigned_spans(data: bytes) -> np.ndarray:
    """Literals whose score, with that of the name they end up in, is high enough.

    A name is followed once, for the most telling of the names that take its value.
    """
    if (b"=" not in data and b":" not in data) or not _ANY_WORD.search(data):
        return _NO_SPANS
    hashes, places = array("q"), array("q")
    sensitive: dict[int, list[array]] = {}  # by score: the names' hashes and where their values begin
    for name, at in assignments(data):
        own = hash(name)
        hashes.append(own)
        places.append(at)
        score = _known_name_score(name) if len(name) <= 64 else name_score(name)
        if score >= LEAST_NAME_SCORE:
            for column, number in zip(sensitive.setdefault(score, [array("q"), array("q")]), (own, at), strict=True):
                column.append(number)
    if not sensitive:
        return _NO_SPANS
    constants = Constants(data, hashes, places)
    found: set[tuple[int, int]] = set()
    for alone in (True, False):  # a word that nothing is assigned to is a literal where it is the whole value
        seen: set[bytes] = set()
        for said in sorted(sensitive, reverse=True):
            for name, at in zip(*sensitive[said], strict=True):
                own = terms(data, at)
                first = [t for _, t in zip(range(2), own, strict=False)]
                if (len(first) == 1) != alone:
                    continue
                stack = [chain(first, own)]
                while stack:
                    term = next(stack[-1], None)
                    if term is None:
                        stack.pop()
                        continue
                    kind, start, end = term
                    text = data[start:end]
                    if kind == "name" and len(stack) == 1 and hash(text) == name:
                        continue
                    value = kind == "literal"
                    if not value and text not in seen:
                        assigned = constants.terms(text)
                        one = next(assigned, None)
                        if one is not None:
                            seen.add(text)
                            stack.append(chain([one], assigned))
                            continue
                        value = alone
                    if value and said + literal_score(text) >= LEAST_SCORE:
                        found.add((start, end))
    literal = KINDS.index("literal")
    return np.array([(start, end, literal, start) for start, end in found], np.int64).reshape(-1, 4)


def all_spans(data: bytes) -> np.ndarray:
    """Base spans and the lexer's, by start and then kind; a literal within a base span is not said again."""
    base, added = base_spans(data), assigned_spans(data)
    if len(base) and len(added):
        by_start = base[np.argsort(base[:, START], kind="stable")]
        reach = np.maximum.accumulate(by_start[:, END])
        at = np.searchsorted(by_start[:, START], added[:, START], "right") - 1
        added = added[(at < 0) | (reach[at] < added[:, END])]
    spans = np.concatenate([base, added])
    return spans[np.lexsort((spans[:, END], spans[:, KIND], spans[:, START]))]


def in_characters(data: bytes, spans: np.ndarray) -> np.ndarray:
    """The same spans counted in code points."""
    if data.isascii() or not len(spans):
        return spans
    places, back = np.unique(spans[:, [START, END, VALUE]], return_inverse=True)
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    ends = np.append(0, places)
    counts = [int(np.count_nonzero(begins[a:b])) for a, b in zip(ends, places, strict=False)]
    made = spans.copy()
    made[:, [START, END, VALUE]] = np.cumsum(counts)[back].reshape(-1, 3)
    return made


def _said(spans: np.ndarray) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, end, kind, _ in spans.tolist()])


def scan(data: bytes) -> tuple:
    spans = in_characters(data, all_spans(data))
    base = spans[spans[:, KIND] < KINDS.index("literal")]
    n_assign, n_access, n_hex, _ = np.bincount(spans[:, KIND], minlength=len(KINDS)).tolist()
    return n_assign, n_access, n_hex, hashlib.sha256(_said(base).encode()).hexdigest(), _said(spans)


def redact(data: bytes) -> tuple[str]:
    """The text with each secret, but not its name, replaced by ``[REDACTED]``."""
    out, at = [], 0
    spans = all_spans(data)
    for start, end in spans[np.lexsort((spans[:, END], spans[:, VALUE]))][:, [VALUE, END]].tolist():
        if start >= at:
            out += [data[at:start], REDACTED]
        at = max(at, end)
    return (b"".join([*out, data[at:]]).decode(),)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256 and all spans.

    Places are code points, ends exclusive. A null or empty text has no spans and the hash
    of nothing. Repeated rows give repeated results, a null id stays null, an empty table
    gives an empty one.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", utf8().alias("data"))
    columns = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return mapped(rows, columns, scan, ["doc_id"])


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the secrets in its texts replaced; null texts stay null.

    ``length_col``, if given, is set to the new number of characters.
    """
    rows = docs.select(whole_row(docs), docs[text_col].isNull().alias("missing"))
    clean = mapped(rows, "clean string", redact, ["row", "missing"], f"row.{text_col}")
    row, missing = F.col("row"), F.col("missing")
    text = F.when(~missing, F.col("clean"))
    made = {text_col: text}
    if length_col:
        unchanged = missing | (text == row[text_col])
        length = F.when(unchanged, row[length_col]).otherwise(F.length(text))
        made[length_col] = length.cast(docs.schema[length_col].dataType)
    return clean.select(*[made.get(c, row[c]).alias(c) for c in docs.columns])
