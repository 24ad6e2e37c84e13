import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from addrloom.llm.bpe import Encoder, Remembered, chunks, decode, default_path, encode, merge, merge_long, packed, round_trip, split, splitter
from addrloom.llm.packing import fast_encoder
from addrloom.llm.token_counts import token_counts


@pytest.fixture(scope="module")
def library_tokenizer():
    return Tokenizer.from_file(default_path())


@pytest.fixture(scope="module")
def content():
    with open(default_path(), encoding="utf-8") as file:
        return file.read()


def odd_texts():
    rnd = random.Random(5)
    parts = [
        " ", "  ", "\n", "\t", " \n", "a", "B", "é", "ß", "'s", "'ll", "1", "٣", "²", "Ⅷ", "中", "😀", "<|endoftext|>", "<|endof", "_", "-",
        "!?", "\x1c", "\x85", " ", "　", "​", "don't", "é", "ﬁ", "\U0001e5f0", "Ɤ", "\0",
    ]
    return ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(3000)]


def test_ids_equal_the_librarys(library_tokenizer, content):
    own, fast = Encoder(content), fast_encoder(content)
    for text in odd_texts():
        want = library_tokenizer.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
        assert fast.encode(text) == ids
        assert own.decode(ids) == library_tokenizer.decode(want, skip_special_tokens=False) == text


def test_broken_bytes_decode_as_the_library_does(library_tokenizer, content):
    own, rnd = Encoder(content), random.Random(1)
    for _ in range(300):
        ids = [rnd.randrange(50_257) for _ in range(rnd.randint(1, 8))]
        assert own.decode(packed(ids)) == library_tokenizer.decode(ids, skip_special_tokens=False)


def test_split_is_the_librarys_for_all_characters(library_tokenizer):
    for code in [*range(0xD800), *range(0xE000, 0x110000)]:
        if 0x30000 < code < 0x10FFF0 and code % 11:
            continue
        text = f"a{chr(code)}1 {chr(code)}b"
        want = [place for _, place in library_tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        assert split(text) == [text[a:b] for a, b in want], hex(code)
        if code < 0x30000 and code % 7 == 0:
            assert [m.span() for m in splitter().finditer(text)] == want, hex(code)


def test_merges_go_by_rank_then_from_the_left(content):
    own = Encoder(content).vocabulary
    assert merge(b"", own) == [] and merge(b"a", own) == [own.first[97]]
    assert b"".join(own.bytes_of[i] for i in merge(b"aaaaaaaaaaaaa", own)) == b"a" * 13


def test_long_pieces_are_merged_alike(library_tokenizer, content):
    own, rnd = Encoder(content), random.Random(9)
    pieces = [b"a" * 5001, bytes(rnd.choices(b"abcdefth", k=6000)), bytes(rnd.choices(b"the ing", k=6000)).replace(b" ", b"s"), "äöé中".encode() * 700]
    for piece in [*pieces, *(bytes(rnd.choices(b"erston", k=rnd.randint(2, 60))) for _ in range(500)), b"", b"x"]:
        ids = merge_long(piece, own.vocabulary)
        assert ids == library_tokenizer.encode(piece.decode(), add_special_tokens=False).ids
        assert len(piece) > 4096 or merge(piece, own.vocabulary) == ids


def test_a_very_long_word_takes_little_memory(content):
    import tracemalloc

    own = Encoder(content)
    word = "".join(random.Random(1).choices("etaoinshrdlu", k=200_000))
    tracemalloc.start()
    ids = own.encode(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert own.decode(ids) == word and peak < 60 * len(word)


def test_what_is_remembered_stays_bounded():
    calls = []
    known = Remembered(lambda new: calls.extend(new) or [len(p) for p in new], 8)
    for i in range(100):
        assert known.of([f"{i}", "often", f"{i}"]) == [len(str(i)), 5, len(str(i))]
        assert len(known.newer) + len(known.older) <= 10
    assert calls.count("often") == 1 and known.of(["x" * 65, "y"]) == [65, 1] and "x" * 65 not in known.newer
    assert known.of([]) == []


def test_chunks_are_cut_where_the_splitter_cuts():
    for text in odd_texts():
        assert "".join(chunks(text)) == text
        assert [p for c in chunks(text) for p in split(c)] == split(text)


def test_queries_equal_the_library(table, odd_rows, library_tokenizer):
    def sha(data):
        return hashlib.sha256(data).hexdigest()

    ids = {t: library_tokenizer.encode(t or "", add_special_tokens=False).ids for _, t in odd_rows}
    docs = table(odd_rows)
    want = [(i, len(ids[t]), sha(packed(ids[t])), sha((t or "").encode())) for i, t in odd_rows]
    assert sorted(map(repr, map(tuple, round_trip(docs).collect()))) == sorted(map(repr, want))
    want = [(i, len((t or "").encode()), len(ids[t]), len(ids[t]) > 1024) for i, t in odd_rows]
    assert sorted(map(repr, map(tuple, token_counts(docs, sample_rows=3, frequent=5).collect()))) == sorted(map(repr, want))
    back = decode(encode(docs)).collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(repr((i, t or "")) for i, t in odd_rows)


def test_empty_tables(table):
    for operator in (round_trip, token_counts, encode):
        assert operator(table([])).count() == 0
