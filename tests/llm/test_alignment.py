import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from addrloom.llm.alignment import alignment_counts, alignments, default_piece_path, identity_counts, pair, pair_table, sizes, _contents
from addrloom.llm.bpe import byte_letters, default_path
from addrloom.operators.staging import staged


@pytest.fixture(scope="module")
def tokenizers_of_both():
    a = Tokenizer.from_file(default_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=default_piece_path())
    letters = byte_letters()
    bytes_a = {i: bytes(letters[c] for c in token) for token, i in a.get_vocab().items() if i != 50256}
    bytes_b = {}
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        bytes_b[i] = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
    return a, b, bytes_a, bytes_b


def brute_force(rows, both):
    a, b, bytes_a, bytes_b = both
    made, holders = [], defaultdict(int)
    for doc_id, text in rows:
        links, groups = [], []
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in ids_a) != want or b"".join(bytes_b[i] for i in ids_b) != want:
            made.append((doc_id, 0, 0, 0, [], ""))
            continue
        at_a = at_b = j = 0
        spans_b = []
        for i in ids_b:
            spans_b.append((at_b, at_b + len(bytes_b[i]), i))
            at_b = spans_b[-1][1]
        own, other, current = [], [], set()
        for i in ids_a:
            end = at_a + len(bytes_a[i])
            own.append(i)
            while j < len(spans_b) and spans_b[j][0] < end:
                links.append((i, spans_b[j][2]))
                if j not in current:
                    other.append(spans_b[j][2])
                    current.add(j)
                if spans_b[j][1] > end:
                    break
                j += 1
            if spans_b[max(current)][1] == end:
                groups.append(",".join(map(str, own)) + "|" + ",".join(map(str, other)))
                own, other, current = [], [], set()
            at_a = end
        assert not own and j == len(spans_b)
        for one in set(links):
            holders[one] += 1
        made.append((doc_id, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = Counter()
    for (i, _), n in holders.items():
        best[i] = max(best[i], n)
    rows = [(d, x, y, g, len(ls), sum(holders[p] == best[p[0]] for p in ls), sum(holders[p] for p in ls), s) for d, x, y, g, ls, s in made]
    return rows, holders


def more_rows():
    return [
        (900, "don't  double▁bar"), (901, " nbsp\ttab\r\nline  "), (902, "<s> </s> <unk> <0x41> <|endoftext|>"), (903, "\0nul"), (904, "ﬁ ligature ½ Å"),
        (905, "日本語のテキスト😀😀"), (906, "a" * 9000), (907, "tokenization tokenizations pretokenized"), (908, "tokenization"), (909, "   "), (910, "▁"),
    ]


def test_against_brute_force(table, odd_rows, tokenizers_of_both):
    rows = [*odd_rows, *more_rows()]
    want, _ = brute_force(rows, tokenizers_of_both)
    for frequent in (1 << 16, 3):
        got = [tuple(r) for r in alignment_counts(table(rows), frequent=frequent).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_pairs_of_the_corpus(table, odd_rows, tokenizers_of_both):
    _, holders = brute_force(odd_rows, tokenizers_of_both)
    n_a, n_b = sizes()
    links = staged(alignments(table(odd_rows)))
    identity = pair(*_contents(None, None)).identity
    got = {(r["a"], r["b"] if r["b"] is not None else int(identity[r["a"]])): r["docs"] for r in pair_table(links, n_a, n_b).collect()}
    assert got == dict(holders)
    vector = identity_counts(links, n_a)
    assert len(vector) == n_a and {a: int(vector[a]) for a in np.flatnonzero(vector)} == {a: n for (a, b), n in holders.items() if identity[a] == b}


def test_identity_map_has_the_same_bytes(tokenizers_of_both):
    _, _, bytes_a, bytes_b = tokenizers_of_both
    both = pair(*_contents(None, None))
    found = [(a, b) for a, b in enumerate(both.identity.tolist()) if b >= 0]
    assert len(found) > 10_000 and all(bytes_a[a] == bytes_b[b] for a, b in found)


def test_empty_table(table):
    assert alignment_counts(table([])).collect() == []
