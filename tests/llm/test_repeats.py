import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from addrloom.llm import repeats
from addrloom.llm.repeats import block_table, group_rows, repeat_digests, repeat_groups, suffix_array, without_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), kept))
    return out


def passages(seed, n):
    rnd = random.Random(seed)
    shared = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(20, 900))) for _ in range(12)]

    def text():
        made = "".join(rnd.choice("xyzwv\n") for _ in range(rnd.randint(0, 300)))
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(shared)
            a = rnd.randint(0, len(p))
            made += p[a : a + rnd.randint(0, 900)] + "".join(rnd.choice("xyzwv") for _ in range(rnd.randint(0, 30)))
        return made

    return [text() for _ in range(n)] + ["a" * 700, "ab" * 400, "", None, "a" * 199, "a" * 200, "q" * 60]


@pytest.mark.parametrize("length, anchor, blocks", [(200, 40, 8192), (200, 40, 3), (60, 20, 2), (600, 50, 8192)])
def test_equals_brute_force(spark, length, anchor, blocks):
    texts = passages(length, 120)
    texts += texts[:3]
    docs = spark.createDataFrame([(i if i != 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = without_repeats(docs, length=length, anchor=anchor, blocks_per_anchor=blocks).collect()
    assert sorted((bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got) == sorted(
        (kept, *rest) for *rest, kept in brute(texts, length)
    )


def test_query_on_odd_rows(table, odd_rows):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 50_000]
    got = repeat_digests(table(rows)).collect()
    want = [(i, *b[:3], hashlib.sha256(b[3]).hexdigest()) for (i, _), b in zip(rows, brute([t for _, t in rows], 200), strict=True)]
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, want))
    assert repeat_digests(table([])).count() == 0


def test_long_texts_are_cut_in_overlapping_buffers(spark, monkeypatch):
    texts = passages(5, 40)
    long = "".join(t or "" for t in texts)
    monkeypatch.setattr(repeats, "BUFFER", 1000)
    table = [block_table([piece], 200, 40) for _, piece in repeats._slices(long.encode(), 200)]
    starts = [start for start, _ in repeats._slices(long.encode(), 200)]
    windows = sorted(w for t, s in zip(table, starts, strict=True) for f, n in zip(t[1], t[2], strict=True) for w in range(s + f, s + f + n))
    assert windows == list(range(len(long.encode()) - 199))
    whole = block_table([long.encode()], 200, 40)
    assert {int(h) for t in table for h in t[4]} == {int(h) for h in whole[4]}


def test_suffix_array():
    data = np.frombuffer(b"banana-bananas-" * 3, np.uint8)
    starts = np.arange(len(data))
    order, common = suffix_array(data, starts, np.full(len(data), len(data)))
    suffixes = [bytes(data[i:]) for i in range(len(data))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    for n, (a, b) in enumerate(zip(order[:-1], order[1:], strict=True), 1):
        x, y = suffixes[a], suffixes[b]
        assert common[n] == next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))


def covered(blocks, least):
    gone = [np.zeros(len(b), bool) for b in blocks]
    for block, place, length, *_ in group_rows(blocks, [len(b) - least + 1 for b in blocks], least):
        gone[block][place : place + length] = True
    return [bytes(np.frombuffer(b, np.uint8)[g]) for b, g in zip(blocks, gone, strict=True)]


def test_a_block_that_ends_early_does_not_part_others():
    assert covered([b"abcdeF", b"abcd", b"eMMM", b"abcdeZ"], 4) == [b"abcde", b"abcd", b"", b"abcde"]
    data = b"abcdeFabcdeMMMabcdeZ"
    starts, ends = np.array([0, 6, 14]), np.array([6, 10, 20])
    order, common = suffix_array(np.frombuffer(data, np.uint8), starts, ends)
    assert (order.tolist(), common.tolist()) == ([1, 0, 2], [0, 4, 5])


def test_groups_of_blocks_that_end_anywhere_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(1500):
        least = rnd.randint(2, 9)
        core = bytes(rnd.choice(b"ab\0\xff") for _ in range(30))
        cuts = [(rnd.randint(0, 20), rnd.randint(least, 24)) for _ in range(rnd.randint(2, 7))]
        blocks = [b for a, n in cuts if len(b := core[a : a + n] + rnd.choice([b"", b"a", b"b", b"\0"])) >= least]
        blocks = list(dict.fromkeys(blocks))
        count = Counter(b[i : i + least] for b in blocks for i in range(len(b) - least + 1))
        want = []
        for b in blocks:
            gone = np.zeros(len(b), bool)
            for i in range(len(b) - least + 1):
                if count[b[i : i + least]] > 1:
                    gone[i : i + least] = True
            want.append(bytes(np.frombuffer(b, np.uint8)[gone]))
        if blocks:
            assert covered(blocks, least) == want


def test_documents_that_end_inside_a_shared_passage(spark):
    rnd = random.Random(4)
    shared = "".join(rnd.choice("ab") for _ in range(1500))
    texts = [shared[a : a + rnd.randint(20, 300)] + rnd.choice(["", "a", "b"]) for a in (rnd.randint(0, 1300) for _ in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = without_repeats(docs, length=20, anchor=8).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == sorted(brute(texts, 20))


def test_groups_are_maximal_and_list_every_occurrence():
    core = b"the same words in every block"
    blocks = [b"1x" + core + b"abc!", b"2x" + core + b"abc?", b"3y" + core + b"zzz?", b"nothing that could be repeated here"]
    rows = list(group_rows(blocks, [len(b) - 9 for b in blocks], 10))
    groups = {}
    for block, place, length, group, parent in rows:
        groups.setdefault((group, length, parent), set()).add((block, place))
    assert {tuple(sorted(v)) for v in groups.values()} >= {((0, 1), (1, 1))}
    outer = [g for g, v in groups.items() if (2, 2) in v]
    inner = [g for g, v in groups.items() if v == {(0, 1), (1, 1)}]
    assert outer[0][1] == len(core) and inner[0][1] == len(b"x" + core + b"abc")
    assert not any(block == 3 for block, *_ in rows)


def test_group_table(spark):
    texts = passages(9, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = repeat_groups(docs).collect()
    assert found
    for r in found:
        assert r["length"] >= 200 and r["start"] + r["length"] <= len(texts[r["doc_id"]].encode())


@pytest.mark.parametrize("length, blocks", [(200, 8192), (60, 2)])
def test_groups_list_all_occurrences(spark, length, blocks):
    texts = [t or "" for t in passages(length + 1, 40)]
    texts += texts[:4] * 2 + ["z" + "the same text " * 3 + "".join(map(str, range(200)))] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    data = [t.encode() for t in texts]
    own, inner, said = {}, {}, {}
    for r in repeat_groups(docs, length=length, anchor=length // 4, blocks_per_anchor=blocks).collect():
        key = (r["anchor"], r["part"], r["group"])
        own.setdefault(key, set()).add((r["doc_id"], r["start"]))
        said[key] = data[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(said[key]) == r["length"] >= length
        if r["parent"] >= 0:
            inner.setdefault((r["anchor"], r["part"], r["parent"]), set()).add(key)

    def occurrences(key):
        return own.get(key, set()).union(*(occurrences(k) for k in inner.get(key, ())))

    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    gone = [np.zeros(len(b), bool) for b in data]
    for key, string in said.items():
        found = occurrences(key)
        assert found == {(n, i) for n, b in enumerate(data) for i in range(len(b)) if b.startswith(string, i)}
        for n, i in found:
            gone[n][i : i + len(string)] = True
    for b, g in zip(data, gone, strict=True):
        want = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                want[i : i + length] = True
        assert (g == want).all()


def test_groups_of_equal_documents(spark):
    docs = spark.createDataFrame([(i, "".join(map(str, range(300)))) for i in range(3)], "doc_id long, text string")
    found = repeat_groups(docs).collect()
    assert {r["doc_id"] for r in found} == {0, 1, 2}


def test_every_maximal_repeat_has_a_row():
    rnd = random.Random(8)
    for _ in range(300):
        least = rnd.randint(2, 5)
        blocks = list(dict.fromkeys(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(least, 14))) for _ in range(rnd.randint(2, 6))))
        places = {}
        for n, b in enumerate(blocks):
            for i in range(len(b)):
                for j in range(i + least, len(b) + 1):
                    places.setdefault(b[i:j], []).append((b[i - 1] if i else -n - 1, b[j] if j < len(b) else -n - 1))
        want = {w for w, at in places.items() if len(at) > 1 and len({a for a, _ in at}) > 1 and len({z for _, z in at}) > 1}
        rows = list(group_rows(blocks, [len(b) - least + 1 for b in blocks], least, every=True))
        assert {blocks[b][place : place + length] for b, place, length, *_ in rows} == want
        groups = {row[3] for row in rows}
        assert len(groups) == len(want) and {row[4] for row in rows} <= groups | {-1}
