import random
import zlib
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

from addrloom.llm.bpe import default_path
from addrloom.llm.bpe import packed as packed_ids
from addrloom.llm.packing import OpenBins, cut, pack, packed_sequences


def check_places(rows, size=1024):
    """Sequences are gapless and no longer than ``size``; returns how many there are."""
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_pieces_are_the_texts(table, odd_rows):
    tokenizer = Tokenizer.from_file(default_path())
    want = []
    for i, t in odd_rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((i, n, a, b - a, zlib.crc32(packed_ids(ids[a:b]))))
    rows = packed_sequences(table(odd_rows)).collect()
    assert sorted(repr(tuple(r)[:5]) for r in rows) == sorted(map(repr, want))
    total = sum(w[3] for w in want)
    assert check_places(rows) <= -(-total // 1024) + 1
    assert packed_sequences(table([])).count() == 0


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("most", [1, 3, 100])
def test_bins_take_the_best_fit_and_close_the_fullest(most):
    rnd, bins = random.Random(most), OpenBins(50, most)
    free = {}  # open bins
    for _ in range(3000):
        length = rnd.randint(1, 50)
        number, offset = bins.put(length)
        fitting = [f for f in free.values() if f >= length]
        if fitting:
            assert free[number] == min(fitting) == 50 - offset
        else:
            assert offset == 0 and number not in free
            if len(free) == most:
                del free[min((k for k in free if free[k] == min(free.values())), key=lambda k: k in {x for s in bins.stacks for x in s})]
        free[number] = 50 - offset - length
        if not free[number]:
            del free[number]
        assert len(free) == bins.count <= most
        assert sorted(free) == sorted(x for s in bins.stacks for x in s)


def test_many_pieces_over_tasks(spark):
    pieces = spark.range(20_000).selectExpr("id AS doc_id", "1 + pmod(xxhash64(id), 700) AS length")
    rows = pack(pieces, pieces_per_task=6_000).collect()
    assert len(rows) == 20_000
    assert check_places(rows) <= 1.02 * sum(r["length"] for r in rows) / 1024
