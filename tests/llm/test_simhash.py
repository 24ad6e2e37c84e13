import random

import numpy as np
import pytest
import xxhash

from addrloom.llm.components import components
from addrloom.llm.simhash import fingerprint_links, keep_class_representatives, near, near_duplicate_classes


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps):
    """Class number of each distinct fingerprint."""
    fps, root = sorted(set(fps)), {}
    for f in fps:
        if f in root:
            continue
        root[f], queue = f, [f]
        while queue:
            x = queue.pop()
            for y in fps:
                if y not in root and (x ^ y).bit_count() <= 4:
                    root[y] = f
                    queue.append(y)
    return root


def test_equals_brute_force(table, odd_rows):
    fps = [(i, brute_fingerprint(t)) for i, t in odd_rows]
    root = brute_classes(f for _, f in fps)
    least = {}
    for i, f in fps:
        least[root[f]] = min((x for x in (least.get(root[f]), i) if x is not None), default=None)
    want = [(i, f"{f:016x}", least[root[f]]) for i, f in fps]
    got = [tuple(r) for r in near_duplicate_classes(table(odd_rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_representatives(table, odd_rows):
    docs = table(odd_rows)
    kept = keep_class_representatives(docs)
    assert kept.schema == docs.schema
    fps = [(i, brute_fingerprint(t)) for i, t in odd_rows]
    root = brute_classes(f for _, f in fps)
    want = {}
    for i, f in fps:
        want[root[f]] = min(want.get(root[f], (True, 0)), (i is None, i or 0))
    got = [(r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()]
    assert sorted(got) == sorted(want.values())
    assert keep_class_representatives(table([])).count() == near_duplicate_classes(table([])).count() == 0


def flipped(rnd, fp, most):
    for b in rnd.sample(range(64), rnd.randint(0, most)):
        fp ^= 1 << b
    return fp


@pytest.mark.parametrize("tile", [4, 16_384])
def test_links_connect_all_that_is_near(spark, tile):
    rnd = random.Random(7)
    centres = [rnd.getrandbits(64) for _ in range(60)]
    fps = {flipped(rnd, c, 6) for c in centres for _ in range(rnd.choice([1, 2, 5, 60]))} | {0, (1 << 64) - 1, 15}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = fingerprint_links(spark.createDataFrame(signed, "fp long"), tile).collect()
    assert all(((r["a"] ^ r["b"]) & ((1 << 64) - 1)).bit_count() <= 4 for r in links)
    node = {f: f for f in fps}

    def root(f):
        while node[f] != f:
            f = node[f]
        return f

    for r in links:
        node[root(r["a"] % (1 << 64))] = root(r["b"] % (1 << 64))
    want = brute_classes(fps)
    assert len({(root(f), want[f]) for f in fps}) == len(set(want.values())) == len({root(f) for f in fps})


def test_chain_loses_no_near_pair():
    rnd = random.Random(3)
    differences = [flipped(rnd, 0, 4) for _ in range(3000)]
    hits = [near(np.array(differences, np.uint64), np.full(3000, first)) for first in range(5)]
    assert np.logical_or.reduce(hits).all()
    far = np.array([sum(1 << b for b in rnd.sample(range(64), 5)) for _ in range(500)], np.uint64)
    assert not any(near(far, np.full(500, first)).any() for first in range(5))


def test_components_of_chains_stars_and_odd_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, None), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
