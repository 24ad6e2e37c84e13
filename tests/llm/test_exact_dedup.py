import hashlib
from collections import defaultdict

import pytest

from addrloom.llm.bloom import MAX_FILTER_BYTES
from addrloom.llm.exact_dedup import drop_exact_copies, exact_groups, possibly_repeated


def groups_of(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append((i is not None, i or 0))
    return groups


@pytest.mark.parametrize("filter_bytes", [64, MAX_FILTER_BYTES])
def test_equals_brute_force(table, odd_rows, filter_bytes):
    groups, want = groups_of(odd_rows), []
    for i, t in odd_rows:
        own = groups[t or ""]
        keep = max(own)
        want.append((i, keep[1] if keep[0] else None, len(own), hashlib.sha256((t or "").encode()).hexdigest()))
    got = exact_groups(table(odd_rows), max_filter_bytes=filter_bytes).collect()
    assert sorted(repr((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == sorted(map(repr, want))
    kept = sorted((r["text_sha256"], repr(r["doc_id"])) for r in got if r["kept"])
    assert kept == sorted({(w[3], repr(w[1])) for w in want})


def test_one_row_of_each_text_stays_with_its_columns(table, odd_rows):
    docs = table(odd_rows)
    kept = drop_exact_copies(docs)
    assert kept.schema == docs.schema
    want = sorted((t, max(own)) for t, own in groups_of(odd_rows).items())
    assert sorted((r["text"] or "", (r["doc_id"] is not None, r["doc_id"] or 0)) for r in kept.collect()) == want


def test_without_repeats_and_empty(table):
    rows = [(i, f"text {i}") for i in range(50)]
    assert drop_exact_copies(table(rows)).count() == 50
    assert exact_groups(table([])).count() == drop_exact_copies(table([])).count() == 0


def test_only_possible_repeats_are_shuffled(spark):
    digests = spark.range(20_000).selectExpr("unhex(sha2(CAST(id % 19900 AS string), 256)) AS digest")
    tested = possibly_repeated(digests.repartition(7), 20_000)
    assert tested.where("maybe").count() < 1_500
    assert tested.where("maybe").groupBy("digest").count().where("count > 1").count() == 100
