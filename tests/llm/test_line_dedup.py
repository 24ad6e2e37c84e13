import hashlib
from collections import defaultdict

import pytest

from addrloom.llm.line_dedup import _tested, common_line_digests, drop_bitmaps, without_common_lines

ENDS = " \t\n\r\x0b\x0c"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(ENDS))


def brute(rows, least):
    found = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            found[key(line)].add((i, t or ""))
    common = {k for k, docs in found.items() if k and len(docs) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("least", [1, 2, 10])
def test_equals_brute_force(table, odd_rows, least):
    rows = [*odd_rows, *((200 + i, f"É Common\nx{i}\n" + "\n" * 130 + "END\nÉ common ") for i in range(4)), (300, "é common\nend")]
    got = common_line_digests(table(rows), min_documents=least).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, brute(rows, least)))


def test_first_line_may_stay(table):
    rows = [(i, f"head {i}\nshared\nshared") for i in range(5)]
    kept = {r["doc_id"]: (r["n_dropped"], r["kept"]) for r in without_common_lines(table(rows), min_documents=3, keep_first=True).collect()}
    assert kept == {0: (1, "head 0\nshared")} | {i: (2, f"head {i}") for i in range(1, 5)}


def test_a_crowded_line_is_dealt_to_groups(table):
    rows = [(i, f"everywhere\n{i}") for i in range(400)]
    for groups in (1, 64):
        assert drop_bitmaps(table(rows), groups=groups).count() == 400
    assert common_line_digests(table([])).count() == 0


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_texts_that_lose_no_line_stay_where_they_are(table, words):
    rows = [*((i, f"shared\nown {i}") for i in range(12)), *((100 + i, f"alone {i}\n\nalso {i}") for i in range(300)), (None, "shared")]
    made = without_common_lines(table(rows), min_documents=12, max_words=words)
    got = {(r["doc_id"], r["n_dropped"], r["kept"]) for r in made.collect()}
    assert got == {(i, 1, f"own {i}") for i in range(12)} | {(i, 0, t) for i, t in rows[12:-1]} | {(None, 1, "")}
    hashed = table(rows).selectExpr("doc_id", "text", "xxhash64(text) AS text_hash")
    meeting = _tested(hashed, drop_bitmaps(table(rows), min_documents=12), words).where("maybe").count()
    assert meeting >= 13
    if words > 1:
        assert meeting < 13 + 300 // 4


def test_no_python_in_the_plan(table, odd_rows):
    plan = common_line_digests(table(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
