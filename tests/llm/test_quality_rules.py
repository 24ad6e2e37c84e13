from collections import Counter

import pytest

from addrloom.llm.quality_rules import RepetitionLimits, keep_by_repetition, measure, repetition_measures

BLANK = " \t\n\r\x0b\x0c"


def split_words(text):
    return text.translate(str.maketrans(BLANK, " " * 6)).split(" ")


def brute(text, limits=None):
    text = text or ""
    words = [w for w in split_words(text) if w]
    chars = sum(map(len, words))
    seen, lines, dups, dup_chars = set(), 0, 0, 0
    for line in text.split("\n"):
        own = [w for w in split_words(line) if w]
        if own:
            lines += 1
            dups += line in seen
            dup_chars += sum(map(len, own)) if line in seen else 0
            seen.add(line)

    def cover(n, first):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        counts, met, out = Counter(grams), set(), set()
        for i, g in enumerate(grams):
            if counts[g] > 1 and (first or g in met):
                out.update(range(i, i + n))
            met.add(g)
        return out

    repeated = len(cover(3, True))
    limits = limits or RepetitionLimits()
    fine = all(sum(len(words[i]) for i in cover(n, False)) <= most * chars for n, most in limits.ngram_chars.items())
    fine &= dups <= limits.line_share * lines and dup_chars <= limits.line_chars * chars
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < limits.min_words or 100 * repeated > 50 * len(words)
    return len(words), chars, symbols, dups, repeated, failed, fine and symbols <= 0.5 * len(words) and not failed


def test_equals_brute_force(table, odd_rows):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 20_000]
    got = [tuple(r)[:8] for r in repetition_measures(table(rows)).collect()]
    assert sorted(got, key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


@pytest.mark.parametrize("shares", [{2: 0.2, 6: 0.5}, {1: 0.9, 4: 0.1}, {9: 0.1, 2: 0.3}, {}])
def test_ngrams_of_any_length_and_order(odd_rows, shares):
    limits = RepetitionLimits(min_words=4, ngram_chars=shares)
    pairs = " ".join(f"same pair w{i}" for i in range(40))
    for text in [pairs, "a b a b", "one two three four five", *(t for _, t in odd_rows if t and len(t) < 20_000)]:
        assert measure(text.encode(), limits)[:7] == brute(text, limits)


def test_a_very_long_text_is_measured_whole():
    half = " ".join(f"w{i}" for i in range(200_000))
    assert measure(half.encode(), RepetitionLimits())[4] == 0
    assert measure((half + " " + half).encode(), RepetitionLimits())[4] == 400_000


def test_kept_rows_keep_their_columns(spark, table, odd_rows):
    docs = table(odd_rows)
    kept = keep_by_repetition(docs)
    assert kept.schema == docs.schema
    assert kept.count() == repetition_measures(docs).where("kept").count() > 5
    assert {r["record"] for r in kept.collect() if r["record"]} == {docs.where("record IS NOT NULL").first()["record"]}


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_nothing_to_keep(table, rows):
    assert keep_by_repetition(table(rows)).count() == 0
    assert repetition_measures(table(rows)).count() == len(rows)
