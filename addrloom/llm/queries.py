"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from addrloom.llm.alignment import alignment_counts
from addrloom.llm.bpe import round_trip
from addrloom.llm.exact_dedup import exact_groups
from addrloom.llm.line_dedup import common_line_digests
from addrloom.llm.manifest import tamper_report
from addrloom.llm.packing import packed_sequences
from addrloom.llm.quality_classifier import quality_scores
from addrloom.llm.quality_rules import repetition_measures
from addrloom.llm.repeats import repeat_digests
from addrloom.llm.rows import find_library
from addrloom.llm.secret_scan import secret_spans
from addrloom.llm.simhash import near_duplicate_classes
from addrloom.llm.token_counts import token_counts
from addrloom.llm.warc import archived_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _on_documents(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_library(spark)
        return operator(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    QUERIES[name] = query


_on_documents("op1_repetition_rules", repetition_measures)
_on_documents("op2_simhash_classes", near_duplicate_classes)
_on_documents("op3_bpe_round_trip", round_trip)
_on_documents("op4_exact_dedup", exact_groups)
_on_documents("op5_best_fit_packing", packed_sequences)
_on_documents("op6_secret_scan", secret_spans)
_on_documents("op7_line_dedup", common_line_digests)
_on_documents("op9_repeated_passages", repeat_digests)
_on_documents("op10_token_counts", token_counts)
_on_documents("op11_tokenizer_alignment", alignment_counts)
_on_documents("op12_merkle_manifest", tamper_report)


def op8_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_library(spark)
    return quality_scores(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))


QUERIES["op8_compression_classifier"] = op8_compression_classifier

def op13_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_library(spark)
    return archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES["op13_warc_archives"] = op13_warc_archives

_WORD = r"[^\x20\x09-\x0D]+"
_SHARES = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
ORACLES["op1_repetition_rules"] = f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), sizes AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
    FROM texts
), lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM texts
), said AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM lines WHERE regexp_matches(line, '{_WORD}')
), line_counts AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_dup_lines,
           coalesce(sum(list_sum(list_transform(regexp_extract_all(line, '{_WORD}'), lambda w: length(w)))) FILTER (WHERE again), 0) AS chars
    FROM said GROUP BY doc_id
), grams AS (
    SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM texts), (SELECT unnest([3, 5, 6, 7, 8, 9, 10]) AS n)
    WHERE i + n - 1 <= len(words)
), marked AS (
    SELECT *, count(*) OVER (PARTITION BY doc_id, n, gram) > 1 AS again,
           row_number() OVER (PARTITION BY doc_id, n, gram ORDER BY i) > 1 AS later FROM grams
), covered AS (
    SELECT doc_id, n, place, bool_or(later) AS later
    FROM (SELECT doc_id, n, later, unnest(range(i, i + n)) AS place FROM marked WHERE again) GROUP BY ALL
), shares AS (
    SELECT c.doc_id, n, count(*) AS n_covered, coalesce(sum(length(words[place])) FILTER (WHERE later), 0) AS chars
    FROM covered c JOIN texts USING (doc_id) GROUP BY ALL
), repeats AS (
    SELECT doc_id, coalesce(max(n_covered) FILTER (WHERE n = 3), 0) AS n_repeat_words,
           coalesce(max(chars / word_chars) FILTER (WHERE n > 3), 0) AS worst,
           coalesce(bool_and(chars / word_chars <= (map {_SHARES}[n]) / 100) FILTER (WHERE n > 3), true) AS within
    FROM shares JOIN sizes USING (doc_id) GROUP BY doc_id
), measured AS (
    SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed,
           coalesce(within, true) AND coalesce(n_dup_lines <= 0.3 * n_lines AND chars / word_chars <= 0.2, true)
               AND n_symbols <= 0.5 * n_words AS within,
           coalesce(worst, 0)::DOUBLE AS worst_ngram_share,
           CASE WHEN word_chars > 0 THEN coalesce(chars, 0) / word_chars ELSE 0 END::DOUBLE AS dup_line_char_share
    FROM sizes LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, within AND NOT base_failed AS kept,
       worst_ngram_share, dup_line_char_share
FROM measured
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES["op7_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
ORACLES["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# CRC-32 bit by bit, as SQL has no such function: of a byte, then of an id's digits.
_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
_CRC_BYTE = f"list_reduce(range(8), lambda c, i: {_CRC_STEP}, xor(crc, byte))"
_CRC = (
    "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
    f"lambda crc, byte: {_CRC_BYTE}, 4294967295), 4294967295)"
)


def _leaf(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in fields)})"


def _tree(name: str, leaves: str) -> str:
    """Levels of trees from leaves (grp, place, node, n), and each node's step to the next level."""
    return f"""{name}(grp, level, place, node, n) AS (
    SELECT grp, 0, place, node, n FROM {leaves}
    UNION ALL
    SELECT grp, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3
    FROM {name} WHERE n > 1 GROUP BY grp, level, n, place // 3
), {name}_steps AS (
    SELECT a.grp, a.level, a.place, coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before,
           coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
    FROM {name} a JOIN {name} b ON a.grp = b.grp AND a.level = b.level AND a.place // 3 = b.place // 3 WHERE a.n > 1
    GROUP BY ALL
)"""


ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE rows_of AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS grp, {_leaf('text')} AS node,
           CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS claimed
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id, node) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n FROM rows_of
), {_tree('own', 'leaves')}, subroots AS (
    SELECT 0 AS grp, grp AS source, node, row_number() OVER (ORDER BY encode(grp)) - 1 AS place, count(*) OVER () AS n FROM own WHERE n = 1
), {_tree('above', 'subroots')}, paths(grp, place, level, now, before, after) AS (
    SELECT grp, place, 0, place, NULL::VARCHAR, NULL::VARCHAR FROM leaves
    UNION ALL
    SELECT p.grp, p.place, p.level + 1, p.now // 3, s.before, s.after
    FROM paths p JOIN own_steps s ON p.grp = s.grp AND p.level = s.level AND p.now = s.place
), tops(source, level, now, before, after) AS (
    SELECT source, 1000, place, NULL::VARCHAR, NULL::VARCHAR FROM subroots
    UNION ALL
    SELECT p.source, p.level + 1, p.now // 3, s.before, s.after FROM tops p JOIN above_steps s ON s.level = p.level - 1000 AND p.now = s.place
), steps AS (
    SELECT l.grp, l.place, row_number() OVER (PARTITION BY l.grp, l.place ORDER BY w.level) AS step, w.before, w.after
    FROM leaves l JOIN (
        SELECT grp, place, level, before, after FROM paths WHERE before IS NOT NULL
        UNION ALL
        SELECT l.grp, l.place, t.level, t.before, t.after FROM leaves l JOIN tops t ON t.source = l.grp WHERE t.before IS NOT NULL
    ) w ON w.grp = l.grp AND w.place = l.place
), folds(grp, place, step, node) AS (
    SELECT grp, place, 1, claimed FROM leaves
    UNION ALL
    SELECT f.grp, f.place, f.step + 1, sha256(s.before || f.node || s.after)
    FROM folds f JOIN steps s ON f.grp = s.grp AND f.place = s.place AND f.step = s.step
), proofs AS (
    SELECT grp, place, string_agg(before || after, '' ORDER BY step) AS siblings FROM steps GROUP BY ALL
)
SELECT l.doc_id, l.node AS leaf, r.node AS subroot, root.node AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.node AS folded_root, f.node = root.node AS verified
FROM leaves l JOIN subroots r ON r.source = l.grp JOIN above root ON root.n = 1
JOIN (SELECT grp, place, arg_max(node, step) AS node FROM folds GROUP BY ALL) f ON f.grp = l.grp AND f.place = l.place
LEFT JOIN proofs p ON p.grp = l.grp AND p.place = l.place
"""

ORACLES["op13_warc_archives"] = """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN best END AS refers_to
FROM (
    SELECT *, payload_bytes >= 1000 AND page_id <> best AS again
    FROM (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
               max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best
        FROM pages
    )
)
"""
