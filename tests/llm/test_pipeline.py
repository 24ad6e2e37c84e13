import re
import zlib

from tokenizers import Tokenizer

import corpus_pipeline
from addrloom.llm.bpe import default_path
from addrloom.llm.bpe import packed as packed_ids
from addrloom.llm.queries import ORACLES, QUERIES
from checks import compare
from tests.llm.test_packing import check_places
from tests.llm.test_quality_rules import brute as judged
from tests.llm.test_secret_scan import PATTERNS
from tests.llm.test_simhash import brute_classes, brute_fingerprint

SMALLEST = "/root/testdata/sf0.001"


def redacted(text):
    """The fixed patterns' values replaced; the given tables have no other secrets."""
    places = []
    for _, pattern, group, least in PATTERNS:
        places += [(m.start(group), m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    out, at = [], 0
    for start, end in sorted(places):
        if start >= at:
            out += [text[at:start], "[REDACTED]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def brute(docs):
    """The rows of each stage, by plain Python."""
    kept = [d for d in docs if judged(d["text"])[6]]
    yield kept
    last = {}
    for d in kept:
        last[d["text"]] = max(last.get(d["text"], -1), d["doc_id"])
    kept = [d for d in kept if last[d["text"]] == d["doc_id"]]
    yield kept
    fps = {d["doc_id"]: brute_fingerprint(d["text"]) for d in kept}
    root, least = brute_classes(fps.values()), {}
    for i, f in fps.items():
        least[root[f]] = min(least.get(root[f], i), i)
    kept = [d for d in kept if d["doc_id"] in set(least.values())]
    yield kept
    clean = [{**d, "text": redacted(d["text"])} for d in kept]
    yield [d if d == e else {**e, "n_chars": len(e["text"])} for d, e in zip(kept, clean, strict=True)]


def plain(rows):
    return sorted((dict(r) if isinstance(r, dict) else r.asDict() for r in rows), key=lambda d: d["doc_id"])


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    columns, want = docs.columns, brute(plain(docs.collect()))
    assert len(corpus_pipeline.STAGES) == 5
    for (_, stage), rows in zip(corpus_pipeline.STAGES, want, strict=False):
        docs = stage(spark, docs, SMALLEST)
        assert docs.columns == columns
        assert plain(docs.collect()) == plain(rows)
    tokenizer = Tokenizer.from_file(default_path())
    pieces = []
    for d in rows:
        ids = [*tokenizer.encode(d["text"], add_special_tokens=False).ids, 2]
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
        for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            pieces.append((d["doc_id"], n, a, b - a, zlib.crc32(packed_ids(ids[a:b]))))
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SMALLEST).collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(pieces)
    check_places(packed)
    run = corpus_pipeline.run(spark, SMALLEST).collect()
    assert sorted(tuple(r)[:5] for r in run) == sorted(pieces)
    check_places(run)


def test_odd_rows_pass_all_stages(spark, table, odd_rows):
    for rows in (odd_rows, [], [(None, None)]):
        docs = table(rows)
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == columns
        docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").columns[:2] == ["doc_id", "piece"]


def test_queries_equal_their_sql(spark, monkeypatch):
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    duck = compare.connect(SMALLEST)
    for name in ORACLES:
        assert compare.differences(duck, name, QUERIES[name](spark, SMALLEST)) is None
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
