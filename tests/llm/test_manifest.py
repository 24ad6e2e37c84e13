import hashlib
import zlib

import pytest

from addrloom.llm.manifest import build_manifest, leaf_digest, numbered, proofs, read_manifest, tamper_report, verified

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, node string, grp string, place string, `odd name.x` string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, arity):
    """Brute force: the root, and for each node the siblings on its way with its places."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            first = at[i] - at[i] % arity
            path.append((nodes[first : at[i]], nodes[at[i] + 1 : first + arity]))
            at[i] //= arity
        nodes = [sha("".join(nodes[j : j + arity])) for j in range(0, len(nodes), arity)]
    return nodes[0], paths


def expected(rows, arity=3):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    done = []
    for name in names:
        own = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        done.append((own, *tree([leaf(r) for r in own], arity)))
    root, above = tree([subroot for _, subroot, _ in done], arity)
    out = []
    for (own, subroot, paths), way in zip(done, above, strict=True):
        for row, path in zip(own, paths, strict=True):
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                now = (*row[:4], row[4].replace("\n", ""))
            steps = path + way
            fold = leaf(now)
            for before, after in steps:
                fold = sha("".join([*before, fold, *after]))
            siblings = sha("".join("".join(b + a) for b, a in steps))
            out.append((row[0], leaf(row), subroot, root, siblings, fold, fold == root))
    return sorted(map(repr, out))


def odd_documents(n):
    rows = [(i, "hot", "en", i, f"text {i}\nline") for i in range(n)]
    rows += [(1000 + i, f"s{i % 7}", None, None, f"é\n{i}" if i % 3 else None) for i in range(40)]
    rows += [(2000 + i, None, "de", 5, "") for i in range(5)] + [(3000, "", "de", 5, "\n\n"), (3001, "é", "de", 5, "x" * 200_000 + "\n")]
    rows += [(7, "hot", "en", 7, "text 7\nline"), (7, "hot", "en", 7, "other of the id\n"), (None, "hot", None, None, None), (None, None, None, None, "\n")]
    return rows


def docs(spark, rows):
    return spark.createDataFrame([(*r, "n", "g", "p", None) for r in rows], SCHEMA)


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize(("n", "arity", "height"), [(0, 3, 3), (27, 3, 3), (28, 3, 3), (760, 3, 3), (100, 3, 1), (65, 2, 2)])
def test_against_brute_force(spark, n, arity, height):
    rows = odd_documents(n)
    assert got(tamper_report(docs(spark, rows), arity, height)) == expected(rows, arity)


def test_a_lone_leaf_is_the_root(spark):
    rows = [(1, "a", None, None, "x")]
    assert got(tamper_report(docs(spark, rows))) == expected(rows)
    one = tamper_report(docs(spark, rows)).first()
    assert one["leaf"] == one["root"] and one["proof_sha256"] == sha("")


def test_many_sources(spark):
    rows = [(i, f"site {i % 100}", "en", 1, "a\nb") for i in range(300)]
    assert got(tamper_report(docs(spark, rows))) == expected(rows)


def test_stored_levels_alone_give_all_proofs(spark, tmp_path):
    table = docs(spark, odd_documents(90))
    built = build_manifest(table, str(tmp_path / "m"))
    manifest = read_manifest(spark, str(tmp_path / "m"))
    assert manifest.root == built.root and len(manifest.sources.levels) == 2
    # 93 leaves of the hot source, and the 4 nodes three levels above; nothing between is stored.
    assert [level.where("grp = 'shot'").selectExpr("sum(size(members)) AS n").first()["n"] for level in manifest.sources.levels] == [93, 4]
    taken = verified(proofs(manifest))
    assert taken.count() == table.count() and taken.where("NOT verified").count() == 0
    wrong = verified(proofs(manifest).selectExpr("id", "leaf", "sha2(leaf, 256) AS claimed", "subroot", "proof", "root"))
    assert wrong.where("verified").count() == 0
    assert taken.where("aggregate(proof, 0, (n, s) -> greatest(n, length(s.before) + length(s.after))) > 128").count() == 0


def test_places_of_a_group_over_many_ranges(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' ELSE concat('b', id % 5) END AS grp", "pmod(hash(id), 700) AS k", "id")
    placed, sizes = numbered(rows, ["k", "id"])
    want = rows.selectExpr("grp", "id", "row_number() OVER (PARTITION BY grp ORDER BY k, id) - 1L AS place")
    assert sorted(map(tuple, placed.select("grp", "id", "place").collect())) == sorted(map(tuple, want.collect()))
    assert dict(map(tuple, sizes.collect())) == dict(map(tuple, rows.groupBy("grp").count().collect()))


def test_no_rows_and_other_columns(spark):
    assert tamper_report(docs(spark, [])).collect() == []
    manifest = build_manifest(docs(spark, [(1, "a", None, None, "x")]), id_col="n_chars", source_col="odd name.x", columns=("odd name.x", "text"))
    assert manifest.root == leaf((None, "x"))
    assert docs(spark, [(1, "a", None, None, "x")]).select(leaf_digest(["text"])).first()[0] == sha("1:x")
