"""A Merkle manifest of a dataset, with proofs from a few stored levels.

The rows of a source are the leaves of a tree; the sources' roots are the leaves of another
one above. Of each tree only every few levels are stored: a stored node covers an aligned
subtree, a block, of the level stored below it. A proof needs the levels between too. They
are computed again from the block's stored nodes when its proofs are taken: the block's
tree is built in memory, the siblings on each way up are given out, and the tree is dropped.

Blocks hold at most ``ARITY ** LEVELS`` nodes, so a source may have any share of the rows. Going
down, a block meets the proof of its top once and not once per node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from addrloom.operators.staging import staged

ARITY = 3
# Every so many levels one is stored.
LEVELS = 3

STEP = "struct<before:string,after:string>"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(columns: list[str], replaced: dict[str, str] | None = None) -> Column:
    """SHA-256 of the columns' values: ``-`` for a null, else the UTF-8 length, ``:`` and the value."""
    parts = []
    for name in columns:
        value = f"CAST({(replaced or {}).get(name, _quoted(name))} AS STRING)"
        parts.append(f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(CAST(octet_length({value}) AS STRING), ':', {value}) END")
    return F.expr(f"sha2(concat({', '.join(parts)}), 256)")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each group within a partition that is sorted by group."""
    current, number = None, 0
    for batch in batches:
        numbers = []
        for group in batch.column("grp").to_pylist():
            if group != current:
                current, number = group, 0
            numbers.append(number)
            number += 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "place"])


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``place``, their number in their group ``grp`` by ``order``; and each group's size ``n``.

    ``grp`` is not null. Ranges are of group and order, so a crowded group is many tasks. A
    range can begin with the rest of one group only, so the table of numbers to add is no
    longer than there are ranges.
    """
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("part int, place bigint").fields])
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    # Written, as the ranges are drawn from a sample.
    local = staged(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(_places, schema))
    sizes = staged(local.groupBy("part", "grp").agg((F.max("place") + 1).alias("rows")))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    added = sizes.withColumn("added", F.sum("rows").over(before)).where("added IS NOT NULL").drop("rows")
    placed = local.join(F.broadcast(added), ["part", "grp"], "left").withColumn("place", F.expr("place + coalesce(added, 0L)"))
    return placed.drop("part", "added"), sizes.groupBy("grp").agg(F.sum("rows").alias("n"))


@dataclass(frozen=True)
class Forest:
    """Trees over the rows of each group.

    ``levels`` are the stored ones from the leaves up, each as blocks: grp, block, whole
    (whether it is the group's only one on this level) and members in order. ``roots`` has
    grp and root. A level between two stored ones is ``arity`` times as long as the next.
    """

    levels: list[DataFrame]
    roots: DataFrame
    arity: int
    height: int


def subtree(nodes: list[str], arity: int, height: int, whole: bool) -> list[list[str]]:
    """The levels over a block's nodes: ``height`` more, but up to the root where it is whole."""
    levels = [nodes]
    while len(levels) <= height and not (whole and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([digest(below[i : i + arity]) for i in range(0, len(below), arity)])
    return levels


def _tops(arity: int, height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("members").to_pylist(), batch.column("whole").to_pylist(), strict=True)
            tops = [subtree([m["node"] for m in members], arity, height, whole)[-1][0] for members, whole in pairs]
            kept = [batch.column(c) for c in ("grp", "block", "whole")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(tops, pa.string())], ["grp", "block", "whole", "node"])

    return run


def _blocks(rows: DataFrame, sizes: DataFrame, size: int) -> DataFrame:
    """Rows (grp, place, id, node, claimed) as aligned blocks of at most ``size``.

    Sizes meet the first block of their group, by a key that has the block in it.
    """
    members = F.sort_array(F.collect_list(F.struct("place", "id", "node", "claimed")))
    blocks = rows.groupBy("grp", F.expr(f"place div {size}").alias("block")).agg(members.alias("members"))
    alone = sizes.where(f"n <= {size}").select("grp", F.lit(0).cast("bigint").alias("block"), F.lit(True).alias("whole"))
    return blocks.join(alone, ["grp", "block"], "left").select("grp", "block", F.expr("coalesce(whole, false)").alias("whole"), "members")


def forest(leaves: DataFrame, order: list[str], arity: int = ARITY, height: int = LEVELS, folder: str | None = None) -> Forest:
    """Trees over ``leaves`` (grp, id, node, claimed and what they are ordered by in a group).

    Each stored level is written to ``folder`` or else the shared one; each is smaller by
    ``arity ** height`` than the one below. ``id`` and ``claimed`` go with a leaf unchanged.
    """
    if arity < 2 or height < 1:
        raise ValueError("a node has at least two below it, and a block at least one level")
    size = arity**height

    def stored(df: DataFrame, name: str) -> DataFrame:
        if folder is None:
            return staged(df)
        path = f"{folder.rstrip('/')}/{name}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    placed, sizes = numbered(leaves, order)
    sizes = staged(sizes)
    rows = placed.select("grp", "place", "id", "node", "claimed")
    levels, roots = [], []
    while True:
        levels.append(stored(_blocks(rows, sizes, size), f"level-{len(levels)}"))
        tops = staged(levels[-1].select("grp", "block", "whole", "members").mapInArrow(_tops(arity, height), "grp string, block bigint, whole boolean, node string"))
        roots.append(tops.where("whole").select("grp", F.col("node").alias("root")))
        sizes = sizes.where(f"n > {size}").selectExpr("grp", f"(n + {size - 1}L) div {size} AS n")
        if sizes.isEmpty():
            break
        nothing = F.lit(None).cast("string")
        rows = tops.where("NOT whole").select("grp", F.col("block").alias("place"), nothing.alias("id"), "node", nothing.alias("claimed"))
    return Forest(levels, stored(reduce(DataFrame.union, roots), "roots"), arity, height)


def _ways(arity: int, height: int, schema: pa.Schema):
    """Each node of a block with the siblings on its way to the block's top, then those above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("grp", "block", "whole", "members", "root", "above")
        for batch in batches:
            out = []
            for grp, block, whole, members, root, above in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                levels = subtree([m["node"] for m in members], arity, height, whole)
                for i, m in enumerate(members):
                    steps, at = [], i
                    for level in levels[:-1]:
                        first = at - at % arity
                        steps.append({"before": "".join(level[first:at]), "after": "".join(level[at + 1 : first + arity])})
                        at //= arity
                    out.append((grp, block * arity**height + i, m["id"], m["node"], m["claimed"], root, steps + above))
                if len(out) >= 1000:
                    yield _batch(out, schema)
                    out = []
            if out:
                yield _batch(out, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_WAY = f"grp string, place bigint, id string, node string, claimed string, root string, proof array<{STEP}>"


def ways(trees: Forest, beyond: DataFrame | None = None) -> DataFrame:
    """The leaves with ``root`` and ``proof``: a step per level with what stands before and after.

    From the highest stored level down: a block takes the proof of its top, one row for the
    block, and adds the steps below it from the subtree that it builds and drops. ``beyond``
    (grp, root, proof) leads on from the groups' roots.
    """
    schema = StructType.fromDDL(_WAY)
    run = _ways(trees.arity, trees.height, to_arrow_schema(schema))
    if beyond is None:
        beyond = trees.roots.withColumn("proof", F.expr(f"CAST(array() AS array<{STEP}>)"))
    ends = beyond.select("grp", F.lit(0).cast("bigint").alias("block"), F.lit(True).alias("whole"), "root", F.col("proof").alias("above"))
    found = None
    for blocks in reversed(trees.levels):
        tops = ends
        if found is not None:
            tops = ends.union(found.select("grp", F.col("place").alias("block"), F.lit(False).alias("whole"), "root", F.col("proof").alias("above")))
        found = blocks.join(tops, ["grp", "block", "whole"]).mapInArrow(run, schema)
    return found


def folded(start: str, proof: str = "proof") -> str:
    """SQL for the root that a digest and the siblings on its way give."""
    return f"aggregate({proof}, {start}, (h, s) -> sha2(concat(s.before, h, s.after), 256))"


@dataclass(frozen=True)
class Manifest:
    """The trees of the sources, the tree above them and its root, null for no rows."""

    sources: Forest
    top: Forest
    root: str | None


def _opened(folder: str | None, name: str) -> str | None:
    return None if folder is None else f"{folder.rstrip('/')}/{name}"


def build_manifest(
    docs: DataFrame,
    folder: str | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: Column | None = None,
    arity: int = ARITY,
    height: int = LEVELS,
) -> Manifest:
    """Store the levels of a dataset's trees in ``folder``, or the shared folder.

    A leaf is the digest of the ``columns``' values, see ``leaf_digest``. Per source leaves
    ascend by id, nulls first, and by digest where ids repeat, so repeated rows are leaves
    each; sources ascend by their UTF-8 bytes, null first. ``claimed``, another digest for a
    row, goes with its leaf to be checked by the leaf's proof. Only the root comes to the driver.
    """
    own = F.col(_quoted(source_col)).cast("string")
    # Not null, and ordered alike: a source's name has a letter before it.
    group = F.when(own.isNull(), "").otherwise(F.concat(F.lit("s"), own))
    claim = F.lit(None).cast("string") if claimed is None else claimed
    leaves = staged(
        docs.select(group.alias("grp"), F.col(_quoted(id_col)).alias("own_id"), leaf_digest(list(columns)).alias("node"), claim.alias("claimed"))
        .selectExpr("grp", "own_id", "CAST(own_id AS STRING) AS id", "node", "nullif(claimed, node) AS claimed")
    )
    below = forest(leaves, ["own_id", "node"], arity, height, _opened(folder, "sources"))
    roots = below.roots.selectExpr("'' AS grp", "grp AS id", "root AS node", "CAST(NULL AS STRING) AS claimed")
    top = forest(roots, ["id"], arity, height, _opened(folder, "top"))
    root = top.roots.first()
    if folder is not None:
        about = [(arity, height, len(below.levels), len(top.levels))]
        docs.sparkSession.createDataFrame(about, "arity int, height int, levels int, top_levels int").coalesce(1).write.parquet(_opened(folder, "about"))
    return Manifest(below, top, root and root["root"])


def read_manifest(spark: SparkSession, folder: str) -> Manifest:
    """A manifest that ``build_manifest`` has written to a folder; its last file is ``about``."""
    about = spark.read.parquet(_opened(folder, "about")).first()

    def trees(name: str, levels: int) -> Forest:
        stored = [spark.read.parquet(f"{_opened(folder, name)}/level-{i}") for i in range(levels)]
        return Forest(stored, spark.read.parquet(f"{_opened(folder, name)}/roots"), about["arity"], about["height"])

    top = trees("top", about["top_levels"])
    root = top.roots.first()
    return Manifest(trees("sources", about["levels"]), top, root and root["root"])


def proofs(manifest: Manifest) -> DataFrame:
    """Per leaf: id (as text), leaf, claimed (null if it is the leaf), subroot, proof and root.

    ``proof`` leads from the leaf over its subroot to the root, a step per level with the
    digests before and after, joined. No leaf, no row.
    """
    above = staged(ways(manifest.top).select(F.col("id").alias("grp"), F.col("node").alias("root"), "proof"))
    own = ways(manifest.sources, above)
    return own.select("id", F.col("node").alias("leaf"), "claimed", F.col("root").alias("subroot"), "proof", F.lit(manifest.root).cast("string").alias("root"))


def verified(taken: DataFrame) -> DataFrame:
    """``taken``, with the root that the claimed digest, else the leaf, folds to, and whether it is the root."""
    return taken.withColumn("folded_root", F.expr(folded("coalesce(claimed, leaf)"))).withColumn("verified", F.expr("folded_root <=> root"))


def tamper_report(docs: DataFrame, arity: int = ARITY, height: int = LEVELS) -> DataFrame:
    """What the manifest's proofs say of rows of which half have lost their line breaks.

    ``docs`` has doc_id, source, lang, n_chars and text. Rows whose id has an even CRC-32 claim
    the digest they have without the line breaks in their text. Per row: doc_id, leaf, subroot,
    root, proof_sha256 (of all siblings), folded_root and verified. Null values, of an id too,
    are values like others; repeated rows are leaves each; an empty table gives an empty result.
    """
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    changed = leaf_digest(list(columns), {"text": "replace(text, '\n', '')"})
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, changed)
    manifest = build_manifest(docs, claimed=claimed, arity=arity, height=height)
    siblings = "array_join(transform(proof, s -> concat(s.before, s.after)), '')"
    kind = docs.schema["doc_id"].dataType.simpleString()
    return verified(proofs(manifest)).selectExpr(
        f"CAST(id AS {kind}) AS doc_id", "leaf", "subroot", "root", f"sha2({siblings}, 256) AS proof_sha256", "folded_root", "verified"
    )
