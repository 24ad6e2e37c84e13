"""Tables stored by key: a folder for each chunk of keys, in buckets by key.

A plan over one chunk reads that chunk's folders and nothing else. Steps that group or join
by the key take the buckets as they are, without an exchange. Buckets are known to a
session's catalog only, so reading registers the folders there as external tables, which
own no data. A bucket with a crowded key has several files; where such a key matters, the
plans spread its rows over groups, and Spark then reads the files without regard to buckets.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from addrloom.functions.ranks import chunk_of
from addrloom.functions.text import literal
from addrloom.sinks.parquet import has_output, parquet_writer

KEY = "uprn"
_CHUNK = "key_chunk"
_LAYOUT = "layout"

# Rows of all tables together that a bucket of a chunk holds on average at most, as one task
# joins them. More buckets than asked for are made where there are more rows.
ROWS_PER_BUCKET = 250_000


@dataclass(frozen=True)
class KeyedTables:
    """Tables by name, all of them in as many chunks, and in as many buckets per chunk."""

    tables: dict[str, DataFrame]
    chunks: int
    buckets: int

    def chunk(self, *chunks: int) -> dict[str, DataFrame]:
        """The rows whose key is in one of the zero-based chunks; other folders are not read."""
        wrong = [chunk for chunk in chunks if not 0 <= chunk < self.chunks]
        if wrong or not chunks:
            raise ValueError(f"chunk must be in [0, {self.chunks}), got {wrong}")
        wanted = f"{_CHUNK} IN ({', '.join(map(str, chunks))})"
        return {name: df.where(wanted).drop(_CHUNK) for name, df in self.tables.items()}

    def whole(self) -> dict[str, DataFrame]:
        return {name: df.drop(_CHUNK) for name, df in self.tables.items()}


def _keyed(df: DataFrame, name: str) -> DataFrame:
    """The key as a number under its own name, whatever its spelling and type."""
    found = [column for column in df.columns if column.lower() == KEY]
    if len(found) != 1:
        raise ValueError(f"{name} needs one column {KEY}, has {', '.join(df.columns)}")
    others = [f"`{column}`" for column in df.columns if column != found[0]]
    return df.selectExpr(f"CAST(`{found[0]}` AS bigint) AS {KEY}", *others)


def _enough_buckets(tables: dict[str, DataFrame], chunks: int, buckets: int, rows_per_bucket: int) -> int:
    """The buckets asked for, or as many as the rows of the tables need. Runs one job now."""
    counted = [table.agg(F.count("*").alias("rows")) for table in tables.values()]
    rows = reduce(DataFrame.union, counted).agg(F.sum("rows")).first()[0]
    return max(buckets, -(-rows // (chunks * rows_per_bucket)))


def write_keyed(
    tables: dict[str, DataFrame],
    path: str,
    chunks: int = 10,
    buckets: int = 200,
    compression: str = "zstd",
    compression_level: int = 9,
    overwrite: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> bool:
    """Store tables by ``uprn`` below ``path``; False where that was done and ``overwrite`` is unset.

    One exchange per table brings the rows of a bucket together; small buckets share a task
    and a crowded one is split. A NULL key has a chunk and a bucket, too. There are at least
    ``buckets``, and more where a bucket of a chunk would hold more than ``rows_per_bucket``
    rows, so that a task's share does not grow with the tables. The layout is written last
    and marks the end.
    """
    if not tables:
        raise ValueError("no tables to store")
    spark = next(iter(tables.values())).sparkSession
    root = path.rstrip("/")
    if not overwrite and has_output(spark, f"{root}/{_LAYOUT}"):
        return False
    keyed = {name: _keyed(table, name) for name, table in tables.items()}
    buckets = _enough_buckets(keyed, chunks, buckets, rows_per_bucket)
    described = []
    for name, rows in keyed.items():
        dealt = rows.selectExpr("*", f"{chunk_of(KEY, chunks)} AS {_CHUNK}")
        # The writer's own rule for a row's bucket, so that a task has whole buckets.
        together = dealt.selectExpr("*", f"pmod(hash({KEY}), {buckets}) AS key_bucket").hint("rebalance", "key_bucket")
        writer = parquet_writer(together.drop("key_bucket"), compression, compression_level).mode("overwrite")
        held = f"keyed_{uuid4().hex}"
        writer.partitionBy(_CHUNK).bucketBy(buckets, KEY).option("path", f"{root}/{name}").saveAsTable(held)
        spark.sql(f"DROP TABLE {held}")  # external: the files stay
        described.append((name, json.dumps(rows.schema.jsonValue()), chunks, buckets))
    layout = spark.createDataFrame(described, "name string, table_schema string, chunks int, buckets int")
    layout.coalesce(1).write.mode("overwrite").json(f"{root}/{_LAYOUT}")
    return True


def read_keyed(spark: SparkSession, path: str) -> KeyedTables:
    """The tables that :func:`write_keyed` stored, with their chunks and buckets."""
    root = path.rstrip("/")
    layout = spark.read.schema("name string, table_schema string, chunks int, buckets int").json(f"{root}/{_LAYOUT}").collect()
    tables = {}
    for row in layout:
        schema = StructType.fromJson(json.loads(row["table_schema"]))
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
        held = f"keyed_{uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {held} ({columns}, {_CHUNK} int) USING parquet PARTITIONED BY ({_CHUNK}) "
            f"CLUSTERED BY ({KEY}) INTO {row['buckets']} BUCKETS LOCATION {literal(root + '/' + row['name'])}"
        )
        spark.catalog.recoverPartitions(held)
        tables[row["name"]] = spark.table(held)
    return KeyedTables(tables, layout[0]["chunks"], layout[0]["buckets"])
