"""What the operators share: the two columns they read and Arrow batches of them."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under the names ``doc_id`` and ``text``."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def whole_row(docs: DataFrame) -> Column:
    """All columns, whatever their names, as the one column ``row``."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row")


def utf8(column: str = "text") -> Column:
    """The text's UTF-8 bytes; a null text is an empty one."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def mapped(df: DataFrame, columns: str, row: Callable[[bytes], tuple], keep: list[str], data: str = "data") -> DataFrame:
    """Add ``columns`` that ``row`` makes from the bytes in ``data``; ``keep`` stays, ``data`` goes.

    ``data`` may also name a field of a kept struct, as in ``row.text``, so that texts pass
    once; a null one is empty. Only the results are gathered per batch.
    """
    source, _, field = data.partition(".")
    new = StructType.fromDDL(columns)
    schema, added = StructType([*(df.schema[c] for c in keep), *new.fields]), to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(source)
            values = values.field(field) if field else values
            values = values.cast(pa.binary()) if pa.types.is_string(values.type) else values
            made = [row(value.as_py() or b"") for value in values]
            results = list(zip(*made, strict=True)) or [()] * len(added)
            arrays = [pa.array(list(r), f.type) for r, f in zip(results, added, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], [*keep, *added.names])

    return df.select(*dict.fromkeys([*keep, source])).mapInArrow(run, schema)


def find_library(spark: SparkSession) -> None:
    """Let Python workers of a local session import this library from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    there = spark.sparkContext.environment
    if root not in there.get("PYTHONPATH", "").split(os.pathsep):
        there["PYTHONPATH"] = os.pathsep.join(filter(None, [root, there.get("PYTHONPATH", "")]))
