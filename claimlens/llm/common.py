"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def type_of(df: DataFrame, column: str) -> str:
    """The column's type as DDL text."""
    return df.schema[column].dataType.simpleString()


def utf8(column: str):
    """The text's bytes; passing bytes to Python spares a decoding of the whole text."""
    return F.col(f"`{column}`").cast("string").cast("binary")


def kept_and(df: DataFrame, added: str = "") -> T.StructType:
    """The schema of ``df``'s column ``kept``, then the added columns, given as DDL text."""
    more = T.StructType.fromDDL(added).fields if added else []
    return T.StructType([df.schema["kept"], *more])


def few_rows(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that only few texts at a time are Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_in(kept: pa.StructArray, column: str) -> list[bytes | None]:
    """The bytes of a text column that travels inside the struct of a whole row."""
    return kept.field(column).cast(pa.string()).cast(pa.binary()).to_pylist()
