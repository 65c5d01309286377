"""Catalog operations: databases, external tables, scans, schema report, preview."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{_text(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")


def drop_database(spark: SparkSession, name: str, confirm: bool = False) -> None:
    """Drop a database with everything in it; refuses unless ``confirm`` is set."""
    if not confirm:
        raise ValueError("dropping a database is destructive: pass confirm=True")
    spark.sql(f"DROP DATABASE IF EXISTS {_quoted(name)} CASCADE")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> str:
    """Write ``df`` to ``path``.  Never overwrite a path ``df`` itself reads from."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    comment: str = "",
    fmt: str = "parquet",
    replace: bool = True,
) -> None:
    """Register the files under ``path`` as an external table."""
    if replace:
        drop_table(spark, name)
    note = f" COMMENT '{_text(comment)}'" if comment else ""
    spark.sql(f"CREATE TABLE {_quoted(name)} USING {fmt} LOCATION '{_text(path)}'{note}")


def publish(
    df: DataFrame,
    name: str,
    path: str,
    comment: str = "",
    fmt: str = "parquet",
    mode: str = "overwrite",
) -> DataFrame:
    """Write, register and scan back by name."""
    spark = df.sparkSession
    write_table(df, path, mode=mode, fmt=fmt)
    register_table(spark, name, path, comment=comment, fmt=fmt)
    return scan_table(spark, name)


def publish_version(
    df: DataFrame,
    name: str,
    folder: str,
    comment: str = "",
    fmt: str = "parquet",
    new_schema: bool = False,
) -> DataFrame:
    """Replace what table ``name`` holds in one step, and scan it.

    The rows go to a folder of their own below ``folder``; when all are there, the table's location is
    switched to it.  A reader sees the rows before or after, never some of both, and one that started
    before goes on with the old files.  A publish that fails leaves the table as it was.  Old versions stay
    until ``remove_old_versions``.  ``df`` may read the table itself.

    Other columns or types than the table has are refused; with ``new_schema`` the table is made
    anew, which readers can notice for a moment.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    there = spark.catalog.tableExists(name)
    same = there and [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]
    if there and not same and not new_schema:
        raise ValueError(f"{name} has other columns: pass new_schema=True to replace them")
    write_table(df, path, mode="errorifexists", fmt=fmt)
    if same:
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{_text(path)}'")
        if comment:
            spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS '{_text(comment)}'")
        spark.catalog.refreshTable(name)
    else:
        register_table(spark, name, path, comment=comment, fmt=fmt)
    return scan_table(spark, name)


def location(spark: SparkSession, name: str) -> str:
    """Folder that table ``name`` reads from."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").filter("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{name} has no location")
    return rows[0]["data_type"]


def remove_old_versions(spark: SparkSession, name: str, folder: str, older_than: float = 86_400.0) -> list[str]:
    """Delete versions in ``folder`` that the table no longer reads and that are older than so many seconds.

    What is left of failed publishes goes as well.  The age gives running readers time to end.
    Returns the names of the deleted versions.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    current = hadoop.Path(location(spark, name)).getName()
    gone = []
    for status in files.listStatus(root):
        version = status.getPath().getName()
        if version.startswith("version-") and version != current:
            if time.time_ns() - int(version.split("-")[1]) >= older_than * 1e9:
                files.delete(status.getPath(), True)
                gone.append(version)
    return sorted(gone)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def schema_report(df: DataFrame, first: Column) -> DataFrame:
    """One row per column: position, name, type, non-null count and the value in the
    row ``first`` selects.  A single aggregation over the table."""
    fields = df.schema.fields
    one_row = df.agg(
        *[F.count(F.col(f.name)).alias(f"n{i}") for i, f in enumerate(fields)],
        *[
            F.max(F.when(first, F.col(f.name))).cast("string").alias(f"v{i}")
            for i, f in enumerate(fields)
        ],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("non_null"),
            F.col(f"v{i}").alias("first_value"),
        )
        for i, f in enumerate(fields)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, keys: Sequence[str], n: int = 6) -> DataFrame:
    """First ``n`` rows in key order (a top-n, not a full sort)."""
    return df.orderBy(*keys).limit(n)
