"""Where intermediate tables go: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Bytes of a shuffle up to which partitions are merged, where their rows are then sorted for a join.
SORTED_BYTES = 8 << 20
_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    Taken from the session.  Only a local master without the setting gets a temporary
    folder; on a cluster a missing setting is an error, since a machine-local folder
    would be lost with its machine.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {_SETTING} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="claimlens-")
    return _local_folders[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """A path for one written table, never used before."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/claimlens/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the written table.

    This cuts the lineage: what is read back no longer depends on any executor, and
    values made by partition-dependent expressions are frozen in the files.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def sorted_in_memory(spark: SparkSession) -> Iterator[None]:
    """Partitions are merged up to fewer bytes than usual, so that a merge join sorts each without spilling.

    In memory rows are several times as large as in the shuffle.  Hot keys are still split, and what is too
    large all the same still spills.
    """
    before = spark.conf.get(_MERGED_BYTES)
    spark.conf.set(_MERGED_BYTES, str(SORTED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_MERGED_BYTES, before)


def unstage(df: DataFrame) -> None:
    """Delete the staged tables that ``df`` reads, once nothing needs them any more."""
    spark = df.sparkSession
    own = f"/claimlens/{spark.sparkContext.applicationId}/"
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        if own in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
