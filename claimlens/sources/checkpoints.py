"""Numbered tables in a folder, of which only whole ones count.

A table is written to a folder of its own; a marker file is created in it when all its
files are there.  A writer that is lost half-way leaves a folder without a marker, which readers
pass over and the next writer replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_MARKER = "_WHOLE"


class Checkpoints:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Numbers of the whole tables, ascending."""
        files = self._files()
        if not files.exists(self._path()):
            return []
        found = []
        for status in files.listStatus(self._path()):
            name = status.getPath().getName()
            if name.startswith("at-") and files.exists(self._path(name, _MARKER)):
                found.append(int(name[3:]))
        return sorted(found)

    def last(self) -> int | None:
        whole = self.numbers()
        return whole[-1] if whole else None

    def write(self, number: int, df: DataFrame) -> DataFrame:
        """Write table ``number``, mark it as whole, and read it back."""
        name = f"at-{number:09d}"
        if number in self.numbers():
            raise ValueError(f"checkpoint {number} is there already")
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self._files().create(self._path(name, _MARKER), False).close()
        return self.read(number)

    def read(self, number: int) -> DataFrame:
        if number not in self.numbers():
            raise ValueError(f"no whole checkpoint {number}")
        return self.spark.read.parquet(f"{self.folder}/at-{number:09d}")

    def drop_before(self, number: int) -> None:
        """Delete older tables, whole or not."""
        files = self._files()
        if files.exists(self._path()):
            for status in files.listStatus(self._path()):
                name = status.getPath().getName()
                if name.startswith("at-") and int(name[3:]) < number:
                    files.delete(status.getPath(), True)
