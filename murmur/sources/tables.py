"""Versioned parquet tables on shared storage.

A version becomes visible when Spark's commit writes its success marker, so a
reader never sees half a table and a failed job leaves the old version in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from murmur.session import SPLIT_BYTES, shared_folder


_Result = TypeVar("_Result")

#: Rows carry digests as hexadecimal text, which only entropy coding makes smaller.
COMPRESSION = "zstd"
#: A row group is read by one task: not more of it than a split has.
SMALL_GROUPS = {"compression": COMPRESSION, "parquet.block.size": str(SPLIT_BYTES)}


def together(
    spark: SparkSession, work: Mapping[str, Callable[[], _Result]], at_once: int = 4
) -> dict[str, _Result]:
    """Run a few Spark jobs side by side; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(at_once) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in work.items()
        }
    return {name: job.result() for name, job in running.items()}


class CommitRefused(RuntimeError):
    """Another writer has taken the number first."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, location: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(location)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def location(self, name: str) -> str:
        return f"{self.root}/{name}"

    def path_exists(self, location: str) -> bool:
        path, fs = self._path(location)
        return fs.exists(path)

    # ------------------------------------------------------------ small files

    def read_text(self, location: str) -> str:
        path, fs = self._path(location)
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, location: str, text: str) -> bool:
        """Create a file with all its content in one step; False if it exists already.

        The text is written beside and renamed without overwriting, which stores with atomic
        renames (HDFS) decide for one of several writers.
        """
        jvm = self.spark._jvm
        path, fs = self._path(location)
        beside, _ = self._path(f"{location}.{uuid4().hex}")
        stream = fs.create(beside, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        no_options = self.spark._sc._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
        )
        try:
            files.rename(beside, path, no_options)
            return True
        except Py4JJavaError as failure:
            fs.delete(beside, False)
            if fs.exists(path):
                return False
            raise failure

    def delete(self, location: str) -> bool:
        path, fs = self._path(location)
        return fs.delete(path, True)

    def scratch(self, table: DataFrame, label: str) -> DataFrame:
        """The frame as a written table of its own: computed once, no lineage behind it."""
        folder = f"{shared_folder(self.spark)}/{label}-{uuid4().hex}"
        table.write.options(**SMALL_GROUPS).parquet(folder)
        return self.spark.read.schema(table.schema).parquet(folder)

    # --------------------------------------------------------------- versions

    def versions(self, name: str) -> list[int]:
        pattern, fs = self._path(f"{self.location(name)}/version=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def _version_path(self, name: str, version: int) -> str:
        return f"{self.location(name)}/version={version:06d}"

    def write(self, name: str, table: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Full rewrite as a new version. Older versions stay readable.

        A writer claims the number first, so two that overlap cannot write the same version;
        a claim whose writer broke off is skipped by the next one.
        """
        version = max([*self.versions(name), *self._claims(name)], default=-1) + 1
        self.claim(name, version)
        return self.write_version(name, table, version, partition_by)

    def _claims(self, name: str) -> list[int]:
        pattern, fs = self._path(f"{self.location(name)}/_claims/*.claim")
        found = fs.globStatus(pattern) or []
        return [int(s.getPath().getName().split(".")[0]) for s in found]

    def claim(self, name: str, version: int) -> None:
        if not self.create_text(f"{self.location(name)}/_claims/{version:06d}.claim", ""):
            raise CommitRefused(f"version {version} of {name} is being written by another run")

    def write_version(
        self, name: str, table: DataFrame, version: int, partition_by: tuple[str, ...] = ()
    ) -> int:
        """Full rewrite under a given number; a version that broke off is replaced."""
        writer = table.write.mode("overwrite").options(**SMALL_GROUPS)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._version_path(name, version))
        return version

    def read(
        self,
        name: str,
        schema: T.StructType | None = None,
        version: int | None = None,
        within: str = "",
    ) -> DataFrame:
        """A finished version, or what lies in one partition folder of it."""
        known = self.versions(name)
        if not known:
            raise FileNotFoundError(f"table {name} has no finished version under {self.root}")
        path = self._version_path(name, known[-1] if version is None else version)
        reader = self.spark.read.option("basePath", path)
        return (reader.schema(schema) if schema else reader).parquet(f"{path}/{within}")

    def holds(self, name: str, within: str) -> bool:
        """Whether the newest version has a partition folder."""
        return self.path_exists(f"{self._version_path(name, self.versions(name)[-1])}/{within}")

    def vacuum(self, name: str, keep: int = 2) -> None:
        """Drop all but the newest finished versions."""
        for version in self.versions(name)[:-keep]:
            path, fs = self._path(self._version_path(name, version))
            fs.delete(path, True)

    def overwrite_partitions(self, name: str, table: DataFrame, partition_by: str) -> None:
        """Replace only the partitions present in ``table``."""
        (
            table.write.mode("overwrite")
            .option("compression", COMPRESSION)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_by)
            .parquet(self.location(name))
        )

    def append_batch(self, name: str, table: DataFrame, batch_id: int, **options) -> None:
        """One directory per micro-batch: replaying a batch replaces its own rows."""
        writer = table.write.mode("overwrite").options(**SMALL_GROUPS)
        partition_by = options.get("partition_by", ())
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.location(name)}/batch_id={batch_id}")

    def read_batches(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema else reader).parquet(self.location(name))

    def batch_ids(self, name: str) -> list[int]:
        pattern, fs = self._path(f"{self.location(name)}/batch_id=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def drop_batches(self, name: str, through: int) -> None:
        """Remove the directories of all batches up to and with ``through``."""
        pattern, fs = self._path(f"{self.location(name)}/batch_id=*")
        for status in fs.globStatus(pattern) or []:
            if int(status.getPath().getName().split("=")[1]) <= through:
                fs.delete(status.getPath(), True)

    def reset(self, name: str) -> bool:
        """Empty a versioned table but keep its schema; missing tables are skipped."""
        if not self.exists(name):
            return False
        empty = self.read(name).limit(0)
        self.write(name, empty)
        return True
