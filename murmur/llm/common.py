"""Tables, shared scratch space and Arrow helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from murmur.session import shared_folder

#: Bytes of the ASCII white space that separates words: blank and tab to carriage return.
SPACES = b" \t\n\x0b\x0c\r"
#: The same as a class of Java's and Python's regular expressions.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: A run of anything but that white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the one that driver and executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a written table: it is computed once, and lost executors cost no rerun."""
    spark = frame.sparkSession
    folder = scratch(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def byte_values(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text; null counts as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""
