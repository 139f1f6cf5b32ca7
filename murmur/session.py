"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: The most that one task reads of a table's files.
SPLIT_BYTES = 16 * 1024 * 1024

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # As everywhere in JSON, the last of several equal keys counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keyed streaming state lives on disk beside the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str = "murmur", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Casts between instants and zone-less timestamps follow the session zone."""
    for key in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys"):
        if spark.conf.get(key) != ENGINE_CONF[key]:
            spark.conf.set(key, ENGINE_CONF[key])


def small_splits(spark: SparkSession) -> None:
    """Compressed logs grow twentyfold in a sort: a task reads few of them at a time.

    A smaller setting of the session stays.
    """
    key = "spark.sql.files.maxPartitionBytes"
    held = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if held > SPLIT_BYTES:
        spark.conf.set(key, str(SPLIT_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a private temporary one in local mode only."""
    configured = spark.conf.get(_CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_SETTING
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="murmur-")
    spark.conf.set(_CHECKPOINT_SETTING, folder)
    return folder
