"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # long texts: bound the bytes of one Arrow batch by its rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Bytes of an Arrow batch that a Python worker holds at a time.
BATCH_BYTES = 16 << 20


def build_session(app: str = "newsflow", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `settings` override."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, in any session: rows may hold long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, named by `spark.checkpoint.dir`.

    Only a master that runs all tasks in the driver's process (`local`, `local[n]`) may leave it unset,
    as in tests; the session then gets a fresh folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = spark.conf.get("spark.newsflow.localDir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="newsflow-")
        spark.conf.set("spark.newsflow.localDir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/newsflow/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: fixes the rows and cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
