"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on: AQE turns shuffle joins into broadcasts
# only after it has seen the real size of a side, splits skewed join partitions
# (also where that costs one more exchange) and merges small ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A JSON object may repeat a name, as the JSON check accepts it.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Streaming state on local disk with change logs, not wholly in executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int = 1) -> int:
    """Starting number of shuffle partitions: about 128 MB each, at least one per core.

    AQE merges what turns out small, so this only has to be high enough.
    """
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def session(app: str = "lectern", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only for local masters."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="lectern-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under one folder per application so it can be removed afterwards."""
    return f"{shared_dir(spark)}/lectern/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete what this application has staged; call it when none of the results is read any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lectern/{spark.sparkContext.applicationId}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor re-reads files instead of replaying the
    job, and gives every later use the same rows and real size statistics.  Packed by zstd: it is read a few times at most.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
