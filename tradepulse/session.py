"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Settings every job wants, whatever the cluster. Partition counts and memory are
#: left to spark-submit; AQE coalesces small shuffle partitions and splits hot ones.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: How tables and topics of files are packed: texts and envelopes repeat themselves.
PACKED = "zstd"


def local_session(name: str = "tradepulse", cores: str | int = "*", **conf) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **JOB_CONF,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime part of JOB_CONF to a session somebody else created."""
    for key, value in JOB_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory for tables and checkpoints that cut a lineage.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Where that is unset, a local
    master (a laptop, the tests) gets a temporary folder, and any other an error: its executors
    would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tradepulse-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished work.

    Spark deletes them when the driver's garbage collector finds that nothing reads them any more, which may be hours after.
    """
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def landed(rows: DataFrame, label: str) -> DataFrame:
    """Rows written once and read back: steps that use them twice work them out once."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.option("compression", PACKED).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
