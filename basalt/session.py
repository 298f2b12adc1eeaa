"""Session set-up shared by library, tests and bench.

Settings applied by :func:`configure`:

* UTC session time zone, so date parts and windows do not depend on the host.
* AQE with partition coalescing and skew-join splitting: partition counts are
  chosen at run time from the real shuffle sizes, and a hot key (one user, one
  bucket, one source holding a third of all rows) is split across tasks.
* Partition column type inference off: ``month=01`` stays the string ``01``.
* RocksDB state store for streaming state (off-heap, incremental commits), so
  dedupe keys and open windows do not live on the executor heap.
* ``spark.sql.legacy.parquet.nanosAsLong``: pandas writes ``TIMESTAMP(NANOS)``,
  which Spark refuses otherwise; such columns arrive as epoch-ns longs and the
  readers convert them once.

Scratch output (written tables that cut lineage, ingest targets, SQL results)
goes under the cluster's shared ``spark.checkpoint.dir``.  A local folder is
only chosen when that setting is missing, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # stream state (watermark dedupe, open windows) off the JVM heap, committed incrementally
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings above to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "basalt",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster brings its own session)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; set one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="basalt-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/basalt/{name}-{uuid.uuid4().hex[:12]}"


def local_path(spark: SparkSession, path: str) -> str | None:
    """The plain path behind a path of the local file system (``file:``), which for shared folders is the same on
    the driver and all executors; None for other stores, which only Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back: its rows,
    also what depends on the partitioning, are then fixed data."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
