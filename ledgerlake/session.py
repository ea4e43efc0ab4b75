"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter on a cluster.  AQE merges small shuffle partitions and splits skewed ones,
# so the initial partition number can be generous.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    # Streaming state on local disk and in the checkpoint, not in the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def shuffle_partitions(input_bytes: int) -> int:
    """Initial shuffle partitions for an input: one per 256 MB, from 200 to 50,000.

    AQE merges small ones.  More than 50,000 would make the map output tables on the driver the
    bottleneck, and shuffles carry pruned columns, not the whole input.
    """
    return min(max(200, -(-input_bytes // (256 << 20))), 50_000)


def scan_bytes(input_bytes: int) -> int:
    """Bytes per scan task: 128 MB, growing to 1 GB so that 100 TB take about 100,000 tasks."""
    return min(max(128 << 20, input_bytes // 100_000), 1 << 30)


def build_session(
    app_name: str = "ledgerlake",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the defaults above, sized for an input; ``conf`` names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if input_bytes is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            shuffle_partitions(input_bytes)
        )
        settings["spark.sql.files.maxPartitionBytes"] = str(scan_bytes(input_bytes))
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs in local mode does the session get a folder of its own
    (removed at exit); on a cluster an unset folder is an error, since executors share no local disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.conf.set("spark.checkpoint.dir", base)
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/ledgerlake/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there; lineage ends here."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
