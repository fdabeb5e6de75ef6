"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan relies on; all of them can be changed on a live session.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the next step then needs a shuffle of its own, as an
    # aggregate on the join key does.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where each partition of one side of a join is found to be small, neither side is sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # Streaming dedup keeps its keys on disk instead of on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A count of the stored keys costs a lookup per row written, and nothing reads it.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

_local_root: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings. Shuffle width and file split size stay the cluster's own: a
    width that an earlier query's input called for is taken back."""
    spark.conf.set(_WIDTH, _own_width(spark))
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


# Input bytes per shuffle partition. Compressed Parquet grows when it is shuffled, so this keeps
# a partition at a few hundred megabytes.
BYTES_PER_PARTITION = 128 * 1024 * 1024
_WIDTH = "spark.sql.shuffle.partitions"
_OWN = "spark.assay.shuffle.own"    # the session's own width
_SET = "spark.assay.shuffle.set"    # what fit_shuffles made of it


def _own_width(spark: SparkSession) -> str:
    """The width that the session's user set last."""
    now = spark.conf.get(_WIDTH)
    if now != spark.conf.get(_SET, None):
        spark.conf.set(_OWN, now)
    return spark.conf.get(_OWN, now)


def fit_shuffles(df: DataFrame) -> DataFrame:
    """Raise the number of shuffle partitions if ``df``'s files call for more than are set.

    The size comes from the file listing, so no job runs. ``tune``, with which every query begins,
    goes back to the session's own width; adaptive execution joins partitions that turn out small.
    """
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = -(-size // BYTES_PER_PARTITION)
    if wanted > int(spark.conf.get(_WIDTH)):
        _own_width(spark)
        spark.conf.set(_WIDTH, str(wanted))
        spark.conf.set(_SET, str(wanted))
    return df


def work_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="assay-")
    return _local_root


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet below the shared work folder."""
    return f"{work_root(spark)}/assay/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use it where several consumers would otherwise repeat an expensive plan. A written table
    survives the loss of executors, which a persisted frame does not.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
