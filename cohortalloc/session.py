"""SparkSession construction with settings that hold from a laptop to a cluster."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: What a task reads of a shuffle at most when Spark merges small partitions.  Sorted or hashed
#: rows take about twenty times their compressed size, so this is some 300 MB of memory.
TASK_BYTES = 16 << 20
#: Bytes of stored input for each partition of a shuffle: wide rows are some six times larger when shuffled.
INPUT_BYTES_PER_PARTITION = 4 << 20

# Settings every job of this package relies on.  Shuffle partition count and
# broadcast threshold are left to the cluster's own configuration unless the
# caller passes them: AQE coalesces small shuffles and splits skewed ones at
# run time, so the static numbers matter less than the adaptive switches.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition is "skewed" when it is 4x the median and above 128 MB
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "cohortalloc",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the package's adaptive settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, applied to the context."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current is None:
        try:
            current = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            current = None
    if current and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: they go as soon as the rows are stored.

    Otherwise they stay until the driver happens to collect its garbage.  A
    session without the setting keeps them that long.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def bounded_tasks(spark: SparkSession, *paths: str) -> None:
    """Let the tasks of a session grow in number, not in size, with the input at ``paths``.

    Raises the number of partitions adaptive execution starts with and lowers
    the size to which it merges them; settings that ask for more or smaller
    tasks already stay.  A session without adaptive merging keeps its own number.
    """
    conf, jvm = spark.conf, spark._jvm
    size = 0
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        size += at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(conf.get(start, conf.get("spark.sql.shuffle.partitions")))
    wanted = -(-size // INPUT_BYTES_PER_PARTITION)
    if wanted > now:
        conf.set(start, str(wanted))
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    to_bytes = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if to_bytes(conf.get(merged)) > TASK_BYTES:
        conf.set(merged, str(TASK_BYTES))
