"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library's semantics depend on. Everything else (memory,
# executors, shuffle partitions at scale) belongs to the cluster operator.
REQUIRED_CONF = {
    # Timestamps in the tables are wall-clock (timestamp_ntz); parse and
    # format them in UTC so no session zone shifts a date bucket.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, turns a join
    # into a broadcast only after measuring the smaller side, splits skewed
    # sort-merge join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Sessions inside shuffles_released: how often, and their setting before.
_lock, _released = threading.Lock(), {}


def get_spark(app: str = "loadstar", cores: int | str = "*",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, build the session
    with the cluster's own launcher and call :func:`configure` on it."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions",
                 str(shuffle_partitions or (8 if cores == "*" else cores))))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library needs to an existing
    session (leaves cluster-sized settings alone)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (tests, local runs) a fresh
    private folder is created and registered as the checkpoint dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that "
                               "driver and executors share")
        root = tempfile.mkdtemp(prefix="loadstar-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint root for tables a job writes
    to cut lineage or to stage data (never a machine-local folder)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def to_local(path: str) -> str:
    """Strip a ``file:`` scheme for the few helpers that talk to a local FS
    in tests."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["get_spark", "configure", "checkpoint_root", "scratch_path",
           "to_local", "REQUIRED_CONF"]


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library staged (through the cluster's FS)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


@contextmanager
def shuffles_released(spark: SparkSession):
    """Inside, the shuffle files of an action are deleted when it ends; else
    they stay until the driver's JVM happens to collect garbage, and a job of
    many steps holds those of all of them. For steps that write what they
    keep. The last of a session's threads puts its setting back."""
    key = spark._jvm.System.identityHashCode(spark._jsparkSession)
    with _lock:
        n, before = _released.get(key) or (
            0, spark.conf.get(SHUFFLE_CLEANUP, None))
        _released[key] = n + 1, before
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _released.pop(key)
            if n > 1:
                _released[key] = n - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def releases_shuffles(job):
    """``job(spark, ...)`` inside :func:`shuffles_released`."""
    @functools.wraps(job)
    def call(spark, *args, **kw):
        with shuffles_released(spark):
            return job(spark, *args, **kw)
    return call


def stage(df, name: str = "stage", path: str | None = None):
    """Cut lineage by writing ``df`` as a parquet table under the checkpoint
    root (or at ``path``) and reading it back. Unlike
    ``DataFrame.checkpoint`` (row-by-row RDD serialization) this is a
    columnar write, later passes read only the columns they need, and the
    staged table survives executor loss."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with shuffles_released(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(
            path)
    # with the known schema: an empty frame writes no data file to infer from
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (through the cluster's FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in ([paths] if isinstance(paths, str) else paths):
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return int(total)


def size_shuffle(spark: SparkSession, nbytes: int,
                 bytes_per_partition: int = 128 << 20,
                 most: int | None = None) -> int:
    """Size the first shuffle of a job to its input: about one partition per
    ``bytes_per_partition`` of input (at least the cluster's parallelism,
    never fewer than already configured). AQE then coalesces partitions that
    turn out small, so starting high keeps each reducer's share within
    executor memory at any scale. For a dedicated job session (the CLI);
    library functions never change session settings behind the caller."""
    want = -(-nbytes // bytes_per_partition)
    if most is not None:      # a cluster operator's own bound
        want = min(most, want)
    want = max(spark.sparkContext.defaultParallelism, want)
    have = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(want, have)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                   str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                   str(bytes_per_partition))
    return n
