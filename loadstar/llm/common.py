"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session
from ..session import drop_path, scratch_path

# ASCII white space, the separator of words in several contracts.
SPACE = " \t\n\x0b\x0c\r"
# Bytes of an Arrow batch on its way to or from a Python worker.
BATCH_BYTES = 2 << 20
# Rows a lookup table may have before it is no longer broadcast on request.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the checkpoint folder and read again."""
    path = scratch_path(df.sparkSession, name)
    out = session.stage(df, name, path)
    out._staged_at = path
    return out


def drop_staged(*tables: DataFrame) -> None:
    """Delete the files of staged tables that no later job reads."""
    for t in tables:
        if getattr(t, "_staged_at", None):
            drop_path(t.sparkSession, t._staged_at)


class Scratch:
    """Tables staged on the way to a result, deleted together."""

    def __init__(self):
        self.tables: list[DataFrame] = []
        # the texts of the operator at work, and the name of their column
        self.source: tuple[DataFrame, str] | None = None

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(stage(df, name))
        return self.tables[-1]

    def drop(self, *kept: DataFrame) -> None:
        drop_staged(*[t for t in self.tables
                      if not any(t is k for k in kept)])


_CACHES: list[dict] = []


def worker_cache() -> dict:
    """What a Python worker keeps from task to task of one operator."""
    _CACHES.append({})
    return _CACHES[-1]


def only(cache: dict | None = None) -> None:
    """Called by a task before it starts: empties the other operators' caches
    in this worker (Spark uses workers again for later stages), and gives
    memory that earlier tasks have freed back to the system."""
    for c in _CACHES:
        if c is not cache:
            c.clear()
    give_back()


def give_back() -> None:
    """Give memory that this process has freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):          # another C library
        pass


def python_ready(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies beside the driver
    (on a cluster it is installed or sent with ``--py-files``), and let a
    batch for them hold ``BATCH_BYTES`` instead of Spark's default of 64 MB:
    JVM and worker each hold a few batches a task. A bound that the session
    sets itself stays."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, "67108864b") == "67108864b":
        spark.conf.set(bound, f"{BATCH_BYTES}b")
    root = os.path.dirname(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``bound`` rows (counted
    by the caller); beyond that Spark joins it by shuffle."""
    return F.broadcast(df) if rows <= bound else df


def letters_down(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: the value becomes a
    lambda variable, so inner lambdas read it instead of computing it for
    every element."""
    return F.transform(F.array(value), body)[0]


def running_offsets(parts: DataFrame, part: str, amount: str, out: str,
                    group: str | None = None) -> DataFrame:
    """``parts`` (one row per task) with ``out`` = the sum of ``amount`` in
    all tasks before it."""
    w = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy(part)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(
        out, F.coalesce(F.sum(amount).over(before), F.lit(0)).cast("long"))


def numbered(df: DataFrame, order: list[Column], out: str = "row_number",
             name: str = "numbered") -> tuple[DataFrame, int]:
    """``df`` with dense global row numbers from 0 in the given order, and
    the number of rows.

    Rows are range-partitioned and sorted on ``order``, written once with the
    (task, position) each got, and numbered by adding the rows of the tasks
    before. No task sees more than its range, and only one count per task is
    gathered. Rows equal in ``order`` are told apart by where they were read,
    so a value that holds a third of all rows is spread over many tasks."""
    spark = df.sparkSession
    read_at = F.monotonically_increasing_id()
    keyed = df.select("*", *[c.alias(f"__o{i}") for i, c in enumerate(order)],
                      read_at.alias("__at"))
    keys = [f"__o{i}" for i in range(len(order))] + ["__at"]
    sorted_ = (keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .drop(*keys).withColumn("__id", F.monotonically_increasing_id()))
    held = stage(sorted_, name).withColumns({
        "__part": F.shiftright("__id", 33),
        "__nth": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = running_offsets(held.groupBy("__part").agg(
        F.count(F.lit(1)).alias("__n")), "__part", "__n", "__before")
    tasks, rows = counts.agg(F.count(F.lit(1)),
                             F.coalesce(F.sum("__n"), F.lit(0))).first()
    out_df = held.join(small(counts.select("__part", "__before"), tasks),
                       "__part").withColumn(
        out, F.col("__before") + F.col("__nth"))
    return out_df.drop("__id", "__part", "__nth", "__before"), int(rows)


__all__ = ["SPACE", "BROADCAST_ROWS", "table", "python_ready", "small",
           "letters_down", "let", "running_offsets", "numbered",
           "scratch_path", "stage", "drop_staged",
           "Scratch", "worker_cache", "only"]
