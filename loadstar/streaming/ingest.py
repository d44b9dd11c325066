"""Incremental ingestion with Structured Streaming.

A scheduled "load the new files" job is a file-source stream run with
``trigger(availableNow=True)``: every run processes exactly the files that
arrived since the last run (the checkpoint remembers which files were
seen), in micro-batches, then stops. Each micro-batch is handed to the
batch pipeline through ``foreachBatch`` and written to its own
``run_id=batch-<epoch>`` partition, so a batch replayed after a failure
overwrites its own partition instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, input_bytes, scratch_path, stage
from ..sinks.lake import load_run, path_exists
from ..sources.csv import (CORRUPT, DirectoryRead, EmptyCsvError, read_files,
                           text_schema)

# Bytes of a file below which it is not split further.
LEAST_SPLIT = 4 << 20


def csv_stream(spark: SparkSession, input_dir: str, columns: Sequence[str],
               archive_dir: str | None = None,
               max_files_per_trigger: int | None = None,
               multi_line: bool = False, pattern: str = "*.csv") -> DataFrame:
    """T1 source: a streaming read of the CSV files landing in
    ``input_dir`` with a known header. ``archive_dir`` moves processed files
    there (``cleanSource=archive``; Spark moves a batch's files when a later
    batch commits)."""
    r = (spark.readStream.schema(text_schema(columns))
         .option("header", True).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT)
         .option("escape", '"').option("multiLine", multi_line)
         .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir",
                                                      archive_dir)
    return r.csv(input_dir)


def file_stream(spark: SparkSession, input_dir: str,
                archive_dir: str | None = None,
                max_files_per_trigger: int | None = None,
                pattern: str = "*.csv") -> DataFrame:
    """The paths of the files landing in ``input_dir``, as a stream. Only
    names are read here; each micro-batch then reads its files the way a
    batch load does, every file by its own header."""
    r = (spark.readStream.format("binaryFile")
         .schema("path string, modificationTime timestamp, length bigint, "
                 "content binary").option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir",
                                                      archive_dir)
    return r.load(input_dir).select("path")


def batch_files(df: DataFrame, columns: Sequence[str] = (),
                spread: bool = False, **kw) -> DirectoryRead | None:
    """The files of a micro-batch of :func:`file_stream` as one frame; None
    if none has a header. ``columns`` that no file has are null. ``spread``:
    a file of more than a core's share of the batch is read in splits, if
    that gives the same rows, so that few files keep all cores busy."""
    files = sorted(r["path"] for r in df.collect())
    if not files:
        return None
    if spread:
        spark = df.sparkSession
        kw["split_bytes"] = max(LEAST_SPLIT, input_bytes(spark, files)
                                // spark.sparkContext.defaultParallelism)
    try:
        read = read_files(df.sparkSession, files, **kw)
    except EmptyCsvError:
        return None
    for c in columns:
        if c not in read.data.columns:
            read.data = read.data.withColumn(c, F.lit(None).cast("string"))
    return read


def ingest_available_now(spark: SparkSession, input_dir: str,
                         columns: Sequence[str], target: str,
                         checkpoint: str,
                         process: Callable[[DataFrame], DataFrame],
                         reject_target: str | None = None,
                         archive_dir: str | None = None,
                         max_files_per_trigger: int | None = None,
                         multi_line: bool | str = "auto") -> dict:
    """Process every new file once and stop.

    Files are read by their own headers; ``columns`` is what ``process`` gets
    at least (a column that no file of a batch has is null).
    ``process``: the per-batch pipeline (all-text rows in → rows to load),
    e.g. coercion + rules. Malformed rows of each batch go to
    ``reject_target``. Returns the query's last progress summary."""
    stream = file_stream(spark, input_dir, archive_dir, max_files_per_trigger)

    def batch(df: DataFrame, epoch_id: int) -> None:
        read = batch_files(df, columns, spread=True, multi_line=multi_line)
        if read is None:
            return
        loads = [(process(read.data), target)]
        if reject_target:
            loads.append((read.malformed, reject_target))
        # a batch has few files: while one load reads them, cores are free
        # for the other
        with ThreadPoolExecutor(max_workers=len(loads)) as ex:
            list(ex.map(lambda x: load_run(*x, f"batch-{epoch_id}"), loads))

    q = (stream.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return {"batches": q.lastProgress["batchId"] + 1 if q.lastProgress
            else 0}


def ingest_runs(spark: SparkSession, input_dir: str, columns: Sequence[str],
                spec, target: str, checkpoint: str,
                reject_target: str | None = None,
                run_log_target: str | None = None,
                archive_dir: str | None = None,
                max_files_per_trigger: int | None = None) -> dict:
    """T1 with the whole load job per micro-batch: every batch of new files
    is one load run (schema gate, dedupe, fill, coercion, rules, run log)
    with ``run_id=batch-<epoch>``, exactly as a scheduled run over those
    files would be; a replayed batch overwrites its own partitions."""
    from ..plans.loadjob import run
    stream = file_stream(spark, input_dir, archive_dir, max_files_per_trigger)
    results = []

    def batch(df: DataFrame, epoch_id: int) -> None:
        read = batch_files(df, columns, multi_line=spec.csv_multi_line)
        if read is None:
            return
        res = run(spark, read.data, spec, target, run_id=f"batch-{epoch_id}",
                  reject_target=reject_target, run_log_target=run_log_target)
        if reject_target:
            load_run(read.malformed, reject_target + "_malformed",
                     f"batch-{epoch_id}")
        results.append((epoch_id, res.status, res.rows_loaded,
                        res.rows_rejected))

    q = (stream.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return {"batches": [{"epoch": e, "status": st, "loaded": lo,
                         "rejected": rj} for e, st, lo, rj in results]}


def _version_path(base: str, v: int) -> str:
    return f"{base.rstrip('/')}/v={v}"


def latest_version(spark: SparkSession, base: str, upto: int | None = None
                   ) -> int | None:
    """Newest committed version of a versioned table (≤ ``upto``)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    vs = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(
                jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            v = int(name[2:])
            if upto is None or v <= upto:
                vs.append(v)
    return max(vs) if vs else None


def read_version(spark: SparkSession, base: str, v: int | None = None
                 ) -> DataFrame:
    v = latest_version(spark, base) if v is None else v
    return spark.read.parquet(_version_path(base, v))


def apply_change_stream(spark: SparkSession, changes: DataFrame,
                        target_base: str, checkpoint: str,
                        apply: Callable[[DataFrame, DataFrame], DataFrame]
                        ) -> int:
    """Keep a table up to date from a stream of change-log rows.

    The table is stored as versions ``v=0, v=1, …``; micro-batch ``e``
    applies its changes to version ``e`` (or the newest before it) and
    writes version ``e+1`` in one write, so readers always see a complete
    version and a replayed batch rewrites the same version. ``apply`` is
    e.g. ``lambda cur, chg: cdc.apply_changes(cur, chg, key)``. Start from
    ``cdc.with_state(df)`` (and read through ``cdc.visible``) where changes
    of one key can arrive in different batches: late ones then lose."""
    if latest_version(spark, target_base) is None:
        raise ValueError(f"{target_base} has no initial version v=0")

    def batch(df: DataFrame, epoch_id: int) -> None:
        cur_v = latest_version(spark, target_base, upto=epoch_id)
        cur = read_version(spark, target_base, cur_v)
        apply(cur, df).write.mode("overwrite").parquet(
            _version_path(target_base, epoch_id + 1))

    q = (changes.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return latest_version(spark, target_base)


BUCKET_COL = "_bucket"


def key_bucket(key: str, buckets: int):
    """Stable bucket of a key: ``pmod(xxhash64(key), buckets)``."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))


def _layout(spark: SparkSession, target: str, key: str, buckets: int) -> str:
    """Marker of the layout a bucketed table was written with."""
    return f"{target.rstrip('/')}/_layout/{key}-{buckets}"


def write_buckets(df: DataFrame, target: str, key: str, buckets: int) -> None:
    """Initial layout for :func:`apply_change_stream_buckets`: the table
    partitioned by key bucket (each bucket written by one task), with key and
    bucket count recorded beside it."""
    spark = df.sparkSession
    (df.withColumn(BUCKET_COL, key_bucket(key, buckets))
       .repartition(BUCKET_COL).write
       .mode("overwrite").partitionBy(BUCKET_COL).parquet(target))
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_layout(spark, target, key, buckets))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def read_buckets(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop(BUCKET_COL)


def apply_to_buckets(spark: SparkSession, target: str, changes: DataFrame,
                     key: str, buckets: int,
                     apply: Callable[[DataFrame, DataFrame], DataFrame],
                     tag: str = "batch") -> list[int]:
    """C3 on a bucketed table (see :func:`write_buckets`), batch or
    streaming: merge ``changes`` into only the key buckets they touch.

    The changes are staged once. The touched bucket ids (at most ``buckets``
    small values) select the current rows by partition pruning; ``apply``
    merges the changes; the result is staged under the checkpoint root (the
    job reads and replaces the same folders); touched buckets that ended up
    empty are removed and the others are replaced by dynamic partition
    overwrite. Re-applying the same changes gives the same table. A key or
    bucket count other than the table's is refused. Returns the touched
    bucket ids."""
    if not path_exists(spark, _layout(spark, target, key, buckets)):
        raise ValueError(f"{target} was not written with key {key!r} in "
                         f"{buckets} buckets")
    chg_path = scratch_path(spark, f"bucket-changes-{tag}")
    staged_path = scratch_path(spark, f"bucket-apply-{tag}")
    try:
        chg = stage(changes.withColumn(BUCKET_COL, key_bucket(key, buckets)),
                    path=chg_path)
        touched = sorted(r[0] for r in chg.select(BUCKET_COL).distinct()
                         .collect())
        if not touched:
            return []
        cur = spark.read.parquet(target).filter(
            F.col(BUCKET_COL).isin(touched)).drop(BUCKET_COL)
        merged = apply(cur, chg.drop(BUCKET_COL)).withColumn(
            BUCKET_COL, key_bucket(key, buckets)).repartition(BUCKET_COL)
        merged.write.partitionBy(BUCKET_COL).parquet(staged_path)
        staged = spark.read.schema(merged.schema).parquet(staged_path)
        kept = {r[0] for r in staged.select(BUCKET_COL).distinct().collect()}
        for b in touched:
            part = f"{target.rstrip('/')}/{BUCKET_COL}={b}"
            if b not in kept and path_exists(spark, part):
                drop_path(spark, part)
        if kept:
            # staged files lie by bucket already: no shuffle to write them
            (staged.write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy(BUCKET_COL).parquet(target))
        return touched
    finally:
        for path in (chg_path, staged_path):
            if path_exists(spark, path):
                drop_path(spark, path)


def apply_change_stream_buckets(
        spark: SparkSession, changes: DataFrame, target: str, key: str,
        buckets: int, checkpoint: str,
        apply: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """T2 at warehouse scale: each micro-batch rewrites only the key buckets
    its changes touch (:func:`apply_to_buckets`), not the whole table.
    Replaying a batch gives the same table (the newest change per key wins
    over the stored row either way). Readers can see a batch half-applied
    across buckets; use the versioned :func:`apply_change_stream` when they
    must not."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        apply_to_buckets(spark, target, df, key, buckets, apply,
                         tag=f"epoch-{epoch_id}")

    q = (changes.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def write_version(df: DataFrame, target_base: str, v: int = 0) -> None:
    df.write.mode("overwrite").parquet(_version_path(target_base, v))


__all__ = ["csv_stream", "ingest_available_now", "ingest_runs",
           "apply_change_stream", "apply_change_stream_buckets",
           "apply_to_buckets",
           "write_buckets", "read_buckets",
           "latest_version", "read_version", "write_version"]
