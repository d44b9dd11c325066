"""Run log (S15, M2) and its analytics."""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import elapsed_seconds

# --- fixed values -----------------------------------------------------------
SUCCESS, FAILED, PARTIAL = "SUCCESS", "FAILED", "PARTIAL"
LONG_RUN_SECONDS = 300          # M5 threshold
TOP_N = 10                      # M4 report size
# ---------------------------------------------------------------------------

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("execution_id", T.StringType(), False),
    T.StructField("pipeline_name", T.StringType(), True),
    T.StructField("start_time", T.TimestampNTZType(), True),
    T.StructField("end_time", T.TimestampNTZType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("rows_processed", T.LongType(), True),
    T.StructField("rows_failed", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("execution_details", T.StringType(), True),
])


def run_log_row(spark: SparkSession, execution_id: str, pipeline_name: str,
                start: _dt.datetime, end: _dt.datetime, status: str,
                rows_processed: int, rows_failed: int,
                error_message: str | None = None,
                details: dict | None = None) -> DataFrame:
    """The one-row run-log entry of a run, with the counts the run
    actually observed."""
    return spark.createDataFrame([(
        execution_id, pipeline_name, start, end, status, int(rows_processed),
        int(rows_failed), error_message,
        json.dumps(details, default=str, sort_keys=True) if details else None,
    )], RUN_LOG_SCHEMA).coalesce(1)       # one row → one file, one task


def runs_from_events(events: DataFrame, pipelines: int = 15) -> DataFrame:
    """A run log derived from an event stream: one run per (user, day);
    start/end are the first/last event, failed rows are ``error`` events,
    and the pipeline is the user's bucket among ``pipelines``."""
    g = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col("event_type") == "error").alias("rows_failed"))
    return g.select(
        F.concat_ws("-", F.col("user_id").cast("string"),
                    F.date_format("day", "yyyyMMdd")).alias("execution_id"),
        F.concat(F.lit("pipeline_"),
                 (F.col("user_id") % pipelines).cast("string"))
         .alias("pipeline_name"),
        "start_time", "end_time",
        F.when(F.col("rows_failed") == 0, F.lit(SUCCESS))
         .when(F.col("rows_failed") == F.col("rows_processed"), F.lit(FAILED))
         .otherwise(F.lit(PARTIAL)).alias("status"),
        "rows_processed", "rows_failed",
        F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("string").alias("execution_details"))


def _round2(total: str, n: str):
    # sum / n rounded half-up to 2 places in whole-number arithmetic, so the
    # result has the same digits in every engine
    centis = F.expr(f"({total} * 200 + {n}) div (2 * {n})")
    return centis.cast("double") / 100


def _without(run_log: DataFrame, exclude_like: str | None) -> DataFrame:
    """leave out pipelines whose name matches a case-insensitive LIKE
    pattern (e.g. the monitoring job itself)."""
    if exclude_like is None:
        return run_log
    return run_log.filter(~F.col("pipeline_name").ilike(exclude_like))


def slowest_pipelines(run_log: DataFrame, n: int = TOP_N,
                      exclude_like: str | None = None) -> DataFrame:
    """M4 + O2: per pipeline — runs, total / mean / min / max duration in
    seconds — the ``n`` with the largest total (ties by name)."""
    d = _without(run_log, exclude_like).select(
        "pipeline_name", elapsed_seconds("start_time", "end_time").alias("d"))
    g = d.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("d").alias("_t"),
        F.min("d").alias("min_s"), F.max("d").alias("max_s"))
    return (g.select("pipeline_name", "calls",
                     F.col("_t").cast("double").alias("total_s"),
                     _round2("_t", "calls").alias("avg_s"), "min_s", "max_s")
             .orderBy(F.desc("total_s"), F.asc("pipeline_name")).limit(n))


def long_runs(run_log: DataFrame, threshold: int = LONG_RUN_SECONDS,
              exclude_like: str | None = None) -> DataFrame:
    """M5 + O3: runs that took longer than ``threshold`` seconds, newest
    first."""
    d = elapsed_seconds("start_time", "end_time")
    return (_without(run_log, exclude_like).filter(d > threshold)
            .select("execution_id", "pipeline_name", "start_time", "status",
                    d.alias("duration_seconds"))
            .orderBy(F.desc("start_time"), F.asc("execution_id")))
