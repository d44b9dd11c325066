"""The load job (P8, M1, M2): extract → transform → load as one Spark plan,
with the run-log row it leaves behind."""

from __future__ import annotations

import datetime as _dt
import logging
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, keys, quality
from ..operators.runlog import FAILED, PARTIAL, SUCCESS, run_log_row
from ..session import (drop_path, releases_shuffles, scratch_path,
                       stage as stage_table)
from ..sinks.files import archive_file
from ..sinks.jdbc import JdbcTarget
from ..sinks.lake import load_run, row_count, verify_load, write_table
from ..sources.csv import (DELIVERED, is_directory, read_csv,
                           read_directory)
from ..schemas import CATALOG, conform, table_rules
from .jobspec import JobSpec

log = logging.getLogger("loadstar")


def observed(obs: Observation | None, fallback):
    """Metrics of an ``Observation``; ``fallback()`` computes them with a
    plain aggregate when Spark cannot deliver them (it fails on some
    empty inputs)."""
    if obs is not None:
        try:
            got = obs.get
            if got:
                return got
        except Exception as e:  # noqa: BLE001 - fall back to counting
            log.info("no metrics from Spark (%s), counting instead", e)
    return fallback()


@dataclass
class TransformResult:
    good: DataFrame
    bad: DataFrame
    extra_columns: list = field(default_factory=list)
    fills: dict = field(default_factory=dict)
    nulls_before: int = 0
    nulls_after: int = 0
    observed_in: Observation | None = None      # rows read
    rows_deduped: int | None = None             # rows after dedupe
    staged_paths: list = field(default_factory=list)  # to delete at the end
    layouts: dict = field(default_factory=dict)  # of each datetime column


DUPLICATE_KEY = "duplicate_key"
_ORD = "_delivered"            # position of a row among the deduped ones


# Bitmaps of 4 KB that may be broadcast (64 MB: 500 million rows); more are
# joined by shuffle.
BROADCAST_BITMAPS = 1 << 14


def _has_key(key: Sequence[str]) -> Column:
    """A row with a null in its key repeats no other's."""
    return reduce(and_, [F.col(f"`{c}`").isNotNull() for c in key])


def _first_rows(tagged: DataFrame, key: Sequence[str], order: Sequence[str]
                ) -> DataFrame:
    """Of the good rows of a key the one that stays (the least by ``order``,
    then the first delivered), as one bit each in bitmaps (``_block``,
    ``_bits``) of up to 32,768 places of rows: whole rows need not be
    shuffled to tell the others."""
    rank = F.struct(*[F.col(f"`{c}`") for c in order], F.col(_ORD))
    at = F.col(f"_least.{_ORD}")
    return tagged.filter((F.col("reject_reasons") == "") & _has_key(key)) \
        .groupBy(*[F.col(f"`{c}`") for c in key]).agg(
            F.min(rank).alias("_least")).select(
            F.bitmap_bucket_number(at).alias("_block"),
            F.bitmap_bit_position(at).alias("_bit")) \
        .repartition("_block").groupBy("_block").agg(
            F.bitmap_construct_agg("_bit").alias("_bits"))


def _unique(tagged: DataFrame, key: Sequence[str], first: DataFrame
            ) -> DataFrame:
    """Key uniqueness: good rows with a key that are not among the ``first``
    of theirs (see :func:`_first_rows`) get ``DUPLICATE_KEY``."""
    bit = F.bitmap_bit_position(_ORD).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3) + 1,
                                    F.lit(1))), 16, 10).cast("int")
    stays = F.coalesce(F.getbit(byte, bit.bitwiseAND(7)) == 1, F.lit(False))
    extra = (F.col("reject_reasons") == "") & _has_key(key) & ~stays
    return tagged.withColumn("_block", F.bitmap_bucket_number(_ORD)).join(
        first, "_block", "left").withColumn("reject_reasons", F.when(
            extra, F.lit(DUPLICATE_KEY)).otherwise(F.col("reject_reasons"))
        ).select(*tagged.columns)


def transform(df: DataFrame, spec: JobSpec,
              order_by: Sequence[str] | None = None,
              stage: bool = True, enforce: bool = False) -> TransformResult:
    """Schema gate → dedupe → fill → type conversion → rules, in that
    order (fill runs before conversion, so a missing value in a text-typed
    numeric column becomes 'Unknown' and then null, and is rejected).

    ``order_by``: delivery-order columns (file ordinal) for keep-first;
    dropped after the dedupe.
    ``stage``: write the deduped rows as a parquet table into the cluster's
    checkpoint folder before the statistics passes of the fill, so those passes (and
    the good/bad writes) read the staged rows instead of re-running the read
    and the dedupe shuffle. The staging pass also fills the row-count
    observations (no extra scan). Without ``dedupe_subset`` the rows read are
    written before, so that the dedupe shuffles their hashes and not all of
    them whole. With ``enforce`` the checked rows are written once more, with
    their reasons, so that the conversions, the rules and the key's shuffles
    run once and not for each reader of the good and bad rows. Each table is
    deleted when the next one is written."""
    held: list[str] = []
    try:
        return _transform(df, spec, order_by, stage, enforce, held)
    except BaseException:
        for path in held:
            drop_path(df.sparkSession, path)
        raise


def _transform(df, spec, order_by, stage, enforce, held) -> TransformResult:
    """:func:`transform`; ``held`` lists the written folders."""
    def write(rows: DataFrame, name: str) -> DataFrame:
        """``rows`` written, and the tables before them deleted."""
        path, old = scratch_path(df.sparkSession, name), list(held)
        held.append(path)
        out = stage_table(rows, path=path)
        for p in old:
            drop_path(df.sparkSession, p)
            held.remove(p)
        return out

    if spec.dedupe_subset and not order_by:
        raise ValueError("dedupe_subset keeps the first row delivered: give "
                         "order_by, the columns that tell the order")
    extra = clean.check_schema(df.drop(*[c for c in order_by or ()
                                         if c in DELIVERED]),
                               spec.expected_columns)
    tag = uuid.uuid4().hex[:12]
    obs_in, obs_d = Observation(f"in_{tag}"), Observation(f"dedup_{tag}")
    src = df.observe(obs_in, F.count(F.lit(1)).alias("rows"))
    if spec.dedupe_subset:
        d = clean.dedupe(src, spec.dedupe_subset, order_by).drop(*order_by)
    else:           # of equal rows it is no matter which one stays
        d = src.drop(*order_by or ())
        if stage:
            d, listed = keys.distinct_rows(write(d, "delivered"))
            held += listed
        else:
            d = clean.dedupe(d)
    enforce = enforce and spec.enforce_table and spec.table in CATALOG
    if enforce:
        d = d.withColumn(_ORD, F.monotonically_increasing_id())
    # the staging write also counts rows and nulls per column, so the fill
    # needs no separate counting pass
    d = d.observe(obs_d, *clean.null_count_columns(d))
    nulls, rows = None, None
    if stage:
        d = write(d, "dedup")
        seen = observed(obs_d, lambda: d.agg(
            *clean.null_count_columns(d)).first().asDict())
        nulls, rows = clean.null_counts_from(d, seen), int(seen["_rows"])
    filled, plan = clean.fill_missing(d, exclude=spec.fill_exclude,
                                      unknown=spec.unknown_text,
                                      null_counts=nulls,
                                      median=spec.median)
    layouts = None
    if spec.infer_datetime:
        layouts = clean.choose_layouts(clean.layout_profile(
            filled, [c for c, t in spec.type_mappings.items()
                     if t.strip().lower() == "datetime"],
            spec.datetime_formats))
    typed = clean.coerce_types(filled, spec.type_mappings,
                               spec.datetime_formats, layouts)
    rules = clean.range_rules(typed, spec.value_constraints) + list(spec.rules)
    if enforce:
        rules += table_rules(spec.table, typed.columns)
        key = spec.key or CATALOG[spec.table].key
        checked = quality.tag_reasons(typed, rules)
        if set(key) <= set(typed.columns):
            first = _first_rows(checked, key, spec.key_order)
            if stage:
                held.append(scratch_path(df.sparkSession, "first-rows"))
                first = stage_table(first, path=held[-1])
                if first.count() <= BROADCAST_BITMAPS:
                    first = F.broadcast(first)
            checked = _unique(checked, key, first)
        checked = checked.drop(_ORD)
        if stage:
            checked = write(checked, "dedup-checked")
        good = checked.filter(F.col("reject_reasons") == "").drop(
            "reject_reasons")
        bad = checked.filter(F.col("reject_reasons") != "")
    else:
        good, bad = quality.split(typed, rules)
    return TransformResult(good, bad, extra, plan.values, plan.nulls_before,
                           plan.nulls_after, obs_in if stage else None, rows,
                           held, layouts or {})


@dataclass
class RunResult:
    run_id: str
    status: str
    start: _dt.datetime
    end: _dt.datetime
    rows_read: int = 0
    duplicates_removed: int = 0
    rows_loaded: int = 0
    rows_rejected: int = 0
    malformed_rows: int = 0
    nulls_before: int = 0      # missing cells before and after the fill
    nulls_after: int = 0
    fills: dict = field(default_factory=dict)
    layouts: dict = field(default_factory=dict)
    extra_columns: list = field(default_factory=list)
    error: str | None = None
    archived_to: str | None = None

    @property
    def duration_s(self) -> float:
        return (self.end - self.start).total_seconds()

    @property
    def rows_per_second(self) -> float:
        return self.rows_loaded / self.duration_s if self.duration_s else 0.0


def now() -> _dt.datetime:
    return _dt.datetime.now().replace(microsecond=0)


@releases_shuffles
def run(spark: SparkSession, source: str | Sequence[str] | DataFrame,
        spec: JobSpec, target: str | JdbcTarget, run_id: str | None = None,
        reject_target: str | None = None, run_log_target: str | None = None,
        archive_dir: str | None = None, order_by: Sequence[str] | None = None,
        fmt: str = "parquet", quality_log_target: str | None = None,
        parents: Mapping[str, DataFrame | str] | None = None) -> RunResult:
    """M1/M2: one load run.

    source        CSV file path(s) sharing one header, a delivery folder
                  (files grouped by header, see :func:`read_directory`), or
                  a DataFrame
    target        lake table path; rows land in partition ``run_id=<id>``
                  with dynamic overwrite, so re-running a run replaces it.
                  Or a :class:`JdbcTarget`: batched parallel inserts, then
                  the before + sent = after row-count check
    reject_target where rejected rows (with reasons) and malformed CSV rows
                  go, partitioned the same way
    run_log_target append the run-log row (SUCCESS / PARTIAL / FAILED)
    archive_dir   move the source file(s) aside after a successful load
    quality_log_target append the quality checks of the rows this run
                  loaded (lake targets), one ``data_quality_log`` row each
    parents       tables that the foreign keys of ``spec.table`` refer to, by
                  name (a DataFrame, or the path of a lake table): rows whose
                  key is not there are rejected with
                  ``<column>_not_in_<table>``

    With ``spec.enforce_table`` and a key, rows whose key a row of another
    run holds are rejected with ``key_in_earlier_run``; a key index beside
    the table (``_keys``) keeps the keys of each run.

    Errors are logged in the run log and re-raised."""
    t0 = time.time()
    start = now()
    t, listed = None, []
    run_id = run_id or f"{start:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
    res = RunResult(run_id, FAILED, start, start)
    try:
        malformed, csv = None, None
        # of files the rows' own places tell which one came first
        ordered = bool(spec.dedupe_subset) and not order_by \
            and not isinstance(source, DataFrame)
        if ordered:
            order_by = list(DELIVERED)
        if isinstance(source, DataFrame):
            raw = source
        elif isinstance(source, str) and is_directory(spark, source):
            # a delivery folder: files grouped by header, combined by name
            csv = read_directory(spark, source, on_error=spec.on_error,
                                 multi_line=spec.csv_multi_line,
                                 with_order=ordered)
            raw, malformed = csv.data, csv.malformed
        else:
            csv = read_csv(spark, source, on_error=spec.on_error,
                           multi_line=spec.csv_multi_line,
                           with_order=ordered)
            raw, malformed = csv.data, csv.malformed
        lake = not isinstance(target, JdbcTarget)
        t = transform(raw, spec, order_by=order_by, enforce=lake)
        res.extra_columns, res.fills = t.extra_columns, t.fills
        res.layouts = t.layouts
        res.nulls_before, res.nulls_after = t.nulls_before, t.nulls_after
        res.rows_read = int(observed(
            t.observed_in, lambda: {"rows": raw.count()})["rows"])
        res.duplicates_removed = res.rows_read - t.rows_deduped
        good, bad, key = t.good, t.bad, ()
        if lake and spec.enforce_table and spec.table in CATALOG:
            table = CATALOG[spec.table]
            key = [] if table.surrogate_key and not spec.key else list(
                spec.key or table.key)
            if not set(key) <= set(good.columns):
                key = []
            if parents:
                good, bad, paths = keys.reject_orphans(
                    good, bad, table.foreign_keys,
                    {n: spark.read.format(fmt).load(d)
                     if isinstance(d, str) else d
                     for n, d in parents.items()})
                listed += paths
            gone = keys.earlier_keys(good, target, run_id, key, fmt) \
                if key else None
            if gone is not None:
                good, bad, path = keys.reject_keys(good, bad, gone, key,
                                                   keys.EARLIER_RUN)
                listed.append(path)
        quality.enforce_policy(bad, spec.on_error)
        if isinstance(target, JdbcTarget):
            # relational target: append (as a table insert), then S8 — the
            # table must hold what it held plus what was sent
            before = target.count(spark)
            obs = Observation(f"sent_{uuid.uuid4().hex[:12]}")
            target.write(t.good.observe(obs, F.count(F.lit(1)).alias("n")))
            res.rows_loaded = int(obs.get.get("n", 0))
            verify_load(before, res.rows_loaded, target.count(spark))
        else:
            extra = ()
            if spec.enforce_table and spec.table in CATALOG:
                good = conform(good, spec.table, start, keep_extra=True)
            if spec.month_partition:
                mcol = f"{spec.month_partition}_month"
                good = good.withColumn(mcol, F.trunc(spec.month_partition,
                                                     "month"))
                extra = (mcol,)
            res.rows_loaded = load_run(good, target, run_id, fmt=fmt,
                                       extra_partitions=extra)
            written = row_count(spark, target, fmt,
                                where=F.col("run_id") == run_id)
            if written != res.rows_loaded:
                raise RuntimeError(f"load check: {written} rows in "
                                   f"partition, {res.rows_loaded} sent")
            if key:
                keys.index_run(spark, target, run_id, key, fmt)
        if csv is not None:
            # the staging pass counted the long rows; re-read the files for
            # the quarantine only when there are any
            res.malformed_rows = csv.malformed_count()
            if not res.malformed_rows:
                malformed = None
        if malformed is not None:
            # quarantine keeps rejected rows as text, next to the malformed
            # records that never had types
            bad = bad.select(*[F.col(f"`{c}`").cast("string").alias(c)
                               for c in bad.columns]).unionByName(
                malformed, allowMissingColumns=True)
        if reject_target:
            res.rows_rejected = load_run(bad, reject_target, run_id, fmt=fmt)
        else:
            res.rows_rejected = bad.count()
        res.status = PARTIAL if res.rows_rejected else SUCCESS
        if quality_log_target and not isinstance(target, JdbcTarget):
            loaded = spark.read.format(fmt).load(target).filter(
                F.col("run_id") == run_id)
            write_table(quality.quality_log_rows(loaded, res.start,
                                                 table=spec.table)
                        .withColumn("run_id", F.lit(run_id)),
                        quality_log_target, mode="append", fmt=fmt)
    except Exception as e:
        res.error = f"{type(e).__name__}: {e}"
        log.error("Run %s failed: %s", run_id, res.error)
        raise
    finally:
        keys.forget(spark, listed + (t.staged_paths if t is not None else []))
        res.end = now()
        log.info("Run %s %s in %.2fs: read %d, duplicates %d, loaded %d, "
                 "rejected %d", run_id, res.status, time.time() - t0,
                 res.rows_read, res.duplicates_removed, res.rows_loaded,
                 res.rows_rejected)
        if run_log_target:
            details = {"rows_read": res.rows_read,
                       "duplicates_removed": res.duplicates_removed,
                       "fills": res.fills,
                       "datetime_layouts": res.layouts,
                       "missing_before": res.nulls_before,
                       "missing_after": res.nulls_after,
                       "extra_columns": res.extra_columns,
                       "target": str(target)}
            write_table(run_log_row(spark, run_id, spec.name, res.start,
                                    res.end, res.status, res.rows_loaded,
                                    res.rows_rejected, res.error, details),
                        run_log_target, mode="append", fmt=fmt)
    if archive_dir and not isinstance(source, DataFrame):
        paths = [source] if isinstance(source, str) else list(source)
        if isinstance(source, str) and is_directory(spark, source):
            # only the files that were read; skipped ones stay for a look
            paths = [f for f in csv.files if f not in csv.skipped] \
                if csv is not None else []
        res.archived_to = ",".join(filter(None, (
            archive_file(spark, p, archive_dir, start) for p in paths)))
    return res
