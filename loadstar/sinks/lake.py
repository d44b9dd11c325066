"""Lake-table sink (S5, S7, S8, S12, S13, S18): parquet (or any file
format) by path, or a catalog table by name."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# pandas-style ``if_exists`` names and Spark's own save modes
SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite",
              "append": "append", "errorifexists": "errorifexists",
              "error": "errorifexists", "overwrite": "overwrite",
              "ignore": "ignore"}


def save_mode(mode: str) -> str:
    try:
        return SAVE_MODES[mode]
    except KeyError:
        raise ValueError(f"unknown write mode {mode!r}") from None


def write_table(df: DataFrame, target: str, mode: str = "append",
                fmt: str = "parquet", partition_by: Sequence[str] = (),
                catalog_table: bool = False, options: Mapping | None = None
                ) -> None:
    """Write ``df`` in one action; ``mode`` is fail / replace / append
    (or a Spark save mode)."""
    w = df.write.mode(save_mode(mode)).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if catalog_table:
        w.saveAsTable(target)
    else:
        w.save(target)


def write_observed(df: DataFrame, target: str, name: str = "sent",
                   **kw) -> int:
    """Write and return the number of rows written, counted by an
    ``Observation`` during the write itself (no second scan)."""
    obs = Observation(f"{name}_{uuid.uuid4().hex[:12]}")
    write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), target,
                **kw)
    fs, p = _fs(df.sparkSession, target)
    if kw.get("mode") == "fail" and not any(
            not x.getPath().getName().startswith(("_", "."))
            for x in fs.listStatus(p)):
        return 0          # a new folder without data files
    try:
        return int(obs.get["rows"])
    except Exception:  # noqa: BLE001 - Spark has no metrics for this input
        return row_count(df.sparkSession, target, kw.get("fmt", "parquet")) \
            if kw.get("mode") == "fail" else 0


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def replace_folder(spark: SparkSession, new: str, place: str) -> None:
    """Put folder ``new`` in place of ``place`` (either may be missing): the
    old one is moved aside, the new one moved in, and only then the old one
    deleted, so a crash leaves one of them whole."""
    fs, src = _fs(spark, new)
    _, dst = _fs(spark, place)
    head, _, tail = place.rstrip("/").rpartition("/")
    _, aside = _fs(spark, f"{head}/.old-{tail}-{uuid.uuid4().hex[:8]}")
    had = fs.exists(dst)
    if had and not fs.rename(dst, aside):
        raise RuntimeError(f"{place} could not be moved aside")
    if fs.exists(src) and not fs.rename(src, dst):
        if had:
            fs.rename(aside, dst)
        raise RuntimeError(f"{place} could not be replaced")
    if had:
        fs.delete(aside, True)


def load_run(df: DataFrame, target: str, run_id: str, run_col: str = "run_id",
             fmt: str = "parquet", extra_partitions: Sequence[str] = ()
             ) -> int:
    """Idempotent load. The rows of one run are written aside and then
    take the place of the run's ``run_col=<run_id>`` folder, so loading a run
    again replaces all of it — also with no rows, or with rows in fewer of
    the ``extra_partitions`` (e.g. months) — and leaves every other run
    untouched. Returns the rows written."""
    spark, base = df.sparkSession, target.rstrip("/")
    aside = f"{base}/_new-{uuid.uuid4().hex[:12]}"
    out = df.withColumn(run_col, F.lit(run_id))
    rows = write_observed(out, aside, name=f"load_{run_id}", mode="fail",
                          fmt=fmt, partition_by=[run_col, *extra_partitions])
    folder = f"{run_col}={run_id}"
    replace_folder(spark, f"{aside}/{folder}", f"{base}/{folder}")
    fs, p = _fs(spark, aside)
    fs.delete(p, True)
    return rows


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def table_exists(spark: SparkSession, target: str,
                 catalog_table: bool = False) -> bool:
    """Does the target exist (catalog table or path)?"""
    if catalog_table:
        return spark.catalog.tableExists(target)
    return path_exists(spark, target)


def row_count(spark: SparkSession, target: str, fmt: str = "parquet",
              where: Column | None = None) -> int:
    """Rows in a target (parquet counts come from file footers)."""
    if not path_exists(spark, target):
        return 0
    try:
        df = spark.read.format(fmt).load(target)
    except AnalysisException:      # folder without data files yet
        return 0
    if where is not None:
        df = df.filter(where)
    return df.count()


class LoadVerificationError(RuntimeError):
    pass


def verify_load(before: int, sent: int, after: int) -> None:
    """The target must hold exactly the rows it held plus the rows sent."""
    if before + sent != after:
        raise LoadVerificationError(
            f"target holds {after} rows, expected {before} + {sent}")


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | object]
                  ) -> DataFrame:
    """Column defaults at write time — a missing column is added with
    its default, a null in an existing one is replaced by it (e.g.
    ``created_at``/``updated_at`` = the run's as_of, ``quantity`` = 1)."""
    out = df
    for c, v in defaults.items():
        lit = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), lit)
                             if c in df.columns else lit)
    return out
