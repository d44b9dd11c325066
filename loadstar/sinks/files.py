"""Moving processed source files aside."""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import SparkSession

log = logging.getLogger("loadstar")

# --- fixed values -----------------------------------------------------------
ARCHIVE_STAMP = "%Y%m%d_%H%M%S"       # prefix of an archived file name
# ---------------------------------------------------------------------------


def archive_file(spark: SparkSession, path: str, archive_dir: str,
                 at: _dt.datetime | None = None) -> str | None:
    """Move ``path`` to ``archive_dir/<yyyyMMdd_HHmmss>_<name>`` through the
    cluster's file system (a rename, no copy), creating the folder. A failure
    is logged as a warning and returns None — archiving never fails a load
    that has already committed."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        src = jvm.org.apache.hadoop.fs.Path(path)
        fs = src.getFileSystem(conf)
        stamp = (at or _dt.datetime.now()).strftime(ARCHIVE_STAMP)
        dst_dir = jvm.org.apache.hadoop.fs.Path(archive_dir)
        fs.mkdirs(dst_dir)
        dst = jvm.org.apache.hadoop.fs.Path(dst_dir, f"{stamp}_{src.getName()}")
        if not fs.rename(src, dst):
            raise OSError(f"rename {path} → {dst.toString()} refused")
        log.info("%s moved to %s", path, dst.toString())
        return dst.toString()
    except Exception as e:  # noqa: BLE001 - archive failures only warn
        log.warning("%s stays where it is: %s", path, e)
        return None
