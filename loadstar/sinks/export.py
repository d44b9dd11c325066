"""CSV exports for downstream tools."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import shuffles_released
from .lake import save_mode


def export_csv(df: DataFrame, path: str, mode: str = "replace",
               header: bool = True, compression: str = "none") -> None:
    """Write ``df`` as CSV with a header line: a directory of part files,
    one per task, so the export is as parallel as the query that feeds it
    (nothing is funnelled through one task). Nulls are written as empty
    fields, timestamps as ``yyyy-MM-dd HH:mm:ss``. With ``compression``
    (e.g. ``gzip``: ``part-*.csv.gz``) a file is one task of its reader."""
    with shuffles_released(df.sparkSession):
        (df.write.mode(save_mode(mode))
           .option("header", header)
           .option("compression", compression)
           .option("escape", '"')
           .option("ignoreLeadingWhiteSpace", False)
           .option("ignoreTrailingWhiteSpace", False)
           .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
           .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
           .csv(path))
