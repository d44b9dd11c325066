"""Line deduplication by site-relative frequency (DataFrame functions only).

Pages are grouped by host. A line's ratio on a host is the number of the
host's pages that contain it divided by the host's pages; lines that reach the
ratio are boilerplate of that host and are dropped from its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, small, stage

# A line on one page in twenty is the site's, not the page's; MIN_PAGES keeps
# small hosts from losing what two or three of their pages happen to share.
MAX_RATIO, MIN_PAGES = 0.05, 5


def _key(line: Column) -> Column:
    """A line without the white space around it."""
    return F.btrim(line, F.lit(SPACE))


def boilerplate(pages: DataFrame, host_col: str = "source",
                text_col: str = "text", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """Boilerplate lines: ``__host``, two 64-bit hashes of the line, the pages
    that contain it and the host's pages.

    A page counts a line once. Counting combines equal (host, line) in every
    map task, so neither a host nor a line with a third of all rows gathers
    anywhere; lines travel as 128-bit fingerprints."""
    per_page = pages.select(
        F.col(host_col).alias("__host"),
        F.explode(F.array_distinct(F.transform(
            F.split(F.col(text_col), "\n"), _key))).alias("__line"))
    per_page = per_page.filter(F.col("__line") != "").select(
        "__host", F.xxhash64("__line").alias("__a"),
        F.xxhash64(F.lit(1), "__line").alias("__b"))
    counts = per_page.groupBy("__host", "__a", "__b").agg(
        F.count(F.lit(1)).alias("__pages")).filter(
        F.col("__pages") >= min_pages)
    hosts = pages.groupBy(F.col(host_col).alias("__h")).agg(
        F.count(F.lit(1)).alias("__all"))
    return counts.join(hosts, F.col("__host").eqNullSafe(F.col("__h"))) \
        .filter(F.col("__pages") / F.col("__all") >= F.lit(max_ratio)) \
        .select("__host", "__a", "__b", "__pages", "__all")


def drop_lines(pages: DataFrame, host_col: str = "source",
               text_col: str = "text", max_ratio: float = MAX_RATIO,
               min_pages: int = MIN_PAGES,
               counts: tuple[str, str] = ("n_lines", "n_dropped")
               ) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text_col`` and two
    columns (named by ``counts``): lines with text, and lines dropped.

    A line is boilerplate of a host if at least ``min_pages`` of the host's
    pages and ``max_ratio`` of them or more contain it (compared without
    surrounding white space). A page whose every line is boilerplate is left
    whole: nothing on it tells content from boilerplate, and deduplication of
    documents is the next step for it.

    * null or empty text stays as it is; blank lines are never dropped
    * null hosts form one host; repeated rows count as pages
    * very long texts and lines: whole lines are compared by fingerprint
    * a page row keeps all its columns; those named like ``counts`` are
      replaced; an empty table gives no rows

    The boilerplate list of a host has at most pages-lines / (ratio × pages)
    entries: its size is bounded by the average lines of a page divided by
    ``max_ratio``. It is joined by host as one row (broadcast while the whole
    list has at most a million lines, by shuffle beyond), so texts are not
    exploded or shuffled by line."""
    lists = stage(boilerplate(pages, host_col, text_col, max_ratio,
                              min_pages), "boilerplate")
    found = lists.count()
    lists = small(lists.groupBy("__host").agg(F.collect_set(F.struct(
        "__a", "__b")).alias("__drop")), found)
    joined = pages.drop(*counts).join(
        lists, F.col(host_col).eqNullSafe(F.col("__host")), "left") \
        .withColumn("__drop", F.coalesce("__drop", F.array().cast(
            "array<struct<__a:bigint,__b:bigint>>")))

    def flagged(line: Column) -> Column:
        key = _key(line)
        return (key != "") & F.array_contains("__drop", F.struct(
            F.xxhash64(key).alias("__a"),
            F.xxhash64(F.lit(1), key).alias("__b")))

    lines = F.split(F.col(text_col), "\n")
    marked = joined.withColumn("__marked", F.transform(
        lines, lambda x: F.struct(x.alias("line"), (_key(x) != "").alias("has"),
                                  flagged(x).alias("drop"))))
    n_lines = F.size(F.filter("__marked", lambda x: x["has"]))
    n_drop = F.size(F.filter("__marked", lambda x: x["drop"]))
    counted = marked.withColumns({
        "__n": F.when(F.col(text_col).isNull(), 0).otherwise(n_lines),
        "__d": F.when(F.col(text_col).isNull(), 0).otherwise(n_drop)})
    drops = (F.col("__d") > 0) & (F.col("__d") < F.col("__n"))
    kept = F.array_join(F.transform(F.filter(
        "__marked", lambda x: ~x["drop"]), lambda x: x["line"]), "\n")
    return counted.withColumns({
        text_col: F.when(drops, kept).otherwise(F.col(text_col)),
        counts[0]: F.col("__n").cast("long"),
        counts[1]: F.when(drops, F.col("__d")).otherwise(0).cast("long"),
    }).drop("__host", "__drop", "__marked", "__n", "__d")


def drop_lines_sql(rel: str, host: str = "source", text: str = "text",
                   key: str = "doc_id", max_ratio: float = MAX_RATIO,
                   min_pages: int = MIN_PAGES) -> str:
    """DuckDB SQL for the same (``key`` must be unique)."""
    sp = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH pages AS (SELECT {key} AS k, {host} AS h, {text} AS t FROM {rel}),
arr AS (SELECT k, h, string_split(t, chr(10)) AS a FROM pages
  WHERE t IS NOT NULL),
lines AS (SELECT k, h, unnest(a) AS line, generate_subscripts(a, 1) AS i
  FROM arr),
keyed AS (SELECT k, h, i, line, trim(line, {sp}) AS key FROM lines),
hosts AS (SELECT h, count(*) AS n FROM pages GROUP BY h),
bad AS (SELECT c.h, c.key FROM (SELECT h, key, count(DISTINCT k) AS p
  FROM keyed WHERE key <> '' GROUP BY h, key) c
  JOIN hosts ON c.h IS NOT DISTINCT FROM hosts.h
  WHERE p >= {min_pages} AND p / n::DOUBLE >= CAST({max_ratio} AS DOUBLE)),
marked AS (SELECT keyed.k, i, line, keyed.key, bad.key IS NOT NULL AS d
  FROM keyed LEFT JOIN bad ON keyed.h IS NOT DISTINCT FROM bad.h
  AND keyed.key = bad.key),
sums AS (SELECT k, count(*) FILTER (WHERE key <> '') AS n,
  count(*) FILTER (WHERE d) AS d,
  string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT d) AS t
  FROM marked GROUP BY k)
SELECT pages.k AS {key}, pages.h AS {host},
  CASE WHEN d > 0 AND d < n THEN sums.t ELSE pages.t END AS {text},
  coalesce(n, 0) AS n_lines,
  CASE WHEN d > 0 AND d < n THEN d ELSE 0 END AS n_dropped
FROM pages LEFT JOIN sums ON pages.k = sums.k"""
