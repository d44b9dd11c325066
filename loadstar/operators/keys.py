"""Constraints that need other rows: foreign keys against parent tables, and
keys against the rows of other runs (S12, J2-J4).

Keys are reduced to one row each (partial aggregation) before anything is
joined, so a key that a third of the rows share costs one row per task.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path, stage
from ..sinks.lake import load_run, path_exists

log = logging.getLogger("loadstar")

# Words of 64 bits in a Bloom filter: at least one per this many keys, and at
# most MOST_WORDS, which bounds what is broadcast (16 bytes a word).
KEYS_PER_WORD, MOST_WORDS = 4, 1 << 20
# Rows of a key list that may be broadcast; a longer one is joined by shuffle.
BROADCAST_KEYS = 1_000_000
# Buckets of a key index.
INDEX_BUCKETS = 64
EARLIER_RUN = "key_in_earlier_run"


def _word_and_bits(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """A key's word in a Bloom filter, and the four bits it sets there."""
    h = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    bits = F.lit(0).cast("long")
    for i in range(4):
        at = F.shiftrightunsigned(h, 40 + 6 * i).bitwiseAND(F.lit(63))
        bits = bits.bitwiseOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), at.cast("int")))
    return F.pmod(h, F.lit(words)), bits


def bloom_filter(keys: DataFrame, words: int) -> DataFrame:
    """(``_word``, ``_bits``): a blocked Bloom filter of the distinct rows of
    ``keys``, one aggregate with at most ``words`` groups."""
    word, bits = _word_and_bits(keys.columns, words)
    return keys.select(word.alias("_word"), bits.alias("_b")).groupBy(
        "_word").agg(F.bit_or("_b").alias("_bits"))


def _words(rows: int) -> int:
    """Words of a Bloom filter of so many keys."""
    words = 64
    while words < min(MOST_WORDS, rows / KEYS_PER_WORD):
        words *= 2
    return words


def _may_hold(rows: DataFrame, keys: Sequence[str], bloom: DataFrame,
              words: int) -> DataFrame:
    """``rows`` with ``_may``: whether the Bloom filter may hold their key."""
    word, bits = _word_and_bits(keys, words)
    # at most MOST_WORDS rows
    return rows.withColumns({"_word": word, "_need": bits}).join(
        F.broadcast(bloom), "_word", "left").withColumn(
        "_may", F.coalesce(F.col("_bits").bitwiseAND(F.col("_need"))
                           == F.col("_need"), F.lit(False)))


# Types whose equal values have equal hashes.
HASHED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
          T.TimestampNTZType, T.BinaryType)


def distinct_rows(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """U1 for a written table: its distinct rows, nulls being equal, and the
    folder written for it, for the caller to delete once they are used.

    Only hashes of all rows are shuffled. Those that come more than once make
    a Bloom filter, and the rows that it may hold are compared whole; no
    other row can have a duplicate."""
    if not df.columns or not all(
            isinstance(f.dataType, HASHED) or f.dataType == T.StringType()
            for f in df.schema.fields):
        return df.dropDuplicates(), []
    path = scratch_path(df.sparkSession, "repeated-hashes")
    own = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.select(F.struct(*own).alias("_own"),
                       F.xxhash64(*own).alias("_hash"))
    again = stage(hashed.groupBy("_hash").agg(
        F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash"),
        path=path)
    words = _words(again.count())
    tagged = _may_hold(hashed, ["_hash"], bloom_filter(again, words), words)
    return tagged.filter(~F.col("_may")).select("_own.*").unionByName(
        tagged.filter("_may").select("_own.*").dropDuplicates()), [path]


def missing_keys(child: DataFrame, parent: DataFrame, keys: Sequence[str],
                 parent_keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``child`` (without nulls, which refer to nothing)
    that no row of ``parent`` has.

    A Bloom filter of the parent's keys settles keys that it does not hold;
    only the others are joined with the parent."""
    keys = list(keys)
    own = child.select(keys).dropna().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n")).drop("_n")
    there = parent.select(*[F.col(f"`{p}`").cast(child.schema[k].dataType)
                            .alias(k) for k, p in zip(keys, parent_keys)]
                          ).dropna()
    words = _words(there.count())
    tagged = _may_hold(own, keys, bloom_filter(there, words), words)
    held = there.distinct().withColumn("_hit", F.lit(True))
    return tagged.filter(~F.col("_may")).select(keys).unionByName(
        tagged.filter("_may").select(keys).join(held, keys, "left")
        .filter(F.col("_hit").isNull()).select(keys))


def reject_keys(good: DataFrame, bad: DataFrame, gone: DataFrame,
                keys: Sequence[str], reason: str
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move the rows of ``good`` whose key is in ``gone`` (distinct) to
    ``bad``, with the reason. ``gone`` is written first and counted; it is
    broadcast up to ``BROADCAST_KEYS`` rows. Returns also the written list,
    for the caller to delete once the rows are written."""
    spark, keys = good.sparkSession, list(keys)
    path = scratch_path(spark, "gone-keys")
    listed = stage(gone, path=path)
    n = listed.count()
    marks = listed.select(*[F.col(k).alias(f"_g{i}")
                            for i, k in enumerate(keys)],
                          F.lit(True).alias("_gone"))
    same = [F.col(f"`{k}`") == F.col(f"_g{i}") for i, k in enumerate(keys)]
    # beyond the bound a join by shuffle: keys of ``gone`` are distinct, and
    # Spark splits the rows of a key that many of ``good`` share
    joined = good.join(F.broadcast(marks) if n <= BROADCAST_KEYS else marks,
                       same, "left")
    out = F.coalesce(F.col("_gone"), F.lit(False))
    return (joined.filter(~out).select(*good.columns),
            bad.unionByName(joined.filter(out).select(
                *good.columns, F.lit(reason).alias("reject_reasons"))), path)


def reject_orphans(good: DataFrame, bad: DataFrame,
                   foreign_keys: Sequence[tuple[str, str, str]],
                   parents: Mapping[str, DataFrame]
                   ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows that refer to a missing parent go to ``bad``, with the reason
    ``<column>_not_in_<table>``. ``foreign_keys``: (column, table, its
    column), checked in this order; a row is charged to the first it fails.
    A table that is not given is not checked (and logged)."""
    paths = []
    for col, table, parent_col in foreign_keys:
        if col not in good.columns:
            continue
        if table not in parents:
            log.warning("%s: no table %s given, reference not checked", col,
                        table)
            continue
        gone = missing_keys(good, parents[table], [col], [parent_col])
        good, bad, path = reject_keys(good, bad, gone, [col],
                                      f"{col}_not_in_{table}")
        paths.append(path)
    return good, bad, paths


# ------------------------------------------------------- keys of all runs

def index_path(target: str) -> str:
    """Where the key index of a lake table lies (hidden from readers)."""
    return f"{target.rstrip('/')}/_keys"


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]),
                  F.lit(INDEX_BUCKETS)).cast("int")


def _runs(spark: SparkSession, folder: str) -> set[str]:
    """Values of ``run_id`` among a table's folders (metadata only)."""
    if not path_exists(spark, folder):
        return set()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return {n[len("run_id="):] for n in names if n.startswith("run_id=")}


def index_run(spark: SparkSession, target: str, run_id: str,
              keys: Sequence[str], fmt: str = "parquet") -> None:
    """Write (again) one run's part of the key index: its keys alone, in
    folders by bucket of the key's hash. A run without rows has no part."""
    if run_id not in _runs(spark, target):
        drop_path(spark, f"{index_path(target)}/run_id={run_id}")
        return
    rows = spark.read.format(fmt).load(target).filter(
        F.col("run_id") == run_id).select(*[F.col(f"`{k}`") for k in keys])
    load_run(rows.withColumn("bucket", _bucket(keys)), index_path(target),
             run_id, extra_partitions=["bucket"])


def earlier_keys(good: DataFrame, target: str, run_id: str,
                 keys: Sequence[str], fmt: str = "parquet") -> DataFrame | None:
    """The keys of ``good`` that rows of other runs in ``target`` hold, or
    None if there is no other run. Parts of the index that are missing (a
    table from before the index, or a crash between rows and index) are
    written first. Only the buckets that the new keys fall into are read."""
    spark, keys = good.sparkSession, list(keys)
    have = _runs(spark, target)
    for run in sorted(have - _runs(spark, index_path(target)) - {run_id}):
        index_run(spark, target, run, keys, fmt)
    if not have - {run_id}:
        return None
    own = good.select(keys).dropna().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n")).drop("_n").withColumn(
        "bucket", _bucket(keys))
    # at most INDEX_BUCKETS values
    touched = [r[0] for r in own.select("bucket").distinct().collect()]
    index = spark.read.parquet(index_path(target)).filter(
        (F.col("run_id").cast("string") != run_id)
        & F.col("bucket").isin(touched)).select(*keys, "bucket").distinct()
    return own.join(index, [*keys, "bucket"], "left_semi").select(keys)


def forget(spark: SparkSession, paths: Sequence[str]) -> None:
    for p in paths:
        drop_path(spark, p)
