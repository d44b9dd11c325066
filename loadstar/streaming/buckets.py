"""Tables in key buckets that grow, changed by whole batches.

A bucket is named by its depth and value: it holds the rows whose key's hash
has ``value`` in its lowest ``depth`` bits. A bucket that would get too large
is split in two (or four, …) by further bits; no other bucket is touched, so
the cost of a batch follows the buckets that its keys are in, however large
the table becomes.

Below the table's folder lie

* ``data/<write>/_leaf=<depth>-<value>``: the rows of a bucket, as one batch
  wrote them; never changed afterwards;
* ``_manifest/v=<n>``: one row per bucket of version ``n`` with the write that
  holds it and its rows. A version is there once its manifest is written whole
  (``_SUCCESS``), so a batch is applied as a whole or not at all.

Readers take the newest manifest and keep reading its files while later
batches are applied; files that none of the newest ``keep`` manifests names
are deleted. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, scratch_path, stage
from ..sinks.lake import path_exists
from .ingest import latest_version, read_buckets, read_version

# A bucket holds about this many rows at most; it is split to fill at most
# FILL of that. Hashes have more bits, but rows that share MAX_DEPTH of them
# (a repeated key) would never come apart.
BUCKET_ROWS, FILL, MAX_DEPTH = 4_000_000, 0.75, 32
LEAF = "_leaf"
OWN = frozenset((LEAF, "__d", "__v", "__f", "__slot"))


@dataclass
class Version:
    """One version of a table, as its manifest tells."""
    number: int
    leaves: DataFrame          # depth, value, folder, rows
    key: str
    most: int
    epochs: dict               # source → last batch of it that is in
    schema: T.StructType


def _manifests(target: str) -> str:
    return f"{target.rstrip('/')}/_manifest"


def _folder(target: str, write: str) -> str:
    return f"{target.rstrip('/')}/data/{write}"


def _hash(key: Column, t: T.DataType) -> Column:
    return F.xxhash64(key.cast(t))


def _low_bits(h: Column, depth: Column) -> Column:
    one = F.lit(1).cast("long")
    return h.bitwiseAND(F.call_function("shiftleft", one, depth) - 1)


def _name(depth: Column, value: Column) -> Column:
    return F.concat_ws("-", depth, value)


def version(spark: SparkSession, target: str, number: int | None = None
            ) -> Version:
    """Version ``number`` of a table (else the newest)."""
    base = _manifests(target)
    n = latest_version(spark, base) if number is None else number
    if n is None:
        raise ValueError(f"{target} has no version")
    rows = read_version(spark, base, n)
    one = rows.select("key", "most", "epochs", "columns").first()
    return Version(n, rows.select("depth", "value", "folder", "rows"),
                   one["key"], one["most"], json.loads(one["epochs"]),
                   T.StructType.fromJson(json.loads(one["columns"])))


def _read(spark: SparkSession, target: str, schema: T.StructType,
          leaves: DataFrame) -> DataFrame:
    """The rows of some buckets. Only names of folders reach the driver, as
    for any read of files."""
    held = leaves.filter(F.col("folder").isNotNull()).select(
        "folder", _name(F.col("depth"), F.col("value")).alias("leaf"))
    paths = [f"{_folder(target, r['folder'])}/{LEAF}={r['leaf']}"
             for r in held.collect()]
    return spark.read.schema(schema).parquet(*paths) if paths \
        else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, target: str, number: int | None = None
               ) -> DataFrame:
    """The rows of a version (else the newest) of a growing table; a table of
    ``ingest.write_buckets`` is read as it is."""
    if not path_exists(spark, _manifests(target)) and \
            path_exists(spark, f"{target.rstrip('/')}/_layout"):
        return read_buckets(spark, target)
    v = version(spark, target, number)
    return _read(spark, target, v.schema, v.leaves)


def _in_leaves(df: DataFrame, key: str, t: T.DataType, leaves: DataFrame
               ) -> DataFrame:
    """``df`` with the bucket of ``leaves`` that each row's key is in: its
    depth ``__d``, its value ``__v`` and its ``further`` bits ``__f``. A
    bucket less deep than the deepest takes several slots of the directory;
    rows find theirs by one equality join."""
    depth = leaves.agg(F.max("depth")).first()[0] or 0
    slots = leaves.select(
        F.col("depth").alias("__d"), F.col("value").alias("__v"),
        F.col("further").alias("__f"), F.explode(F.expr(
            f"transform(sequence(0L, shiftleft(1L, {depth} - depth) - 1), "
            "i -> value + i * shiftleft(1L, depth))")).alias("__slot"))
    h = _hash(F.col(f"`{key}`"), t)
    return df.withColumn("__slot", _low_bits(h, F.lit(depth))).join(
        slots, "__slot").drop("__slot")


def _further(rows: Column, depth: Column, most: int) -> Column:
    """Bits by which a bucket that may hold ``rows`` is to be split."""
    bits = F.ceil(F.log2(rows / F.lit(most * FILL))).cast("int")
    return F.when(rows > most, F.greatest(F.lit(0), F.least(
        bits, MAX_DEPTH - depth))).otherwise(0)


def _put(rows: DataFrame, target: str, key: str, t: T.DataType,
         leaves: DataFrame) -> DataFrame:
    """Write the rows of ``leaves`` (``depth``, ``value``, ``further``) split
    by their further bits; the buckets they became."""
    spark, write = rows.sparkSession, uuid.uuid4().hex
    deep = F.col("__d") + F.col("__f")
    placed = _in_leaves(rows, key, t, leaves).withColumn(LEAF, _name(
        deep, _low_bits(_hash(F.col(f"`{key}`"), t), deep))).drop(
        "__d", "__v", "__f")
    path = _folder(target, write)
    placed.repartition(LEAF).write.partitionBy(LEAF).parquet(path)
    counts = spark.read.schema(T.StructType(
        [*rows.schema.fields, T.StructField(LEAF, T.StringType())])).parquet(
        path).groupBy(LEAF).agg(F.count(F.lit(1)).alias("rows"))
    new = leaves.select(
        (F.col("depth") + F.col("further")).alias("depth"),
        F.explode(F.expr(
            "transform(sequence(0L, shiftleft(1L, further) - 1), "
            "i -> value + i * shiftleft(1L, depth))")).alias("value"))
    return new.withColumn(LEAF, _name(F.col("depth"), F.col("value"))).join(
        counts, LEAF, "left").select(
        "depth", "value", F.when(F.col("rows").isNotNull(), F.lit(write))
        .alias("folder"), F.coalesce("rows", F.lit(0)).alias("rows"))


def _commit(spark: SparkSession, target: str, v: Version) -> None:
    """Write the manifest that makes a version readable."""
    head = [F.lit(v.key).alias("key"), F.lit(v.most).cast("long")
            .alias("most"), F.lit(json.dumps(v.epochs)).alias("epochs"),
            F.lit(v.schema.json()).alias("columns")]
    v.leaves.select(F.col("depth").cast("int"), "value", "folder", "rows",
                    *head).write.mode("overwrite").parquet(
        f"{_manifests(target)}/v={v.number}")


def write_table(df: DataFrame, target: str, key: str,
                bucket_rows: int = BUCKET_ROWS) -> None:
    """Version 0: the rows of ``df``, one per ``key``, in buckets of about
    ``bucket_rows`` rows at most. Null keys share a bucket; an empty table is
    one empty bucket. An existing table is refused, and so are columns with
    names of ``OWN``."""
    spark = df.sparkSession
    if path_exists(spark, _manifests(target)):
        raise ValueError(f"{target} is there already")
    taken = OWN.intersection(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are names of the buckets'")
    t = df.schema[key].dataType
    path = scratch_path(spark, "bucket-rows")
    try:
        held = stage(df, path=path)
        root = spark.range(1).select(
            F.lit(0).alias("depth"), F.lit(0).cast("long").alias("value"),
            _further(F.lit(held.count()), F.lit(0), bucket_rows)
            .alias("further"))
        leaves = _put(held, target, key, t, root)
        _commit(spark, target, Version(0, leaves, key, bucket_rows, {},
                                       held.schema))
    finally:
        if path_exists(spark, path):
            drop_path(spark, path)


def apply_batch(spark: SparkSession, target: str, changes: DataFrame,
                apply: Callable[[DataFrame, DataFrame], DataFrame],
                source: str = "", epoch: int | None = None, keep: int = 2
                ) -> int:
    """Bring a table up to date with a batch of changes, as a new version;
    returns its number.

    ``apply`` merges changes into the rows of the buckets they touch (e.g.
    ``lambda cur, chg: cdc.apply_changes(cur, chg, key)``). Before that, a
    bucket that could get over the table's size (its rows and the batch's
    distinct keys in it) is given further bits; the merged rows are then
    written once. With ``epoch``, a batch of ``source`` that is in the table
    already is not applied again.

    * a batch without rows makes no version
    * rows whose key is null are given to ``apply`` with the bucket of nulls
    * until the manifest is written readers see the version before; what a
      crash left behind is deleted with the next batch"""
    if keep < 2:
        raise ValueError("readers need the version before, too")
    v = version(spark, target)
    if epoch is not None and v.epochs.get(source, -1) >= epoch:
        return v.number
    t = v.schema[v.key].dataType
    paths = [scratch_path(spark, f"bucket-{n}") for n in ("changes", "leaves")]
    try:
        chg = stage(_in_leaves(changes, v.key, t, v.leaves.withColumn(
            "further", F.lit(0))), path=paths[0])
        seen = chg.groupBy(F.col("__d").alias("depth"), F.col("__v").alias(
            "value")).agg(F.count_distinct(F.col(f"`{v.key}`")).alias("n"))
        touched = stage(v.leaves.join(seen, ["depth", "value"]).withColumn(
            "further", _further(F.col("rows") + F.col("n"), F.col("depth"),
                                v.most)), path=paths[1])
        if touched.isEmpty():
            return v.number
        merged = apply(_read(spark, target, v.schema, touched),
                       chg.drop("__d", "__v", "__f"))
        if merged.schema.names != v.schema.names:
            raise ValueError("apply() must give the table's columns")
        new = _put(merged.select(*[F.col(f"`{f.name}`").cast(f.dataType)
                                   for f in v.schema]),
                   target, v.key, t, touched)
        rest = v.leaves.join(touched, ["depth", "value"], "left_anti")
        epochs = v.epochs if epoch is None else {**v.epochs, source: epoch}
        _commit(spark, target, Version(
            v.number + 1, rest.unionByName(new), v.key, v.most, epochs,
            v.schema))
    finally:
        for p in paths:
            if path_exists(spark, p):
                drop_path(spark, p)
    retire(spark, target, keep)
    return v.number + 1


def _children(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] \
        if fs.exists(p) else []


def retire(spark: SparkSession, target: str, keep: int = 2) -> None:
    """Delete what the newest ``keep`` versions do not name: buckets of older
    versions, those versions' manifests, and writes without a version."""
    base = _manifests(target)
    newest = latest_version(spark, base)
    have = sorted(int(n[2:]) for n in _children(spark, base)
                  if n.startswith("v="))
    live = [read_version(spark, base, n) for n in have
            if newest - keep < n <= newest]
    named = live[0].select("folder", "depth", "value")
    for m in live[1:]:
        named = named.unionByName(m.select("folder", "depth", "value"))
    named = named.filter(F.col("folder").isNotNull()).distinct()
    for n in (n for n in have if n <= newest - keep):
        gone = read_version(spark, base, n).select(
            "folder", "depth", "value").join(
            named, ["folder", "depth", "value"], "left_anti").filter(
            F.col("folder").isNotNull())
        for r in gone.collect():
            drop_path(spark, f"{_folder(target, r['folder'])}/{LEAF}="
                             f"{r['depth']}-{r['value']}")
        drop_path(spark, f"{base}/v={n}")
    writes = {r[0] for r in named.select("folder").distinct().collect()}
    for w in _children(spark, f"{target.rstrip('/')}/data"):
        if w not in writes:
            drop_path(spark, _folder(target, w))


def apply_change_stream(spark: SparkSession, changes: DataFrame, target: str,
                        checkpoint: str,
                        apply: Callable[[DataFrame, DataFrame], DataFrame],
                        keep: int = 2) -> int:
    """Apply what has arrived on a stream of changes, one version per
    micro-batch, each batch once: a batch that is replayed after its version
    was written is recognised by the stream's id and its number. Returns the
    newest version."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata")
                            .first()[0])["id"]
        apply_batch(spark, target, df, apply, stream, epoch_id, keep)

    q = (changes.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return version(spark, target).number


__all__ = ["write_table", "read_table", "apply_batch", "apply_change_stream",
           "retire", "version"]
