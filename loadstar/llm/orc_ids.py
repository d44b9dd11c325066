"""Token ids as ORC.

Documents are range-partitioned and sorted by id, encoded, and written with
Spark's ORC writer: ids are integer columns (run-length encoded), row indexes
have their own stride, and document ids have a Bloom filter. Readers take
stripes in parallel and skip stripes and row groups by the statistics.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, running_offsets, small
from .packing import _arrow
from .tokens import encoder

_BYTES = 4 << 20
# Pieces that a worker keeps; nothing else of size is in it.
KEEP = 1_000_000


def _encoded(path: str, end_id: int | None, schema: pa.Schema):
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches):
        enc, part, row = encoder(path, KEEP), TaskContext.get().partitionId(), 0
        docs, ids, held = [], [], 0

        def batch():
            ends = np.cumsum([0] + [len(x) // 4 for x in ids], dtype="i8")
            values = np.frombuffer(b"".join(ids), dtype="<i4")
            return pa.RecordBatch.from_arrays([
                pa.array(docs, schema[0].type),
                pa.array(np.full(len(ids), part, dtype="i4")),
                pa.array(np.arange(row - len(ids), row, dtype="i8")),
                pa.ListArray.from_arrays(pa.array(ends.astype("i4")),
                                         pa.array(values)).cast(
                    schema[3].type)], schema=schema)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                docs.append(doc)
                ids.append(enc.encode(text.as_py()) + end)
                held, row = held + len(ids[-1]), row + 1
                if held >= _BYTES:
                    yield batch()
                    docs, ids, held = [], [], 0
        if docs:
            yield batch()
    return run


# Rows after which a stripe's size is looked at; by default 5,000, which very
# long documents would make a stripe of gigabytes.
CHECK_ROWS = 256


def write_ids(docs: DataFrame, path: str, tokenizer: str,
              end_id: int | None = 1, id_col: str = "doc_id",
              text_col: str = "text", index_stride: int = 10_000,
              stripe_bytes: int = 64 << 20, bloom_fpp: float = 0.01,
              compression: str = "lz4") -> str:
    """Write the ids of all documents as ORC below ``path``, ascending by id
    within and across files, and return ``path``.

    File columns: ``id_col``; ``part`` and ``nth`` (the file's place and the
    row's place in it); ``ids`` (array of int).

    * null or empty text: the end id alone; null ids come first
    * repeated rows and ids: each row is written
    * very long texts: encoded whole, one row
    * other columns are ignored; an empty table gives a folder without rows
    """
    python_ready(docs.sparkSession)
    out = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    arrow = pa.schema([
        (id_col, _arrow(out[0].dataType)), ("part", pa.int32()),
        ("nth", pa.int64()),
        ("ids", pa.list_(pa.field("element", pa.int32(), nullable=False)))])
    keys = ["__id", "__at"]
    sorted_ = (docs.select(F.col(id_col).alias("__id"),
                           F.col(text_col).cast("string").alias("__text"),
                           F.monotonically_increasing_id().alias("__at"))
               .repartitionByRange(*keys).sortWithinPartitions(*keys)
               .select("__id", "__text"))
    (sorted_.mapInArrow(_encoded(tokenizer, end_id, arrow), out)
     .write.option("orc.bloom.filter.columns", id_col)
     .option("orc.bloom.filter.fpp", str(bloom_fpp))
     .option("orc.create.index", "true")
     .option("orc.row.index.stride", str(index_stride))
     .option("orc.stripe.size", str(stripe_bytes))
     .option("orc.rows.between.memory.checks", str(CHECK_ROWS))
     .option("compression", compression).orc(path))
    return path


def read_ids(spark: SparkSession, path: str, id_type: T.DataType,
             id_col: str = "doc_id") -> DataFrame:
    """The written rows (a filter on ``id_col`` is answered from the
    statistics and Bloom filters where it can be)."""
    return spark.read.schema(T.StructType([
        T.StructField(id_col, id_type),
        T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()))])).orc(path)


def _digests(schema: pa.Schema):
    def run(batches):
        for b in batches:
            col = b.column(3)
            ends = col.offsets.to_numpy().astype("i8")
            values = col.values.to_numpy(zero_copy_only=False).astype(
                "<u4", copy=False)
            crc = [zlib.crc32(values[s:e]) for s, e in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2),
                 pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                schema=schema)
    return run


def positions(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files of :func:`write_ids`: ``id_col``,
    ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    (of its ids as little-endian unsigned 32-bit integers).

    Only these numbers are shuffled: a running sum within each file, plus the
    total of the files before it."""
    python_ready(files.sparkSession)
    kind = files.schema[id_col].dataType
    out = T.StructType([
        T.StructField(id_col, kind), T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType())])
    arrow = pa.schema([(id_col, _arrow(kind)), ("part", pa.int32()),
                       ("nth", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids_crc32", pa.int64())])
    rows = files.select(id_col, "part", "nth", "ids").mapInArrow(
        _digests(arrow), out)
    before = Window.partitionBy("part").orderBy("nth").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("__in", F.coalesce(
        F.sum("n_tokens").over(before), F.lit(0)))
    sizes = files.groupBy("part").agg(
        F.sum(F.size("ids").cast("long")).alias("__all"))
    sizes = running_offsets(sizes, "part", "__all", "__before")
    parts = files.select("part").distinct().count()
    return rows.join(small(sizes.select("part", "__before"), parts),
                     "part").select(
        id_col, (F.col("__before") + F.col("__in")).cast("long")
        .alias("start"), "n_tokens", "ids_crc32")
