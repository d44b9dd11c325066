"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces whose lengths are powers of two (as
many of ``max_len`` as fit, then the binary digits of the rest, longest
first). A piece is a sequence of its own, so no sequence crosses documents
and none needs padding; sequences of equal length form one bucket with
consecutive sequence ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, running_offsets, small, stage
from .tokens import KEEP, encoder

# Output rows (and bytes of ids) gathered in a worker before they go out.
_ROWS, _BYTES = 8192, 4 << 20


def lengths(n: int, max_len: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids."""
    whole, rest = divmod(n, max_len)
    return [max_len] * whole + [1 << b for b in range(
        max_len.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cut(path: str, end_id: int | None, max_len: int, schema: pa.Schema,
         keep: int):
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches):
        enc, part = encoder(path, keep), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        rows: list[tuple] = []
        held = 0

        def batch():
            cols = list(zip(*rows)) or [[]] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)],
                schema=schema)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.encode(text.as_py()) + end
                n, start = len(ids) // 4, 0
                for k in lengths(n, max_len):
                    nth = seen.get(k, 0)
                    seen[k] = nth + 1
                    rows.append((doc, start, k,
                                 ids[4 * start:4 * (start + k)], n, part, nth))
                    start += k
                held += len(ids)
                if len(rows) >= _ROWS or held >= _BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()
    return run


def pack(docs: DataFrame, tokenizer: str, max_len: int = 2048,
         end_id: int | None = 1, id_col: str = "doc_id",
         text_col: str = "text", keep: int = KEEP) -> DataFrame:
    """Token pieces of all documents: ``id_col``, ``start``, ``length``,
    ``tokens`` (little-endian unsigned 32-bit ids), ``doc_tokens``,
    ``sequence_id`` (dense, longest bucket first), ``offset`` (always 0).
    ``keep``: words whose ids a worker keeps (about 230 bytes each).

    * null or empty text: the end id alone (nothing if ``end_id`` is None)
    * null id, repeated rows: each row is packed as a document of its own
    * very long texts: encoded whole; no limit on pieces
    * other columns of ``docs`` are ignored; an empty table gives no rows

    Texts are encoded once and never shuffled: pieces are written in the
    order and partitions of the input with their place among the pieces of
    that length in the task, and a count per (length, task) turns places into
    dense ids."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    spark = docs.sparkSession
    python_ready(spark)
    out = T.StructType([
        T.StructField("__doc", docs.schema[id_col].dataType),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("tokens", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("__part", T.IntegerType()),
        T.StructField("__nth", T.LongType())])
    arrow = pa.schema([
        (f.name, t) for f, t in zip(out, [
            _arrow(out[0].dataType), pa.int64(), pa.int64(), pa.binary(),
            pa.int64(), pa.int32(), pa.int64()])])
    pieces = docs.select(F.col(id_col), F.col(text_col).cast("string")) \
        .mapInArrow(_cut(tokenizer, end_id, max_len, arrow, keep), out)
    held = stage(pieces, "packed")
    counts = held.groupBy("length", "__part").agg(
        F.count(F.lit(1)).alias("__n"))
    counts = running_offsets(counts, "__part", "__n", "__before", "length")
    # at most log2(max_len) + 1 lengths
    bucket = counts.groupBy("length").agg(F.sum("__n").alias("__all"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, -1)
    bucket = bucket.select("length", F.coalesce(
        F.sum("__all").over(longer), F.lit(0)).alias("__longer"))
    base = counts.join(F.broadcast(bucket), "length").select(
        "length", "__part", (F.col("__before") + F.col("__longer"))
        .alias("__base"))
    base = stage(base, "packed-base")
    return held.join(small(base, base.count()), ["length", "__part"]).select(
        F.col("__doc").alias(id_col), "start", "length", "tokens",
        "doc_tokens",
        (F.col("__base") + F.col("__nth")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def unpack(tokens: bytes) -> np.ndarray:
    """Ids of a piece."""
    return np.frombuffer(tokens, dtype="<u4")
