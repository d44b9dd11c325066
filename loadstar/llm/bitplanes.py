"""Centroid clustering by bit planes.

A vector has 64 integer components. Bit p of all components is one unsigned
64-bit word, plane p; the highest plane holds the sign (two's complement) and
weighs -2**p. Hence, with w the weights of the planes,

    x . y = sum over p, q of w[p] * w[q] * popcount(x[p] & y[q])

is the exact dot product, and |x|^2 - 2 x.c + |c|^2 the exact squared distance
to a centroid c. Sums of a cluster's components come from the planes too: the
number of members with bit p of component d, times w[p].
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_staged, python_ready, small, stage

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
# Components of more bits would let a squared distance pass 63 bits.
MOST_BITS = 28
# Vectors whose planes are worked on at once.
_ROWS = 4096


def plane_weights(bits: int) -> np.ndarray:
    w = 1 << np.arange(bits, dtype="i8")
    w[-1] = -w[-1]
    return w


def to_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64) integers → (n, bits) unsigned 64-bit planes."""
    one = (values[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(one.astype("u1"), axis=2, bitorder="little").view(
        "<u8")[:, :, 0]


def from_planes(planes: np.ndarray) -> np.ndarray:
    """(n, bits) planes → (n, 64) integers."""
    return np.einsum("npd,p->nd", _bits(planes).astype("i8"),
                     plane_weights(planes.shape[1]))


def _bits(planes: np.ndarray) -> np.ndarray:
    """(n, bits) planes → (n, bits, 64) zeros and ones."""
    return np.unpackbits(
        np.ascontiguousarray(planes, "<u8")[:, :, None].view("u1"), axis=2,
        bitorder="little")


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of every row of planes ``x`` with every row of
    planes ``c``."""
    w = plane_weights(x.shape[1])
    out = np.empty((len(x), len(c)), dtype="i8")
    for k, planes in enumerate(c):
        both = np.bitwise_count(x[:, :, None] & planes).astype("i8")
        out[:, k] = (both @ w) @ w
    return out


def norms(x: np.ndarray) -> np.ndarray:
    w = plane_weights(x.shape[1])
    both = np.bitwise_count(x[:, :, None] & x[:, None, :]).astype("i8")
    return (both @ w) @ w


def assign_planes(x: np.ndarray, own: np.ndarray, c: np.ndarray,
                  c_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared
    distance to it."""
    far = own[:, None] + c_norms[None, :] - 2 * dots(x, c)
    at = far.argmin(axis=1)
    return at.astype("i4"), far[np.arange(len(x)), at]


def _whole(components: Column, scale: int) -> Column:
    """floor(scale * component) as exact integers."""
    return F.transform(components, lambda x: F.floor(
        x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(df: DataFrame, vec_col: str, dims: int = DIMS) -> DataFrame:
    """Rows whose vector has exactly ``dims`` components, none of them null,
    NaN or infinite."""
    def finite(x: Column) -> Column:
        d = x.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))
    v = F.col(vec_col)
    return df.filter(v.isNotNull() & (F.size(v) == dims)
                     & F.coalesce(F.forall(v, finite), F.lit(False)))


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` numbers each as the rows of a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _packed(bits: int, schema: pa.Schema):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                b = whole.slice(at, _ROWS)
                planes = to_planes(_matrix(b.column(1), DIMS), bits)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(norms(planes)),
                     _lists(planes.view("i8"))], schema=schema)
    return run


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, (n + 1) * width, width, dtype="i4")),
        pa.array(np.ascontiguousarray(rows).reshape(-1)))


def _read(b: pa.RecordBatch, bits: int):
    for at in range(0, b.num_rows, _ROWS):
        part = b.slice(at, _ROWS)
        yield (part, _matrix(part.column(2), bits).view("u8"),
               part.column(1).to_numpy(zero_copy_only=False))


def _summed(centroids: np.ndarray):
    """Per task and centroid: members and sums of their components."""
    bits, c_norms = centroids.shape[1], norms(centroids)
    w = plane_weights(bits)

    def run(batches):
        count = np.zeros(len(centroids), dtype="i8")
        ones = np.zeros((len(centroids), bits, DIMS), dtype="i8")
        for b in batches:
            for _, x, own in _read(b, bits):
                at, _ = assign_planes(x, own, centroids, c_norms)
                one = _bits(x)
                for k in np.unique(at):
                    mine = at == k
                    count[k] += mine.sum()
                    ones[k] += one[mine].sum(axis=0, dtype="i8")
        held = np.flatnonzero(count)
        sums = np.einsum("kpd,p->kd", ones[held], w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype("i4")), pa.array(count[held]),
             _lists(sums)], names=["cluster", "n", "sums"])
    return run


def _placed(centroids: np.ndarray, schema: pa.Schema):
    bits, c_norms = centroids.shape[1], norms(centroids)

    def run(batches):
        for b in batches:
            for part, x, own in _read(b, bits):
                at, far = assign_planes(x, own, centroids, c_norms)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(at), pa.array(far)],
                    schema=schema)
    return run


def _start(whole: DataFrame, id_col: str, clusters: int, seed: int
           ) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; equal hashes
    (repeated ids) in the order of their components, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))
                 .cast("binary"), 256)
    rows = (whole.select(key.alias("h"), "__x")
            .orderBy(F.col("h").asc_nulls_last(), "__x").limit(clusters)
            .collect())
    return np.array([r["__x"] for r in rows], dtype="i8").reshape(-1, DIMS)


def cluster(df: DataFrame, id_col: str = "vec_id",
            vec_col: str = "embedding", clusters: int = CLUSTERS,
            rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED
            ) -> DataFrame:
    """Lloyd's algorithm in whole numbers over all usable vectors. One row per
    vector: ``id_col``, ``cluster``, ``distance`` (squared, to its final
    centroid), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    A component x becomes floor(scale * x). Centroids start as the vectors of
    the smallest sha256 of "seed:id"; a round assigns every vector to the
    nearest centroid (ties: the smaller number) and moves each centroid that
    has vectors to the componentwise floor(sum / count); after the last round
    vectors are assigned once more.

    * null vectors, other lengths than 64, null, NaN or infinite components:
      no row
    * null ids: clustered as others, last in the choice of the start
    * repeated rows and ids: each row is a vector of its own
    * fewer vectors than ``clusters``: as many centroids as vectors; an empty
      table gives no rows
    * a component of more than 28 bits as an integer: ``OverflowError``, since
      squared distances would pass 63 bits
    * other columns are ignored, whatever their names

    Vectors are written once as planes. Each round reads them in parallel and
    gathers one row per task and centroid, added up by Spark; only the
    centroids reach the driver and the workers."""
    spark = df.sparkSession
    python_ready(spark)
    whole = usable(df, vec_col).select(
        F.col(id_col), _whole(F.col(vec_col), scale).alias("__x"))
    lo, hi = whole.agg(F.min(F.array_min("__x")), F.max(F.array_max("__x"))
                       ).first()
    bits = 1 if lo is None else max(int(lo if lo >= 0 else ~lo).bit_length(),
                                    int(hi if hi >= 0 else ~hi).bit_length()) + 1
    if bits > MOST_BITS:
        raise OverflowError(f"components need {bits} bits; at most "
                            f"{MOST_BITS} keep distances exact")
    kind = whole.schema[id_col]
    out = T.StructType([kind, T.StructField("__own", T.LongType()),
                        T.StructField("__planes", T.ArrayType(T.LongType()))])
    planes = stage(whole.mapInArrow(_packed(bits, _arrow(out)), out), "planes")
    at = _start(whole, id_col, clusters, seed)
    for _ in range(rounds if len(at) else 0):
        moved = planes.mapInArrow(
            _summed(to_planes(at, bits)),
            "cluster int, n bigint, sums array<bigint>")
        # at most 64 rows per centroid
        for r in moved.select("cluster", "n", F.posexplode("sums")).groupBy(
                "cluster", "pos").agg(
                F.sum("n").alias("n"),
                F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect():
            at[r["cluster"], r["pos"]] = int(r["s"]) // r["n"]
    out = T.StructType([kind, T.StructField("cluster", T.IntegerType()),
                        T.StructField("distance", T.LongType())])
    placed = stage(planes.mapInArrow(
        _placed(to_planes(at, bits), _arrow(out)), out), "placed")
    drop_staged(planes)
    # at most one row per centroid
    sums = {r["cluster"]: int(r["far"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("far")).collect()}
    known = spark.createDataFrame(
        [(k, far, sum(sums.values()), hashlib.sha256(
            ",".join(map(str, at[k].tolist())).encode()).hexdigest())
         for k, far in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, "
        "centroid_sha256 string")
    return placed.join(small(known, len(at)), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def cluster_sql(rel: str, clusters: int = CLUSTERS, rounds: int = ROUNDS,
                scale: int = SCALE, seed: int = SEED) -> str:
    """DuckDB SQL for :func:`cluster` with the default column names (unique
    ids), one pair of common table expressions a round."""
    def nearest(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (SELECT vec_id, x,
    arg_min(cluster, (far, cluster)) AS cluster, min(far) AS far
    FROM (SELECT vec_id, x, cluster, list_sum(list_transform(
        range(1, {DIMS + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])
      ))::BIGINT AS far FROM kept, c{r}) GROUP BY vec_id, x)"""

    def moved(r: int) -> str:
        return f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster,
    coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (SELECT cluster,
      list(v ORDER BY i) AS c FROM (SELECT cluster, i,
        sum(x[i])::BIGINT // count(*) - CASE WHEN sum(x[i])::BIGINT < 0
          AND sum(x[i])::BIGINT % count(*) <> 0 THEN 1 ELSE 0 END AS v
        FROM a{r}, range(1, {DIMS + 1}) t(i) GROUP BY cluster, i)
      GROUP BY cluster) m USING (cluster))"""
    steps = ",\n".join(f"{nearest(r)},\n{moved(r)}" for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding,
    lambda v: floor({scale} * v::DOUBLE)::BIGINT) AS x FROM {rel}
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding,
    lambda v: v IS NOT NULL AND isfinite(v::DOUBLE))) = {DIMS}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER
    AS cluster, x AS c FROM (SELECT sha256('{seed}:' || vec_id) AS h, x
    FROM kept ORDER BY h LIMIT {clusters})),
{steps},
{nearest(rounds)},
sums AS (SELECT cluster, sum(far)::BIGINT AS cluster_inertia
  FROM a{rounds} GROUP BY cluster)
SELECT vec_id, cluster, far AS distance, cluster_inertia,
  (SELECT sum(cluster_inertia)::BIGINT FROM sums) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster) JOIN sums USING (cluster)"""
