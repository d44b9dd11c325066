"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in id order. A balanced Feistel network over the
smallest even number of bits that holds n permutes the numbers; results of n
or more are walked on through the network until they fall below n (cycle
walking), which keeps it a permutation of 0..n-1. Position p goes to shard
p mod k, slot p div k: counts differ by at most one, slots are gapless, and
both directions can be computed without a table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, python_ready

ROUNDS = 6
# Fixed odd multipliers of the round function (31 bits).
MULT_A, MULT_B = 1_540_483_477, 1_181_783_497
_M31 = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """31-bit keys derived from the seed."""
    return [int.from_bytes(hashlib.sha256(f"{seed}:{r}".encode()).digest()[:4],
                           "little") & _M31 for r in range(rounds)]


def half_bits(n: int) -> int:
    """Bits of one half of the network over ``n`` numbers."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _mix(x, key: int, mask: int):
    """Round function; every product stays below 2**63."""
    y = (x + key) * MULT_A
    y = (y ^ (y >> 29)) & _M31
    return (y * MULT_B >> 13) & mask


def _network(x: np.ndarray, keys: list[int], half: int) -> np.ndarray:
    mask = (1 << half) - 1
    left, right = x >> half, x & mask
    for k in keys:
        left, right = right, left ^ _mix(right, k, mask)
    return left << half | right


def _network_back(x: np.ndarray, keys: list[int], half: int) -> np.ndarray:
    mask = (1 << half) - 1
    left, right = x >> half, x & mask
    for k in reversed(keys):
        left, right = right ^ _mix(left, k, mask), left
    return left << half | right


def _walk(x, n: int, seed: int, step) -> np.ndarray:
    keys, half = round_keys(seed), half_bits(n)
    if half > 31:
        raise ValueError("more than 2**62 rows")
    x = np.asarray(x, dtype=np.int64)
    out = step(x.reshape(-1), keys, half)
    while (far := out >= n).any():
        out[far] = step(out[far], keys, half)
    return out.reshape(x.shape)


def position(row, n: int, seed: int = 0) -> np.ndarray:
    """Position of each row number in the shuffle."""
    return _walk(row, n, seed, _network)


def row_at(pos, n: int, seed: int = 0) -> np.ndarray:
    """Row number at each position (the inverse)."""
    return _walk(pos, n, seed, _network_back)


def row_of(shard, slot, n: int, n_shards: int, seed: int = 0) -> np.ndarray:
    """Row number that lies in a shard's slot."""
    return row_at(np.asarray(slot) * n_shards + np.asarray(shard), n, seed)


def assign(df: DataFrame, n_shards: int, seed: int = 0,
           order: list[Column] | None = None, id_col: str = "doc_id"
           ) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` (int) and ``slot`` (long).

    * null ids come first; equal ids (and fully equal rows) are ordered by
      ``order``'s further columns, then by where they were read
    * an empty table gives no rows; every column of ``df`` is kept, and one
      named like an output column is replaced
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    python_ready(df.sparkSession)
    kept = df.drop("row_number", "shard", "slot")
    rows, n = numbered(kept, order or [F.col(id_col)], "row_number", "shards")

    @F.pandas_udf("long")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(position(x.to_numpy(), n, seed))

    return rows.withColumn("__pos", place("row_number")).withColumns({
        "shard": F.pmod("__pos", F.lit(n_shards)).cast("int"),
        "slot": F.expr(f"__pos div {int(n_shards)}"),
    }).drop("__pos")



def assign_sql(rel: str, n_shards: int, seed: int = 0) -> str:
    """DuckDB SQL for ``doc_id``, ``row_number``, ``shard`` and ``slot`` of a
    relation with unique ``doc_id``: the same network and walk, step by step
    in a recursive query."""
    chain = []
    for i, k in enumerate(round_keys(seed)):
        p = f"((r + {k}) * {MULT_A})"
        y = f"(xor({p}, {p} >> 29) & {_M31})"
        chain.append(
            f"s{i + 1} AS (SELECT d, row_number, half, mask, n, r AS l, "
            f"xor(l, (({y} * {MULT_B}) >> 13) & mask) AS r FROM s{i})")
    return f"""
WITH RECURSIVE walk(d, row_number, half, n, x, steps) AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1,
    greatest(1, (length(bin(greatest(c.n - 1, 1))) + 1) // 2)::BIGINT, c.n,
    row_number() OVER (ORDER BY doc_id) - 1, 0
  FROM {rel}, (SELECT count(*) AS n FROM {rel}) c
  UNION ALL
  SELECT d, row_number, half, n, x, steps + 1 FROM (
    WITH s0 AS (SELECT d, row_number, half, (1::BIGINT << half) - 1 AS mask,
      n, x >> half AS l, x & ((1::BIGINT << half) - 1) AS r, steps FROM walk
      WHERE steps = 0 OR x >= n),
    {", ".join(chain)}
    SELECT z.d, z.row_number, z.half, z.n, (z.l << z.half) | z.r AS x,
      s0.steps FROM s{ROUNDS} z JOIN s0 ON z.d = s0.d))
SELECT d AS doc_id, row_number, (x % {n_shards})::INTEGER AS shard,
  x // {n_shards} AS slot FROM walk WHERE steps > 0 AND x < n"""


def crc_sql(rel: str, text: str = "text") -> str:
    """DuckDB SQL for ``doc_id`` and the CRC-32 of the text's UTF-8 bytes."""
    return f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1
    THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
hexed AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce({text}, ''))),
  '..') AS h FROM {rel})
SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(h, lambda x: ('0x' || x)::BIGINT)),
  lambda c, b: xor(c >> 8, list_extract(t, xor(c & 255, b) + 1))),
  4294967295) AS crc FROM hexed, tab"""
