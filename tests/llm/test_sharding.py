import numpy as np
import pytest
from pyspark.sql import functions as F

from loadstar.llm import sharding

from .helpers import docs


def test_permutation_and_inverse():
    for n in [1, 2, 3, 4, 5, 15, 16, 17, 100, 1000, 4097, 70_001]:
        rows = np.arange(n)
        pos = sharding.position(rows, n, 5)
        assert sorted(pos.tolist()) == list(range(n))
        assert (sharding.row_at(pos, n, 5) == rows).all()
    assert (sharding.position(np.arange(500), 500, 1)
            != sharding.position(np.arange(500), 500, 2)).any()


def test_shuffle_spreads_neighbours():
    pos = sharding.position(np.arange(20_000), 20_000, 3)
    assert abs(np.corrcoef(np.arange(20_000), pos)[0, 1]) < 0.05
    counts = np.bincount(pos[:1600] % 16, minlength=16)
    assert counts.min() > 50


def test_shards_and_slots(spark):
    rows = [(i, f"t{i}") for i in range(203)] + [(None, None)] * 3 + [
        (5, "t5")] * 40
    df = docs(spark, rows, extra=("shard", "slot"))
    got = sharding.assign(df.repartition(4), 16, 9).collect()
    n = len(rows)
    assert sorted(r["row_number"] for r in got) == list(range(n))
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert sharding.row_of(r["shard"], r["slot"], n, 16, 9) == r["row_number"]
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    ordered = [r["doc_id"] for r in sorted(got, key=lambda r: r["row_number"])]
    assert ordered[:3] == [None] * 3 and ordered[3:] == sorted(ordered[3:])


def test_same_shards_however_the_rows_lie(spark):
    df = docs(spark, [(i, str(i)) for i in range(300)])
    a = sharding.assign(df.repartition(3), 16, 1)
    b = sharding.assign(df.repartition(7, F.rand(3)), 16, 1)
    key = ["doc_id", "shard", "slot"]
    assert sorted(map(tuple, a.select(key).collect())) == sorted(
        map(tuple, b.select(key).collect()))


def test_empty_and_bad_count(spark):
    assert sharding.assign(docs(spark, []), 16).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(docs(spark, []), 0)
