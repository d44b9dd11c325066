import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadstar.llm import bitplanes as bp

SCHEMA = "vec_id bigint, embedding array<double>, cluster int, __x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA)


def plain(rows, clusters=8, rounds=10):
    """The contract in plain whole numbers."""
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64
            and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(
        f"3:{r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in first[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k)
                   for k, c in enumerate(at))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        at = [[sum(x) // len(x) for x in zip(*(
            v for (_, v), o in zip(kept, own) if o == k))] or c
            for k, c in enumerate(at)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    sums = {k: sum(d for _, o, d in out if o == k) for _, k, _ in out}
    return sorted([(-1 if i is None else i, k, d, sums[k],
                    sum(sums.values()), hashlib.sha256(
        ",".join(map(str, at[k])).encode()).hexdigest()) for i, k, d in out])


def rows_of(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in
                  map(tuple, df.collect()))


def test_planes_and_dots_are_exact():
    rng = np.random.default_rng(4)
    for bits in [2, 3, 12, 28]:
        top = 1 << (bits - 1)
        x = rng.integers(-top, top, (50, 64))
        x[0], x[1] = -top, top - 1
        p = bp.to_planes(x, bits)
        assert (bp.from_planes(p) == x).all()
        assert (bp.dots(p, p[:9]) == x @ x[:9].T).all()
        assert (bp.norms(p) == (x * x).sum(axis=1)).all()


def test_clusters_equal_plain_whole_numbers(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 64))
    rows = [(i, (centres[i % 5] + rng.normal(size=64) / 3).tolist())
            for i in range(120)]
    # a hot vector, repeated rows and ids, ties
    rows += [(500 + i, rows[0][1]) for i in range(60)] + rows[3:6]
    rows += [(None, rows[7][1])]
    junk = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65),
            (904, [float("nan")] * 64), (905, [float("inf")] + [0.0] * 63),
            (906, [None] + [0.0] * 63)]
    df = frame(spark, rows + junk)
    assert rows_of(bp.cluster(df.repartition(5))) == plain(rows)
    assert rows_of(bp.cluster(df.repartition(3, F.rand(1)))) == plain(rows)


def test_equal_vectors_leave_clusters_empty(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(20)]
    assert rows_of(bp.cluster(frame(spark, rows))) == plain(rows)


def test_few_or_no_vectors(spark):
    rows = [(i, [float(i), -0.5] * 32) for i in range(3)]
    assert rows_of(bp.cluster(frame(spark, rows))) == plain(rows)
    empty = bp.cluster(frame(spark, []))
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "cluster"]


def test_components_beyond_exact_range(spark):
    with pytest.raises(OverflowError):
        bp.cluster(frame(spark, [(1, [1e9] * 64)]))


def test_query_on_the_given_table(spark):
    import __spark_entry__ as entry
    from conftest import SF001

    got = rows_of(entry.queries()["op12_centroid_clusters"](spark, SF001))
    rows = [(r[0], r[1]) for r in spark.read.parquet(
        f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got == plain(rows)
