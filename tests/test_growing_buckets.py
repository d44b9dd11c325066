"""Key buckets that grow, and batches that apply as a whole or not at all."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from loadstar.operators import cdc
from loadstar.streaming import buckets, ingest


def merge(cur, chg):
    return cdc.apply_changes(cur, chg, "k")


def table(spark, lo, hi, v=0):
    return spark.range(lo, hi).select(
        F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(v).alias("v"))


def changes(old, new, at=1):
    return cdc.diff(old, new, "k", dt.datetime(2026, 1, at))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def leaves(spark, t):
    return {(r.depth, r.value): (r.folder, r.rows)
            for r in buckets.version(spark, t).leaves.collect()}


def test_buckets_stay_bounded_as_the_table_grows(spark, tmp):
    t = os.path.join(tmp, "t")
    have = table(spark, 0, 500)
    buckets.write_table(have, t, "k", bucket_rows=400)
    assert len(leaves(spark, t)) == 2
    for lo, hi in ((500, 700), (700, 4000)):
        more = table(spark, lo, hi)
        buckets.apply_batch(spark, t, changes(have.limit(0), more), merge)
        have = have.unionByName(more)
        got = leaves(spark, t)
        assert max(n for _, n in got.values()) <= 400
        assert sum(n for _, n in got.values()) == hi
        # the buckets are all of the hash space, once
        assert sum(2.0 ** -d for d, _ in got) == 1
        assert rows(buckets.read_table(spark, t)) == rows(have)


def test_only_touched_buckets_are_split_and_written(spark, tmp):
    t = os.path.join(tmp, "t")
    old = table(spark, 0, 2000)
    buckets.write_table(old, t, "k", bucket_rows=200)
    before = leaves(spark, t)
    new = old.withColumn("v", F.when(F.col("k") == "k7", -7).otherwise(
        F.col("v"))).filter(F.col("k") != "k8")
    buckets.apply_batch(spark, t, changes(old, new), merge)
    after = leaves(spark, t)
    assert rows(buckets.read_table(spark, t)) == rows(new)
    assert 1 <= sum(before[b] != after.get(b) for b in before) <= 2
    # what was superseded two versions ago is gone, the rest stays
    buckets.apply_batch(spark, t, changes(new, old, 2), merge)
    named = {f"{f}/_leaf={d}-{v}" for n in (1, 2) for d, v, f in (
        (r.depth, r.value, r.folder) for r in buckets.version(
            spark, t, n).leaves.collect()) if f}
    found = {os.path.relpath(p, t + "/data")
             for p in glob.glob(t + "/data/*/_leaf=*")}
    assert found == named
    assert rows(buckets.read_table(spark, t, 1)) == rows(new)
    assert rows(buckets.read_table(spark, t)) == rows(old)


def test_a_reader_keeps_its_version_and_a_crash_changes_nothing(
        spark, tmp, monkeypatch):
    t = os.path.join(tmp, "t")
    old, new = table(spark, 0, 300), table(spark, 100, 600, 1)
    buckets.write_table(old, t, "k", bucket_rows=100)
    reader = buckets.read_table(spark, t)
    chg = changes(old, new)

    def crash(*a):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(buckets, "_commit", crash)
        with pytest.raises(RuntimeError, match="lost"):
            buckets.apply_batch(spark, t, chg, merge, "s", 0)
    assert rows(buckets.read_table(spark, t)) == rows(old)
    assert buckets.apply_batch(spark, t, chg, merge, "s", 0) == 1
    assert rows(reader) == rows(old)
    assert rows(buckets.read_table(spark, t)) == rows(new)
    # a manifest that was not finished is no version
    os.makedirs(t + "/_manifest/v=2")
    assert rows(buckets.read_table(spark, t)) == rows(new)
    # the crashed write is gone
    assert len(os.listdir(t + "/data")) == 2
    # replayed: applied already; another stream's first batch is another batch
    add = changes(old.limit(0), table(spark, 900, 901), 2)
    assert buckets.apply_batch(spark, t, add, merge, "s", 0) == 1
    assert buckets.apply_batch(spark, t, add, merge, "other", 0) == 2
    assert buckets.read_table(spark, t).count() == 501


def test_empty_tables_deletes_nulls_and_types(spark, tmp):
    t = os.path.join(tmp, "t")
    # names that the directory has, too
    empty = spark.createDataFrame([], "k bigint, value string")
    buckets.write_table(empty, t, "k", bucket_rows=10)
    assert buckets.read_table(spark, t).schema.names == ["k", "value"]
    assert buckets.read_table(spark, t).count() == 0
    some = spark.createDataFrame([(1, "x"), (2, None)], empty.schema)
    # keys arrive as text; they hash as the table's type
    log = changes(empty, some).withColumn("k", F.col("k").cast("string"))
    assert buckets.apply_batch(spark, t, log.limit(0), merge) == 0
    buckets.apply_batch(spark, t, log, merge)
    assert rows(buckets.read_table(spark, t)) == [(1, "x"), (2, None)]
    buckets.apply_batch(spark, t, changes(some, empty, 2), merge)
    assert rows(buckets.read_table(spark, t)) == []
    with pytest.raises(ValueError, match="already"):
        buckets.write_table(some, t, "k")
    with pytest.raises(ValueError, match="_leaf"):
        buckets.write_table(some.withColumn("_leaf", F.lit(1)), t + "2", "k")
    nulls = os.path.join(tmp, "n")
    buckets.write_table(spark.createDataFrame([(None, "y"), (1, "x")],
                                              some.schema), nulls, "k", 1)
    assert buckets.read_table(spark, nulls).count() == 2


def test_stream_and_older_layout(spark, tmp):
    t, log = os.path.join(tmp, "t"), os.path.join(tmp, "log")
    old, new = table(spark, 0, 300), table(spark, 50, 700, 1)
    ingest.write_buckets(old, t + "_old", "k", 4)
    assert rows(buckets.read_table(spark, t + "_old")) == rows(old)
    buckets.write_table(buckets.read_table(spark, t + "_old"), t, "k", 100)
    chg = changes(old, new)
    chg.repartition(3).write.json(log)
    stream = spark.readStream.schema(chg.schema).option(
        "maxFilesPerTrigger", 1).json(log)
    last = buckets.apply_change_stream(spark, stream, t, tmp + "/ck", merge)
    assert last == 3
    assert rows(buckets.read_table(spark, t)) == rows(new)
    assert list(buckets.version(spark, t).epochs.values()) == [2]
