"""Change ids in sequence, and the diff by row hashes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loadstar.operators import cdc

NOW = dt.datetime(2026, 1, 1)
SCHEMA = "k string, a double, b string, c array<int>"


def changes(spark, n, value="x"):
    return spark.range(0, n, 1, 5).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("INSERT").alias("change_type"),
        F.lit(NOW).cast("timestamp_ntz").alias("changed_at"),
        F.lit(None).cast("string").alias("old_values"),
        F.concat(F.lit('{"order_id":"'), "id", F.lit(f'","v":"{value}"}}'))
        .alias("new_values"))


def ids(spark, log):
    return sorted(r[0] for r in cdc.read_changes(spark, log).select(
        "change_id").collect())


def test_ids_follow_each_other_over_appends(spark, tmp_path):
    log = str(tmp_path / "log")
    assert cdc.append_changes(changes(spark, 23), log) == 23
    assert cdc.append_changes(changes(spark, 0), log) == 23
    assert cdc.append_changes(changes(spark, 10, "y"), log) == 33
    assert ids(spark, log) == list(range(1, 34))
    late = cdc.read_changes(spark, log).filter("new_values LIKE '%y%'")
    assert late.agg(F.min("change_id")).first()[0] == 24
    table = spark.createDataFrame([], "order_id string, v string")
    got = cdc.apply_changes(table, cdc.read_changes(spark, log), "order_id")
    assert got.filter("v = 'y'").count() == 10 and got.count() == 23


def test_rows_without_a_mark_still_count(spark, tmp_path):
    log = str(tmp_path / "log")
    cdc.append_changes(changes(spark, 5), log)
    # the writer stops between rows and mark
    cdc.read_changes(spark, log).withColumn(
        "change_id", F.col("change_id") + 5).write.mode("append").parquet(log)
    assert cdc.append_changes(changes(spark, 2), log) == 12
    assert ids(spark, log) == list(range(1, 13))


def test_ids_in_a_given_order(spark, tmp_path):
    log = str(tmp_path / "log")
    cdc.append_changes(changes(spark, 40).withColumn(
        "n", -F.col("order_id").cast("int")), log, order_by=["n"])
    got = {r["order_id"]: r["change_id"] for r in
           cdc.read_changes(spark, log).collect()}
    assert got == {str(39 - i): i + 1 for i in range(40)}


def test_ids_that_were_no_sequence(spark, tmp_path):
    log = str(tmp_path / "log")
    changes(spark, 1).withColumn("change_id", F.lit((1 << 62) + 5)).select(
        *[f.name for f in cdc.CHANGE_LOG_SCHEMA]).write.parquet(log)
    with pytest.raises(ValueError):
        cdc.append_changes(changes(spark, 1), log)


def row_diff(old, new):
    """Key → kind, the largest row of a key standing for it."""
    def top(rows):
        out = {}
        for r in rows:
            rank = [(v is not None, v if v is not None else 0) for v in r[1:]]
            if r[0] not in out or rank > out[r[0]][0]:
                out[r[0]] = (rank, r)
        return {k: v[1] for k, v in out.items()}
    o, n = top(old), top(new)
    return {k: "INSERT" if k not in o else "DELETE" if k not in n else
            "UPDATE" for k in {*o, *n} if o.get(k) != n.get(k)}


def test_diff_by_row_hashes(spark):
    rng = random.Random(4)

    def some():
        return [(rng.choice([None, *"abcdefghijkl"]),
                 rng.choice([None, 0.0, 1.5]), rng.choice([None, "x", "y"]),
                 rng.choice([None, [1], [1, 2]])) for _ in range(14)]
    for _ in range(4):
        old, new = some(), some()
        new += old[:7]
        got = cdc.diff(spark.createDataFrame(old, SCHEMA),
                       spark.createDataFrame(new, SCHEMA), "k", NOW)
        assert {r["k"]: r["change_type"] for r in got.collect()} == row_diff(
            old, new)


def test_nulls_count_with_their_place(spark):
    old = spark.createDataFrame([("a", 1.0, None, None)], SCHEMA)
    new = spark.createDataFrame([("a", None, "1.0", None)], SCHEMA)
    assert cdc.diff(old, new, "k", NOW).first()["change_type"] == "UPDATE"
    zero = spark.createDataFrame([("a", 0.0, None, None)], SCHEMA)
    other = spark.createDataFrame([("a", -0.0, None, None)], SCHEMA)
    assert cdc.diff(zero, other, "k", NOW).count() == 0


def test_first_pass_holds_no_rows(spark):
    old = spark.range(100).select(F.col("id").alias("k"),
                                  F.col("id").cast("string").alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == 7, "z").otherwise(
        F.col("v")))
    plan = cdc.differing_keys(old, new, "k", ["k", "v"])
    assert "SortAggregate" not in \
        plan._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in plan.collect()] == [7]
