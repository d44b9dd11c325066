"""Hot keys: one key holds a third of all rows. Results must be whole and
right, and every key-grouping operator must combine rows inside each map
task before its shuffle (a partial aggregate under the exchange), never
ship raw rows of a key to one task through a join or a window."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from loadstar.operators import cdc, clean, quality

T0 = dt.datetime(2026, 1, 1)
N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    # a third of all rows on key "HOT"; the rest spread over 10,000 keys
    return (spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .otherwise((F.col("id") % 10000).cast("string")).alias("order_id"),
        F.when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise((F.col("id") % 97).cast("string")).alias("customer_id"),
        (F.col("id") % 1000).cast("decimal(10,2)").alias("price"),
        F.col("id").alias("_row")).repartition(8))


def plan_of(df):
    """The final (adaptive) physical plan, after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def assert_partial_before_shuffle(plan):
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        # every hash exchange on a key sits on top of a partial aggregate
        if "Exchange hashpartitioning" in line:
            below = "\n".join(lines[i + 1:i + 4])
            assert re.search(r"(HashAggregate|SortAggregate)", below), \
                f"no partial aggregate under: {line}"
        # a join only ever sees per-key aggregates of the child, not rows
        if "SortMergeJoin" in line or "ShuffledHashJoin" in line:
            child = "\n".join(lines[i + 1:i + 4])
            assert "HashAggregate" in child, f"join over raw rows: {line}"
    assert "Window" not in plan


def test_keep_first_on_hot_key(skewed):
    out = clean.dedupe(skewed, subset=["order_id"], order_by=["_row"])
    hot = out.filter(F.col("order_id") == "HOT").collect()
    assert len(hot) == 1 and hot[0]._row == 0
    assert out.count() == 1 + len({i % 10000 for i in range(N) if i % 3})
    assert_partial_before_shuffle(plan_of(out))


def test_latest_change_on_hot_key(skewed):
    chg = skewed.select("order_id", F.lit(T0).alias("changed_at"),
                        F.col("_row").alias("change_id"), "price")
    out = cdc.latest(chg, "order_id")
    assert out.filter(F.col("order_id") == "HOT").first().change_id == \
        max(i for i in range(N) if i % 3 == 0)
    assert_partial_before_shuffle(plan_of(out))


def test_validator_and_duplicates_on_hot_key(skewed):
    v = quality.validate_first_failure(skewed).first()
    assert v.error_message == "Missing required fields found"
    assert_partial_before_shuffle(plan_of(
        quality.validate_first_failure(skewed)))
    keys = quality.duplicate_keys(skewed)
    assert keys.filter(F.col("order_id") == "HOT").first().row_count == \
        len(range(0, N, 3))
    assert_partial_before_shuffle(plan_of(keys))


def test_orphans_with_hot_child_key(spark, skewed):
    parents = spark.createDataFrame([(str(i),) for i in range(50)],
                                    "customer_id string")
    got = quality.orphan_count(skewed, parents, ["customer_id"]).first()[1]
    want = sum(1 for i in range(N)
               if i % 7 == 0 or (i % 97) >= 50)
    assert got == want
    assert_partial_before_shuffle(plan_of(
        quality.orphan_count(skewed, parents, ["customer_id"])))


def test_diff_and_apply_with_hot_key(spark, skewed):
    old = skewed.select("order_id", "price")
    new = old.withColumn("price", F.col("price") + 1)
    d = cdc.diff(old, new, "order_id", T0)
    assert d.filter(F.col("change_type") == "UPDATE").count() == \
        old.select("order_id").distinct().count()
    assert_partial_before_shuffle(plan_of(d))


def test_median_with_hot_value(spark, skewed):
    import statistics
    vals = [i % 1000 for i in range(N)] + [500] * (N // 2)
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    assert clean.exact_median(df, "x") == statistics.median(vals)
