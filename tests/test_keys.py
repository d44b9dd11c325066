"""Foreign keys and keys across runs, delivery order, datetime layouts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loadstar.functions.values import ALL_FORMATS
from loadstar.operators import clean, keys
from loadstar.plans.jobspec import JobSpec
from loadstar.plans.loadjob import run, transform
from loadstar.sources.csv import DELIVERED, parse_header, read_csv, read_directory

ITEMS = JobSpec(name="items", table="order_items",
                fill_exclude=("order_id", "product_id"))
CUSTOMERS = JobSpec(name="customers", table="customers",
                    type_mappings={"customer_name": "string"},
                    fill_exclude=("customer_id", "email", "city", "country"))


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bloom_filter_has_no_false_negatives(spark):
    parent = spark.range(5000).select(F.col("id").cast("string").alias("p"))
    child = spark.range(4000, 6000).select(
        F.col("id").cast("string").alias("k")).unionByName(
        spark.createDataFrame([(None,)], "k string"))
    # a hot key of half the rows
    child = child.unionByName(spark.range(2000).select(
        F.lit("9999").alias("k")))
    got = {r[0] for r in keys.missing_keys(child, parent, ["k"], ["p"]
                                           ).collect()}
    assert got == {str(i) for i in range(5000, 6000)} | {"9999"}


@pytest.mark.parametrize("words", [64, 256])
def test_bloom_filter_settles_most(spark, words):
    held = spark.range(200).select("id")
    bloom = keys.bloom_filter(held, words)
    assert bloom.count() <= words
    word, bits = keys._word_and_bits(["id"], words)
    probe = spark.range(0, 10_200).withColumns({"_word": word, "_n": bits}) \
        .join(bloom, "_word", "left").withColumn("may", F.coalesce(
            F.col("_bits").bitwiseAND(F.col("_n")) == F.col("_n"),
            F.lit(False)))
    assert probe.filter("id < 200 AND NOT may").count() == 0
    assert probe.filter("id >= 200 AND may").count() < 2500


def items(spark, rows):
    return spark.createDataFrame(
        rows, "order_id string, product_id string, quantity int")


def test_foreign_keys_on_load(spark, tmp_path):
    orders = spark.createDataFrame([("o1",), ("o2",), (None,)],
                                   "order_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    target = str(tmp_path / "items")
    rows = [("o1", "p1", 1), ("o1", "p9", 1), ("o9", "p1", 1),
            ("o9", "p9", 1), (None, "p1", 1)] + [
        ("o8", "p1", i) for i in range(20)]
    res = run(spark, items(spark, rows), ITEMS, target, run_id="r1",
              reject_target=target + "_rejects",
              parents={"sales_transactions": orders, "products": products})
    assert res.rows_loaded == 1 and res.rows_rejected == 24
    assert values(spark.read.parquet(target), "order_id",
                  "product_id") == [("o1", "p1")]
    got = spark.read.parquet(target + "_rejects").groupBy(
        "reject_reasons").count()
    assert values(got, "reject_reasons", "count") == [
        ("order_id_not_in_sales_transactions", 22),
        ("order_id_not_null", 1), ("product_id_not_in_products", 1)]


def test_parents_by_path_empty_or_not_given(spark, tmp_path):
    target = str(tmp_path / "items")
    (tmp_path / "products").mkdir()
    spark.createDataFrame([], "product_id string").write.mode(
        "overwrite").parquet(str(tmp_path / "products"))
    res = run(spark, items(spark, [("o1", "p1", 1)]), ITEMS, target,
              run_id="r1", parents={"products": str(tmp_path / "products")})
    assert (res.rows_loaded, res.rows_rejected) == (0, 1)
    res = run(spark, items(spark, [("o1", "p1", 1)]), ITEMS, target,
              run_id="r1")
    assert (res.rows_loaded, res.rows_rejected) == (1, 0)


def customers(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id string, customer_name string")


def test_keys_across_runs(spark, tmp_path):
    target = str(tmp_path / "customers")

    def load(run_id, rows):
        return run(spark, customers(spark, rows), CUSTOMERS, target,
                   run_id=run_id, reject_target=target + "_rejects")

    def table():
        return values(spark.read.parquet(target), "customer_id",
                      "customer_name", "run_id")
    load("r1", [("A1", "Z"), ("A2", "Y")])
    res = load("r2", [("A1", "new"), ("A3", "X")])
    assert (res.rows_loaded, res.rows_rejected) == (1, 1)
    first = [("A1", "Z", "r1"), ("A2", "Y", "r1"), ("A3", "X", "r2")]
    assert table() == first
    assert values(spark.read.parquet(target + "_rejects").filter(
        "run_id = 'r2'"), "customer_id", "reject_reasons") == [
        ("A1", "key_in_earlier_run")]
    # the same run again replaces its rows and its part of the index
    load("r1", [("A2", "Y2"), ("A4", "W"), ("A3", "theirs")])
    assert table() == [("A2", "Y2", "r1"), ("A3", "X", "r2"),
                       ("A4", "W", "r1")]
    # A1 is free now, also after a run was emptied
    load("r3", [("A1", "V")])
    load("r1", [])
    res = load("r4", [("A2", "U"), ("A1", "no")])
    assert (res.rows_loaded, res.rows_rejected) == (1, 1)
    assert table() == [("A1", "V", "r3"), ("A2", "U", "r4"),
                       ("A3", "X", "r2")]


def test_index_is_made_for_rows_that_have_none(spark, tmp_path):
    target = str(tmp_path / "customers")
    run(spark, customers(spark, [("A1", "Z")]), CUSTOMERS, target,
        run_id="r1")
    # a crash between the rows and their index part
    keys.forget(spark, [keys.index_path(target)])
    res = run(spark, customers(spark, [("A1", "Y")]), CUSTOMERS, target,
              run_id="r2")
    assert (res.rows_loaded, res.rows_rejected) == (0, 1)


def test_only_touched_buckets_are_read(spark, tmp_path):
    target = str(tmp_path / "customers")
    run(spark, customers(spark, [(f"A{i}", "x") for i in range(500)]),
        CUSTOMERS, target, run_id="r1")
    gone = keys.earlier_keys(customers(spark, [("A7", "x"), ("B7", "x")]),
                             target, "r2", ["customer_id"])
    assert [r[0] for r in gone.collect()] == ["A7"]
    plan = gone._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_first_row_delivered_stays(spark, tmp_path):
    d = str(tmp_path / "in")
    write(f"{d}/1.csv", "id,name", "A1,Z", "A1,B", "A2,M")
    write(f"{d}/2.csv", "name,id", "A,A2", "K,A3", "J,A3")
    got = read_directory(spark, d, with_order=True).data
    out = clean.dedupe(got, ["id"], list(DELIVERED)).drop(*DELIVERED)
    assert values(out, "id", "name") == [("A1", "Z"), ("A2", "M"),
                                         ("A3", "K")]
    spec = JobSpec(name="c", table="none", dedupe_subset=("id",))
    target = str(tmp_path / "table")
    run(spark, d, spec, target, run_id="r1")
    loaded = spark.read.parquet(target)
    assert values(loaded, "id", "name") == values(out, "id", "name")
    assert loaded.columns == ["id", "name", "run_id"]
    with pytest.raises(ValueError, match="order_by"):
        transform(out, spec)


def test_order_holds_over_splits_of_one_file(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    write(path, "id,n", *[f"k{i % 50},{20_000 - i}" for i in range(20_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_csv(spark, path, multi_line=False, with_order=True).data
        assert df.rdd.getNumPartitions() > 4
        out = clean.dedupe(df, ["id"], list(DELIVERED))
        assert values(out, "id", "n") == sorted(
            (f"k{i}", str(20_000 - i)) for i in range(50))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_duplicate_headers_take_free_names(spark, tmp_path):
    assert parse_header("a,a,a_1") == ["a", "a_2", "a_1"]
    assert parse_header("a,A,b") == ["a", "A_1", "b"]
    assert parse_header("a,a,a") == ["a", "a_1", "a_2"]
    write(str(tmp_path / "x.csv"), "a,a,a_1", "1,2,3")
    got = read_csv(spark, str(tmp_path / "x.csv")).data
    assert got.columns == ["a", "a_2", "a_1"]
    assert values(got, *got.columns) == [("1", "2", "3")]


TEXTS = [("2026-01-01 10:30", dt.datetime(2026, 1, 1, 10, 30)),
         ("2026-01-01T10:30:00.123Z", dt.datetime(2026, 1, 1, 10, 30, 0,
                                                  123000)),
         ("2026-01-01 10:30:00.5", dt.datetime(2026, 1, 1, 10, 30, 0, 500000)),
         ("2026-01-01T10:30:00+02:00", dt.datetime(2026, 1, 1, 8, 30)),
         ("2026-01-02", dt.datetime(2026, 1, 2)),
         ("20260103", dt.datetime(2026, 1, 3)),
         ("31/12/2025", dt.datetime(2025, 12, 31)),
         ("2026-13-01", None), ("Unknown", None), ("2026", None), (None, None)]


def test_layouts(spark):
    df = spark.createDataFrame(TEXTS, "t string, want timestamp_ntz")
    got = clean.coerce_types(df, {"t": "datetime"}, ALL_FORMATS)
    assert all(r["t"] == r["want"] for r in got.collect())


def test_layouts_chosen_by_frequency(spark):
    df = spark.createDataFrame([("01/02/2026", "x"), ("25/02/2026", "x"),
                                ("26/02/2026", None)], "a string, b string")
    chosen = clean.choose_layouts(clean.layout_profile(df, ["a", "b", "no"]))
    assert list(chosen["a"].items()) == [("dd/MM/yyyy", 3), ("MM/dd/yyyy", 1),
                                         ("none", 0)]
    assert chosen["b"] == {"none": 2}
    got = clean.coerce_types(df, {"a": "datetime", "b": "datetime"},
                             layouts=chosen)
    assert values(got, "a")[0][0] == dt.datetime(2026, 2, 1)
    assert clean.choose_layouts(clean.layout_profile(
        df.filter("false"), ["a"])) == {"a": {"none": 0}}


def test_run_records_the_layouts(spark, tmp_path):
    spec = JobSpec(name="c", table="none", type_mappings={"d": "datetime"},
                   infer_datetime=True, datetime_formats=ALL_FORMATS)
    df = spark.createDataFrame([("1", "05.06.2026")], "id string, d string")
    target = str(tmp_path / "t")
    res = run(spark, df, spec, target, run_id="r1",
              run_log_target=target + "_log")
    assert res.layouts == {"d": {"dd.MM.yyyy": 1, "none": 0}}
    assert "dd.MM.yyyy" in spark.read.parquet(target + "_log").first()[
        "execution_details"]
