"""Deliveries, reruns and changes that are not well-formed."""

import decimal
import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF001, write
from loadstar.operators import cdc, clean, quality
from loadstar.plans import lens
from loadstar.plans.jobspec import SALES_JOB
from loadstar.plans.loadjob import run
from loadstar.session import checkpoint_root
from loadstar.sinks import lake
from loadstar.sources.csv import EmptyCsvError, read_csv
from loadstar.streaming import ingest

HEAD = "order_id,customer_id,order_date,product_id,price\n"


def _file(tmp, name, text):
    return write(os.path.join(tmp, name), text)


def test_files_of_a_list_keep_their_own_headers(spark, tmp):
    a = _file(tmp, "a.csv", "order_id,customer_id\n10,C1\n")
    b = _file(tmp, "b.csv", "customer_id,price,order_id\nC2,5,20\n")
    empty = _file(tmp, "c.csv", "")
    got = read_csv(spark, [empty, a, b]).data
    assert {(r.order_id, r.customer_id, r.price) for r in got.collect()} == {
        ("10", "C1", None), ("20", "C2", "5")}
    with pytest.raises(EmptyCsvError):
        read_csv(spark, [empty, empty])


def test_stream_reads_like_a_batch(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    _file(src, "a.csv", 'order_id,price,note\n"1",NA,"two\nlines"\n')
    _file(src, "b.csv", 'price,note,order_id\n5,plain,2\n6,x,3,long\n')
    _file(src, "c.csv", "")
    ingest.ingest_available_now(
        spark, src, ["order_id", "price", "note"], tmp + "/t", tmp + "/ck",
        lambda df: df.select("order_id", "price", "note"),
        reject_target=tmp + "/rej")
    got = spark.read.parquet(tmp + "/t").collect()
    assert {(r.order_id, r.price, r.note) for r in got} == {
        ("1", None, "two\nlines"), ("2", "5", "plain")}
    assert [r.raw_record for r in spark.read.parquet(tmp + "/rej").collect()
            ] == ["6,x,3,long"]


@pytest.mark.parametrize("limit", [1, 4096])
def test_median_among_infinities_and_wide_decimals(spark, limit):
    inf = float("inf")
    df = spark.range(6000).select(F.col("id").cast("double").alias("x"))
    more = df.unionByName(spark.createDataFrame([(inf,)], "x double"))
    assert clean.exact_median(more, "x", fetch_limit=limit) == 3000.0
    split = spark.createDataFrame([(-inf,), (-inf,), (1.0,), (inf,), (inf,)],
                                  "x double")
    assert clean.exact_median(split, "x", fetch_limit=limit) == 1.0
    assert clean.exact_median(split.filter("x <> 1.0"), "x") is None
    assert clean.exact_median(split.filter("x > 0"), "x") == inf
    lead = "9" * 30
    wide = spark.range(6000).select(F.concat(F.lit(lead), F.lpad(
        F.col("id").cast("string"), 8, "0")).cast("decimal(38,0)").alias("x"))
    assert clean.exact_median(wide, "x", fetch_limit=limit) == \
        decimal.Decimal(lead + "00002999.5")
    filled, plan = clean.fill_missing(more.unionByName(
        spark.createDataFrame([(None,)], "x double")))
    assert plan.values == {"x": 3000.0} and (
        plan.nulls_before, plan.nulls_after) == (1, 0)
    assert filled.filter("x is null").count() == 0


def test_integer_median_keeps_its_fraction(spark):
    df = spark.createDataFrame([(1,), (4,), (None,)], "x int")
    filled, _ = clean.fill_missing(df)
    assert sorted(r.x for r in filled.collect()) == [1, 2.5, 4]


def test_run_enforces_the_table(spark, tmp):
    src = _file(tmp, "s.csv", HEAD + "A1,C1,2026-01-02,P1,1.5\n"
                ",C2,2026-01-02,P1,2\nA3,,2026-01-02,P1,2\n"
                "A4,C4,junk,P1,2\n" + "x" * 51 + ",C5,2026-01-02,P1,2\n"
                "A1,C9,2026-01-03,P2,3\n")
    t = tmp + "/t"
    res = run(spark, src, SALES_JOB, t, run_id="r", reject_target=t + "_rej")
    assert (res.status, res.rows_loaded, res.rows_rejected) == ("PARTIAL", 1, 5)
    row = spark.read.parquet(t).first()
    assert row.order_id == "A1" and row.created_at == row.updated_at
    assert dict(spark.read.parquet(t).dtypes)["price"] == "decimal(10,2)"
    why = {r.reject_reasons for r in spark.read.parquet(t + "_rej").collect()}
    assert why == {"order_id_not_null", "customer_id_not_null",
                   "order_date_not_null", "order_id_max_50", "duplicate_key"}


def test_rerun_leaves_nothing_of_the_first_run(spark, tmp):
    bad = _file(tmp, "bad.csv", HEAD + "A1,C1,2026-01-02,P1,-1\n"
                "A2,C1,2026-01-02,P1,3\n")
    good = _file(tmp, "good.csv", HEAD + "A2,C1,2026-01-02,P1,3\n")
    none = _file(tmp, "none.csv", HEAD + "A9,C1,2026-01-02,P1,-5\n")
    t = tmp + "/t"
    seen = []
    for src in (bad, good, none):
        res = run(spark, src, SALES_JOB, t, run_id="x",
                  reject_target=t + "_rej")
        seen.append((res.rows_loaded, res.rows_rejected,
                     lake.row_count(spark, t), lake.row_count(spark, t + "_rej")))
    assert seen == [(1, 1, 1, 1), (1, 0, 1, 0), (0, 1, 0, 1)]
    assert not [f for f in os.listdir(t) if f.startswith((".old", "_new"))]


def test_no_staged_copy_stays(spark, tmp):
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(glob.glob(root + "/dedup-*"))
    src = _file(tmp, "s.csv", HEAD + "A1,C1,2026-01-02,P1,-1\n")
    run(spark, src, SALES_JOB, tmp + "/t", run_id="r")
    with pytest.raises(ValueError):
        run(spark, src, replace(SALES_JOB, on_error="halt"), tmp + "/t")
    assert set(glob.glob(root + "/dedup-*")) == before


def _change(spark, rows):
    return spark.createDataFrame(
        rows, "k string, change_type string, changed_at string, change_id long,"
        "new_values string").withColumn("changed_at", F.col("changed_at").cast(
            "timestamp_ntz"))


def test_late_changes_lose(spark):
    table = spark.createDataFrame([("a", 0), ("b", 0)], "k string, v int")
    batches = [
        _change(spark, [("a", "UPDATE", "2026-01-02", 2, '{"k":"a","v":2}'),
                        ("b", "DELETE", "2026-01-03", 3, None)]),
        _change(spark, [("a", "UPDATE", "2026-01-01", 1, '{"k":"a","v":1}'),
                        ("b", "INSERT", "2026-01-01", 1, '{"k":"b","v":7}'),
                        ("c", "UPDATE", "2026-01-01", 4, "no json"),
                        ("d", "INSERT", "2026-01-01", 5, None)])]
    for order in (batches, batches[::-1], [*batches, batches[0]]):
        state = cdc.with_state(table)
        for b in order:
            state = cdc.apply_changes(state, b, "k")
        assert [tuple(r) for r in cdc.visible(state).collect()] == [("a", 2)]
    bad = cdc.unreadable_changes(batches[1], table.schema, "k")
    assert {r.k for r in bad.collect()} == {"c", "d"}


def test_images_are_exact_and_repeats_are_reported(spark):
    new = spark.sql(
        "select 'a' k, cast('1234567890123456789.0123456789' as decimal(38,10))"
        " d, timestamp_ntz'2020-01-02 01:02:03.456789' t")
    changes = cdc.diff(new.limit(0), new, "k", lens.AS_OF)
    assert cdc.apply_changes(new.limit(0), changes, "k").collect() == \
        new.collect()
    twice = cdc.repeated_keys(new.unionByName(new), "k").collect()
    assert [tuple(r) for r in twice] == [("a", 2)]


def test_bucket_count_must_match(spark, tmp):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"),
                                 F.lit(1).alias("v"))
    ingest.write_buckets(df, tmp + "/t", "k", 8)
    change = _change(spark, [("5", "UPDATE", "2026-01-02", 1,
                              '{"k":"5","v":9}')])
    apply = lambda c, g: cdc.apply_changes(c, g, "k")
    with pytest.raises(ValueError):
        ingest.apply_to_buckets(spark, tmp + "/t", change, "k", 4, apply)
    ingest.apply_to_buckets(spark, tmp + "/t", change, "k", 8, apply)
    got = ingest.read_buckets(spark, tmp + "/t")
    assert got.count() == 100 and got.filter("v = 9").count() == 1


def test_foreign_key_checks_find_something(spark):
    from loadstar.plans.registry import QUERIES, load_all
    load_all()
    assert QUERIES["dq_fk_order_items_products"](spark, SF001).first()[1] > 0
    assert QUERIES["dq_fk_violations_rows"](spark, SF001).count() > 0


def test_quality_report_reads_its_input_once(spark):
    sales = lens.dirty_sales(spark, SF001)
    plan = quality.quality_report(
        sales, lens.customers(spark, SF001), lens.AS_OF)._jdf \
        .queryExecution().optimizedPlan().toString()
    one = sales._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and plan.count(
        "parquet") == one.count("parquet") + 1
