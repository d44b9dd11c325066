"""Every operator family on empty inputs: right, whole (empty or zero)
results, no errors."""

import datetime as dt

from loadstar import schemas
from loadstar.functions.rules import range_rule, required_rule
from loadstar.operators import cdc, clean, marts, quality, runlog
from loadstar.plans.jobspec import SALES_JOB
from loadstar.plans.loadjob import transform

SALES = ("order_id string, customer_id string, order_date timestamp_ntz, "
         "product_id string, product_category string, price decimal(10,2)")
T0 = dt.datetime(2026, 1, 1)


def test_empty_sales_everywhere(spark):
    s = spark.createDataFrame([], SALES)
    c = spark.createDataFrame([], "customer_id string")
    assert marts.daily_sales(s).count() == 0
    assert marts.category_revenue(s, T0).count() == 0
    assert quality.duplicate_count(s).first().duplicate_count == 0
    assert quality.orphan_count(s, c, ["customer_id"]).first()[1] == 0
    rep = {r.check_name: r.affected_rows
           for r in quality.quality_report(s, c, T0).collect()}
    assert set(rep.values()) == {0} and len(rep) == 7
    v = quality.validate_first_failure(s).first()
    assert (v.validation_passed, v.error_message) == (
        True, "All validations passed")
    assert quality.null_customer_log_row(s, T0).first().affected_rows == 0
    assert clean.dedupe(s).count() == 0
    assert clean.dedupe(s, subset=["order_id"], order_by=["order_date"]
                        ).count() == 0
    out, plan = clean.fill_missing(s)
    assert out.count() == 0 and plan.values == {}
    assert clean.exact_median(s, "price") is None
    good, bad = quality.split(s, [required_rule(["order_id"]),
                                  range_rule("price", 0, 1)])
    assert good.count() == 0 and bad.count() == 0
    r = clean.range_failures(s, {"price": (0, 1)}).first()
    assert (r.rows_in, r.removed_total, r.rows_out) == (0, 0, 0)
    t = schemas.conform(s, "sales_transactions", T0)
    assert schemas.rule_failures(
        t, schemas.table_rules("sales_transactions")).count() == 11


def test_empty_text_delivery_transform(spark):
    raw = spark.createDataFrame([], ", ".join(
        f"{c} string" for c in SALES_JOB.expected_columns))
    res = transform(raw, SALES_JOB)
    assert res.good.count() == 0 and res.bad.count() == 0


def test_header_only_delivery_run(spark, tmp_path):
    from loadstar.plans.loadjob import run
    p = tmp_path / "empty.csv"
    p.write_text(",".join(SALES_JOB.expected_columns) + "\n")
    t = str(tmp_path / "t")
    res = run(spark, str(p), SALES_JOB, t, run_log_target=t + "_log")
    assert (res.status, res.rows_read, res.rows_loaded, res.rows_rejected) \
        == ("SUCCESS", 0, 0, 0)
    assert spark.read.parquet(t + "_log").first().rows_processed == 0


def test_empty_snapshots_and_changes(spark):
    e = spark.createDataFrame([], "k string, v int")
    full = spark.createDataFrame([("1", 1)], "k string, v int")
    assert cdc.diff(e, e, "k", T0).count() == 0
    assert {r.change_type for r in cdc.diff(e, full, "k", T0).collect()} == \
        {"INSERT"}
    assert {r.change_type for r in cdc.diff(full, e, "k", T0).collect()} == \
        {"DELETE"}
    no_changes = cdc.diff(full, full, "k", T0)
    assert [tuple(r) for r in cdc.apply_changes(full, no_changes, "k")
            .collect()] == [("1", 1)]


def test_empty_run_log(spark):
    log = spark.createDataFrame([], runlog.RUN_LOG_SCHEMA)
    assert runlog.slowest_pipelines(log).count() == 0
    assert runlog.long_runs(log).count() == 0
