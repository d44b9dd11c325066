"""Cleaning operators on small frames (FIXTURES B9-B21, A9)."""

import decimal
import math

import pytest
from pyspark.sql import functions as F

from loadstar.functions.rules import range_rule, required_rule
from loadstar.operators import clean, quality
from loadstar.plans.jobspec import SALES_JOB
from loadstar.plans.loadjob import transform


def srt(rows):
    return sorted(rows, key=lambda t: tuple(
        (0, "") if v is None else (1, str(v)) for v in t))


def test_schema_gate_and_issues(spark):
    df = spark.createDataFrame([("1", "c", "2026-01-01", "p", "x")],
                               "order_id string, customer_id string, "
                               "order_date string, product_id string, "
                               "note string")
    with pytest.raises(clean.SchemaError):
        clean.check_schema(df, SALES_JOB.expected_columns)
    issues = {(r.issue_kind, r.column_name, r.affected_rows)
              for r in clean.schema_issues(df, SALES_JOB.expected_columns)
              .collect()}
    assert issues == {("MISSING_COLUMN", "price", 1),
                      ("EXTRA_COLUMN", "note", 1)}
    ok = df.withColumn("price", F.lit("1"))
    assert clean.check_schema(ok, SALES_JOB.expected_columns) == ["note"]


def test_duplicate_example_from_readme(spark):
    df = spark.createDataFrame([("A001", 100), ("A001", 100), ("A002", 200)],
                               "order_id string, price int")
    assert clean.dedupe(df).count() == 2


def test_full_row_dedupe_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert clean.dedupe(df).count() == 1


def test_keep_first_by_ordinal(spark):
    df = spark.createDataFrame([("o1", "x", 2), ("o1", "y", 1), ("o2", "z", 3)],
                               "order_id string, v string, _row int")
    out = clean.dedupe(df, subset=["order_id"], order_by=["_row"])
    assert srt(tuple(r) for r in out.collect()) == [("o1", "y", 1),
                                                    ("o2", "z", 3)]


def test_median_even_count_fills(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,), (None,)],
                               "x double")
    out, plan = clean.fill_missing(df)
    assert plan.values["x"] == 6.0
    assert sorted(r.x for r in out.collect()) == [1.0, 2.0, 6.0, 10.0, 20.0]


def test_median_all_null_unchanged(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    out, _ = clean.fill_missing(df)
    assert [r.x for r in out.collect()] == [None, None]


def test_median_text_numbers_and_decimal(spark):
    df = spark.createDataFrame([("1",), ("4",), (None,), ("2",)], "x string")
    out, plan = clean.fill_missing(df)
    assert plan.values["x"] == 2.0
    assert sorted(r.x for r in out.collect()) == ["1", "2", "2.0", "4"]
    d = spark.createDataFrame([(decimal.Decimal("1.00"),),
                               (decimal.Decimal("2.01"),), (None,)],
                              "p decimal(10,2)")
    out, plan = clean.fill_missing(d)
    assert plan.values["p"] == decimal.Decimal("1.505")
    assert sorted(r.p for r in out.collect()) == [
        decimal.Decimal("1.00"), decimal.Decimal("1.51"),
        decimal.Decimal("2.01")]


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 5001])
def test_exact_median_matches_numpy(spark, n):
    import random
    import statistics
    rnd = random.Random(n)
    vals = [round(rnd.uniform(-50, 50), 3) for _ in range(n)]
    vals += [vals[0]] * (n // 3)          # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = clean.exact_median(df, "x", buckets=16, fetch_limit=8)
    assert math.isclose(got, statistics.median(vals), rel_tol=0, abs_tol=1e-12)


def test_exact_median_long_keys(spark):
    vals = [10**15 + i for i in range(101)] + [10**15 + 7] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    import statistics
    assert clean.exact_median(df, "x", buckets=4, fetch_limit=2) == \
        statistics.median(vals)


def test_text_fill_and_excluded_key(spark):
    df = spark.createDataFrame([("a", "1"), (None, None), ("b", "4")],
                               "name string, customer_id string")
    out, plan = clean.fill_missing(df, exclude=["customer_id"])
    rows = srt(tuple(r) for r in out.collect())
    assert rows == [("Unknown", None), ("a", "1"), ("b", "4")]
    good, bad = quality.split(out, [required_rule(["customer_id"])])
    assert good.count() == 2 and bad.count() == 1


def test_fill_before_coerce(spark):
    df = spark.createDataFrame([("o1", "c", "2026-01-01", "p", "10"),
                                ("o2", "c", "2026-01-01", "p", "abc"),
                                ("o3", "c", "2026-01-01", "p", None)],
                               "order_id string, customer_id string, "
                               "order_date string, product_id string, "
                               "price string")
    res = transform(df, SALES_JOB, stage=False)
    assert [r.order_id for r in res.good.collect()] == ["o1"]
    assert res.fills == {"price": "Unknown"}


NUMERIC_OK = ["1", " 2 ", "1e3", ".5", "5.", "+3"]
NUMERIC_BAD = ["$5", "1,000", "0x10", "1_000", "true", "5d", "5f", "nan"]


def test_numeric_coercion(spark):
    df = spark.createDataFrame([(v,) for v in NUMERIC_OK + NUMERIC_BAD],
                               "v string")
    out = clean.coerce_types(df, {"v": "numeric"}).collect()
    assert [r.v for r in out] == [1.0, 2.0, 1000.0, 0.5, 5.0, 3.0] + \
        [None] * len(NUMERIC_BAD)


def test_datetime_coercion(spark):
    import datetime as dt
    vals = ["2026-01-02", "2026-01-02 03:04:05", "01/02/2026",
            "2026-13-01", "Unknown", "2026", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = [r.v for r in clean.coerce_types(df, {"v": "datetime"}).collect()]
    assert out == [dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 4, 5),
                   dt.datetime(2026, 1, 2), None, None, None, None]


def test_cast_string_keeps_null(spark):
    df = spark.createDataFrame([(None,), (7,)], "v int")
    assert [r.v for r in clean.coerce_types(df, {"v": "string"})
            .collect()] == [None, "7"]


def test_unknown_type_is_error(spark):
    df = spark.createDataFrame([("1",)], "v string")
    with pytest.raises(ValueError):
        clean.coerce_types(df, {"v": "complex"})


def test_range_edges(spark):
    vals = [-0.01, 0.0, 100000.0, 100000.01, None, float("nan"),
            float("inf")]
    df = spark.createDataFrame([(v,) for v in vals], "price double")
    out = sorted(r.price for r in clean.range_filter(
        df, {"price": (0, 100000)}).collect())
    assert out == [0.0, 100000.0]


def test_ordered_rule_counts(spark):
    df = spark.createDataFrame([(-1.0, -5), (5.0, -5), (5.0, 5)],
                               "price double, shipping_days int")
    r = clean.range_failures(df, {"price": (0, 100), "shipping_days": (0, 9)}
                             ).first()
    assert (r.rows_in, r.removed_price, r.removed_shipping_days,
            r.removed_total, r.rows_out) == (3, 1, 1, 2, 1)


def test_split_reasons_in_rule_order(spark):
    df = spark.createDataFrame([(None, -1.0), ("a", 5.0)],
                               "id string, price double")
    good, bad = quality.split(df, [required_rule(["id"]),
                                   range_rule("price", 0, 10)])
    assert [r.id for r in good.collect()] == ["a"]
    assert bad.first().reject_reasons == "required,price_range"


def test_column_classes(spark):
    df = spark.createDataFrame(
        [("1", "True", "x", None, "007"), ("2.5", "False", None, None, "8")],
        "n string, b string, t string, e string, z string")
    got = {r.column_name: r.column_class
           for r in clean.column_profile(df).collect()}
    assert got == {"n": "numeric", "b": "boolean", "t": "text",
                   "e": "numeric", "z": "numeric"}


def test_table_catalog_rules_and_defaults(spark):
    import datetime as dt
    from loadstar import schemas
    df = spark.createDataFrame([("A1", "C" * 60, None, "P1", "10.5"),
                                ("A2", "C2", "2026-01-01", "P2", "1e9")],
                               "order_id string, customer_id string, "
                               "order_date string, product_id string, "
                               "price string")
    t = schemas.conform(df.withColumn("order_date", F.to_timestamp_ntz(
        "order_date")), "sales_transactions", dt.datetime(2026, 2, 1))
    assert t.columns[-2:] == ["created_at", "updated_at"]
    assert {r.created_at for r in t.collect()} == {dt.datetime(2026, 2, 1)}
    fails = {r.rule_name: r.failed_rows for r in schemas.rule_failures(
        t, schemas.table_rules("sales_transactions")).collect()}
    # 1e9 does not fit decimal(10,2): try_cast → null → price_not_null fails
    assert fails["price_not_null"] == 1
    assert fails["customer_id_max_50"] == 1
    assert fails["order_date_not_null"] == 1
    assert schemas.key_duplicates(t, "sales_transactions").count() == 0


def test_exact_median_heavy_tails(spark):
    """Values over hundreds of orders of magnitude, both signs, plus a hot
    value: linear buckets stall, asinh buckets take over."""
    import random
    import statistics
    rnd = random.Random(7)
    vals = [rnd.choice((-1, 1)) * 10 ** rnd.uniform(-300, 300)
            for _ in range(3000)] + [1e-200] * 500 + [0.0] * 3
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert clean.exact_median(df, "x", buckets=8, fetch_limit=4) == \
        statistics.median(vals)


def test_fill_several_numeric_columns(spark):
    import statistics
    rows = [(float(i), i * 3, None if i % 4 == 0 else f"{i}.5")
            for i in range(1, 41)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "a double, b long, c string")
    out, plan = clean.fill_missing(df)
    assert plan.values["a"] == statistics.median(range(1, 41))
    assert plan.values["b"] == statistics.median([i * 3 for i in
                                                  range(1, 41)])
    assert plan.values["c"] == statistics.median(
        [i + 0.5 for i in range(1, 41) if i % 4])
    assert out.filter("a IS NULL OR b IS NULL OR c IS NULL").count() == 0


def test_approx_median_option(spark):
    import statistics
    vals = [float(i) for i in range(1, 1002)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out, plan = clean.fill_missing(df, median="approx")
    exact = statistics.median(v for v in vals if v is not None)
    assert abs(plan.values["x"] - exact) <= 1.0      # a data value near it
    assert out.filter("x IS NULL").count() == 0
    with pytest.raises(ValueError):
        clean.fill_missing(df, median="mean")
