"""Data-quality checks, the first-failure validator, referential checks and
the good/bad split (A1-A5, A15-A19, J1-J4, M3, S14, X1, P10-P19).

Skew: every check that groups or joins on a key pre-aggregates first
(partial aggregation inside each map task), so a key holding a third of
all rows costs one row per task in the shuffle, never one giant task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, reasons
from ..functions.values import severity_of, ts_literal

# --- fixed values -----------------------------------------------------------
# Check names and messages of the warehouse's quality checks and validator.
CHECK_DUPLICATES = "Duplicate Records Check"
CHECK_NULLS = "Null Values Check"
CHECK_INVALID_PRICE = "Invalid Price Check"
CHECK_FUTURE_DATE = "Future Date Check"
CHECK_ORPHANS = "Orphaned Customer Records"
MSG_REQUIRED = "Missing required fields found"
MSG_PRICE_RANGE = "Invalid price range detected"
MSG_DUPLICATES = "Duplicate orders found"
MSG_PASSED = "All validations passed"
LOG_TABLE = "sales_transactions"
LOG_CHECK_TYPE = "Null Values"
LOG_DESCRIPTION = "Missing customer_id values found"
# Affected-row count above which a logged issue is CRITICAL.
CRITICAL_ABOVE = 100
# Validator price bounds (inclusive on both ends are valid).
VALID_PRICE_MIN, VALID_PRICE_MAX = 0, 1000000
# ---------------------------------------------------------------------------


def duplicate_count(df: DataFrame, key: str = "order_id") -> DataFrame:
    """A1: ``COUNT(*) - COUNT(DISTINCT key)``; null keys count as
    duplicates (they are rows but not distinct values)."""
    return df.agg(F.lit(CHECK_DUPLICATES).alias("check_name"),
                  (F.count(F.lit(1)) - F.count_distinct(key))
                  .alias("duplicate_count"))


def _null_sum(c: str) -> Column:
    # SUM(CASE ...) — null on an empty table, as in SQL
    return F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint")


def null_counts(df: DataFrame, cols: Sequence[str] = ("order_id",
                "customer_id", "price")) -> DataFrame:
    """A2: null counts of the key columns in one pass."""
    names = {"order_id": "null_order_ids", "customer_id": "null_customer_ids",
             "price": "null_prices"}
    return df.agg(F.lit(CHECK_NULLS).alias("check_name"),
                  *[_null_sum(c).alias(names.get(c, f"null_{c}"))
                    for c in cols])


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for every column, one pass."""
    stats = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}")
                     for i, c in enumerate(df.columns)])
    args = [F.lit(len(df.columns))]
    for i, c in enumerate(df.columns):
        args += [F.lit(c), F.col(f"_n{i}")]
    return stats.select(F.stack(*args)).toDF("column_name", "null_count")


def invalid_price(price: str = "price") -> Column:
    """P10: ``price <= 0 OR price IS NULL``."""
    return (F.col(price) <= 0) | F.col(price).isNull()


def invalid_price_count(df: DataFrame, price: str = "price") -> DataFrame:
    """A3."""
    return df.agg(F.lit(CHECK_INVALID_PRICE).alias("check_name"),
                  F.count_if(invalid_price(price)).alias("invalid_price_count"))


def future_date(as_of, col: str = "order_date") -> Column:
    """``order_date > as_of``."""
    return F.col(col) > ts_literal(as_of)


def future_date_count(df: DataFrame, as_of, col: str = "order_date"
                      ) -> DataFrame:
    """A4."""
    return df.agg(F.lit(CHECK_FUTURE_DATE).alias("check_name"),
                  F.count_if(future_date(as_of, col)).alias("future_date_count"))


def _key_counts(child: DataFrame, keys: Sequence[str]) -> DataFrame:
    return child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _parent_keys(parent: DataFrame, keys: Sequence[str],
                 parent_keys: Sequence[str] | None) -> DataFrame:
    pk = list(parent_keys or keys)
    return parent.select(*[F.col(p).alias(k) for p, k in zip(pk, keys)])


def orphan_count(child: DataFrame, parent: DataFrame, keys: Sequence[str],
                 parent_keys: Sequence[str] | None = None,
                 name: str = CHECK_ORPHANS, out: str = "orphaned_records"
                 ) -> DataFrame:
    """A5/J1-J4 (count): child rows whose key has no parent row; a null key
    is an orphan (``NOT EXISTS`` semantics).

    The child is first reduced to one row per key with its row count
    (partial aggregation — a hot key costs nothing extra), then left-joined
    with the distinct parent keys; the reduced side is already partitioned
    on the key, so only the parent keys are shuffled (or broadcast, when AQE
    measures them small). A left outer join, not an anti join: Catalyst
    pushes an anti join below the aggregate, which would shuffle every child
    row by key again."""
    keys = list(keys)
    hits = _parent_keys(parent, keys, parent_keys).distinct().withColumn(
        "_hit", F.lit(True))
    joined = _key_counts(child, keys).join(hits, on=keys, how="left")
    return joined.agg(F.lit(name).alias("check_name"),
                      F.coalesce(F.sum(F.when(F.col("_hit").isNull(),
                                              F.col("_n"))), F.lit(0))
                      .cast("bigint").alias(out))


def referential_violations(child: DataFrame, parent: DataFrame,
                           keys: Sequence[str],
                           parent_keys: Sequence[str] | None = None
                           ) -> DataFrame:
    """J4 (rows): the child rows without a parent. A row-level anti join;
    AQE splits a skewed child partition across tasks."""
    return child.join(_parent_keys(parent, list(keys), parent_keys),
                      on=list(keys), how="left_anti")


def duplicate_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    """``GROUP BY key HAVING COUNT(*) > 1`` (null keys form a group)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
              .filter(F.col("row_count") > 1))


def validate_first_failure(df: DataFrame, key: str = "order_id",
                           required: Sequence[str] = ("order_id",
                                                      "customer_id", "price"),
                           price: str = "price",
                           lo=VALID_PRICE_MIN, hi=VALID_PRICE_MAX
                           ) -> DataFrame:
    """Ordered existence tests → one row
    ``(validation_passed, error_message)`` naming the first failing rule:
    required fields → price range → duplicate keys → passed.

    One aggregate per key (partial, skew-safe) feeds one global aggregate;
    no self-join, no second scan."""
    req = F.lit(False)
    for c in required:
        req = req | F.col(c).isNull()
    bad_price = (F.col(price) < lo) | (F.col(price) > hi)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                  F.bool_or(req).alias("_req"),
                                  F.bool_or(bad_price).alias("_price"))
    flags = per_key.agg(
        F.coalesce(F.bool_or("_req"), F.lit(False)).alias("r"),
        F.coalesce(F.bool_or("_price"), F.lit(False)).alias("p"),
        F.coalesce(F.bool_or(F.col("_n") > 1), F.lit(False)).alias("d"))
    r, p, d = F.col("r"), F.col("p"), F.col("d")
    return flags.select(
        (~(r | p | d)).alias("validation_passed"),
        F.when(r, F.lit(MSG_REQUIRED)).when(p, F.lit(MSG_PRICE_RANGE))
         .when(d, F.lit(MSG_DUPLICATES)).otherwise(F.lit(MSG_PASSED))
         .alias("error_message"))


def quality_report(sales: DataFrame, customers: DataFrame, as_of,
                   key: str = "order_id", customer_key: str = "customer_id",
                   price: str = "price", date: str = "order_date"
                   ) -> DataFrame:
    """M3: every check as one long table
    ``(check_name, affected_rows, severity)``.

    One chain: a pre-aggregate per (order, customer) pair — a partial
    aggregate, so hot keys collapse in each map task — is left-joined to the
    distinct parent keys, summed per order, then totalled. The input is read
    and shuffled once. Severity follows A19."""
    pairs = sales.groupBy(key, customer_key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(price).isNull()).alias("_np"),
        F.count_if(invalid_price(price)).alias("_ip"),
        F.count_if(future_date(as_of, date)).alias("_fd"))
    hits = _parent_keys(customers, [customer_key], None).distinct() \
        .withColumn("_hit", F.lit(True))
    per_order = pairs.join(hits, on=[customer_key], how="left").groupBy(
        key).agg(
        F.sum("_n").alias("_n"),
        F.sum(F.when(F.col(customer_key).isNull(), F.col("_n"))).alias("_nc"),
        F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))).alias("_or"),
        F.sum("_np").alias("_np"), F.sum("_ip").alias("_ip"),
        F.sum("_fd").alias("_fd"))
    tot = per_order.agg(
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(key)).alias("dup"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0))
         .alias("noid"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
            "_nc", "_np", "_ip", "_fd", "_or")])
    checks = [("duplicate_records", "dup"), ("null_order_ids", "noid"),
              ("null_customer_ids", "_nc"), ("null_prices", "_np"),
              ("invalid_prices", "_ip"), ("future_dates", "_fd"),
              ("orphaned_customers", "_or")]
    args = [F.lit(len(checks))]
    for name, c in checks:
        args += [F.lit(name), F.col(c).cast("bigint")]
    rows = tot.select(F.stack(*args)).toDF("check_name", "affected_rows")
    return rows.withColumn("severity", severity_of("affected_rows",
                                                   CRITICAL_ABOVE))


def quality_log_rows(sales: DataFrame, as_of, table: str = LOG_TABLE,
                     key: str = "order_id",
                     customer_key: str = "customer_id", price: str = "price",
                     date: str = "order_date") -> DataFrame:
    """S14 for a whole load: the row checks of :func:`quality_report` as
    ``data_quality_log`` rows (table, check, description, affected rows,
    severity, checked_at) — every check logged, also at zero."""
    aggs = [F.count(F.lit(1)).alias("_n"),
            F.count_if(F.col(key).isNull()).alias("noid"),
            F.count_if(F.col(customer_key).isNull()).alias("ncust"),
            F.count_if(F.col(price).isNull()).alias("nprice"),
            F.count_if(invalid_price(price)).alias("ip"),
            F.count_if(future_date(as_of, date)).alias("fd"),
            F.count_distinct(key).alias("_d")]
    checks = [("Duplicates", "Duplicate order ids found", "dup"),
              ("Null Values", "Missing order_id values found", "noid"),
              ("Null Values", LOG_DESCRIPTION, "ncust"),
              ("Null Values", "Missing price values found", "nprice"),
              ("Invalid Values", "Prices not above zero or missing", "ip"),
              ("Future Dates", "Order dates after the run's as_of", "fd")]
    stats = sales.agg(*aggs).withColumn("dup", F.col("_n") - F.col("_d"))
    args = [F.lit(len(checks))]
    for check, desc, c in checks:
        args += [F.lit(check), F.lit(desc), F.col(c).cast("bigint")]
    rows = stats.select(F.stack(*args)).toDF("check_type",
                                             "issue_description",
                                             "affected_rows")
    return rows.select(F.lit(table).alias("table_name"), "check_type",
                       "issue_description", "affected_rows",
                       severity_of("affected_rows", CRITICAL_ABOVE)
                       .alias("severity"),
                       ts_literal(as_of).alias("checked_at"))


def null_customer_log_row(sales: DataFrame, as_of,
                          customer_key: str = "customer_id") -> DataFrame:
    """The quality-log row for missing customer ids (always one
    row, also when the count is 0)."""
    return sales.filter(F.col(customer_key).isNull()).agg(
        F.lit(LOG_TABLE).alias("table_name"),
        F.lit(LOG_CHECK_TYPE).alias("check_type"),
        F.lit(LOG_DESCRIPTION).alias("issue_description"),
        F.count(F.lit(1)).alias("affected_rows"),
        severity_of(F.count(F.lit(1)), CRITICAL_ABOVE).alias("severity"),
        ts_literal(as_of).alias("checked_at"))


# ----------------------------------------------------------- good / bad ---

def tag_reasons(df: DataFrame, rules: Sequence[Rule],
                col: str = "reject_reasons") -> DataFrame:
    """Add the comma-joined names of failed rules (empty = good)."""
    return df.withColumn(col, F.array_join(reasons(rules), ","))


def split(df: DataFrame, rules: Sequence[Rule], col: str = "reject_reasons"
          ) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``reject_reasons``). Both come
    from one tagged plan, so each consumer re-evaluates the row-level rules
    over the input: stage an expensive input first (the load job writes
    both from its staged table)."""
    tagged = tag_reasons(df, rules, col)
    good = tagged.filter(F.col(col) == "").drop(col)
    bad = tagged.filter(F.col(col) != "")
    return good, bad


class RejectedRowsError(ValueError):
    """P19 ``halt`` policy: at least one row failed a rule."""


def enforce_policy(bad: DataFrame, policy: str = "log_and_continue") -> None:
    """``halt`` stops the run when any row was rejected (reads only until
    the first rejected row); ``log_and_continue`` keeps going."""
    if policy == "halt":
        if not bad.isEmpty():
            raise RejectedRowsError("rows failed validation rules")
    elif policy != "log_and_continue":
        raise ValueError(f"unknown on-error policy {policy!r}")

