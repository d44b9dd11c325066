"""The warehouse's table catalog (S12, S13): column types, keys, NOT NULL,
text lengths, defaults and foreign keys as data. Spark does not enforce
constraints on file tables, so each constraint becomes a named rule checked
before the write (:func:`table_rules`), and defaults are applied at write
time (:func:`conform`)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.rules import Rule, max_length_rule, required_rule
from .functions.values import ts_literal


@dataclass(frozen=True)
class Col:
    name: str
    type: str                      # Spark SQL type
    not_null: bool = False
    max_len: int | None = None     # VARCHAR(n)
    default: str | None = None     # "now" (= the run's as_of) or a literal


@dataclass(frozen=True)
class TableDef:
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()   # (col, table, col)
    surrogate_key: bool = False    # key generated by the store, not loaded
    extra: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, T._parse_datatype_string(c.type),
                          not c.not_null) for c in self.columns])


# --- fixed values -----------------------------------------------------------
# Table definitions of the sales warehouse.
TS = "timestamp_ntz"
MONEY = "decimal(10,2)"
CATALOG = {t.name: t for t in (
    TableDef("sales_transactions", (
        Col("order_id", "string", True, 50),
        Col("customer_id", "string", True, 50),
        Col("order_date", TS, True),
        Col("product_id", "string", True, 50),
        Col("product_category", "string", False, 100),
        Col("price", MONEY, True),
        Col("payment_type", "string", False, 50),
        Col("shipping_days", "int"),
        Col("created_at", TS, default="now"),
        Col("updated_at", TS, default="now")),
        key=("order_id",)),
    TableDef("customers", (
        Col("customer_id", "string", True, 50),
        Col("customer_name", "string", False, 100),
        Col("email", "string", False, 100),
        Col("city", "string", False, 50),
        Col("country", "string", False, 50),
        Col("created_at", TS, default="now")),
        key=("customer_id",)),
    TableDef("products", (
        Col("product_id", "string", True, 50),
        Col("product_name", "string", False, 200),
        Col("product_category", "string", False, 100),
        Col("price", MONEY),
        Col("created_at", TS, default="now")),
        key=("product_id",)),
    TableDef("order_items", (
        Col("order_item_id", "bigint", True),
        Col("order_id", "string", True, 50),
        Col("product_id", "string", True, 50),
        Col("quantity", "int", default="1"),
        Col("unit_price", MONEY),
        Col("total_price", MONEY)),
        key=("order_item_id",), surrogate_key=True,
        foreign_keys=(("order_id", "sales_transactions", "order_id"),
                      ("product_id", "products", "product_id"))),
    TableDef("data_quality_log", (
        Col("log_id", "bigint", True),
        Col("table_name", "string", False, 100),
        Col("check_type", "string", False, 100),
        Col("issue_description", "string"),
        Col("affected_rows", "int"),
        Col("severity", "string", False, 20),
        Col("checked_at", TS, default="now")),
        key=("log_id",), surrogate_key=True),
    TableDef("etl_execution_log", (
        Col("execution_id", "string", True),
        Col("pipeline_name", "string", False, 100),
        Col("start_time", TS),
        Col("end_time", TS),
        Col("status", "string", False, 20),
        Col("rows_processed", "bigint"),
        Col("rows_failed", "bigint"),
        Col("error_message", "string"),
        Col("execution_details", "string")),
        key=("execution_id",)),
    TableDef("sales_transactions_changes", (
        Col("change_id", "bigint", True),
        Col("order_id", "string", False, 50),
        Col("change_type", "string", False, 10),
        Col("changed_at", TS, default="now"),
        Col("old_values", "string"),
        Col("new_values", "string")),
        key=("change_id",)),
)}
# ---------------------------------------------------------------------------


def table(name: str) -> TableDef:
    return CATALOG[name]


def _fits(c: Col) -> Rule | None:
    dt = T._parse_datatype_string(c.type)
    if not isinstance(dt, T.DecimalType):
        return None
    bound = 10 ** (dt.precision - dt.scale)
    return Rule(f"{c.name}_fits_{c.type}",
                lambda: F.coalesce(F.abs(F.col(c.name)) < bound, F.lit(True)),
                (c.name,))


def table_rules(name: str, columns=None) -> list[Rule]:
    """The table's (those over ``columns``, if given) constraints as rules: NOT NULL (and the key) → required,
    VARCHAR(n) → max length, NUMERIC(p,s) → magnitude fits. Key uniqueness
    and foreign keys need other rows; see :func:`key_duplicates` and
    :func:`loadstar.operators.quality.orphan_count`."""
    t = CATALOG[name]
    rules: list[Rule] = []
    nn = [c.name for c in t.columns if c.not_null and not (
        t.surrogate_key and c.name in t.key)]
    for c in nn:
        rules.append(required_rule([c], f"{c}_not_null"))
    for c in t.columns:
        if c.max_len:
            rules.append(max_length_rule(c.name, c.max_len,
                                         f"{c.name}_max_{c.max_len}"))
        r = _fits(c)
        if r is not None:
            rules.append(r)
    return [r for r in rules
            if columns is None or set(r.columns) <= set(columns)]


def conform(df: DataFrame, name: str, as_of, keep_extra: bool = False
            ) -> DataFrame:
    """Shape ``df`` to the table — table column order, types (``try``
    casts: a value that does not fit becomes null and fails NOT NULL),
    defaults for missing columns and nulls (``now`` = the run's ``as_of``, one
    instant per run). Surrogate keys are left to the store. Columns that the
    table does not have are dropped, or kept behind it with ``keep_extra``."""
    out = []
    for c in CATALOG[name].columns:
        if c.name in df.columns:
            col: Column = F.col(c.name).try_cast(c.type)
        else:
            col = F.lit(None).cast(c.type)
        if c.default is not None:
            d = ts_literal(as_of) if c.default == "now" else \
                F.lit(c.default).cast(c.type)
            col = F.coalesce(col, d)
        out.append(col.alias(c.name))
    if keep_extra:
        known = {c.name for c in CATALOG[name].columns}
        out += [F.col(f"`{c}`") for c in df.columns if c not in known]
    return df.select(*out)


def key_duplicates(df: DataFrame, name: str) -> DataFrame:
    """Primary-key uniqueness as rows: every key value present more than
    once, with its count (partial aggregation — skew-safe)."""
    key = list(CATALOG[name].key)
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
              .filter(F.col("row_count") > 1))


def rule_failures(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows failing each rule (independently), as ``(rule_name,
    failed_rows)`` from one aggregate pass."""
    stats = df.agg(*[F.count_if(r.fails()).alias(f"_r{i}")
                     for i, r in enumerate(rules)])
    args = [F.lit(len(rules))]
    for i, r in enumerate(rules):
        args += [F.lit(r.name), F.col(f"_r{i}")]
    return stats.select(F.stack(*args)).toDF("rule_name", "failed_rows")
