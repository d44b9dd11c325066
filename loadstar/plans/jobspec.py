"""Declarative job specs (M6): what a load run expects and enforces."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from ..functions.rules import Rule
from ..functions.values import DATETIME_FORMATS


@dataclass(frozen=True)
class JobSpec:
    name: str                                   # run-log pipeline name
    table: str                                  # target table
    expected_columns: tuple[str, ...] = ()      # P1: presence only
    type_mappings: Mapping[str, str] = field(default_factory=dict)    # P6
    value_constraints: Mapping[str, tuple] = field(default_factory=dict)  # P7
    fill_exclude: tuple[str, ...] = ()          # key columns never filled
    dedupe_subset: tuple[str, ...] | None = None    # None = full row
    rules: tuple[Rule, ...] = ()                # extra named rules (P18)
    on_error: str = "log_and_continue"          # P19: or "halt"
    unknown_text: str = "Unknown"
    # CSV records may contain quoted line breaks. Reading them makes a file
    # one task: True does so for every file, False for none, "auto" for those
    # that need it (long files cost one more text scan, read in splits).
    csv_multi_line: bool | str = "auto"
    # Also partition the loaded table by the month of this timestamp column
    # (``<column>_month``), so recency queries prune whole months.
    month_partition: str | None = None
    # Enforce the constraints of ``table`` (if the catalog has it) on lake
    # loads: NOT NULL, text lengths, magnitudes and key uniqueness reject rows
    # with a reason, and loaded rows get the table's types and defaults.
    enforce_table: bool = True
    # Key columns (default: the table's key), and the columns that decide
    # which row of a repeated key stays (then: the first delivered).
    key: tuple[str, ...] = ()
    key_order: tuple[str, ...] = ()
    # Datetime layouts, tried in this order (``values.ALL_FORMATS`` has more,
    # with minutes, fractions and offsets), or with ``infer_datetime`` per
    # column those that parse any of its texts, the most frequent first.
    datetime_formats: tuple[str, ...] = DATETIME_FORMATS
    infer_datetime: bool = False
    # "exact" (distributed selection) or "approx" (percentile_approx) median
    median: str = "exact"


# --- fixed values -----------------------------------------------------------
# The sales load: expected columns, conversions and the accepted price range
# of the warehouse's sales file (the job name is our own label).
SALES_JOB = JobSpec(
    name="sales_load",
    table="sales_transactions",
    expected_columns=("order_id", "customer_id", "order_date", "product_id",
                      "price"),
    type_mappings={"order_date": "datetime", "price": "numeric",
                   "customer_id": "string", "product_id": "string"},
    value_constraints={"price": (0, 100000)},
    fill_exclude=("order_id", "customer_id", "product_id"),
)
# ---------------------------------------------------------------------------
