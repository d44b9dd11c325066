"""Named row rules: a rule is a boolean ``Column`` that is true when a row
passes. A null result counts as a failure (SQL three-valued logic would
otherwise let a null slip through both a filter and its negation).

Rules are built lazily (a ``Column`` needs a live session), so a job spec
holds ``Rule`` objects and compiles them when a DataFrame is at hand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    build: Callable[[], Column]
    columns: tuple[str, ...] = ()

    def passes(self) -> Column:
        """True when the row passes; null is treated as a failure."""
        return F.coalesce(self.build(), F.lit(False))

    def fails(self) -> Column:
        return ~self.passes()


def range_rule(column: str, lo, hi, name: str | None = None) -> Rule:
    """``lo <= value <= hi`` inclusive; null fails."""
    return Rule(name or f"{column}_range",
                lambda: F.col(column).between(F.lit(lo), F.lit(hi)), (column,))


def required_rule(columns: Sequence[str], name: str = "required") -> Rule:
    """Every listed column is present."""
    cols = tuple(columns)

    def build() -> Column:
        out = F.lit(True)
        for c in cols:
            out = out & F.col(c).isNotNull()
        return out
    return Rule(name, build, cols)


def positive_rule(column: str, name: str | None = None) -> Rule:
    """P16 (and the negation of P10): ``value > 0``."""
    return Rule(name or f"{column}_positive", lambda: F.col(column) > 0,
                (column,))


def max_length_rule(column: str, n: int, name: str | None = None) -> Rule:
    """VARCHAR(n) as a check: text longer than ``n`` fails; null passes."""
    return Rule(name or f"{column}_max_length",
                lambda: F.coalesce(F.length(F.col(column)) <= n, F.lit(True)),
                (column,))


def reasons(rules: Sequence[Rule]) -> Column:
    """The names of every failed rule, in rule order, as an array."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[
        F.when(r.fails(), F.lit(r.name)) for r in rules]))


def ordered_failures(rules: Sequence[Rule]) -> list[tuple[str, Column]]:
    """Rules applied one after another; rule *i* is charged only
    with rows that passed rules 1..i-1 and fail rule *i*. Returned as
    ``count_if`` aggregate columns so all counts come from one pass."""
    out = []
    prior = F.lit(True)
    for r in rules:
        out.append((r.name, F.count_if(prior & r.fails())))
        prior = prior & r.passes()
    return out
