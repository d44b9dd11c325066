"""Cleaning operators: schema check, dedupe, missing-value fill, type
coercion, range rules (P1-P8, U1-U4, A11-A14, A17, F2-F7).

All of them are DataFrame → DataFrame functions. The only driver work is
metadata (column lists) and bounded statistics (one row per column, or a
histogram of at most ``buckets`` rows per pass in :func:`exact_median`).
"""

from __future__ import annotations

import decimal
import logging
import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Rule, range_rule
from ..functions.values import (ALL_FORMATS, BOOL_TOKENS, DATETIME_FORMATS,
                                UNKNOWN_TEXT, is_number_text,
                                nan_to_null, parse_datetime,
                                parse_layout, parse_number,
                                to_text)

log = logging.getLogger("loadstar")


class SchemaError(ValueError):
    """Expected columns are missing (P2: the run stops before any action)."""


# ---------------------------------------------------------------- schema ---

ISSUE_SCHEMA = T.StructType([
    T.StructField("issue_kind", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("affected_rows", T.LongType(), True),
])


def schema_diff(df: DataFrame, expected: Iterable[str]) -> tuple[list, list]:
    """U4: (missing, extra) column names; plan-time, no job."""
    exp, act = list(expected), list(df.columns)
    return ([c for c in exp if c not in act], [c for c in act if c not in exp])


def check_schema(df: DataFrame, expected: Iterable[str] | None) -> list[str]:
    """Raise :class:`SchemaError` when expected columns are missing;
    return the extra columns (a warning, not an error). Order and types are
    not checked."""
    if not expected:
        return []
    missing, extra = schema_diff(df, expected)
    if missing:
        raise SchemaError(f"input lacks {len(missing)} of the expected "
                          f"columns: {sorted(missing)}")
    if extra:
        log.warning("input has %d columns beyond the expected: %s",
                    len(extra), sorted(extra))
    return extra


def schema_issues(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """P1 as rows for the quality log: one row per missing column (ERROR,
    every row lacks it) or extra column (WARNING, rows holding a value in
    it). Counts come from one aggregate pass over the data."""
    missing, extra = schema_diff(df, expected)
    spark = df.sparkSession
    if not missing and not extra:
        return spark.createDataFrame([], ISSUE_SCHEMA)
    stats = df.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count(F.col(c)).alias(f"_x{i}")
                     for i, c in enumerate(extra)])
    entries = ([("MISSING_COLUMN", c, "ERROR", F.col("_n")) for c in missing]
               + [("EXTRA_COLUMN", c, "WARNING", F.col(f"_x{i}"))
                  for i, c in enumerate(extra)])
    args = [F.lit(len(entries))]
    for kind, c, sev, n in entries:
        args += [F.lit(kind), F.lit(c), F.lit(sev), n.cast("bigint")]
    return stats.select(F.stack(*args)).toDF(
        "issue_kind", "column_name", "severity", "affected_rows")


# ---------------------------------------------------------------- dedupe ---

def dedupe(df: DataFrame, subset: Sequence[str] | None = None,
           order_by: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicate rows.

    ``subset``   columns that identify a row (default: all columns except
                 ``order_by``); nulls compare equal, as in pandas.
    ``order_by`` columns giving delivery order (e.g. a file ordinal); the
                 first row of each group survives. Without it the survivor
                 is still deterministic (smallest remaining values).

    Implemented as an aggregate, never a window: Spark combines each group
    inside every map task before the shuffle, so a key holding a third of
    all rows ships one row per task, not a third of the table to one task.
    """
    order = list(order_by or [])
    keys = list(subset) if subset else [c for c in df.columns if c not in order]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys) if subset else df.dropDuplicates()
    if len(rest) == 1 and rest == order[:1]:
        return (df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0]))
                  .select(*df.columns))
    ordered = order + [c for c in rest if c not in order]
    first = F.min(F.struct(*[F.col(c).alias(f"_f{i}")
                             for i, c in enumerate(ordered)])).alias("_first")
    out = df.groupBy(*keys).agg(first)
    pos = {c: i for i, c in enumerate(ordered)}
    return out.select(*[F.col(c) if c in keys else
                        F.col(f"_first._f{pos[c]}").alias(c)
                        for c in df.columns])


# ------------------------------------------------------ column classes ---

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC_TYPES = (*INTEGER_TYPES, T.FloatType, T.DoubleType, T.DecimalType)


def _stats_columns(df: DataFrame, skip: set = frozenset()) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"_nn{i}"))
        if isinstance(f.dataType, T.StringType) and f.name not in skip:
            aggs.append(F.bool_and(c.isNull() | is_number_text(c))
                        .alias(f"_num{i}"))
            aggs.append(F.bool_and(c.isNull() | c.isin(list(BOOL_TOKENS)))
                        .alias(f"_bool{i}"))
    return aggs


def _class_expr(df: DataFrame, i: int, f: T.StructField,
                skip: set = frozenset()) -> Column:
    dt = f.dataType
    if f.name in skip:
        return F.lit("unclassified")
    if isinstance(dt, NUMERIC_TYPES):
        return F.lit("numeric")
    if isinstance(dt, T.BooleanType):
        return F.lit("boolean")
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("datetime")
    if not isinstance(dt, T.StringType):
        return F.lit("other")
    nn = F.col(f"_nn{i}")
    has_null = nn < F.col("_rows")
    return (F.when(F.col("_rows") == 0, F.lit("text"))
             .when(F.col(f"_num{i}"), F.lit("numeric"))
             .when(F.col(f"_bool{i}") & (nn > 0) & ~has_null, F.lit("boolean"))
             .otherwise(F.lit("text")))


def column_profile(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """A17 + A12: one aggregate pass → long table
    ``(column_name, column_class, null_count)``.

    Classes follow the CSV semantics: a text column whose every value is a
    number (or that is entirely null) is ``numeric``; true/false text with
    no nulls is ``boolean``; other text is ``text``; typed columns keep the
    class of their type. Columns in ``skip`` (never filled) get only their
    null count."""
    skip = set(skip)
    stats = df.agg(*_stats_columns(df, skip))
    args = [F.lit(len(df.schema.fields))]
    for i, f in enumerate(df.schema.fields):
        args += [F.lit(f.name), _class_expr(df, i, f, skip),
                 (F.col("_rows") - F.col(f"_nn{i}")).cast("bigint")]
    return stats.select(F.stack(*args)).toDF("column_name", "column_class",
                                             "null_count")


def column_profile_dict(df: DataFrame, skip: Iterable[str] = ()
                        ) -> dict[str, tuple[str, int]]:
    """The profile on the driver: one small row per column."""
    return {r["column_name"]: (r["column_class"], r["null_count"])
            for r in column_profile(df, skip).collect()}


# ----------------------------------------------------------- exact median ---

# Offset that puts log10|v| of every non-zero double (-324 … 308) above 0.
_LOG_OFFSET = 400.0


def _signed_log(x: float) -> float:
    return 0.0 if x == 0 else math.copysign(math.log10(abs(x)) + _LOG_OFFSET,
                                            x)


def _bucket(vd: Column, lo_d: float, hi_d: float, buckets: int,
            log_scale: bool) -> Column | None:
    """Equal-width bucket of a double over [lo, hi]; with ``log_scale`` the
    width is taken on ``sign(v)·(log10|v| + 400)`` (0 ↦ 0), which is
    monotonic and spreads values that differ in magnitude — huge or tiny —
    evenly. None when the range cannot be split as doubles."""
    if log_scale:
        t = F.when(vd == 0, F.lit(0.0)).otherwise(
            F.signum(vd) * (F.log10(F.abs(vd)) + F.lit(_LOG_OFFSET)))
        t_lo, t_hi = _signed_log(lo_d), _signed_log(hi_d)
    else:
        t, t_lo, t_hi = vd / 2, lo_d / 2, hi_d / 2
    width = t_hi - t_lo
    if not width > 0 or math.isinf(width):
        return None
    raw = F.floor((t - F.lit(t_lo)) / F.lit(width) * F.lit(buckets))
    return F.greatest(F.lit(0), F.least(raw, F.lit(buckets - 1)))


def _midpoint(lo, hi):
    """A value of the column's exact type between ``lo`` (inclusive) and
    ``hi`` (exclusive); decimals keep their scale, however wide."""
    if isinstance(lo, decimal.Decimal):
        with decimal.localcontext(decimal.Context(prec=80)):
            step = decimal.Decimal(1).scaleb(lo.as_tuple().exponent)
            return lo + ((hi - lo) / 2).quantize(
                step, rounding=decimal.ROUND_FLOOR)
    if isinstance(lo, int):
        return lo + (hi - lo) // 2
    return lo + (hi / 2 - lo / 2)


def _exact(value, dt: T.DataType) -> Column:
    """``value`` as a literal of the column's type."""
    if isinstance(value, decimal.Decimal):
        return F.lit(format(value, "f")).cast(dt)
    return F.lit(value).cast(dt)


def _ranges(vals: DataFrame, marks: Sequence[tuple]) -> DataFrame:
    """The values of ``vals`` in each of ``marks`` (column, lo, hi, bucket):
    ``g`` (the mark's place), ``b`` (the bucket) and the value, in one column
    per data type (``v0``, ``v1`` …); the others are null."""
    kinds = {f.name: f.dataType for f in vals.schema.fields}
    slots = list(dict.fromkeys(kinds[c] for c, *_ in marks))
    rows = [F.when(
        F.col(c).between(_exact(lo, kinds[c]), _exact(hi, kinds[c])),
        F.struct(F.lit(g).alias("g"), b.cast("int").alias("b"),
                 *[(F.col(c) if kinds[c] == t else F.lit(None).cast(t))
                   .alias(f"v{i}") for i, t in enumerate(slots)]))
        for g, (c, lo, hi, b) in enumerate(marks)]
    return vals.select(F.explode(F.array(*rows)).alias("x")).where(
        F.col("x").isNotNull()).select("x.*")


def _values(row, names: Sequence[str]):
    """The value among columns of which at most one is not null."""
    return next(row[c] for c in names if row[c] is not None)


def _select_ranks(vals: DataFrame, wanted: Mapping[str, tuple], buckets: int,
                  fetch_limit: int, max_passes: int = 80) -> dict[str, dict]:
    """Exact k-th smallest (0-based) finite values of several columns.
    ``wanted``: column → (ks, smallest, largest, number of finite values);
    result: column → {k: value}.

    Distributed selection. Each pass is one job for all columns and ranks:
    it narrows every rank's [lo, hi] to the histogram bucket holding the rank
    (``groupBy(range, bucket)``: at most ``buckets`` result rows a range reach
    the driver), using the bucket's actual min and max as the next range. When
    that bucket is one value, the answer is known; when it holds at most
    ``fetch_limit`` rows, it waits for one last job that reads all such
    buckets. A pass that cuts the candidates by less than a quarter of the
    bucket count switches the next pass between linear and log-magnitude
    buckets, so values spread over many orders of magnitude converge as fast as
    evenly spread ones. Values that doubles cannot tell apart are halved on
    their exact type, so any number of them converges too."""
    kinds = {f.name: f.dataType for f in vals.schema.fields}
    out = {c: {} for c in wanted}
    # (column, k) → (lo, hi, rows below lo, rows in [lo, hi], log buckets?)
    pending = {(c, k): (lo, hi, 0, n, False)
               for c, (ks, lo, hi, n) in wanted.items() for k in ks}
    last: dict[tuple, list[tuple]] = {}     # (column, lo, hi) → (k, place)
    passes = 0
    while pending:
        passes += 1
        groups: dict[tuple, list[int]] = {}
        for (c, k), st in pending.items():
            if st[0] == st[1]:
                out[c][k] = st[0]
            else:
                groups.setdefault((c, *st), []).append(k)
        pending = {}
        if not groups:
            break
        marks, halved = [], []
        for c, lo, hi, _, _, log_scale in groups:
            b = None if passes >= max_passes else _bucket(
                F.col(c).cast("double"), float(lo), float(hi), buckets,
                log_scale)
            halved.append(b is None)
            marks.append((c, lo, hi, F.col(c) > _exact(
                _midpoint(lo, hi), kinds[c]) if b is None else b))
        spread = _ranges(vals, marks)
        slots = spread.columns[2:]
        hist: dict[int, list] = {}
        for r in spread.groupBy("g", "b").agg(
                F.count(F.lit(1)).alias("n"),
                *[f(v).alias(f"{x}{v}") for v in slots
                  for x, f in (("lo", F.min), ("hi", F.max))]).collect():
            hist.setdefault(r["g"], []).append(
                (r["b"], r["n"], _values(r, [f"lo{v}" for v in slots]),
                 _values(r, [f"hi{v}" for v in slots])))
        for g, ((c, _, _, below, cnt, log_scale), ks) in enumerate(
                groups.items()):
            for k in ks:
                seen = below
                for _, bn, mn, mx in sorted(hist[g]):
                    if k < seen + bn:
                        if mn == mx:
                            out[c][k] = mn
                        elif bn <= fetch_limit:
                            last.setdefault((c, mn, mx), []).append(
                                (k, k - seen))
                        else:
                            stalled = not halved[g] and bn * max(2, min(
                                8, buckets // 4)) > cnt
                            pending[c, k] = (mn, mx, seen, bn,
                                             log_scale != stalled)
                        break
                    seen += bn
    if last:
        spread = _ranges(vals, [(*m, F.lit(0)) for m in last])
        slots, got = spread.columns[2:], {}
        for r in spread.collect():
            got.setdefault(r["g"], []).append(_values(r, slots))
        for g, ((c, _, _), places) in enumerate(last.items()):
            rows = sorted(got[g])
            for k, at in places:
                out[c][k] = rows[at]
    return out


def _value_expr(dt: T.DataType, c: Column) -> Column:
    """The numeric value of a column for statistics: text is parsed, NaN
    is treated as missing."""
    v = parse_number(c) if isinstance(dt, T.StringType) else c
    if isinstance(dt, (T.StringType, T.FloatType, T.DoubleType)):
        v = nan_to_null(v)
    return v


def _median_stats(v: Column, tag: str = "") -> list[Column]:
    """Aggregates a median starts from: counts of −∞, finite values and +∞,
    and the smallest and largest finite value. Infinities are ranks, not
    part of a range that is cut into buckets."""
    low = v.cast("double") == F.lit(float("-inf"))
    high = v.cast("double") == F.lit(float("inf"))
    finite = F.when(~low & ~high, v)
    return [F.count_if(low).alias(f"_l{tag}"), F.count(finite)
            .alias(f"_n{tag}"), F.count_if(high).alias(f"_h{tag}"),
            F.min(finite).alias(f"_lo{tag}"), F.max(finite).alias(f"_hi{tag}")]


def _middle(stats: tuple) -> tuple[list[int], list[int]]:
    """The median's ranks, and those of them among the finite values."""
    below, n, above, _, _ = stats
    rows = below + n + above
    ks = sorted({(rows - 1) // 2, rows // 2}) if rows else []
    return ks, [k - below for k in ks if below <= k < below + n]


def _medians(vals: DataFrame, stats: Mapping[str, tuple], buckets: int,
             fetch_limit: int) -> dict:
    """Column → exact median, by one selection for all columns of ``stats``
    (the values of :func:`_median_stats`)."""
    wanted = {c: (_middle(s)[1], *s[3:], s[1]) for c, s in stats.items()
              if _middle(s)[1]}
    got = _select_ranks(vals, wanted, buckets, fetch_limit) if wanted else {}
    return {c: _median_of(s, got.get(c, {})) for c, s in stats.items()}


def _median_of(stats: tuple, got: Mapping):
    below, n = stats[:2]
    ks, _ = _middle(stats)
    if not ks:
        return None
    ends = [float("-inf") if k < below else got[k - below]
            if k < below + n else float("inf") for k in ks]
    a, b = ends[0], ends[-1]
    if isinstance(a, float) or isinstance(b, float):
        a, b = float(a), float(b)
        # the mean of two infinities of unlike sign is no number
        return a if a == b else None if math.isinf(a) and math.isinf(b) \
            else a / 2 + b / 2 if abs(a) > 1e307 or abs(b) > 1e307 \
            else (a + b) / 2
    with decimal.localcontext(decimal.Context(prec=80)):
        a, b = decimal.Decimal(a), decimal.Decimal(b)
        return a if len(ks) == 1 else (a + b) / 2


def exact_median(df: DataFrame, c: str | Column, buckets: int = 1024,
                 fetch_limit: int = 4096, stats: tuple | None = None):
    """Exact median of a numeric column (nulls and NaN skipped,
    infinities counted; even count → mean of the two middle values; no
    values, or −∞ and +∞ in the middle → None).

    Unlike ``F.median``/``percentile`` — whose final step holds every
    distinct value of the column in one task — every pass here is a
    distributed ``groupBy`` with a bounded result, so memory does not grow
    with the data. Decimal and integer inputs give an exact Decimal.
    ``stats`` = the values of :func:`_median_stats` when already known."""
    col = F.col(c) if isinstance(c, str) else c
    vals = df.select(col.alias("v"))
    vals = vals.select(_value_expr(vals.schema["v"].dataType, F.col("v"))
                       .alias("v"))
    if stats is None:
        stats = tuple(vals.agg(*_median_stats(F.col("v"))).first())
    return _medians(vals, {"v": stats}, buckets, fetch_limit)["v"]


# ------------------------------------------------------------------ fill ---

@dataclass
class FillPlan:
    """What :func:`fill_missing` decided, for the run log."""
    values: dict = field(default_factory=dict)      # column → fill value
    nulls_before: int = 0
    nulls_after: int = 0        # missing cells that the fill leaves


def _fill_literal(dt: T.DataType, median) -> Column | None:
    if median is None:
        return None
    if isinstance(dt, T.DecimalType):
        with decimal.localcontext(decimal.Context(prec=80)):
            q = decimal.Decimal(1).scaleb(-dt.scale)
            return _exact(decimal.Decimal(median).quantize(
                q, rounding=decimal.ROUND_HALF_UP), dt)
    if isinstance(dt, INTEGER_TYPES):
        # a fraction makes the column double (see fill_missing)
        return F.lit(int(median)).cast(dt) if median == int(median) \
            else F.lit(float(median))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.lit(float(median)).cast(dt)
    # numeric text column: keep text, write the number as text
    return F.lit(repr(float(median)))


def null_count_columns(df: DataFrame) -> list[Column]:
    """``count(*)`` and ``count(column)`` for every column — aggregates that
    can ride along any action as an ``Observation`` (see
    :func:`fill_missing`'s ``null_counts``)."""
    return [F.count(F.lit(1)).alias("_rows")] + [
        F.count(F.col(f"`{f.name}`")).alias(f"_nn{i}")
        for i, f in enumerate(df.schema.fields)]


def null_counts_from(df: DataFrame, row) -> dict[str, int]:
    rows = row["_rows"]
    return {f.name: rows - row[f"_nn{i}"]
            for i, f in enumerate(df.schema.fields)}


def fill_missing(df: DataFrame, exclude: Iterable[str] = (),
                 unknown: str = UNKNOWN_TEXT, buckets: int = 1024,
                 stage: bool = False, null_counts: dict | None = None,
                 median: str = "exact", accuracy: int = 10000
                 ) -> tuple[DataFrame, FillPlan]:
    """Numeric columns with gaps get their exact median (an integer
    column whose median is a fraction becomes double), text columns get ``'Unknown'``; boolean columns without gaps and datetime
    columns are left alone; ``exclude`` (key columns) is never filled, so a
    missing id stays missing and is rejected by the required rule.

    Passes: (1) null counts of every column — skipped when ``null_counts``
    is given (e.g. observed while the input was staged); (2) only for
    fillable columns that have gaps — text class (numeric or not) and
    count/min/max of the numbers; (3) the median selection passes.
    ``stage=True`` first writes the input under the checkpoint root, for
    inputs that are expensive to recompute (joins, shuffles) and need
    several passes. ``median="approx"`` takes ``percentile_approx`` (a data
    value within 1/``accuracy`` of the middle rank) from pass (2) and skips
    the selection passes, for very large inputs where an estimate will do."""
    if median not in ("exact", "approx"):
        raise ValueError(f"median must be 'exact' or 'approx', not {median!r}")
    if stage:
        from ..session import stage as stage_table
        df = stage_table(df, "fill-input")
    skip = set(exclude)
    fields = df.schema.fields
    nulls = null_counts if null_counts is not None else null_counts_from(
        df, df.agg(*null_count_columns(df)).first())
    plan = FillPlan(nulls_before=sum(nulls.values()))
    gaps = [f for f in fields if nulls[f.name] and f.name not in skip and
            isinstance(f.dataType, (T.StringType,) + NUMERIC_TYPES)]
    stats, approx = {}, {}
    if gaps:
        aggs = []
        for i, f in enumerate(gaps):
            c = F.col(f"`{f.name}`")
            v = _value_expr(f.dataType, c)
            if isinstance(f.dataType, T.StringType):
                aggs.append(F.coalesce(F.bool_and(c.isNull() | is_number_text(c)),
                                       F.lit(True)).alias(f"_num{i}"))
            else:
                aggs.append(F.lit(True).alias(f"_num{i}"))
            aggs += _median_stats(v, str(i))
            if median == "approx":
                aggs.append(F.percentile_approx(v, 0.5, accuracy)
                            .alias(f"_q{i}"))
        r2 = df.agg(*aggs).first()
        for i, f in enumerate(gaps):
            stats[f.name] = (r2[f"_num{i}"], tuple(
                r2[f"_{x}{i}"] for x in ("l", "n", "h", "lo", "hi")))
            if median == "approx":
                approx[f.name] = r2[f"_q{i}"]
    todo = [f for f in fields if f.name in stats and stats[f.name][0]]
    if median == "approx":
        medians = approx
    else:
        got = _medians(
            df.select(*[_value_expr(f.dataType, F.col(f"`{f.name}`"))
                        .alias(f"c{i}") for i, f in enumerate(todo)]),
            {f"c{i}": stats[f.name][1] for i, f in enumerate(todo)},
            buckets, 4096) if todo else {}
        medians = {f.name: got[f"c{i}"] for i, f in enumerate(todo)}
    exprs = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        fill = None
        if f.name in stats:
            numeric = stats[f.name][0]
            if numeric:
                med = medians.get(f.name)
                fill = _fill_literal(f.dataType, med)
                if med is not None:
                    plan.values[f.name] = med
            else:
                fill = F.lit(unknown)
                plan.values[f.name] = unknown
        exprs.append(F.coalesce(c, fill).alias(f.name) if fill is not None
                     else c)
    plan.nulls_after = plan.nulls_before - sum(nulls[c] for c in plan.values)
    return df.select(*exprs), plan


# ---------------------------------------------------------------- coerce ---

def layout_profile(df: DataFrame, columns: Sequence[str],
                   formats: Sequence[str] = ALL_FORMATS) -> DataFrame:
    """``(column_name, layout, parsed)`` per text column and layout, the
    texts that the layout parses; layout null: the texts that become null.
    One aggregate over the data, whatever the number of layouts."""
    text = [c for c in columns if c in df.columns
            and isinstance(df.schema[c].dataType, T.StringType)]
    spark = df.sparkSession
    if not text:
        return spark.createDataFrame(
            [], "column_name string, layout string, parsed bigint")
    aggs, entries = [], []
    for i, c in enumerate(text):
        col = F.col(f"`{c}`")
        for j, f in enumerate(formats):
            aggs.append(F.count(parse_layout(col, f)).alias(f"_p{i}_{j}"))
            entries.append((c, f, f"_p{i}_{j}"))
        aggs.append(F.count_if(col.isNotNull() & parse_datetime(
            col, formats).isNull()).alias(f"_p{i}_none"))
        entries.append((c, None, f"_p{i}_none"))
    args = [F.lit(len(entries))]
    for c, f, n in entries:
        args += [F.lit(c), F.lit(f).cast("string"), F.col(n)]
    return df.agg(*aggs).select(F.stack(*args)).toDF(
        "column_name", "layout", "parsed")


def choose_layouts(profile: DataFrame) -> dict[str, dict[str, int]]:
    """Of each column the layouts that parse any text with the number of
    texts, the most frequent first (equal ones in the order of the profile),
    and ``"none"``: the texts that no layout parses. A day and month that
    could be either way round are read as most of the column's texts can be.
    """
    out: dict[str, dict[str, int]] = {}
    for r in profile.collect():        # one row per column and layout
        out.setdefault(r["column_name"], {})[r["layout"]] = r["parsed"]
    chosen = {}
    for c, counts in out.items():
        none = counts.pop(None)
        chosen[c] = dict(sorted(((f, n) for f, n in counts.items() if n),
                                key=lambda x: -x[1])) | {"none": none}
    return chosen


def coerce_column(c: Column, dt: T.DataType, target: str,
                  formats: Sequence[str] = DATETIME_FORMATS) -> Column:
    """P3-P5 for one column; unparseable → null, never an error."""
    t = target.strip().lower()
    if t == "string":
        return to_text(c)
    if t == "datetime":
        if isinstance(dt, T.StringType):
            return parse_datetime(c, formats)
        if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("timestamp_ntz")
        return F.lit(None).cast("timestamp_ntz")   # numbers are not dates
    if t in ("numeric", "double") or t.startswith("decimal") or t in (
            "int", "integer", "bigint", "long"):
        to = "double" if t == "numeric" else t
        if isinstance(dt, T.StringType):
            out = parse_number(c, to)
        else:
            out = c.try_cast(to)
        return nan_to_null(out) if to in ("double", "float") else out
    raise ValueError(f"unknown target type {target!r}")


def coerce_types(df: DataFrame, mappings: Mapping[str, str],
                 formats: Sequence[str] = DATETIME_FORMATS,
                 layouts: Mapping[str, Mapping[str, int]] | None = None
                 ) -> DataFrame:
    """Apply every conversion in one projection. A mapped column that is
    absent is skipped with a warning; an unknown type name is an error.
    ``formats`` are the datetime layouts, ``layouts`` those chosen for a
    column by :func:`choose_layouts`."""
    def of(c: str) -> list[str]:
        return [f for f in layouts[c] if f != "none"] \
            if layouts and c in layouts else list(formats)

    types = {f.name: f.dataType for f in df.schema.fields}
    for col, t in mappings.items():
        if col not in types:
            log.warning("%s: not in the input, left out", col)
    return df.select(*[
        coerce_column(F.col(f"`{n}`"), types[n], mappings[n], of(n)).alias(n)
        if n in mappings else F.col(f"`{n}`") for n in df.columns])


# ---------------------------------------------------------------- ranges ---

def range_rules(df: DataFrame, constraints: Mapping[str, tuple]) -> list[Rule]:
    rules = []
    for col, (lo, hi) in constraints.items():
        if col not in df.columns:
            log.warning("%s: not in the input, left out", col)
            continue
        rules.append(range_rule(col, lo, hi))
    return rules


def range_filter(df: DataFrame, constraints: Mapping[str, tuple]) -> DataFrame:
    """Keep rows with ``lo <= value <= hi`` for every constraint; null
    and NaN values fail. One filter, pushed to the scan where possible."""
    cond = F.lit(True)
    for r in range_rules(df, constraints):
        cond = cond & r.passes()
    return df.filter(cond)


def range_failures(df: DataFrame, constraints: Mapping[str, tuple]
                   ) -> DataFrame:
    """Rows in, rows removed by each rule in order (a row is charged to
    the first rule it fails), total removed, rows out — one pass."""
    from ..functions.rules import ordered_failures
    rules = range_rules(df, constraints)
    fails = ordered_failures(rules)
    aggs = [F.count(F.lit(1)).alias("rows_in")]
    aggs += [c.alias(f"removed_{r.columns[0]}") for r, (_, c) in
             zip(rules, fails)]
    out = df.agg(*aggs)
    total = F.lit(0).cast("bigint")
    for r in rules:
        total = total + F.col(f"removed_{r.columns[0]}")
    return out.select("*", total.alias("removed_total"),
                      (F.col("rows_in") - total).alias("rows_out"))
