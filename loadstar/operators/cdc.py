"""Change data capture (C1-C3): snapshot diff → change log → apply.

Both directions are one ``union`` + one ``groupBy(key)`` aggregate instead
of a join: a full-outer join would shuffle both sides and put every row of
a hot key into one task, while the aggregate combines each key's rows
inside every map task first (partial aggregation) and ships one row per
key per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import IMAGE_TIME, json_image, ts_literal
from ..session import drop_path, scratch_path, stage
from ..sinks.lake import path_exists

# --- fixed values -----------------------------------------------------------
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
# ---------------------------------------------------------------------------

CHANGE_LOG_SCHEMA = T.StructType([
    T.StructField("change_id", T.LongType(), True),
    T.StructField("order_id", T.StringType(), True),
    T.StructField("change_type", T.StringType(), True),
    T.StructField("changed_at", T.TimestampNTZType(), True),
    T.StructField("old_values", T.StringType(), True),
    T.StructField("new_values", T.StringType(), True),
])


def repeated_keys(snapshot: DataFrame, key: str) -> DataFrame:
    """Keys that a snapshot holds more than once, with their row counts."""
    return snapshot.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")) \
        .filter(F.col("row_count") > 1)


def _row_hashes(df: DataFrame, key: str, cols: Sequence[str], side: int
                ) -> DataFrame:
    """(key, counts, 128 bits of the row's hash): fixed-width columns that a
    hash aggregate combines. Nulls count with their place."""
    held = [F.col(f"`{c}`") for c in cols]
    flags = [F.col(f"`{c}`").isNull() for c in cols]
    return df.select(
        F.col(f"`{key}`").alias("_key"),
        *[F.lit(int(side == s)).alias(f"_c{s}") for s in (0, 1)],
        *[(F.xxhash64(F.lit(h), *flags, *held) if side == s else
           F.lit(None).cast("long")).alias(f"_h{s}{h}")
          for s in (0, 1) for h in (0, 1)])


def differing_keys(old: DataFrame, new: DataFrame, key: str,
                   columns: Sequence[str]) -> DataFrame:
    """Keys that only one snapshot holds, whose rows differ, or that repeat
    in one: one aggregate over 128-bit row hashes, not over rows."""
    both = _row_hashes(old, key, columns, 0).unionByName(
        _row_hashes(new, key, columns, 1))
    g = both.groupBy("_key").agg(
        F.sum("_c0").alias("_c0"), F.sum("_c1").alias("_c1"),
        *[F.max(f"_h{s}{h}").alias(f"_h{s}{h}")
          for s in (0, 1) for h in (0, 1)])
    same = (F.col("_c0") == 1) & (F.col("_c1") == 1) \
        & (F.col("_h00") == F.col("_h10")) & (F.col("_h01") == F.col("_h11"))
    return g.filter(~F.coalesce(same, F.lit(False))).select("_key")


def _of_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    return df.join(keys, F.col(f"`{key}`").eqNullSafe(F.col("_key")),
                   "left_semi")


def diff(old: DataFrame, new: DataFrame, key: str, as_of,
         columns: Sequence[str] | None = None) -> DataFrame:
    """Compare two snapshots keyed by ``key`` and emit the change log:
    INSERT (new image), UPDATE (old + new image, only when some column
    differs, nulls compared as equal) and DELETE (old image).

    A snapshot is expected to hold one row per key; if a key repeats, the
    largest row image stands for it (deterministic), and
    :func:`repeated_keys` reports it. Images are exact: decimals keep their
    digits, timestamps their microseconds.

    Row hashes find the keys whose rows differ; whole rows are read and
    compared for those keys only. ``change_id`` tells the changes of one call
    apart; :func:`append_changes` gives them their place in the log."""
    cols = list(columns or new.columns)
    if not any(isinstance(f.dataType, (T.MapType, T.VariantType))
               for f in new.schema if f.name in cols):
        keys = differing_keys(old, new, key, cols)
        old, new = _of_keys(old, key, keys), _of_keys(new, key, keys)
    side = lambda df, s: df.select(
        F.col(key).alias("_key"),
        F.when(F.lit(s == 0), F.struct(*[F.col(f"`{c}`") for c in cols]))
         .alias("_o"),
        F.when(F.lit(s == 1), F.struct(*[F.col(f"`{c}`") for c in cols]))
         .alias("_n"))
    both = side(old, 0).unionByName(side(new, 1))
    g = both.groupBy("_key").agg(F.max("_o").alias("_o"),
                                 F.max("_n").alias("_n"))
    o, n = F.col("_o"), F.col("_n")
    kind = (F.when(o.isNull(), F.lit(INSERT))
             .when(n.isNull(), F.lit(DELETE))
             .when(~o.eqNullSafe(n), F.lit(UPDATE)))
    changed = g.select("_key", "_o", "_n", kind.alias("change_type")).filter(
        F.col("change_type").isNotNull())
    img = lambda s: json_image(
        [F.col(f"{s}.`{c}`").alias(c) for c in cols])
    at = ts_literal(as_of)
    return changed.select(
        F.xxhash64(F.col("_key"), at).alias("change_id"),
        F.col("_key").alias(key),
        "change_type",
        at.alias("changed_at"),
        F.when(o.isNotNull(), img("_o")).alias("old_values"),
        F.when(n.isNotNull(), img("_n")).alias("new_values"))


def _marks(spark: SparkSession, log: str):
    """File system, and the high-water marks kept with a change log."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{log.rstrip('/')}/_sequence")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] \
        if fs.exists(folder) else []
    return fs, folder, sorted(int(n) for n in names if n.isdigit())


def last_change_id(spark: SparkSession, log: str) -> int:
    """The highest change id of a log (0 without any): its newest mark, or
    above that, if a writer stopped between rows and mark, what the rows say.
    Row groups at or below the mark are skipped by their statistics."""
    mark = (_marks(spark, log)[2] or [0])[-1]
    if not path_exists(spark, log):
        return mark
    top = read_changes(spark, log).filter(F.col("change_id") > mark).agg(
        F.max("change_id")).first()[0]
    return max(mark, top or 0)


def number_changes(changes: DataFrame, after: int,
                   order_by: Sequence[str] = ()) -> tuple[DataFrame, int, str]:
    """``changes`` with ``change_id`` = ``after`` + 1, + 2 … without gaps, in
    the order of ``order_by`` (else as the tasks hold them); the last id; and
    the folder where the rows lie meanwhile. Tasks number their own rows, and
    one count per task makes the numbers follow each other."""
    spark = changes.sparkSession
    if order_by:
        changes = changes.repartitionByRange(*order_by).sortWithinPartitions(
            *order_by)
    path = scratch_path(spark, "numbered-changes")
    held = stage(changes.withColumn("_at", F.monotonically_increasing_id()),
                 path=path).withColumns({
        "_part": F.shiftright("_at", 33),
        "_nth": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task
    parts = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0))
        .alias("_before"))
    rows = held.count()
    out = held.join(F.broadcast(parts.drop("_n")), "_part").withColumn(
        "change_id", F.lit(after + 1) + F.col("_before") + F.col("_nth"))
    return out.drop("_at", "_part", "_nth", "_before"), after + rows, path


def append_changes(changes: DataFrame, log: str, key: str = "order_id",
                   order_by: Sequence[str] = ()) -> int:
    """Append change rows to the change-log table at ``log`` (columns and
    types of the log; the key column is stored as text) with ids that follow
    the log's last one without gaps, so of two changes of a key at one instant
    the one appended later is the newer. Returns the last id.

    The new high-water mark is written beside the rows, after them. One writer
    at a time."""
    spark = changes.sparkSession
    after = last_change_id(spark, log)
    if after >= 1 << 62:
        raise ValueError(f"{log} holds ids that were not given in sequence")
    numbered, last, path = number_changes(changes, after, order_by)
    numbered.select(*[
        F.col(key if f.name == "order_id" else f.name).cast(f.dataType)
        .alias(f.name) for f in CHANGE_LOG_SCHEMA]).write.mode(
        "append").parquet(log)
    drop_path(spark, path)
    fs, folder, old = _marks(spark, log)
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if last not in old:
        fs.mkdirs(folder)
        fs.create(here(folder, str(last))).close()
    for m in old:
        if m < last:
            fs.delete(here(folder, str(m)), False)
    return last


def read_changes(spark, log: str) -> DataFrame:
    """The change-log table at ``log``."""
    return spark.read.schema(CHANGE_LOG_SCHEMA).parquet(log)


def latest(changes: DataFrame, key: str,
           order: Sequence[str] = ("changed_at", "change_id")) -> DataFrame:
    """C3 (first half): the newest change per key, newest by ``order``
    (later ``changed_at`` wins; equal times → higher ``change_id``).

    ``max(struct(order…, row…))`` per key: a partial aggregate, so a key
    with a third of all changes is reduced inside every map task."""
    order = list(order)
    rest = [c for c in changes.columns if c != key and c not in order]
    ordered = order + rest
    packed = F.struct(*[F.col(f"`{c}`").alias(f"_f{i}")
                        for i, c in enumerate(ordered)])
    g = changes.groupBy(key).agg(F.max(packed).alias("_last"))
    pos = {c: i for i, c in enumerate(ordered)}
    return g.select(*[F.col(f"`{c}`") if c == key else
                      F.col(f"_last._f{pos[c]}").alias(c)
                      for c in changes.columns])


def _row_type(cols, schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(c, schema[c].dataType, True)
                         for c in cols])


def _image(new_values: str, row_type: T.StructType):
    return F.from_json(F.col(new_values), row_type,
                       {"timestampNTZFormat": IMAGE_TIME,
                        "timestampFormat": IMAGE_TIME})


def unreadable_changes(changes: DataFrame, schema: T.StructType, key: str,
                       change_type: str = "change_type",
                       new_values: str = "new_values") -> DataFrame:
    """Changes that no apply can use: a null key, or an INSERT or UPDATE
    whose image is missing, is no JSON object of the table's row, or names
    another key. :func:`apply_changes` leaves them out; keep them aside."""
    image = _image(new_values, _row_type(schema.names, schema))
    usable = F.col(f"`{key}`").isNotNull() & (
        (F.col(change_type) == DELETE)
        | image[key].eqNullSafe(F.col(f"`{key}`").cast(schema[key].dataType)))
    return changes.filter(~F.coalesce(usable, F.lit(False)))


# State columns of a table that changes are applied to as they arrive
STATE = ("_changed_at", "_change_id", "_deleted")


def with_state(df: DataFrame) -> DataFrame:
    """A table as the starting state: rows older than any change."""
    return df.withColumns({
        "_changed_at": F.lit(None).cast("timestamp_ntz"),
        "_change_id": F.lit(None).cast("bigint"), "_deleted": F.lit(False)})


def visible(state: DataFrame) -> DataFrame:
    """The rows of a stateful table that are there."""
    return state.filter(~F.col("_deleted")).drop(*STATE)


def apply_changes(target: DataFrame, changes: DataFrame, key: str,
                  changed_at: str = "changed_at",
                  change_id: str = "change_id",
                  change_type: str = "change_type",
                  new_values: str = "new_values") -> DataFrame:
    """Bring ``target`` up to date with a change log. Per key the newest
    change (later ``changed_at``, then higher ``change_id``) wins; a DELETE
    removes the key; INSERT and UPDATE carry the full new image (JSON text,
    read with the target's schema). Keys without changes keep their row;
    :func:`unreadable_changes` are left out.

    A ``target`` made by :func:`with_state` keeps, per key, when its row last
    changed, also for deleted keys (as tombstones). A change that arrives
    late then loses to what is newer, and batches can be applied in any
    order, or twice. A plain target knows no times: every change is newer.

    One union + one aggregate per key — no join, no window. (``MERGE INTO``
    needs a table format such as Delta; this is the plain-parquet form.)"""
    stateful = all(c in target.columns for c in STATE)
    cols = [c for c in target.columns if not (stateful and c in STATE)]
    row_type = _row_type(cols, target.schema)
    none = lambda t: F.lit(None).cast(t)
    cur = target.select(
        F.col(f"`{key}`").alias("_key"),
        F.struct((F.col("_changed_at") if stateful else none("timestamp_ntz"))
                 .alias("at"),
                 (F.col("_change_id") if stateful else none("bigint"))
                 .alias("id"),
                 (F.col("_deleted") if stateful else F.lit(False))
                 .alias("del"),
                 F.struct(*[F.col(f"`{c}`").cast(row_type[c].dataType)
                            for c in cols]).cast(row_type).alias("row"))
        .alias("_v"))
    image = _image(new_values, row_type)
    deletes = F.col(change_type) == DELETE
    chg = changes.select(
        F.col(f"`{key}`").cast(target.schema[key].dataType).alias("_key"),
        F.struct(F.col(changed_at).cast("timestamp_ntz").alias("at"),
                 F.col(change_id).cast("bigint").alias("id"),
                 deletes.alias("del"),
                 F.when(~deletes, image).alias("row")).alias("_v")).filter(
        F.col("_key").isNotNull() & (
            F.col("_v.del") | F.col(f"_v.row.`{key}`").eqNullSafe(
                F.col("_key"))))
    g = cur.unionByName(chg).groupBy("_key").agg(F.max("_v").alias("_v"))
    if not stateful:
        return g.filter(~F.col("_v.del")).select(
            *[F.col(f"_v.row.`{c}`").alias(c) for c in cols])
    return g.select(*[
        (F.col("_key") if c == key else F.col(f"_v.row.`{c}`")).alias(c)
        for c in cols], F.col("_v.at").alias("_changed_at"),
        F.col("_v.id").alias("_change_id"), F.col("_v.del").alias("_deleted"))
