"""Change-capture queries (C1-C3) over two snapshots of orders and over the
events stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc
from ..session import scratch_path
from . import lens
from .lens import AS_OF
from .registry import register

AS_OF_TS = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
IMAGE_COLS = ("order_id", "customer_id", "order_status", "total_price",
              "order_date", "priority")
# Snapshot semantics: "old" is the order book before pending orders arrived;
# "new" has the pending orders, has dropped finished low-priority orders
# (archived) and has every open order finished.
SQL_SNAPSHOTS = """base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS order_status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_price,
         o_orderdate AS order_date,
         o_orderpriority AS priority
  FROM orders),
old AS (SELECT * FROM base WHERE order_status <> 'P'),
new AS (
  SELECT * REPLACE (CASE WHEN order_status = 'O' THEN 'F'
                         ELSE order_status END AS order_status)
  FROM base WHERE NOT (order_status = 'F' AND priority = '5-LOW'))"""


def snapshots(spark, sf_dir):
    base = lens.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_price"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("priority"))
    old = base.filter(F.col("order_status") != "P")
    new = (base.filter(~((F.col("order_status") == "F")
                         & (F.col("priority") == "5-LOW")))
               .withColumn("order_status",
                           F.when(F.col("order_status") == "O", F.lit("F"))
                            .otherwise(F.col("order_status"))))
    return old, new


def _img(a: str) -> str:
    """The row image: decimals and timestamps written out by hand, with all
    their digits."""
    def field(c: str) -> str:
        v = f"{a}.{c}"
        text = f"CAST({v} AS VARCHAR)" if c == "total_price" else \
            f"""'"' || strftime({v}, '%Y-%m-%d %H:%M:%S.%f') || '"'""" \
            if c == "order_date" else f"CAST(to_json({v}) AS VARCHAR)"
        return f"""'"{c}":' || coalesce({text}, 'null')"""
    return "'{' || " + " || ',' || ".join(map(field, IMAGE_COLS)) + " || '}'"


_CHANGED = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in IMAGE_COLS)


@register("cdc_diff", f"""
WITH {SQL_SNAPSHOTS}
SELECT coalesce(n.order_id, o.order_id) AS order_id,
       CASE WHEN o.order_id IS NULL THEN 'INSERT'
            WHEN n.order_id IS NULL THEN 'DELETE'
            ELSE 'UPDATE' END AS change_type,
       {AS_OF_TS} AS changed_at,
       CASE WHEN o.order_id IS NOT NULL THEN {_img('o')} END AS old_values,
       CASE WHEN n.order_id IS NOT NULL THEN {_img('n')} END AS new_values
FROM old o FULL OUTER JOIN new n ON o.order_id = n.order_id
WHERE o.order_id IS NULL OR n.order_id IS NULL OR {_CHANGED}""")
def cdc_diff(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return cdc.diff(old, new, "order_id", AS_OF).drop("change_id")


@register("cdc_apply_roundtrip", f"""
WITH {SQL_SNAPSHOTS}
SELECT * FROM new""")
def cdc_apply_roundtrip(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return cdc.apply_changes(old, cdc.diff(old, new, "order_id", AS_OF),
                             "order_id")


@register("cdc_latest", """
SELECT user_id, changed_at, change_id, change_type, event_type, value
FROM (
  SELECT user_id, ts AS changed_at, event_id AS change_id,
         CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END
           AS change_type, event_type, value,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1""")
def cdc_latest(spark, sf_dir):
    ev = lens.table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").alias("changed_at"),
        F.col("event_id").alias("change_id"),
        F.when(F.col("event_type") == "error", F.lit(cdc.DELETE))
         .otherwise(F.lit(cdc.UPDATE)).alias("change_type"),
        "event_type", "value")
    return cdc.latest(ev, "user_id")


@register("cdc_apply_events", """
WITH ranked AS (
  SELECT user_id, ts, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY ts DESC, event_id DESC) AS rn
  FROM events),
changed AS (SELECT * FROM ranked WHERE rn = 1),
firsts AS (
  SELECT user_id, event_type AS last_event, value AS last_value
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                     ORDER BY ts, event_id) AS r0
        FROM events) WHERE r0 = 1)
SELECT f.user_id,
       coalesce(c.event_type, f.last_event) AS last_event,
       coalesce(c.value, f.last_value) AS last_value
FROM firsts f LEFT JOIN changed c ON c.user_id = f.user_id
WHERE coalesce(c.event_type, '') <> 'error'""")
def cdc_apply_events(spark, sf_dir):
    """Per-user state (last event type and value) kept up to date from the
    event stream: the state starts at each user's first event, every event
    is an upsert of the new image, an ``error`` event deletes the user."""
    ev = lens.table(spark, sf_dir, "events")
    first = cdc.latest(
        ev.select("user_id", (-F.unix_micros(F.col("ts").cast("timestamp")))
                  .alias("changed_at"), (-F.col("event_id")).alias("change_id"),
                  F.col("event_type").alias("last_event"),
                  F.col("value").alias("last_value")), "user_id")
    target = first.select("user_id", "last_event", "last_value")
    changes = ev.select(
        "user_id", F.col("ts").alias("changed_at"),
        F.col("event_id").alias("change_id"),
        F.when(F.col("event_type") == "error", F.lit(cdc.DELETE))
         .otherwise(F.lit(cdc.UPDATE)).alias("change_type"),
        F.to_json(F.struct(F.col("user_id"),
                           F.col("event_type").alias("last_event"),
                           F.col("value").alias("last_value")))
         .alias("new_values"))
    return cdc.apply_changes(target, changes, "user_id")


@register("cdc_sequence", f"""
WITH {SQL_SNAPSHOTS},
c AS (SELECT count(*) AS n FROM old FULL JOIN new USING (order_id)
      WHERE old.order_status IS DISTINCT FROM new.order_status
         OR old.customer_id IS NULL OR new.customer_id IS NULL)
SELECT 1 AS first_id, 2 * n AS last_id, 2 * n AS changes, 2 * n AS ids FROM c""")
def cdc_sequence(spark, sf_dir):
    """Ids of two appends to one log follow each other without gaps."""
    old, new = snapshots(spark, sf_dir)
    log = scratch_path(spark, "change-log")
    for a, b in ((old, new), (new, old)):
        cdc.append_changes(cdc.diff(a, b, "order_id", AS_OF), log)
    return cdc.read_changes(spark, log).agg(
        F.min("change_id").alias("first_id"),
        F.max("change_id").alias("last_id"),
        F.count(F.lit(1)).alias("changes"),
        F.count_distinct("change_id").alias("ids"))


@register("cdc_same_instant", f"""
WITH {SQL_SNAPSHOTS}
SELECT * FROM old""")
def cdc_same_instant(spark, sf_dir):
    """A diff and its reverse, logged at one instant, apply in the
    order in which they were appended."""
    old, new = snapshots(spark, sf_dir)
    log = scratch_path(spark, "change-log")
    for a, b in ((old, new), (new, old)):
        cdc.append_changes(cdc.diff(a, b, "order_id", AS_OF), log)
    return cdc.apply_changes(new, cdc.read_changes(spark, log), "order_id")
