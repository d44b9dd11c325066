"""JDBC sink (S5, S6): parallel batched inserts into a relational table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .lake import save_mode


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batchsize: int = 1000, num_partitions: int | None = None,
               truncate: bool = False, properties: Mapping | None = None
               ) -> None:
    """Each partition opens one connection and sends multi-row batches of
    ``batchsize`` rows; ``num_partitions`` caps concurrent connections (Spark
    coalesces to it, without a shuffle). ``replace`` + ``truncate=True``
    keeps the table definition (constraints, grants) and empties it.

    A JDBC write commits per partition: a failed job can leave some
    partitions' rows behind. For all-or-nothing loads write to a staging
    table and swap it in the database, or load the lake table first
    (:func:`loadstar.sinks.lake.load_run`), which is idempotent."""
    w = (df.write.format("jdbc").mode(save_mode(mode))
         .option("url", url).option("dbtable", table)
         .option("batchsize", batchsize))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    if truncate:
        w = w.option("truncate", "true")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def execute_sql(spark, url: str, statements, properties: Mapping | None = None
                ) -> None:
    """Run DDL/DML statements in the database as one transaction, over a
    JDBC connection opened by the driver's JVM (no Spark job)."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k != "driver":
            props.setProperty(k, str(v))
    if properties and "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        for sql in statements:
            st.executeUpdate(sql)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


@dataclass(frozen=True)
class JdbcTarget:
    """A relational table as the load target of a run.

    ``atomic=True``: rows are first written (in parallel, per partition) to
    a staging table, then moved into the target by one
    ``INSERT INTO … SELECT`` in a single database transaction and the
    staging table dropped — a failed or retried Spark job never leaves part
    of a load in the target."""
    url: str
    table: str
    properties: Mapping = field(default_factory=dict)
    batchsize: int = 1000
    num_partitions: int | None = None
    atomic: bool = False

    def write(self, df: DataFrame, mode: str = "append") -> None:
        if not self.atomic:
            write_jdbc(df, self.url, self.table, mode, self.batchsize,
                       self.num_partitions, properties=self.properties)
            return
        import uuid
        stage = f"{self.table}_STAGE_{uuid.uuid4().hex[:8]}".upper()
        write_jdbc(df, self.url, stage, "replace", self.batchsize,
                   self.num_partitions, properties=self.properties)
        cols = ", ".join(df.columns)
        try:
            if mode in ("replace", "overwrite"):
                stmts = [f"DELETE FROM {self.table}"]
            else:
                stmts = []
            stmts.append(f"INSERT INTO {self.table} ({cols}) "
                         f"SELECT {cols} FROM {stage}")
            execute_sql(df.sparkSession, self.url, stmts, self.properties)
        finally:
            execute_sql(df.sparkSession, self.url, [f"DROP TABLE {stage}"],
                        self.properties)

    def count(self, spark) -> int:
        """Rows in the table, counted by the database (a pushed-down
        ``COUNT(*)`` query; 0 when the table does not exist yet)."""
        r = spark.read.format("jdbc").option("url", self.url).option(
            "query", f"SELECT COUNT(*) AS n FROM {self.table}")
        for k, v in self.properties.items():
            r = r.option(k, v)
        if not self.exists(spark):
            return 0
        return int(r.load().first()[0])

    def exists(self, spark) -> bool:
        """Does the database list the table (or view)?"""
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in self.properties.items():
            props.setProperty(k, str(v))
        con = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            schema, _, name = self.table.rpartition(".")
            meta = con.getMetaData()
            fold = str.upper if meta.storesUpperCaseIdentifiers() else \
                str.lower if meta.storesLowerCaseIdentifiers() else str
            found = meta.getTables(None, fold(schema) if schema else None,
                                   fold(name.strip('"')), None)
            return bool(found.next())
        finally:
            con.close()
