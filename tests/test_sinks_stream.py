"""Sinks, the load run, incremental ingest and the driver contract
(FIXTURES B30; JDBC on embedded in-memory Derby — no server, no port)."""
from dataclasses import replace

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001, write
from loadstar.plans.jobspec import SALES_JOB
from loadstar.plans.loadjob import run
from loadstar.sinks import jdbc, lake
from loadstar.sinks.export import export_csv
from loadstar.sinks.files import archive_file
from loadstar.sources.csv import read_csv, read_jdbc
from loadstar.streaming import ingest

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_jdbc_modes_on_derby(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    df = spark.createDataFrame([("A1", 10.5), ("A2", 20.0)],
                               "order_id string, price double")
    jdbc.write_jdbc(df, url, "SALES", mode="fail", batchsize=1,
                    num_partitions=2, properties=DERBY)
    with pytest.raises(Exception):
        jdbc.write_jdbc(df, url, "SALES", mode="fail", properties=DERBY)
    jdbc.write_jdbc(df, url, "SALES", mode="append", properties=DERBY)
    back = read_jdbc(spark, url, "SALES", DERBY)
    assert back.count() == 4
    jdbc.write_jdbc(df.limit(1), url, "SALES", mode="replace", truncate=True,
                    properties=DERBY)
    assert read_jdbc(spark, url, "SALES", DERBY).count() == 1


def test_idempotent_reload(spark, tmp):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    t = os.path.join(tmp, "t")
    assert lake.load_run(df.filter("id < 5"), t, "r1") == 5
    lake.load_run(df.filter("id < 5"), t, "r1")
    lake.load_run(df.filter("id >= 5"), t, "r2")
    out = spark.read.parquet(t)
    assert out.count() == 10
    assert {r.run_id: r.n for r in out.groupBy("run_id").agg(
        F.count("*").alias("n")).collect()} == {"r1": 5, "r2": 5}


def test_write_modes_and_verify(spark, tmp):
    t = os.path.join(tmp, "t")
    df = spark.range(3)
    assert lake.write_observed(df, t, mode="fail") == 3
    with pytest.raises(Exception):
        lake.write_table(df, t, mode="fail")
    lake.write_table(df, t, mode="append")
    assert lake.row_count(spark, t) == 6
    lake.verify_load(3, 3, 6)
    with pytest.raises(lake.LoadVerificationError):
        lake.verify_load(3, 3, 5)
    assert lake.table_exists(spark, t)
    assert not lake.table_exists(spark, t + "_nope")


def test_defaults(spark):
    df = spark.createDataFrame([(None,), (3,)], "quantity int")
    out = lake.with_defaults(df, {"quantity": 1, "created_at": F.lit("x")})
    assert sorted((r.quantity, r.created_at) for r in out.collect()) == [
        (1, "x"), (3, "x")]


def _csv(tmp, name, text):
    return write(os.path.join(tmp, name), text)


def test_load_run_end_to_end(spark, tmp):
    src = _csv(tmp, "sales.csv",
               "order_id,customer_id,order_date,product_id,price,note\n"
               "A1,C1,2026-01-02,P1,10.5,x\n"
               "A1,C1,2026-01-02,P1,10.5,x\n"
               "A2,,01/03/2026,P2,NA,y\n"
               "A3,C3,2026-01-04 05:06:07,P3,250000,z\n"
               "A4,C4,2026-01-05,P4,20,w,extra\n")
    target = os.path.join(tmp, "sales")
    res = run(spark, src, SALES_JOB, target, run_id="r1",
              reject_target=target + "_rej", run_log_target=target + "_log",
              archive_dir=os.path.join(tmp, "archive"))
    # 4 well-formed rows read (the long A4 row is quarantined separately)
    assert (res.rows_read, res.duplicates_removed, res.rows_loaded) == (
        4, 1, 1)
    assert res.status == "PARTIAL" and res.rows_rejected == 3
    assert res.extra_columns == ["note"]
    loaded = spark.read.parquet(target).collect()
    assert [r.order_id for r in loaded] == ["A1"]
    rej = {r.order_id: r.reject_reasons
           for r in spark.read.parquet(target + "_rej").collect()}
    assert rej == {"A2": "price_range,customer_id_not_null", "A3": "price_range",
                   "A4": "malformed_row"}
    log = spark.read.parquet(target + "_log").first()
    assert (log.status, log.rows_processed, log.rows_failed) == (
        "PARTIAL", 1, 3)
    assert json.loads(log.execution_details)["duplicates_removed"] == 1
    assert not os.path.exists(src) and res.archived_to.endswith("_sales.csv")


def test_load_run_failure_is_logged(spark, tmp):
    src = _csv(tmp, "bad.csv", "order_id,price\n1,2\n")
    target = os.path.join(tmp, "t")
    with pytest.raises(Exception):
        run(spark, src, SALES_JOB, target, run_log_target=target + "_log")
    log = spark.read.parquet(target + "_log").first()
    assert log.status == "FAILED" and "lacks 3 of the expected" in log.error_message


def test_archive_failure_only_warns(spark, tmp):
    assert archive_file(spark, os.path.join(tmp, "nope.csv"),
                        os.path.join(tmp, "a")) is None


def test_stream_ingest_only_new_files(spark, tmp):
    cols = ["order_id", "price"]
    inp = os.path.join(tmp, "in")
    os.makedirs(inp)
    _csv(inp, "1.csv", "order_id,price\n1,10\n2,abc\n")
    _csv(inp, "2.csv", "order_id,price\n3,30\n4,40,9\n")
    base = os.path.join(tmp, "out")

    def process(df):
        return df.withColumn("price", F.col("price").try_cast("double")) \
                 .filter(F.col("price").isNotNull())

    def go():
        ingest.ingest_available_now(spark, inp, cols, base + "/t",
                                    base + "/ck", process,
                                    reject_target=base + "/rej",
                                    max_files_per_trigger=1)
        return sorted(r.order_id for r in
                      spark.read.parquet(base + "/t").collect())
    assert go() == ["1", "3"]
    assert [r.raw_record for r in spark.read.parquet(base + "/rej")
            .collect()] == ["4,40,9"]
    _csv(inp, "3.csv", "order_id,price\n5,50\n")
    assert go() == ["1", "3", "5"]


def test_export_csv_roundtrip(spark, tmp):
    df = spark.createDataFrame([(" a ", None), ('x "q", y', 2)],
                               "t string, n int")
    export_csv(df, os.path.join(tmp, "e"))
    from loadstar.sources.csv import read_directory
    back = read_directory(spark, os.path.join(tmp, "e"),
                          pattern="part-*.csv").data
    assert sorted((r.t, r.n) for r in back.collect()) == [
        (" a ", None), ('x "q", y', "2")]


def test_driver_contract(spark):
    import __spark_entry__ as E
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 45
    df = E.entry(spark)
    assert df.columns == ["sale_date", "order_count", "unique_customers",
                          "total_revenue", "avg_order_value", "min_price",
                          "max_price"]
    assert df.count() > 0
    assert read_csv is not None and SF001


def test_json_and_parquet_sources(spark, tmp):
    from loadstar.sources.csv import read_source
    p = write(os.path.join(tmp, "a.json"),
              '{"order_id": "A1", "price": 1.5}\n{"order_id": "A2"}\n')
    df = read_source(spark, p, fmt="json",
                     schema="order_id string, price double")
    assert sorted((r.order_id, r.price) for r in df.collect()) == [
        ("A1", 1.5), ("A2", None)]
    df.write.parquet(os.path.join(tmp, "pq"))
    assert read_source(spark, os.path.join(tmp, "pq"), fmt="parquet").count() \
        == 2
    with pytest.raises(ValueError):
        read_source(spark, p, fmt="xml")


def test_staged_copy_removed_after_run(spark, tmp):
    src = _csv(tmp, "s.csv",
               "order_id,customer_id,order_date,product_id,price\n"
               "A1,C1,2026-01-02,P1,10.5\n")
    from loadstar.session import checkpoint_root
    root = checkpoint_root(spark).replace("file:", "")
    before = {d for d in os.listdir(root) if d.startswith("dedup-")}
    run(spark, src, SALES_JOB, os.path.join(tmp, "t"))
    after = {d for d in os.listdir(root) if d.startswith("dedup-")}
    assert after == before


def test_load_run_into_jdbc_table(spark, tmp):
    from loadstar.sinks.jdbc import JdbcTarget
    url = f"jdbc:derby:memory:r{uuid.uuid4().hex[:8]};create=true"
    tgt = JdbcTarget(url, "SALES_TRANSACTIONS", DERBY, batchsize=2)
    src = _csv(tmp, "s.csv",
               "order_id,customer_id,order_date,product_id,price\n"
               "A1,C1,2026-01-02,P1,10.5\nA2,C2,2026-01-03,P2,20\n"
               "A3,C3,2026-01-03,P3,-1\n")
    res = run(spark, src, SALES_JOB, tgt)
    assert (res.rows_loaded, res.rows_rejected, res.status) == (2, 1,
                                                                "PARTIAL")
    run(spark, _csv(tmp, "t.csv",
                    "order_id,customer_id,order_date,product_id,price\n"
                    "A9,C9,2026-01-09,P9,9\n"), SALES_JOB, tgt)
    assert tgt.count(spark) == 3


def test_cli_load_marts_report(spark, tmp):
    from loadstar.__main__ import main
    src = _csv(tmp, "s.csv",
               "order_id,customer_id,order_date,product_id,price,"
               "product_category\n"
               "A1,C1,2026-01-02,P1,10.5,toys\nA2,C2,2026-01-03,P2,20,toys\n")
    t = os.path.join(tmp, "sales")
    assert main(["load", src, "--target", t, "--run-id", "r1"]) == 0
    assert main(["marts", "--table", t, "--out", os.path.join(tmp, "m"),
                 "--as-of", "2026-01-10"]) == 0
    daily = spark.read.parquet(os.path.join(tmp, "m", "v_daily_sales"))
    assert daily.count() == 2
    assert spark.sql("SELECT count(*) AS n FROM v_monthly_sales").first().n \
        == 1
    cust = os.path.join(tmp, "cust")
    spark.createDataFrame([("C1",)], "customer_id string").write.parquet(cust)
    assert main(["report", "--table", t, "--customers", cust, "--out",
                 os.path.join(tmp, "rep"), "--as-of", "2026-01-10"]) == 0
    rep = {r.check_name: r.affected_rows for r in
           spark.read.parquet(os.path.join(tmp, "rep")).collect()}
    assert rep["orphaned_customers"] == 1


def test_ingest_runs_full_job_per_batch(spark, tmp):
    from loadstar.__main__ import main
    inp = os.path.join(tmp, "in")
    os.makedirs(inp)
    hdr = "order_id,customer_id,order_date,product_id,price\n"
    _csv(inp, "1.csv", hdr + "A1,C1,2026-01-02,P1,10\nA1,C1,2026-01-02,P1,10\n"
         "A2,C2,2026-01-02,P2,abc\n")
    out = os.path.join(tmp, "out")
    args = ["ingest", inp, "--target", out + "/t", "--checkpoint",
            out + "/ck", "--rejects", out + "/rej", "--run-log", out + "/log"]
    assert main(args) == 0
    assert [r.order_id for r in spark.read.parquet(out + "/t").collect()] == [
        "A1"]
    _csv(inp, "2.csv", hdr + "A3,C3,2026-01-03,P3,30\n")
    assert main(args) == 0
    t = spark.read.parquet(out + "/t")
    assert sorted(r.order_id for r in t.collect()) == ["A1", "A3"]
    log = spark.read.parquet(out + "/log")
    assert sorted(r.status for r in log.collect()) == ["PARTIAL", "SUCCESS"]


def test_halt_policy_stops_run_and_logs(spark, tmp):
    import dataclasses
    from loadstar.operators.quality import RejectedRowsError
    spec = dataclasses.replace(SALES_JOB, on_error="halt")
    src = _csv(tmp, "s.csv",
               "order_id,customer_id,order_date,product_id,price\n"
               "A1,C1,2026-01-02,P1,10.5\nA2,C2,2026-01-02,P2,-3\n")
    t = os.path.join(tmp, "t")
    with pytest.raises(RejectedRowsError):
        run(spark, src, spec, t, run_log_target=t + "_log")
    assert spark.read.parquet(t + "_log").first().status == "FAILED"
    assert not lake.table_exists(spark, t)      # nothing was loaded


def test_source_file_name_column(spark, tmp):
    p = _csv(tmp, "deliv_01.csv", "a\n1\n2\n")
    r = read_csv(spark, p, with_file_name=True)
    assert {x._source_file for x in r.data.collect()} == {"deliv_01.csv"}


def test_month_partitions_prune_and_rerun(spark, tmp):
    import dataclasses
    import datetime as dt
    from loadstar.operators import marts
    spec = dataclasses.replace(SALES_JOB, month_partition="order_date")
    hdr = "order_id,customer_id,order_date,product_id,price\n"
    t = os.path.join(tmp, "t")
    first = _csv(tmp, "a.csv", hdr + "A1,C1,2026-01-02,P1,1\n"
                 "A2,C2,2026-03-05,P2,2\n")
    run(spark, first, spec, t, run_id="r1")
    assert sorted(os.listdir(os.path.join(t, "run_id=r1"))) == [
        "order_date_month=2026-01-01", "order_date_month=2026-03-01"]
    # rerun of r1 with one month only: the other month must not survive
    again = _csv(tmp, "b.csv", hdr + "A2,C2,2026-03-05,P2,2\n")
    run(spark, again, spec, t, run_id="r1")
    sales = spark.read.parquet(t)
    assert [r.order_id for r in sales.collect()] == ["A2"]
    q = marts.recent(sales, dt.datetime(2026, 3, 31), 30)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date_month" in plan
    assert [r.order_id for r in q.collect()] == ["A2"]


def test_bucketed_change_apply_touches_only_needed_buckets(spark, tmp):
    import datetime as dt
    import glob
    from loadstar.operators import cdc
    t = os.path.join(tmp, "t")
    old = spark.createDataFrame([(str(i), i) for i in range(200)],
                                "k string, v int")
    ingest.write_buckets(old, t, "k", 16)
    before = {p: os.path.getmtime(p) for p in glob.glob(t + "/*/*.parquet")}
    bucket_of = {r.k: r.b for r in old.select(
        "k", ingest.key_bucket("k", 16).alias("b")).collect()}
    # delete every key of one bucket, update one key elsewhere, insert one
    gone = sorted(k for k, b in bucket_of.items() if b == bucket_of["0"])
    new = (old.filter(~F.col("k").isin(gone))
              .withColumn("v", F.when(F.col("k") == "5", F.lit(-5))
                                .otherwise(F.col("v")))
              .unionByName(spark.createDataFrame([("999", 9)],
                                                 "k string, v int")))
    changes = cdc.diff(old, new, "k", dt.datetime(2026, 1, 1))
    changes.write.json(os.path.join(tmp, "chg"))
    stream = spark.readStream.schema(changes.schema).json(
        os.path.join(tmp, "chg"))
    ingest.apply_change_stream_buckets(
        spark, stream, t, "k", 16, os.path.join(tmp, "ck"),
        lambda cur, chg: cdc.apply_changes(cur, chg, "k"))
    got = sorted(tuple(r) for r in ingest.read_buckets(spark, t).collect())
    assert got == sorted(tuple(r) for r in new.collect())
    assert not os.path.exists(f"{t}/_bucket={bucket_of['0']}")
    inserted_bucket = spark.createDataFrame([("999",)], "k string").select(
        ingest.key_bucket("k", 16)).first()[0]
    touched = {bucket_of["0"], bucket_of["5"], inserted_bucket}

    def bucket(p):
        return int(p.split("_bucket=")[1].split("/")[0])
    untouched = [p for p in before if bucket(p) not in touched]
    assert untouched
    assert all(os.path.getmtime(p) == before[p] for p in untouched)


def test_run_on_delivery_folder(spark, tmp):
    d = os.path.join(tmp, "drop")
    os.makedirs(d)
    _csv(d, "a.csv", "order_id,customer_id,order_date,product_id,price\n"
         "A1,C1,2026-01-02,P1,10\nA9,C9,2026-01-02,P9,1,extra\n")
    _csv(d, "b.csv", "order_id,price,product_id,order_date,customer_id,note\n"
         "B1,20,P2,2026-01-03,C2,hi\n")
    _csv(d, "c.csv", "")
    t = os.path.join(tmp, "t")
    res = run(spark, d, SALES_JOB, t, reject_target=t + "_rej",
              archive_dir=os.path.join(tmp, "arch"))
    assert sorted(r.order_id for r in spark.read.parquet(t).collect()) == [
        "A1", "B1"]
    assert res.malformed_rows == 1 and res.rows_rejected == 1
    assert sorted(os.listdir(d)) == ["c.csv"]          # read files archived


def test_run_writes_quality_log(spark, tmp):
    src = _csv(tmp, "s.csv",
               "order_id,customer_id,order_date,product_id,price\n"
               "A1,,2026-01-02,P1,10\nA1,C2,2026-01-03,P2,20\n"
               "A3,C3,2099-01-03,P3,0\n")
    t = os.path.join(tmp, "t")
    run(spark, src, replace(SALES_JOB, enforce_table=False), t, run_id="r1",
        quality_log_target=t + "_dq")
    log = {r.issue_description: (r.check_type, r.affected_rows, r.severity,
                                 r.run_id)
           for r in spark.read.parquet(t + "_dq").collect()}
    assert log["Missing customer_id values found"] == (
        "Null Values", 1, "WARNING", "r1")
    assert log["Duplicate order ids found"][1] == 1
    assert log["Prices not above zero or missing"][1] == 1
    assert log["Order dates after the run's as_of"][1] == 1
    assert len(log) == 6


def test_shuffle_sizing(spark, tmp):
    from loadstar.session import input_bytes, size_shuffle
    p = _csv(tmp, "x.csv", "a\n" + "1\n" * 1000)
    assert input_bytes(spark, [p]) == os.path.getsize(p)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle(spark, 10 * (128 << 20)) >= 10
        assert size_shuffle(spark, 1) >= int(before)       # never lowered
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_atomic_jdbc_target(spark, tmp):
    from loadstar.sinks.jdbc import JdbcTarget, execute_sql
    url = f"jdbc:derby:memory:a{uuid.uuid4().hex[:8]};create=true"
    execute_sql(spark, url, ["CREATE TABLE SALES (ORDER_ID VARCHAR(50) "
                             "PRIMARY KEY, PRICE DOUBLE)"], DERBY)
    tgt = JdbcTarget(url, "SALES", DERBY, atomic=True)
    df = spark.createDataFrame([("A1", 1.0), ("A2", 2.0)],
                               "ORDER_ID string, PRICE double")
    tgt.write(df)
    assert tgt.count(spark) == 2
    # a duplicate key fails the single INSERT … SELECT: nothing of this
    # load lands, and the staging table is gone
    bad = spark.createDataFrame([("A3", 3.0), ("A1", 9.0)],
                                "ORDER_ID string, PRICE double")
    with pytest.raises(Exception):
        tgt.write(bad)
    assert tgt.count(spark) == 2
    tables = read_jdbc(spark, url, "SYS.SYSTABLES", DERBY).filter(
        F.col("TABLENAME").like("SALES_STAGE_%")).count()
    assert tables == 0


def test_jdbc_partitioned_read_finds_bounds(spark):
    url = f"jdbc:derby:memory:p{uuid.uuid4().hex[:8]};create=true"
    df = spark.range(1000).select(F.col("id").alias("ID"),
                                  (F.col("id") * 2).alias("V"))
    jdbc.write_jdbc(df, url, "T", mode="fail", properties=DERBY)
    back = read_jdbc(spark, url, "T", DERBY, partition_column="ID",
                     num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 1000
    assert back.agg(F.sum("V")).first()[0] == sum(range(0, 2000, 2))


def test_a_batch_of_one_file_is_read_by_several_tasks(spark, tmp_path):
    row = "{},some text that makes the line longer than it was before\n"
    plain, quoted = str(tmp_path / "plain.csv"), str(tmp_path / "quoted.csv")
    with open(plain, "w") as f:
        f.write("k,v\n" + "".join(map(row.format, range(300_000))))
    with open(quoted, "w") as f:
        f.write("k,v\n" + "".join(map(row.format, range(150_000)))
                + '150000,"two\nlines"\n')
    for path, rows, split in ((plain, 300_000, True), (quoted, 150_001, False)):
        given = spark.createDataFrame([("file:" + path,)], "path string")
        data = ingest.batch_files(given, spread=True).data
        assert data.agg(F.count("k"), F.countDistinct("k")).first() == (
            rows, rows)
        assert (data.rdd.getNumPartitions() > 1) == split
