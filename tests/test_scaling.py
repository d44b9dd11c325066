"""Steps whose cost must follow their input, not its square or one task."""

import glob
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from loadstar.operators import keys
from loadstar.plans import loadjob, queries_keys, queries_load, queries_repair
from loadstar.plans.loadjob import transform
from loadstar.session import (SHUFFLE_CLEANUP, checkpoint_root,
                              releases_shuffles, shuffles_released, stage)
from loadstar.sinks.export import export_csv
from loadstar.sources.csv import (header_line, list_files, read_directory,
                                  splittable)


def _no_coalesce(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("one task for all steps before the write")
    monkeypatch.setattr(type(spark.range(1)), "coalesce", fail)


def test_mixed_delivery_joins_in_many_tasks(spark, monkeypatch):
    _no_coalesce(spark, monkeypatch)
    d = queries_repair._mixed_delivery(spark, SF001)
    assert len(list_files(spark, d + "/c", "part-*.csv")) == 1


def test_archived_deliveries_join_in_many_tasks(spark, monkeypatch):
    _no_coalesce(spark, monkeypatch)
    got = queries_repair.archived_source_files(spark, SF001)
    assert got.count() == queries_repair.DELIVERIES


def test_change_files_come_in_a_few_batches(spark, tmp_path):
    for kind, n in (("INSERT", 25), ("DELETE", 1)):
        (tmp_path / f"change_type={kind}").mkdir()
        for i in range(n):
            (tmp_path / f"change_type={kind}" / f"part-{i:05d}.json").write_text("")
    assert queries_load._files_a_batch(spark, str(tmp_path)) == 5
    assert queries_load._files_a_batch(spark, str(tmp_path / "none")) == 1


def test_rejected_keys_are_not_multiplied(spark, monkeypatch):
    monkeypatch.setattr(keys, "BROADCAST_KEYS", 0)
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"),
                                   (F.col("id") % 7).alias("x")).unionByName(
        spark.createDataFrame([(None, 0)], "k string, x long"))
    bad = rows.limit(0).withColumn("reject_reasons", F.lit(""))
    gone = rows.filter("x = 3").select("k")
    good, bad, _ = keys.reject_keys(rows, bad, gone, ["k"], "gone")
    assert good.count() == 101 - 14 and bad.count() == 14
    assert "Generate" not in good._jdf.queryExecution().optimizedPlan() \
        .toString()


def test_checked_rows_are_written_once(spark):
    res = transform(_raw(spark), queries_load.LENS_JOB, order_by=["_row"],
                    enforce=True)
    for df, n in ((res.good, 2), (res.bad, 2)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
        assert df.count() == n
    assert sorted(r.reject_reasons for r in res.bad.collect()) == [
        "duplicate_key", "price_range"]


def _raw(spark):
    return spark.createDataFrame(
        [("1", "1", "C", "2026-01-02", "P", "x", "5", "y", "3", 1),
         ("1", "2", "C", "2026-01-02", "P", "x", "6", "y", "3", 2),
         ("2", "1", "C", "2026-01-02", "P", "x", "5", "y", "3", 3),
         ("3", "1", "C", "2026-01-02", "P", "x", "-5", "y", "3", 4)],
        ", ".join(f"{c} string" for c in queries_load.RAW_COLS)
        + ", _row long")


def test_delivered_files_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(queries_keys, "FILE_INPUT", 10_000)
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(glob.glob(root + "/delivered-csv-*"))
    got = queries_keys.csv_keep_first(spark, SF001)
    [d] = set(glob.glob(root + "/delivered-csv-*")) - before
    assert len(glob.glob(os.path.join(d, "part-*.csv"))) > 5
    rows = got.count()
    assert rows == got.select("order_id").distinct().count() > 0


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager() \
        .diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def _gone(spark, before):
    for _ in range(50):             # they are deleted in the background
        if not _shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_shuffle_files_go_with_their_step(spark, tmp):
    before = _shuffle_files(spark)
    rows = spark.range(1000).withColumn("x", F.col("id") % 7)
    stage(rows.groupBy("x").count())
    export_csv(rows.repartition(3, "x"), tmp + "/csv")
    count = releases_shuffles(lambda _: rows.groupBy("x").count().count())
    assert count(spark) == 7
    assert _gone(spark, before)


def test_load_run_leaves_no_shuffle_files(spark, tmp):
    before = _shuffle_files(spark)
    loadjob.run(spark, _raw(spark), queries_load.LENS_JOB, tmp + "/t",
                run_id="r1", reject_target=tmp + "/bad", order_by=["_row"])
    assert _gone(spark, before)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_cleanup_setting_is_put_back(spark):
    with pytest.raises(KeyError):
        with shuffles_released(spark), shuffles_released(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            raise KeyError
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        with shuffles_released(spark):
            pass
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def _folders(spark, *names):
    root = checkpoint_root(spark).removeprefix("file:")
    return {d for n in names for d in glob.glob(f"{root}/{n}-*")}


STEPS = ("delivered", "repeated-hashes", "dedup", "first-rows")


def test_checked_rows_replace_the_tables_before_them(spark):
    before = _folders(spark, *STEPS)
    res = transform(_raw(spark), queries_load.LENS_JOB, order_by=["_row"],
                    enforce=True)
    [left] = _folders(spark, *STEPS) - before
    assert "dedup-checked-" in left and res.staged_paths[0].endswith(
        os.path.basename(left))
    assert res.rows_deduped == 4 and res.good.count() == 2


def test_failed_transform_leaves_no_tables(spark, monkeypatch):
    before = _folders(spark, *STEPS)

    def fail(*_):
        raise KeyError("rules")
    monkeypatch.setattr(loadjob, "table_rules", fail)
    with pytest.raises(KeyError):
        transform(_raw(spark), queries_load.LENS_JOB, order_by=["_row"],
                  enforce=True)
    assert _folders(spark, *STEPS) == before


def test_key_check_shuffles_no_whole_rows(spark, monkeypatch):
    plans = {}

    def look(df, path):
        plans[path.rsplit("/", 1)[-1].rpartition("-")[0]] = \
            df._jdf.queryExecution().executedPlan().toString()
        return stage(df, path=path)
    monkeypatch.setattr(loadjob, "stage_table", look)
    transform(_raw(spark), queries_load.LENS_JOB, order_by=["_row"],
              enforce=True)
    assert "BroadcastHashJoin" in plans["dedup-checked"]
    assert "Exchange hashpartitioning" not in plans["dedup-checked"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_first_rows_of_keys(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(loadjob, "BROADCAST_BITMAPS", -1)
    # over several bitmaps, with keys in many of them and null parts of keys
    n = 150_000
    rows = spark.range(n, numPartitions=3).select(
        F.when(F.col("id") % 10 != 0, F.col("id") % 1000).alias("a"),
        (F.col("id") % 3).alias("b"), (-F.col("id")).alias("o"),
        F.monotonically_increasing_id().alias(loadjob._ORD),
        F.when(F.col("id") % 7 == 0, "bad").otherwise("")
         .alias("reject_reasons"))
    first = loadjob._first_rows(rows, ["a", "b"], ["o"])
    got = loadjob._unique(rows, ["a", "b"], first).collect()
    assert len(got) == n
    best, want = {}, Counter()
    for i in range(n):
        if i % 10 and i % 7:
            best[i % 1000, i % 3] = i       # the least -id is the last
    for r in got:
        i = -r["o"]
        k = (i % 1000, i % 3)
        reason = "bad" if i % 7 == 0 else "" if i % 10 == 0 \
            or best[k] == i else loadjob.DUPLICATE_KEY
        want[r["reject_reasons"] == reason] += 1
    assert want == {True: n}


@pytest.mark.parametrize("most", [keys.MOST_WORDS, 1])
def test_distinct_rows(spark, monkeypatch, most):
    monkeypatch.setattr(keys, "MOST_WORDS", most)
    nan = float("nan")
    some = [("a", None, 1.0, nan), (None, "a", 1.0, nan), (None, "a", 1.0, nan),
            (None, None, None, None), (None, None, None, None),
            ("", "a", 0.0, 2.0), ("", "a", -0.0, 2.0), ("a", "", 0.0, 2.0)]
    rows = spark.createDataFrame(
        some, "`x.y` string, _word string, c double, d float").unionByName(
        spark.range(3000).selectExpr("cast(id as string) AS `x.y`",
                                     "'w' AS _word", "cast(id as double) AS c",
                                     "cast(id % 5 as float) AS d")
    ).unionByName(spark.range(400).selectExpr(
        "cast(id as string)", "'w'", "cast(id as double)",
        "cast(id % 5 as float)").toDF("x.y", "_word", "c", "d"))
    table = stage(rows)
    got, paths = keys.distinct_rows(table)
    assert got.columns == rows.columns and len(paths) == 1
    text = F.to_json(F.struct(F.struct("*")))
    assert Counter(r[0] for r in got.select(text).collect()) == Counter(
        r[0] for r in rows.dropDuplicates().select(text).collect())
    assert got.count() == 3000 + 5


def test_distinct_rows_of_other_types(spark):
    rows = spark.createDataFrame([([1],), ([1],), ([2],)], "a array<int>")
    got, paths = keys.distinct_rows(rows)
    assert got.count() == 2 and paths == []


def test_compressed_delivery(spark, tmp):
    rows = spark.createDataFrame([("1", 'x, "y"'), ("2", "two\nlines"),
                                  ("3", None)], "id string, t string")
    export_csv(rows, tmp, compression="gzip")
    files = list_files(spark, tmp, "part-*.csv.gz")
    assert files and header_line(spark, files[0]) == "id,t"
    assert splittable(spark, files, split_bytes=0) == set()
    got = read_directory(spark, tmp, "part-*.csv.gz").data
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, rows.collect()), key=lambda r: r[0])


def test_load_runs_leave_no_delivery(spark):
    names = ("raw-sales-csv", "delivered-sales", *STEPS[:2], "first-rows")
    before = _folders(spark, *names)
    assert queries_load.load_constraint_rejects(spark, SF001).count()
    assert queries_keys.load_key_rejects(spark, SF001).count() == 3
    assert _folders(spark, *names) == before


def test_two_runs_join_once(spark, monkeypatch):
    plans = []

    def look(_, rows, *a, **kw):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(queries_keys, "run", look)
    queries_keys._two_runs(spark, SF001)
    assert len(plans) == 3 and not any("Join" in p for p in plans)
