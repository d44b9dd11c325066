import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import orc
from pyspark.sql import functions as F

from loadstar.llm import orc_ids

from .helpers import docs
from .test_packing import truth

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_round_trip_in_id_order(spark, tmp):
    rows = [(i * 7 % 50, f"Text number {i}, one. " * (i % 9)) for i in range(50)]
    rows += [(50, None), (51, ""), (52, "long " * 30000), (None, "none")]
    df = docs(spark, rows, extra=("part", "nth", "ids")).repartition(5)
    path = orc_ids.write_ids(df, tmp + "/orc", PATH)
    files = orc_ids.read_ids(spark, path, df.schema["doc_id"].dataType)
    want = {d: truth(PATH, t) + [1] for d, t in rows}
    for r in files.collect():
        assert r["ids"] == want[r["doc_id"]]
    got = orc_ids.positions(files).collect()
    order = sorted(want, key=lambda d: (d is not None, d or 0))
    start = 0
    by_id = {r["doc_id"]: r for r in got}
    for d in order:
        ids = np.array(want[d], "<u4")
        assert tuple(by_id[d]) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert files.filter(F.col("doc_id") == 52).count() == 1


def test_repeated_ids_and_empty_table(spark, tmp):
    df = docs(spark, [(1, "a b")] * 4 + [(2, "c")])
    path = orc_ids.write_ids(df, tmp + "/a", PATH)
    got = orc_ids.positions(orc_ids.read_ids(
        spark, path, df.schema["doc_id"].dataType)).collect()
    assert sorted(r["start"] for r in got) == [0, 3, 6, 9, 12]
    empty = docs(spark, [])
    path = orc_ids.write_ids(empty, tmp + "/b", PATH)
    assert orc_ids.positions(orc_ids.read_ids(
        spark, path, empty.schema["doc_id"].dataType)).count() == 0


def _rows_scanned(df):
    """Rows that the file reader gave for ``df``, after it has run."""
    rows = df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return rows, scan.metrics().apply("numOutputRows").value()


def test_indexes_and_bloom_filters_skip_rows(spark, tmp):
    df = docs(spark, [(2 * i, f"text {i}") for i in range(6000)]).coalesce(1)
    path = orc_ids.write_ids(df, tmp + "/skip", PATH, index_stride=1000)
    files = orc_ids.read_ids(spark, path, df.schema["doc_id"].dataType) \
        .select("doc_id")
    rows, scanned = _rows_scanned(files.filter("doc_id = 5000"))
    assert [r[0] for r in rows] == [5000] and scanned <= 1000
    # odd ids lie within the statistics: only Bloom filters can tell
    counts = []
    for d in range(1001, 11001, 1000):
        rows, scanned = _rows_scanned(files.filter(F.col("doc_id") == d))
        assert not rows
        counts.append(scanned)
    assert sum(n == 0 for n in counts) >= 8, counts
    plain = orc_ids.write_ids(df, tmp + "/plain", PATH, index_stride=1000,
                              id_col="n_chars")
    without = spark.read.orc(plain).select("n_chars")
    assert _rows_scanned(without.filter("n_chars = 8"))[1] > 0


def test_stripes_are_read_one_by_one(spark, tmp):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(map(str, rng.integers(0, 10 ** 6, 400))))
            for i in range(3000)]
    df = docs(spark, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        path = orc_ids.write_ids(df, tmp + "/stripes", PATH, index_stride=1000,
                                 stripe_bytes=1 << 18)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    seen, most = [], 0
    for name in sorted(glob.glob(path + "/*.orc")):
        file = orc.ORCFile(name)
        most = max(most, file.nstripes)
        parts = [pa.Table.from_batches([file.read_stripe(k)])
                 for k in range(file.nstripes)]
        assert pa.concat_tables(parts).combine_chunks().equals(
            file.read().combine_chunks())
        seen += [d for p in parts for d in p.column("doc_id").to_pylist()]
    assert most > 1
    assert sorted(seen) == [d for d, _ in rows]
