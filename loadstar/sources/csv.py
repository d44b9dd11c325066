"""CSV source (S1-S4): files → all-text DataFrames with the meaning of a
pandas-style CSV reader, plus the malformed rows kept apart.

* every column is read as text (no type inference: ids like ``007`` stay
  ``007``; the column classifier and the coercion rules decide types later);
* NA tokens (``''``, ``NA``, ``null``, ``None``, ``N/A``, ``NaN`` …) become
  null in one projection;
* a row with more fields than the header is malformed: it is quarantined
  (``on_error='log_and_continue'``) or stops the run (``'halt'``); a row with
  fewer fields is padded with nulls and kept;
* quotes are doubled inside quoted text (``"x ""q"", y"``), and quoted line
  breaks are allowed. The reader that allows them cannot split a file, so
  ``multi_line="auto"`` keeps it to the files that need it (see
  :func:`splittable`).
"""

from __future__ import annotations

import logging
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import NA_TOKENS, null_tokens

log = logging.getLogger("loadstar")

# Columns that give the order in which rows were delivered.
DELIVERED = ("_delivered_file", "_delivered_split", "_delivered_row")
CORRUPT = "_corrupt_record"
# Quoted text (with doubled quotes inside); removed before counting commas.
QUOTED_PATTERN = r'"(?:[^"]++|"")*"'
# A quoted field between delimiters (or the ends of the line).
FIELD_PATTERN = r'(?:\A|{d})"(?:[^"]++|"")*+"(?={d}|\r?\z)'


class MalformedCsvError(ValueError):
    """A row has more fields than the header (``halt`` policy)."""


class EmptyCsvError(ValueError):
    """The file has no header line."""


@dataclass
class CsvRead:
    data: DataFrame          # accepted rows, every column text
    malformed: DataFrame     # raw text of rows with too many fields
    columns: list
    # filled by the first action over ``data``: rows parsed and rows
    # malformed, so a caller can skip the quarantine pass when it is empty
    observed: Observation | None = None

    def malformed_count(self) -> int | None:
        if self.observed is None:
            return None
        try:
            return int(self.observed.get["malformed"])
        except Exception:  # noqa: BLE001 - metrics unavailable: count
            return self.malformed.count()


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _codec(spark: SparkSession, p):
    """The codec of a compressed file, by its name, or None."""
    return spark.sparkContext._jvm.org.apache.hadoop.io.compress \
        .CompressionCodecFactory(
            spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)


def header_line(spark: SparkSession, path: str) -> str | None:
    """First non-blank line of one file (metadata read on the driver: a few
    bytes through the cluster's file system, never the data)."""
    fs, p = _fs_and_path(spark, path)
    jvm = spark.sparkContext._jvm
    stream, codec = fs.open(p), _codec(spark, p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        reader = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return None if line is None else line.lstrip("﻿")
    finally:
        stream.close()


def parse_header(line: str, delimiter: str = ",") -> list[str]:
    """Split a header line with CSV quoting; a name that came before gets the
    first of the suffixes ``_1``, ``_2`` … that no column has (names that
    differ in case alone count as one, as Spark resolves them)."""
    import csv
    names = next(csv.reader([line], delimiter=delimiter))
    taken = {n.lower() for n in names}
    seen: set[str] = set()
    out, dup = [], []
    for n in names:
        name, k = n, 0
        if n.lower() in seen:
            dup.append(n)
            while name.lower() in taken:
                k += 1
                name = f"{n}_{k}"
            taken.add(name.lower())
        seen.add(name.lower())
        out.append(name)
    dup = sorted(set(dup))
    if dup:
        log.warning("Duplicate header names %s renamed with _1, _2 … "
                    "suffixes", dup)
    return out


def _place(path: str) -> tuple[str, str]:
    """A file's authority and decoded path, however its name is written."""
    u = urlsplit(path)
    return u.netloc, unquote(u.path)


def _longer_than(spark: SparkSession, files: Sequence[str],
                 most: int | None) -> dict[tuple[str, str], str]:
    """Those of ``files`` longer than ``most`` bytes (else: than a split), by
    place (file status only; what is no plain file is left out, and so are
    compressed ones, which are read whole)."""
    if most is None:
        most = spark._jvm.org.apache.spark.network.util.JavaUtils \
            .byteStringAsBytes(
                spark.conf.get("spark.sql.files.maxPartitionBytes"))

    def look(f: str):
        fs, p = _fs_and_path(spark, f)
        if any(c in f for c in "*?[{") or not fs.exists(p):
            return None
        st = fs.getFileStatus(p)
        if not st.isFile() or st.getLen() <= most \
                or _codec(spark, p) is not None:
            return None
        uri = st.getPath().toUri()
        return (uri.getAuthority() or "", uri.getPath()), f
    with ThreadPoolExecutor(max_workers=max(1, min(32, len(files)))) as ex:
        return dict(x for x in ex.map(look, files) if x is not None)


def splittable(spark: SparkSession, files: Sequence[str],
               delimiter: str = ",", split_bytes: int | None = None
               ) -> set[str]:
    """Those of ``files`` that are longer than a split (``split_bytes``, else
    Spark's) and give the same rows when each line is read by itself.

    One aggregate over a plain text scan, which is read in splits, looks for
    what the multi-line reader treats differently: quotes outside complete
    quoted fields (a quoted line break leaves one on the line where it
    starts), lines of blanks, and carriage returns that do not end every
    line. Files of one split are not scanned: they are one task either way."""
    long = _longer_than(spark, files, split_bytes)
    if not long:
        return set()
    line = F.col("value")
    d = re.escape(delimiter)
    loose = line.contains('"') & F.regexp_replace(
        line, FIELD_PATTERN.format(d=d), "").contains('"')
    blank = (line != "\r") & line.rlike(r"\A[\x00-\x20]+\z")
    inner = line.rlike(r"\r(?!\z)")
    seen = (spark.read.option("lineSep", "\n").text(sorted(long.values()))
            .select(F.col("_metadata.file_path").alias("file"),
                    (loose | blank | inner).alias("odd"),
                    line.endswith("\r").alias("cr"))
            .groupBy("file").agg(
                F.bool_or("odd").alias("odd"),
                F.count_if("cr").alias("cr"), F.count(F.lit(1)).alias("n")))
    plain = seen.filter(~F.col("odd") & F.col("cr").isin(0, F.col("n")))
    return {long[_place(r["file"])] for r in plain.select("file").collect()}


def _reader(spark: SparkSession, schema: T.StructType, multi_line: bool,
            encoding: str = "UTF-8", delimiter: str = ","):
    return (spark.read.schema(schema)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            # a row's fields are counted only where all are parsed
            .option("columnPruning", False)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .option("quote", '"')
            .option("encoding", encoding)
            .option("sep", delimiter)
            .option("enforceSchema", True))


def field_count(raw: str = CORRUPT, delimiter: str = ","):
    """Fields in a raw CSV record: delimiters outside quoted text + 1."""
    return F.regexp_count(F.regexp_replace(F.col(raw), QUOTED_PATTERN, ""),
                          F.lit(delimiter)) + 1


def text_schema(cols: Sequence[str]) -> T.StructType:
    """Every column text, plus the corrupt-record column."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_records(df: DataFrame, cols: Sequence[str],
                  na_tokens: Sequence[str] = NA_TOKENS, delimiter: str = ",",
                  with_file_name: bool = False,
                  observe: Observation | None = None,
                  with_order: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split a PERMISSIVE all-text CSV read (batch or streaming) into
    (accepted rows with NA tokens nulled, malformed rows). Spark marks short
    *and* long rows as corrupt; only rows with more fields than the header
    are malformed, short rows are padded with nulls and kept."""
    extra = [F.col("_metadata.file_name").alias("_source_file")] \
        if with_file_name else []
    # a task reads its splits one after another, so ids rise within a split
    place = [F.col("_metadata.file_path").alias(DELIVERED[0]),
             F.col("_metadata.file_block_start").alias(DELIVERED[1]),
             F.monotonically_increasing_id().alias(DELIVERED[2])] \
        if with_order else []
    # The flag also reads the first data column: Spark refuses plans whose
    # only input is the corrupt-record column, which pruning would leave for
    # a bare ``malformed.count()``.
    anchor = F.col(f"`{cols[0]}`")
    long_row = (F.col(CORRUPT).isNotNull()
                & (field_count(CORRUPT, delimiter) > len(cols))
                & (anchor.isNull() | anchor.isNotNull()))
    tagged = df.select(*[null_tokens(F.col(f"`{c}`"), na_tokens).alias(c)
                         for c in cols], F.col(CORRUPT), *extra, *place,
                       long_row.alias("_long"))
    seen = tagged if observe is None else tagged.observe(
        observe, F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_long")).alias("malformed"))
    data = seen.filter(~F.col("_long")).drop(CORRUPT, "_long")
    malformed = tagged.filter(F.col("_long")).select(
        *[F.col(f"`{c}`") for c in cols],
        F.col(CORRUPT).alias("raw_record"),
        *[F.col("_source_file") for _ in extra],
        F.lit("malformed_row").alias("reject_reasons"))
    return data, malformed


def read_csv(spark: SparkSession, paths: str | Sequence[str],
             columns: Sequence[str] | None = None,
             on_error: str = "log_and_continue",
             multi_line: bool | str = "auto",
             na_tokens: Sequence[str] = NA_TOKENS, delimiter: str = ",",
             with_file_name: bool = False, with_order: bool = False,
             split_bytes: int | None = None) -> CsvRead | DirectoryRead:
    """Read CSV files, each by its own header.

    ``columns``: the files' common header when already known; otherwise the
    headers are looked up, files are grouped by them and the groups combined
    by column name, so files may order their columns differently.
    ``multi_line``: True reads each file as one task and allows quoted line
    breaks, False reads in splits without them, ``"auto"`` chooses by file
    (:func:`splittable`); the rows are those of True.
    ``with_file_name``: add ``_source_file`` (F20, from ``_metadata``).
    ``with_order``: add the columns ``DELIVERED``, whose order is that in
    which rows were delivered: files by their paths, then the place of the
    split in the file, then the place of the row in the split.
    Raises ``PATH_NOT_FOUND`` for a missing path (S2) and
    :class:`EmptyCsvError` when the file has no header line."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if columns is None:
        if len(paths) > 1:
            return read_files(spark, paths, on_error=on_error,
                              multi_line=multi_line, na_tokens=na_tokens,
                              delimiter=delimiter,
                              with_file_name=with_file_name,
                              with_order=with_order, split_bytes=split_bytes)
        line = header_line(spark, paths[0])
        if line is None:
            raise EmptyCsvError(f"{paths[0]} holds no header line")
        columns = parse_header(line, delimiter)
    cols = list(columns)
    if multi_line == "auto":
        plain = splittable(spark, paths, delimiter, split_bytes)
        rest = [p for p in paths if p not in plain]
        if plain and rest:
            return _combined(paths, {}, [
                read_csv(spark, ps, cols, on_error, whole, na_tokens,
                         delimiter, with_file_name, with_order)
                for ps, whole in ((sorted(plain), False), (rest, True))])
        multi_line = not plain
    df = _reader(spark, text_schema(cols), multi_line,
                 delimiter=delimiter).csv(paths)
    obs = Observation(f"csv_{uuid.uuid4().hex[:12]}")
    data, malformed = parse_records(df, cols, na_tokens, delimiter,
                                    with_file_name, obs, with_order)
    if on_error == "halt":
        if not malformed.isEmpty():
            raise MalformedCsvError(
                f"rows with more fields than the header in {paths}")
    elif on_error != "log_and_continue":
        raise ValueError(f"unknown on-error policy {on_error!r}")
    return CsvRead(data, malformed, cols, obs)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def list_files(spark: SparkSession, directory: str, pattern: str = "*.csv"
               ) -> list[str]:
    """Non-recursive listing of ``directory/pattern`` through the cluster's
    file system (sorted for a stable order)."""
    fs, p = _fs_and_path(spark, directory.rstrip("/") + "/" + pattern)
    st = fs.globStatus(p)
    if st is None:
        return []
    return sorted(s.getPath().toString() for s in st if s.isFile())


@dataclass
class DirectoryRead:
    data: DataFrame
    malformed: DataFrame | None
    files: list
    skipped: dict            # file → reason
    parts: list = None       # one CsvRead per header group

    @property
    def columns(self) -> list[str]:
        return self.data.columns

    def malformed_count(self) -> int | None:
        counts = [p.malformed_count() for p in (self.parts or [])]
        return None if any(c is None for c in counts) else sum(counts)


def read_files(spark: SparkSession, files: Sequence[str], **kw
               ) -> DirectoryRead:
    """Read files grouped by header (and, with ``multi_line="auto"``, by
    whether they can be split): each group is one distributed read, and
    the groups are combined by column name (columns missing in a group are
    null). A file that is not there is an error; a file without a header is
    skipped and reported, and no header at all is :class:`EmptyCsvError`."""
    groups: dict[tuple, list[str]] = {}
    skipped = {}
    mode = kw.pop("multi_line", "auto")
    split_bytes = kw.pop("split_bytes", None)
    delimiter = kw.get("delimiter", ",")
    plain = splittable(spark, files, delimiter, split_bytes) \
        if mode == "auto" else set()
    # header peeks are small independent reads: run them concurrently (an
    # object store answers many at once; a thread each costs nothing here)
    with ThreadPoolExecutor(max_workers=max(1, min(32, len(files)))) as ex:
        peeked = list(ex.map(lambda f: header_line(spark, f), files))
    for f, line in zip(files, peeked):
        if line is None:
            skipped[f] = "no header (empty file)"
            log.warning("Skipping %s: %s", f, skipped[f])
        else:
            groups.setdefault((f not in plain,
                               *parse_header(line, delimiter)), []).append(f)
    if not groups:
        raise EmptyCsvError(f"none of {len(files)} files holds a header line")
    log.info("Read %d files in %d header groups", sum(map(len,
             groups.values())), len(groups))
    return _combined(files, skipped, [
        read_csv(spark, fs, columns=cols, multi_line=whole
                 if mode == "auto" else mode, **kw)
        for (whole, *cols), fs in groups.items()])


def _combined(files: Sequence[str], skipped: dict, parts: list
              ) -> DirectoryRead:
    """Several reads as one, combined by column name."""
    data, malformed = parts[0].data, parts[0].malformed
    for r in parts[1:]:
        data = data.unionByName(r.data, allowMissingColumns=True)
        malformed = malformed.unionByName(r.malformed,
                                          allowMissingColumns=True)
    return DirectoryRead(data, malformed, list(files), skipped, parts)


def read_directory(spark: SparkSession, directory: str,
                   pattern: str = "*.csv", **kw) -> DirectoryRead:
    """Read every matching file of a directory (see
    :func:`read_files`); no readable file at all is an error."""
    files = list_files(spark, directory, pattern)
    if not files:
        raise ValueError(f"{directory}: no file matches {pattern}")
    try:
        return read_files(spark, files, **kw)
    except EmptyCsvError as e:
        raise ValueError(f"{directory}: {e}") from e


def read_source(spark: SparkSession, path: str | Sequence[str],
                fmt: str = "csv", schema: T.StructType | str | None = None,
                **options) -> DataFrame:
    """One entry point for CSV, JSON and Parquet inputs (JSON and
    Parquet keep their own types; CSV goes through :func:`read_csv`)."""
    fmt = fmt.lower()
    if fmt == "csv":
        return read_csv(spark, path, **options).data
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    if fmt == "json":
        return reader.json(path)
    if fmt == "parquet":
        return reader.parquet(*([path] if isinstance(path, str) else path))
    raise ValueError(f"unsupported source format {fmt!r}")


def read_jdbc(spark: SparkSession, url: str, table: str,
              properties: dict | None = None,
              partition_column: str | None = None, lower=None, upper=None,
              num_partitions: int | None = None) -> DataFrame:
    """JDBC source. With ``partition_column`` the read is split into
    ``num_partitions`` parallel range queries instead of one; bounds that
    are not given are looked up with one ``MIN``/``MAX`` query run by the
    database."""
    def reader():
        r = spark.read.format("jdbc").option("url", url)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        return r
    if partition_column and (lower is None or upper is None):
        b = reader().option(
            "query", f"SELECT MIN({partition_column}) AS lo, "
                     f"MAX({partition_column}) AS hi FROM {table}").load().first()
        lower = b[0] if lower is None else lower
        upper = b[1] if upper is None else upper
        if lower is None:                      # empty table
            partition_column = None
    r = reader().option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", lower).option("upperBound", upper)
              .option("numPartitions", num_partitions or 8))
    return r.load()
