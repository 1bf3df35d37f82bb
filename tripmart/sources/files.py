"""File sources (SRC-1 .. SRC-14).

Readers return lazy DataFrames.  CSV is split by the reader unless gzipped
(one task per .gz file), so callers of big gz inputs repartition afterwards.
"""

from __future__ import annotations

import csv
import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, _parse_datatype_string

from tripmart.sources.widening import same, union_widened


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
             header: bool = True, columns: Sequence[str] | None = None,
             timestamp_format: str | None = None, mode: str = "FAILFAST",
             min_partitions: int | None = None) -> DataFrame:
    """Typed CSV(.gz) scan (SRC-1).

    ``columns`` (SRC-2, copy-in with a column list): the file's fields are
    loaded by position into these names; target columns not in the list stay
    NULL.  A value that cannot be parsed and a surplus or missing field fail
    the read; ``mode='PERMISSIVE'`` makes such values NULL and drops surplus
    fields.

    A gzip file cannot be split, so it is read by one task; ``min_partitions``
    spreads the rows over that many partitions right after the read (a
    round-robin shuffle) so later stages are not held to one task per file."""
    df = _read_csv(spark, paths, schema, header, columns, timestamp_format, mode)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def _read_csv(spark, paths, schema, header, columns, timestamp_format, mode) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    r = spark.read.option("header", header).option("mode", mode)
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    if columns is None:
        return r.schema(schema).csv(paths)
    by_name = {f.name: f for f in schema.fields}
    file_schema = StructType([by_name[c] for c in columns])
    df = r.option("enforceSchema", True).schema(file_schema).csv(paths)
    return df.select(*[F.col(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def external_table(spark: SparkSession, name: str, location: str, schema: StructType | None,
                   fmt: str = "csv", options: Mapping[str, str] | None = None) -> DataFrame:
    """External table over files that stay in place (SRC-3, SRC-4).  Surplus
    trailing CSV fields are dropped (PERMISSIVE); for Parquet the schema may
    be omitted and is read from the footers."""
    opts = {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    cols = f"({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema.fields)})" if schema else ""
    opt_sql = ", ".join(f"'{k}' '{v}'" for k, v in opts.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {cols} USING {fmt} "
              + (f"OPTIONS ({opt_sql}) " if opt_sql else "") + f"LOCATION '{location}'")
    return spark.table(name)


def external_view(spark: SparkSession, name: str, pattern: str, fmt: str = "parquet") -> DataFrame:
    """Temp view over a glob of files, schema from the files (SRC-4)."""
    df = spark.read.format(fmt).load(pattern)
    df.createOrReplaceTempView(name)
    return df


def read_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """JSON with schema inference (SRC-8)."""
    return spark.read.option("multiLine", multiline).json(path)


def read_json_records(spark: SparkSession, path: str, record_path: str,
                      multiline: bool = False) -> DataFrame:
    """Records of the array under ``record_path`` of each document, one row
    per record with the record's keys as columns (SRC-7)."""
    docs = read_json(spark, path, multiline)
    return docs.select(F.explode_outer(record_path).alias("__r")).select("__r.*")


def read_json_variants(spark: SparkSession, path: str, record_path: str, multiline: bool = False) -> DataFrame:
    """Records of the array under ``record_path`` (a JSON path, ``$.products``)
    of each document, one VARIANT ``record`` per row.  No schema is inferred, so
    there is no pass for it, records may differ, and a key that is absent and one
    that is null stay apart (``keep_record_columns``).  A document without the
    array has no records; an element that is null is one."""
    docs = spark.read.option("singleVariantColumn", "document").option("multiLine", multiline).option("mode", "FAILFAST").json(path)
    records = F.variant_get("document", record_path, "array<variant>")
    return docs.select(F.explode(records).alias("record"))


def read_seed(spark: SparkSession, path: str, sep: str = ",", lower_header: bool = True) -> DataFrame:
    """Delimited seed file (SRC-10, SRC-11): header row, inferred types, CRLF
    line ends accepted; a quoted field may hold the delimiter, and a quote
    written twice; header names lower-cased."""
    df = spark.read.option("header", True).option("inferSchema", True).option("sep", sep).option("escape", '"').csv(path)
    if lower_header:
        df = df.toDF(*[c.strip().lower() for c in df.columns])
    return df


# --- header-driven typing (SRC-12) -----------------------------------------

def schema_from_header(header: Iterable[str], type_map: Mapping[str, str | DataType],
                       default: DataType = StringType()) -> StructType:
    """Schema from header names: lower-cased name -> type from ``type_map``,
    unknown names -> ``default``."""
    fields = []
    for raw in header:
        name = raw.strip().strip('"')
        t = type_map.get(name.lower())
        if isinstance(t, str):
            t = _parse_datatype_string(t)
        fields.append(StructField(name, t or default, True))
    return StructType(fields)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a file, folder or glob, without hidden ones."""
    fs, p = _hadoop(spark, path)
    found = []
    for status in fs.globStatus(p) or []:
        for s in (fs.listStatus(status.getPath()) if status.isDirectory() else [status]):
            if s.isFile() and s.getPath().getName()[0] not in "._":
                found.append(s.getPath().toString())
    return sorted(found)


def first_lines(spark: SparkSession, paths: Sequence[str], threads: int = 16) -> list[str]:
    """The first line of every file (compressed ones too; '' for an empty one).
    The driver opens the files themselves, some at a time, and reads their
    beginning: no Spark job, whatever the number of files."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(path: str) -> str:
        fs, p = _hadoop(spark, path)
        stream = fs.open(p)
        try:
            codec = codecs.getCodec(p)
            text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
            return jvm.java.io.BufferedReader(text).readLine() or ""
        finally:
            stream.close()
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(first, paths))


def header_names(line: str, sep: str = ",") -> list[str]:
    """Names in a header line; quoted names may hold the separator."""
    return next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])


def read_csv_header_typed(spark: SparkSession, path: str, type_map: Mapping[str, str | DataType],
                          sep: str = ",", on_bad_value: str = "fail") -> DataFrame:
    """CSV typed from the files' own header lines (SRC-12).

    Files are grouped by their header, so a file with other columns is read by
    its own; a column missing from a group is NULL.  A value that does not fit
    its type fails the read; ``on_bad_value='infer'`` reads a group with such
    values with inferred types instead (which costs a pass to find out)."""
    groups: dict[tuple[str, ...], list[str]] = {}
    found = data_files(spark, path)
    for f, line in zip(found, first_lines(spark, found)):
        header = header_names(line, sep)
        if header:
            groups.setdefault(tuple(header), []).append(f)
    if not groups:
        return spark.createDataFrame([], StructType([]))
    reader = lambda: spark.read.option("header", True).option("sep", sep)
    parts = []
    for header, members in groups.items():
        df = reader().option("mode", "FAILFAST").option("enforceSchema", True) \
            .schema(schema_from_header(header, type_map)).csv(members)
        if on_bad_value == "infer":
            try:
                df.write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - the reader's errors have no common class
                df = reader().option("inferSchema", True).csv(members)
        parts.append((df, members[0]))
    return union_widened(parts)


# --- file names as data (SRC-13, FN-18) ------------------------------------

# Fixed value: a whole trip file name, <taxi>_tripdata_<yyyy>-<mm>.csv or .csv.gz.
TRIP_FILE_PATTERN = r"(?:^|/)(yellow|green|fhv)_tripdata_(\d{4})-(\d{2})\.csv(?:\.gz)?$"


def parse_trip_filename(path: Column) -> tuple[Column, Column, Column]:
    """(taxi, year, month) of a path whose file name is a trip file's; '' for others."""
    return (F.regexp_extract(path, TRIP_FILE_PATTERN, 1),
            F.regexp_extract(path, TRIP_FILE_PATTERN, 2),
            F.regexp_extract(path, TRIP_FILE_PATTERN, 3))


def with_source_file(df: DataFrame, ext: str = ".csv", keep_unmatched: bool = False) -> DataFrame:
    """Add ``filename`` = '<taxi>_tripdata_<y>-<m><ext>' (and taxi, year,
    month) from each row's source file path; rows of files whose name does not
    match are skipped unless ``keep_unmatched``."""
    path = F.col("_metadata.file_path")
    taxi, year, month = parse_trip_filename(path)
    out = df.select("*", taxi.alias("taxi"), year.cast("int").alias("file_year"),
                    month.cast("int").alias("file_month"))
    out = out.withColumn("filename", F.when(
        F.col("taxi") != "", F.concat("taxi", F.lit("_tripdata_"), year, F.lit("-"), month, F.lit(ext))))
    return out if keep_unmatched else out.where(F.col("taxi") != "")


# --- month fan-in (SRC-6, INC-2, FN-19) ------------------------------------

def plan_months(start: _dt.date, end: _dt.date, types: Sequence[str]) -> list[tuple[int, int, str]]:
    """(year, month, type) for every calendar month from ``start`` to ``end``
    inclusive (months stepped on (year, month), so day-of-month never drifts)."""
    out = []
    y, m = start.year, start.month
    while (y, m) <= (end.year, end.month):
        for t in types:
            out.append((y, m, t))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


DEFAULT_TEMPLATE = "{root}/{taxi}_tripdata_{year:04d}-{month:02d}.parquet"


def month_paths(spark: SparkSession, root: str, types: Sequence[str], start: _dt.date, end: _dt.date,
                template: str = DEFAULT_TEMPLATE) -> list[str]:
    """The files of the inclusive range that exist."""
    paths = [template.format(root=root, taxi=t, year=y, month=m) for y, m, t in plan_months(start, end, types)]
    return [p for p in paths if path_exists(spark, p)]


def unreadable(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the Parquet files that cannot be read to their end (each is read once)."""
    bad = []
    for p in paths:
        try:
            spark.read.option("ignoreCorruptFiles", False).parquet(p).write.format("noop").mode("overwrite").save()
        except Exception:  # noqa: BLE001 - the reader's errors have no common class
            bad.append(p)
    return bad


def read_months(spark: SparkSession, root: str, types: Sequence[str], start: _dt.date, end: _dt.date,
                schema: StructType, extracted_at: _dt.datetime | None = None,
                template: str = DEFAULT_TEMPLATE, skip: Sequence[str] = ()) -> DataFrame:
    """Month x type Parquet fan-in (SRC-6): the files of the inclusive range
    that exist, united by column name.  Files whose columns have the same types
    are one scan; columns of ``schema`` are cast to its types, other columns
    whose types differ are widened, a column missing from a file reads NULL.  A
    value that would change by either fails the run, with its file named.
    ``extracted_at`` is one value per run, so a retried task writes the same.
    No file found -> an empty frame with ``schema``.

    A file that cannot be read fails the run.  To leave whole files out, name
    them in ``skip``, for instance ``skip=unreadable(spark, month_paths(...))``
    after reporting that list."""
    found = [p for p in month_paths(spark, root, types, start, end, template) if p not in set(skip)]
    ts = extracted_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    stamp = F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz").alias("extracted_at")
    if not found:
        return spark.createDataFrame([], schema).select("*", stamp)
    reader = lambda: spark.read.option("ignoreCorruptFiles", False)
    df = union_widened([(reader().schema(footer).parquet(*paths), paths[0]) for footer, paths in schema_groups(spark, found)], schema)
    wanted = {f.name for f in schema.fields}
    cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in wanted]
    return df.select(*cols, *extra, stamp)


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """The Parquet files in groups whose columns have the same types, each with
    its merged schema.  All footers are read by one job; only where types differ
    is the list halved until they don't, so the number of jobs follows the number of
    changes and not of files.  A file without a readable footer raises."""
    groups: dict[str, tuple[dict, list[str]]] = {}

    def visit(some: Sequence[str]) -> None:
        try:
            merged = spark.read.option("ignoreCorruptFiles", False).option("mergeSchema", True).parquet(*some).schema
        except Exception:  # noqa: BLE001 - conflicts and damage have no common class
            if len(some) == 1:
                raise
            visit(some[:len(some) // 2])
            visit(some[len(some) // 2:])
            return
        fields = {f.name: f for f in merged.fields}
        for known, members in groups.values():
            if all(same(f.dataType, known[n].dataType) for n, f in fields.items() if n in known):
                known.update({n: f for n, f in fields.items() if n not in known})
                members.extend(some)
                return
        groups[some[0]] = (fields, list(some))
    visit(list(paths))
    return [(StructType(list(fields.values())), members) for fields, members in groups.values()]
