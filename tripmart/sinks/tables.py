"""Materialisation strategies on plain Parquet tables (SNK-*).

Parquet tables have no MERGE / UPDATE / DELETE, so every strategy is written
as a set computation plus one of two writes:

* append (``insertInto``): used by the insert-only merge;
* dynamic partition overwrite: only the partitions that appear in the written
  frame are replaced; used by upsert, delete+insert and the time-interval
  refresh, which therefore touch only the partitions their keys/window reach.

Re-running any of them with the same input leaves the same table (insert-only
merge by key, the others by construction), so a job retried after an executor
or driver loss converges.  One writer per table at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.operators.aggregates import duplicate_keys
from tripmart.operators.joins import BROADCAST_LIMIT_BYTES, anti_join, estimated_bytes, is_bounded, semi_join
from tripmart.sinks import key_index


class ContractError(ValueError):
    """A frame does not match the declared contract of its table."""


class MergeKeyError(ValueError):
    """More than one source row per key in an upsert."""


@contextmanager
def session_like(spark: SparkSession, **settings: str):
    """A session of its own with the caller's settings and some others, so
    that a write under other settings does not touch the caller's writers."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    yield own


def overwrite_partitions(rows: DataFrame, target: str) -> list[str | None]:
    """Replace the partitions of ``target`` in which ``rows`` has rows, by one
    dynamic overwrite, and return them (as text; NULL is None).

    ``rows`` is computed once and written once: it may read the target, as the
    new files take the partitions' place only when the write is complete, and
    the partitions are noted while the rows pass.  The overwrite mode is a
    session setting, so the plan goes to a session of its own as a view."""
    spark = rows.sparkSession
    part = partition_columns(spark, target)[0]
    drop_key_index(spark, target)
    name = f"overwrite_{uuid.uuid4().hex}"
    noted = Observation(name)
    values = F.to_json(F.collect_set(F.struct(F.col(part).cast("string").alias("value"))))
    rows.select(*[f"`{c}`" for c in spark.table(target).columns]).createGlobalTempView(name)
    try:
        with session_like(spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}) as own:
            seen = own.table(f"global_temp.{name}").observe(noted, values.alias("values"))
            spread(seen, [part]).write.insertInto(target, overwrite=True)
            try:
                written = noted.get["values"]
            except Exception:
                # A plan found to be empty is not run, so nothing was noted and nothing written.
                if not own.table(f"global_temp.{name}").isEmpty():
                    raise
                written = "[]"
    finally:
        spark.catalog.dropGlobalTempView(name)
    spark.catalog.refreshTable(target)
    return [v.get("value") for v in json.loads(written)]


def spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition value before a partitioned write, so
    that a partition gets few files instead of one from every task; adaptive
    execution splits a partition that is larger than the advisory size."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _layout(spark: SparkSession, name: str) -> dict:
    """The catalog's description of a table: a command, which runs no Spark job
    (``catalog.listColumns`` runs one for every few columns)."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])


def column_names(spark: SparkSession, name: str) -> list[str]:
    """As ``spark.table(name).columns``, which would list the table's files."""
    return [c["name"] for c in _layout(spark, name)["columns"]]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return _layout(spark, name).get("partition_columns", [])


def bucket_columns(spark: SparkSession, name: str) -> list[str]:
    return _layout(spark, name).get("bucket_columns", [])


def _writer(df: DataFrame, partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None):
    w = (df if bucket_by else spread(df, partition_by)).write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    return w


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


# --- create / replace / append (SNK-1 .. SNK-6) ----------------------------

def ensure_table(spark: SparkSession, name: str, schema: StructType,
                 partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with a typed schema (SNK-1).

    ``bucket_by=(n, keys)`` stores the table in ``n`` buckets hashed on the
    merge keys: joins on those keys (the merges' anti and semi joins) then
    shuffle only the other side, never the table."""
    if table_exists(spark, name):
        return
    _writer(spark.createDataFrame([], schema), partition_by, bucket_by).saveAsTable(name)


def create_like(df: DataFrame, name: str) -> None:
    """Empty table with the columns of ``df`` (SNK-2)."""
    df.limit(0).write.format("parquet").saveAsTable(name)


def write_replace(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                  bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Full refresh / CTAS (SNK-3, INC-6)."""
    drop_key_index(df.sparkSession, name)
    _writer(df, partition_by, bucket_by).mode("overwrite").saveAsTable(name)


def write_append(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Append (SNK-4); creates the table on first use.  Re-running appends
    again, by design."""
    spark = df.sparkSession
    if table_exists(spark, name):
        _insert(df, name)
    else:
        _writer(df, partition_by).saveAsTable(name)


def write_append_counted(df: DataFrame, name: str) -> int:
    """Append to a table and return the number of rows appended, counted while
    they pass: neither ``df`` nor the table is read for it."""
    noted = Observation(f"append_{uuid.uuid4().hex}")
    # Counted behind the write's shuffle, where a repeated task does not count twice.
    _insert(df, name, noted=noted)
    try:
        return noted.get["rows"]
    except Exception:
        # A plan found to be empty is not run, so nothing was noted and nothing written.
        if not df.isEmpty():
            raise
        return 0


def _insert(df: DataFrame, name: str, keeps_index: bool = False, noted: Observation | None = None, dealt: int | None = None,
            small: bool = False) -> None:
    """``small``: the rows are few, so adaptive execution would leave the files of all partitions to one task."""
    spark = df.sparkSession
    if not keeps_index:
        drop_key_index(spark, name)
    layout = _layout(spark, name)
    rows = df.select(*[f"`{c['name']}`" for c in layout["columns"]])
    if layout.get("bucket_columns") and layout["num_buckets"] != dealt:
        # Dealt out like the buckets, so that each bucket gets one file of the insert.
        rows = rows.repartition(layout["num_buckets"], *layout["bucket_columns"])
    parts = layout.get("partition_columns", [])
    rows = rows.repartition(spark.sparkContext.defaultParallelism, *parts) if small and parts else spread(rows, parts)
    (rows.observe(noted, F.count(F.lit(1)).alias("rows")) if noted else rows).write.insertInto(name)


def write_truncate_insert(df: DataFrame, name: str) -> None:
    """Empty the table, keep its definition, insert ``df`` (SNK-5)."""
    spark = df.sparkSession
    spark.sql(f"TRUNCATE TABLE {name}")
    _insert(df, name)


def write_view(df: DataFrame, name: str) -> None:
    """Session view (SNK-6): a named, lazily evaluated plan."""
    df.createOrReplaceTempView(name)


def write_stored_view(spark: SparkSession, name: str, query: str) -> None:
    """View kept in the catalog (SNK-6): later sessions see it.  Such a view
    is stored as SQL text over stored tables or views."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON files (SNK-15), one object per line."""
    df.write.mode(mode).json(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 100_000) -> None:
    """JDBC sink (SNK-14).  ``batch_size`` mirrors the reference's 100k-row
    chunks; parallelism is the frame's partition count.  Needs the database's
    JDBC driver on the classpath (not shipped here)."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


# --- contract and evolution (SNK-12, SNK-13) -------------------------------

def conform(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Enforce a contract (SNK-13, DQ-10): names, order and types must match.

    ``strict=False`` casts and reorders instead of raising (columns missing
    from ``df`` still raise)."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if have == want:
        return df
    missing = [n for n, _ in want if n not in dict(have)]
    if strict or missing:
        extra = [n for n, _ in have if n not in dict(want)]
        wrong = [(n, dict(have)[n], t) for n, t in want if n in dict(have) and dict(have)[n] != t]
        order = [n for n, _ in have if n in dict(want)] != [n for n, _ in want if n in dict(have)]
        raise ContractError(f"contract mismatch: missing={missing} extra={extra} "
                            f"type(name, have, want)={wrong} order_differs={order}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def evolve_append(df: DataFrame, name: str) -> None:
    """Append with schema evolution (SNK-12): columns new to the table are
    added (old rows read NULL), columns missing from ``df`` are written NULL."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        write_append(df, name)
        return
    target = spark.table(name)
    have = {c.lower() for c in target.columns}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        spark.catalog.refreshTable(name)
        target = spark.table(name)
    _insert(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(target.schema[c].dataType).alias(c)
                        for c in target.columns]), name)


# --- merges (SNK-7, SNK-8, SNK-10) -----------------------------------------

def merge_insert_new(src: DataFrame, target: str, keys: Sequence[str],
                     dedupe_source: bool = False, few_files: bool = False, dealt: int | None = None,
                     seen: key_index.Seen | None = None, alike: bool = False) -> None:
    """Insert-only merge (SNK-7): source rows whose key is absent from the
    target are appended; target rows never change.  Duplicates inside one
    batch are all inserted (as the reference's MERGE does) unless
    ``dedupe_source``.  A re-run inserts nothing (a NULL key matches nothing,
    as in SQL, so such a row is inserted by every run).  ``few_files`` is for a
    stream of small batches: each brings its rows together before the insert,
    so that the number of files the next batches read follows that of the
    batches and not of their tasks.  ``dealt``: the source is hashed on the
    keys to so many partitions already, as a target of so many buckets is; its
    rows are then not moved again for the insert.  ``seen``: the keys that the
    target holds; a batch without any of them is inserted without reading the
    target, and the batch's keys are added to it.  ``alike``: the caller knows that
    the source may be read several times."""
    spark = src.sparkSession
    if dedupe_source:
        src = src.dropDuplicates(list(keys))
    if seen is not None and not seen.full:
        with nullcontext(src) if alike else read_alike(src, "batch") as rows:
            places = seen.places(rows)
            if seen.holds_some(places):
                merge_insert_new(rows, target, keys, few_files=few_files, dealt=dealt, alike=True)
            else:
                _insert_new(rows, target, keys, few_files, dealt)
        seen.add(places)
        return
    if has_key_index(spark, target, keys):
        part = partition_columns(spark, target)[0]
        with nullcontext(src) if alike else read_alike(src, "batch") as rows:
            reached = partition_values(key_index.partitions_with(spark.table(key_index.name_of(target)), rows, keys))
            if reached:
                with staged(_new_in(rows, target, keys, part, reached), "new") as (added, _):
                    _insert_indexed(added, target, keys, part, few_files)
            else:
                # No partition can hold a key of the batch: all its rows are new.
                _insert_indexed(rows.select(*spark.table(target).columns), target, keys, part, few_files)
        return
    gathered = _gathered(spark, target, few_files)
    if _meets_by_batch(spark, src, target, keys):
        # The batch is read twice (its keys, then its rows): compute it once.
        with nullcontext(src) if alike else read_alike(src, "batch") as rows:
            _insert(gathered(new_rows(rows, target, keys)), target)
    elif not few_files and spark.table(target).isEmpty():
        # Every row is new; no key has to be moved to see that.
        _insert(src.select(*spark.table(target).columns), target, dealt=dealt)
    else:
        _insert(gathered(new_rows(src, target, keys)), target, dealt=dealt)


def _gathered(spark: SparkSession, target: str, few_files: bool):
    return (lambda rows: rows.hint("rebalance")) if few_files and not partition_columns(spark, target) else (lambda rows: rows)


def _insert_new(rows: DataFrame, target: str, keys: Sequence[str], few_files: bool, dealt: int | None) -> None:
    """Insert rows none of whose keys is in the target; ``rows`` may be read several times."""
    spark = rows.sparkSession
    if has_key_index(spark, target, keys):
        _insert_indexed(rows, target, keys, partition_columns(spark, target)[0], few_files)
    else:
        _insert(_gathered(spark, target, few_files)(rows), target, dealt=dealt)


def _insert_indexed(added: DataFrame, target: str, keys: Sequence[str], part: str, small: bool) -> None:
    """``added`` may be read several times."""
    # Bits before rows: a run that fails in between leaves too many bits, never too few.
    index = key_index.name_of(target)
    key_index.bitmaps(added, keys, part).write.insertInto(index)
    added.sparkSession.catalog.refreshTable(index)
    _insert(added, target, keeps_index=True, small=small)


def _new_in(src: DataFrame, target: str, keys: Sequence[str], part: str, reached: list[str | None]) -> DataFrame:
    """The rows whose key is in none of the reached partitions of the target."""
    tgt = src.sparkSession.table(target)
    return anti_join(src, rows_of_partitions(tgt, part, reached).select(*keys), keys).select(*tgt.columns)


def seen_keys(target: str, rows: StructType, keys: Sequence[str], spark: SparkSession) -> key_index.Seen | None:
    """The keys that the target holds now, for a run of merges of such rows; None
    if keys of these types can't be told by their places."""
    tgt = spark.table(target)
    if not key_index.Seen.can_tell(rows, tgt.schema, keys):
        return None
    seen = key_index.Seen(keys)
    seen.add(seen.places(tgt))
    return seen


def merge_insert_missing(src: DataFrame, target: str, keys: Sequence[str], of_batch: Column) -> None:
    """Insert-only merge of a batch that may be in the target already, wholly
    or in part; ``of_batch`` tells its rows there.  Adds the rows that the merge
    would insert into the rest of the target and that aren't there yet, counted
    as often as they occur, so NULL and repeated keys come out as after one
    merge (INC-3).  Columns must be comparable (no maps)."""
    tgt = src.sparkSession.table(target)
    already = tgt.where(of_batch)
    if already.isEmpty():
        merge_insert_new(src, target, keys)
        return
    due = anti_join(src, tgt.where(~F.coalesce(of_batch, F.lit(False))), keys).select(*tgt.columns)
    _insert(due.exceptAll(already), target)


def build_key_index(spark: SparkSession, target: str, keys: Sequence[str]) -> None:
    """Index the keys of a partitioned table (``key_index``); insert-only merges
    on these keys then read only the partitions that a batch's keys can be in,
    and keep the index.  Building it again makes it compact.  Any other write to
    the table drops the index, after which merges read all keys as before."""
    index = key_index.name_of(target)
    found = key_index.bitmaps(spark.table(target), keys, partition_columns(spark, target)[0])
    drop_key_index(spark, target)
    found.write.format("parquet").saveAsTable(index)
    spark.sql(f"ALTER TABLE {index} SET TBLPROPERTIES ('{_INDEXED}' = '{','.join(keys)}')")


_INDEXED = "indexed_keys"


def has_key_index(spark: SparkSession, target: str, keys: Sequence[str]) -> bool:
    index = key_index.name_of(target)
    if not table_exists(spark, index):
        return False
    return spark.sql(f"SHOW TBLPROPERTIES {index} ('{_INDEXED}')").first()["value"] == ",".join(keys)


def drop_key_index(spark: SparkSession, target: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {key_index.name_of(target)}")


def _meets_by_batch(spark: SparkSession, src: DataFrame, target: str, keys: Sequence[str]) -> bool:
    """A bounded batch against a target several times as large that isn't
    bucketed on the keys: else every batch would shuffle or broadcast all the
    target's keys."""
    batch = estimated_bytes(src.select(*keys))
    return (0 <= batch <= BROADCAST_LIMIT_BYTES and not is_bounded(spark.table(target).select(*keys), MEETS_BY_BATCH * batch)
            and sorted(bucket_columns(spark, target)) != sorted(keys))


#: A target this many times as large as a batch is searched for the batch's keys.
MEETS_BY_BATCH = 4


def new_rows(src: DataFrame, target: str, keys: Sequence[str], dedupe_source: bool = False) -> DataFrame:
    """The rows an insert-only merge appends: ``src`` rows whose key is not in
    the target (lazy; evaluated against the target as it is then).  The join
    reads only the target's key columns.

    Of a target with a key index only the partitions are read that the index
    names.  A target bucketed on the keys is read bucket by bucket and only the
    batch is shuffled.  Otherwise a small batch finds its keys in a large target by
    a semi join first, so that the target's keys are not shuffled."""
    spark = src.sparkSession
    if dedupe_source:
        src = src.dropDuplicates(list(keys))
    tgt = spark.table(target)
    known = tgt.select(*keys)
    if has_key_index(spark, target, keys):
        part = partition_columns(spark, target)[0]
        reached = partition_values(key_index.partitions_with(spark.table(key_index.name_of(target)), src, keys))
        return _new_in(src, target, keys, part, reached)
    if _meets_by_batch(spark, src, target, keys):
        known = semi_join(known, src, keys)
    return anti_join(src, known, keys).select(*tgt.columns)


def partition_values(parts: DataFrame) -> list[str | None]:
    """The distinct values of a partition column, as text; no more than the
    table's partitions, which the catalog keeps on the driver as well."""
    return [r[0] for r in parts.select(F.col(parts.columns[0]).cast("string").alias("value")).distinct().collect()]


def rows_of_partitions(tgt: DataFrame, part: str, values: list[str | None]) -> DataFrame:
    """The target's rows in the given partitions (NULL included).  The values
    are literals, so no other partition is listed or read."""
    kind = tgt.schema[part].dataType
    known = [F.lit(v).cast(kind) for v in values if v is not None]
    found = F.col(part).isin(known) if known else F.lit(False)
    return tgt.where(found | F.col(part).isNull() if None in values else found)


def swap_partitions(out: DataFrame, target: str, part: str, touched: list[str | None]) -> None:
    """Replace the touched partitions by ``out``: one dynamic overwrite, then a
    drop of those left empty (such an overwrite never removes a partition it
    writes no row to)."""
    spark = out.sparkSession
    for value in set(touched) - set(overwrite_partitions(out, target)):
        text = "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({part} = {text})")
    spark.catalog.refreshTable(target)


#: Plan steps whose rows come again alike and cheaply when they are read twice.
_PLAIN_STEPS = frozenset("Relation Project Filter SubqueryAlias View Union LocalRelation".split())


def reads_alike(df: DataFrame) -> bool:
    """Whether reading ``df`` twice costs two plain scans and gives the same
    rows: files, projections, filters and unions without a value of the moment.
    Of a stream: whether that is so for its micro-batches, made of landed files."""
    plan = df._jdf.queryExecution().analyzed()
    lines = [line.lstrip(" :+-'~") for line in plan.toString().splitlines() if line.strip()]
    steps = {re.split(r"[^A-Za-z]", line)[0] for line in lines if not (line.startswith("StreamingRelation ") and "), FileSource[" in line)}
    return bool(plan.deterministic()) and steps <= _PLAIN_STEPS and not re.search(r"current_|localtimestamp|\bnow\(", plan.toString())


@contextmanager
def read_alike(df: DataFrame, label: str):
    """``df`` itself if it may be read several times, else its stored copy."""
    if reads_alike(df):
        yield df
    else:
        with staged(df, label) as (rows, _):
            yield rows


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the shared work folder and return a
    frame reading it: later actions reuse the files instead of recomputing
    the plan, and a lost executor costs a re-read, not a recomputation."""
    from tripmart.session import scratch_dir
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str):
    """(frame, folder) of ``df`` written once to the shared work folder; the
    folder goes when the block ends, so a merge leaves no copies behind."""
    from tripmart.session import scratch_dir
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path), path
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def merge_upsert(src: DataFrame, target: str, keys: Sequence[str], partition_col: str | None = None,
                 check_unique: bool = True) -> None:
    """Upsert (SNK-8): target rows whose key is in the source are replaced by
    the source row, other source rows inserted.  More than one source row per
    key raises ``MergeKeyError`` (the target engine rejects it too); a NULL
    key matches nothing, so any number of such rows is inserted.

    Only the partitions touched by the source (or by a matched target row,
    when a key moves partition) are rewritten."""
    spark = src.sparkSession
    with read_alike(src.select(*spark.table(target).columns), "source") as rows:
        if check_unique and duplicate_keys(rows, keys, skip_null_keys=True).limit(1).count() > 0:
            raise MergeKeyError(f"source has more than one row for some key of {list(keys)}")
        _replace_by_keys(spark, rows, target, keys, partition_col)


def write_delete_insert(src: DataFrame, target: str, keys: Sequence[str],
                        partition_col: str | None = None) -> None:
    """Delete every target row whose key occurs in the source, then insert
    the source (SNK-10).  Keys need not be unique."""
    spark = src.sparkSession
    with read_alike(src.select(*spark.table(target).columns), "source") as rows:
        _replace_by_keys(spark, rows, target, keys, partition_col)


def _replace_by_keys(spark: SparkSession, src: DataFrame, target: str, keys: Sequence[str],
                     partition_col: str | None) -> None:
    """``src`` may be read several times."""
    tgt = spark.table(target)
    part = partition_col or (partition_columns(spark, target) or [None])[0]
    if part is None:
        # Unpartitioned: the whole table is the one partition.
        with staged(anti_join(tgt, src, keys).unionByName(src), "swap") as (out, _):
            drop_key_index(spark, target)
            out.write.insertInto(target, overwrite=True)
        spark.catalog.refreshTable(target)
        return
    # Partitions with a source row or a target row whose key is in the source; only keys and partitions are read for them.
    touched = partition_values(src.select(part).unionByName(semi_join(tgt.select(*keys, part), src, keys).select(part)))
    if touched:
        swap_partitions(anti_join(rows_of_partitions(tgt, part, touched), src, keys).unionByName(src), target, part, touched)


# --- time-interval refresh (SNK-9) -----------------------------------------

OUTSIDE = "time_interval result has rows outside the window"


def write_time_interval(result: DataFrame, target: str, key: str, start, end,
                        partition_col: str, partition_of=None) -> None:
    """Replace the target rows with ``start <= key < end`` by ``result``.

    ``result`` must be filtered to the same window (rows outside it raise, as
    inserting them would duplicate rows).  The target is partitioned by
    ``partition_col`` = ``partition_of(key)`` (default: the date of ``key``;
    e.g. ``month_start`` for monthly partitions).  The partitions the window
    reaches are rewritten with their rows outside the window kept; partitions
    left empty are dropped."""
    from tripmart.functions.columns import in_window, ts_literal
    spark = result.sparkSession
    part_of = partition_of or F.to_date
    tgt = spark.table(target)
    like = tgt.schema[key].dataType
    window = in_window(key, start, end, like)
    first, last = (part_of(ts_literal(t, like)) for t in (start, end))
    in_reach = (F.col(partition_col) >= first) & (F.col(partition_col) <= last)
    # A row outside the window or its partitions fails the write before anything is replaced.
    fits = F.coalesce(window & in_reach, F.lit(False))
    rows = result.select(*[F.when(fits, F.col(c)).otherwise(F.raise_error(F.lit(OUTSIDE)).cast(tgt.schema[c].dataType)).alias(c)
                           if c == partition_col else F.col(c) for c in tgt.columns])
    reached = tgt.where(in_reach)
    try:
        swap_partitions(reached.where(~window).unionByName(rows), target, partition_col, partition_values(reached.select(partition_col)))
    except Exception as e:
        if OUTSIDE in str(e):
            raise ValueError(OUTSIDE) from e
        raise


# --- clustered layout (SNK-11) ---------------------------------------------

def clustered(df: DataFrame, date_of: str, cluster_by: Sequence[str], date_col: str | None = None) -> DataFrame:
    """Frame laid out for ``write_clustered``: a derived DATE column, rows
    range-partitioned on (date, cluster columns, row hash) and sorted inside
    each task, so every day's files hold row groups with tight min/max on the
    cluster columns.  Range rather than hash partitioning: a day holding a
    third of all rows is split over many writer tasks instead of one; the
    row hash keeps the split deterministic under task retries."""
    date_col = date_col or f"{date_of}_date"
    out = df.withColumn(date_col, F.to_date(date_of))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return out.repartitionByRange(F.col(date_col), *[F.col(c) for c in cluster_by], spread) \
              .sortWithinPartitions(date_col, *cluster_by)


def write_clustered(df: DataFrame, name: str, date_of: str, cluster_by: Sequence[str],
                    date_col: str | None = None) -> None:
    """Partition by the date of a timestamp, cluster by columns (SNK-11)."""
    date_col = date_col or f"{date_of}_date"
    clustered(df, date_of, cluster_by, date_col).write.format("parquet").mode("overwrite") \
        .partitionBy(date_col).saveAsTable(name)
