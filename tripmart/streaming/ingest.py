"""Incremental page/file ingestion with Structured Streaming (STR-1, STR-2,
SRC-9 re-aimed).

Pages land as JSON files in a landing folder; a file source picks up each new
file exactly once (the processed-file log lives in the checkpoint, in the
shared work folder).  ``trigger(availableNow=True)`` turns a run into "process
what has landed, then stop", which is how the reference's paged load runs.

Every micro-batch is written with a mark derived from its batch id and is
appended.  Only the first batch of a run can be one that an earlier run wrote
and did not commit; if the table holds rows with its mark, they are taken into
account, so a replay leaves the table as one run would.  Batches are grouped, a
block of them to a partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType, TimestampType

from tripmart.sinks import tables

LEDGER_SCHEMA = StructType([
    StructField("load_id", StringType()),
    StructField("inserted_at", TimestampType()),
    StructField("status", StringType()),
    StructField("row_count", LongType()),
    StructField("load_block", LongType()),
])

#: So many batches share a partition, in the target and in the ledger, so the
#: number of partitions does not follow that of the batches.
LEDGER_BLOCK = 1000


def schema_with_hints(schema: StructType, hints: Mapping[str, DataType]) -> StructType:
    """Apply column type hints (e.g. a code read as text, a tax as double) to
    an otherwise given schema."""
    return StructType([StructField(f.name, hints.get(f.name, f.dataType), True) for f in schema.fields])


# Timestamps in landed pages keep microseconds (the JSON default keeps
# milliseconds only).
PAGE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def page_stream(spark: SparkSession, landing_dir: str, schema: StructType,
                max_files_per_trigger: int | None = None,
                timestamp_format: str = PAGE_TIMESTAMP_FORMAT) -> DataFrame:
    """Streaming frame over landed JSON pages (one record per line)."""
    r = spark.readStream.schema(schema).option("timestampNTZFormat", timestamp_format) \
        .option("timestampFormat", timestamp_format)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(landing_dir)


def load_id_of(batch_id: int) -> str:
    return f"load_{batch_id:010d}"


def _ensure(spark: SparkSession, name: str, schema: StructType, part: str) -> None:
    tables.ensure_table(spark, name, schema, [part])


def append_with_ledger(stream: DataFrame, target: str, ledger: str, checkpoint: str,
                       data_columns: Sequence[str] | None = None) -> None:
    """Run the stream to the end of what has landed (STR-1): rows go to
    ``target`` with ``_load_id``, in partitions of ``LEDGER_BLOCK`` batches;
    each batch adds one ``ledger`` row (load_id, inserted_at, status 'loaded',
    row_count); a batch of empty pages adds none.  A second run with the same
    checkpoint reads nothing new, and a batch that an earlier run wrote, wholly
    or in part, replaces its own rows."""
    spark = stream.sparkSession
    cols = list(data_columns or stream.columns)
    row_schema = StructType([stream.schema[c] for c in cols] + [StructField("_load_id", StringType()), StructField("load_block", LongType())])
    _ensure(spark, target, row_schema, "load_block")
    _ensure(spark, ledger, LEDGER_SCHEMA, "load_block")
    state = {"first": True}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch runs in the stream's own session.
        s = batch.sparkSession
        lid, block = load_id_of(batch_id), F.lit(batch_id // LEDGER_BLOCK).cast("long")
        rows = batch.select(*cols, F.lit(lid).alias("_load_id"), block.alias("load_block"))
        here = s.table(target).where(F.col("load_block") == block)
        mine = F.col("_load_id") == lid
        first, state["first"] = state["first"], False
        if first and not here.where(mine).isEmpty():
            tables.overwrite_partitions(here.where(~mine).unionByName(rows), target)
            s.catalog.refreshTable(target)
            n = s.table(target).where((F.col("load_block") == block) & mine).count()
        else:
            n = tables.write_append_counted(rows, target)
        if n == 0:
            return      # an empty page loads nothing and leaves no ledger row
        entry = s.range(0, 1, 1, 1).select(F.lit(lid).alias("load_id"), F.current_timestamp().alias("inserted_at"),
                                  F.lit("loaded").alias("status"), F.lit(n).cast("long").alias("row_count"), block.alias("load_block"))
        if not first:   # no earlier run wrote this batch
            tables.write_append(entry, ledger)
            return
        # A replayed batch replaces its own row; the block's other rows are written again with it.
        s.catalog.refreshTable(ledger)
        others = s.table(ledger).where((F.col("load_block") == block) & (F.col("load_id") != lid))
        tables.overwrite_partitions(others.unionByName(entry), ledger)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    # Batches wrote through the stream's session; refresh the caller's view.
    spark.catalog.refreshTable(target)
    spark.catalog.refreshTable(ledger)


def merge_stream(stream: DataFrame, target: str, keys: Sequence[str], checkpoint: str, batch_column: str = "_batch_id") -> None:
    """Insert-only merge of every micro-batch into ``target`` (STR-2).

    If the target has a column ``batch_column`` (long), every row carries its
    batch's number there, and the result is exactly-once for all rows: a batch
    that an earlier run inserted, wholly or in part, adds just the rows that
    are missing, those with a NULL key or a repeated key included.  Without
    that column a replay inserts none of the rows that have a key, and rows
    with a NULL key, which match nothing, again.

    A run reads the target's keys at most twice, however many batches it has,
    as long as its batches bring new keys (``key_index.Seen``); a batch with a
    key that may be there is compared with the target."""
    spark = stream.sparkSession
    marked = batch_column in tables.column_names(spark, target)
    alike = tables.reads_alike(stream)
    run: dict = {"batches": 0, "seen": None}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(batch_column, F.lit(batch_id).cast("long")) if marked else batch
        # The target's keys are read for a run of several batches, not for one that compares a single batch with them.
        if run["batches"] == 1 or (run["batches"] == 0 and batch.sparkSession.table(target).isEmpty()):
            run["seen"] = run["seen"] or tables.seen_keys(target, rows.schema, keys, batch.sparkSession)
        if marked and run["batches"] == 0 and run["seen"] is None:
            tables.merge_insert_missing(rows, target, keys, F.col(batch_column) == batch_id)
        else:
            tables.merge_insert_new(rows, target, keys, few_files=True, seen=run["seen"], alike=alike)
        run["batches"] += 1

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    spark.catalog.refreshTable(target)
