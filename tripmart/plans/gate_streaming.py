"""Gate queries of the streaming ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans.gate import gate
from tripmart.session import scratch_database, scratch_dir
from tripmart.sinks import tables
from tripmart.sources import adapter, pages
from tripmart.streaming import ingest

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
# Fixed value: records per page of the paged source.
PAGE_SIZE = 1000
# Pages taken per micro-batch.
PAGES_PER_BATCH = 32
# Pages re-delivered by a second landing (their events arrive twice).
REDELIVERED_PAGES = 3


def _land_pages(events: DataFrame, landing: str, page_offset: int = 0) -> None:
    """Write events as JSON pages of PAGE_SIZE records, one file per page
    (pages are bounded, so one task per page is safe)."""
    page = (F.floor(F.col("event_id") / PAGE_SIZE) + F.lit(page_offset)).cast("long")
    pages.land_pages(events.select(*EVENT_COLS, page.alias("page")), landing, timestampNTZFormat=ingest.PAGE_TIMESTAMP_FORMAT)


def _event_schema(spark: SparkSession, sf_dir: str):
    return adapter.table(spark, sf_dir, "events").select(*EVENT_COLS).schema


def _page_schema(spark: SparkSession, sf_dir: str):
    return _event_schema(spark, sf_dir).add("page", "long")


@gate("stream_append_ledger", "select event_id, ts, user_id, event_type, value, props from events")
def stream_append_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages landed, streamed with a ledger, then the stream is run again
    (it reads nothing new): every event exactly once."""
    return spark.table(f"{_stream_twice(spark, sf_dir)}.events").select(*EVENT_COLS)


@gate("stream_ledger", f"""
select 'loaded' as status, cast(ceil(count(distinct event_id // {PAGE_SIZE}) / {PAGES_PER_BATCH}.0) as bigint) as loads,
  cast(count(*) as bigint) as rows, true as ids_in_order, true as rows_agree from events""")
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the same runs: one loaded row per batch, numbered without
    a gap, whose row counts are those of the rows with its load id."""
    db = _stream_twice(spark, sf_dir)
    found = spark.table(f"{db}.events").groupBy("_load_id").agg(F.count(F.lit(1)).alias("found"))
    ledger = spark.table(f"{db}.loads").join(found, F.col("load_id") == F.col("_load_id"), "left")
    return ledger.groupBy("status").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("row_count").alias("rows"),
        (F.max(F.substring("load_id", 6, 10).cast("long")) == F.count(F.lit(1)) - 1).alias("ids_in_order"),
        F.min((F.col("row_count") == F.col("found")).cast("int")).cast("boolean").alias("rows_agree"))


def _stream_twice(spark: SparkSession, sf_dir: str) -> str:
    ev = adapter.table(spark, sf_dir, "events").select(*EVENT_COLS)
    landing, ckpt = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    _land_pages(ev, landing)
    db = scratch_database(spark, "stream")
    schema = ingest.schema_with_hints(_page_schema(spark, sf_dir), {})
    for _ in range(2):
        stream = ingest.page_stream(spark, landing, schema, max_files_per_trigger=PAGES_PER_BATCH)
        ingest.append_with_ledger(stream, f"{db}.events", f"{db}.loads", ckpt, EVENT_COLS)
    return db


@gate("stream_merge", "select event_id, ts, user_id, event_type, value, props from events")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only merge per micro-batch: a second landing re-delivers the
    first pages; their events are not inserted again."""
    ev = adapter.table(spark, sf_dir, "events").select(*EVENT_COLS)
    landing, ckpt = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    db = scratch_database(spark, "smerge")
    target = f"{db}.events"
    tables.ensure_table(spark, target, _event_schema(spark, sf_dir))
    schema = _page_schema(spark, sf_dir)
    _land_pages(ev, landing)
    ingest.merge_stream(ingest.page_stream(spark, landing, schema, PAGES_PER_BATCH).select(*EVENT_COLS), target,
                        ["event_id"], ckpt)
    again = ev.where(F.col("event_id") < REDELIVERED_PAGES * PAGE_SIZE)
    _land_pages(again, landing, page_offset=1_000_000)
    ingest.merge_stream(ingest.page_stream(spark, landing, schema, PAGES_PER_BATCH).select(*EVENT_COLS), target,
                        ["event_id"], ckpt)
    return spark.table(target)


@gate("stream_merge_indexed", "select event_id, ts, user_id, event_type, value, props from events")
def stream_merge_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_merge``, into a target by day with a key index: a batch reads
    only the days that its keys can be in."""
    ev = adapter.table(spark, sf_dir, "events").select(*EVENT_COLS)
    landing, ckpt = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    target = f"{scratch_database(spark, 'sindex')}.events"
    schema = _page_schema(spark, sf_dir)
    day = F.to_date("ts").alias("event_date")
    tables.ensure_table(spark, target, ev.select("*", day).schema, ["event_date"])
    tables.build_key_index(spark, target, ["event_id"])
    for rows, offset in ((ev, 0), (ev.where(F.col("event_id") < REDELIVERED_PAGES * PAGE_SIZE), 1_000_000)):
        _land_pages(rows, landing, page_offset=offset)
        stream = ingest.page_stream(spark, landing, schema, PAGES_PER_BATCH).select(*EVENT_COLS, day)
        ingest.merge_stream(stream, target, ["event_id"], ckpt)
    return spark.table(target).select(*EVENT_COLS)


# --- replays -------------------------------------------------------------------

def _forget_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """Take back the commit of the checkpoint's last batch, as if the run had
    died right after it wrote the rows: the next run reads that batch again."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    commits = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().isdigit()]
    fs.delete(max(commits, key=lambda p: int(p.getName())), False)


def _keyless(events: DataFrame) -> DataFrame:
    """Every seventh event has no id."""
    return events.withColumn("event_id", F.when(F.col("event_id") % 7 != 3, F.col("event_id")))


REPLAY_SQL = """select case when event_id % 7 <> 3 then event_id end as event_id, ts, user_id, event_type, value, props from events"""


@gate("stream_merge_replay", REPLAY_SQL)
def stream_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch is merged, forgotten and merged again; many of its rows
    have no key.  Every event is there once."""
    landing, ckpt = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    target = f"{scratch_database(spark, 'sreplay')}.events"
    schema = _page_schema(spark, sf_dir)
    tables.ensure_table(spark, target, _keyless(spark.createDataFrame([], _event_schema(spark, sf_dir))).schema.add("_batch_id", "long"))
    _land_pages(adapter.table(spark, sf_dir, "events"), landing)
    for _ in range(2):
        stream = ingest.page_stream(spark, landing, schema, PAGES_PER_BATCH).select(*EVENT_COLS)
        ingest.merge_stream(_keyless(stream), target, ["event_id"], ckpt)
        _forget_last_batch(spark, ckpt)
    return spark.table(target).select(*EVENT_COLS)


@gate("stream_append_replay", REPLAY_SQL)
def stream_append_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch is appended, forgotten and appended again: it replaces its own rows."""
    landing, ckpt = scratch_dir(spark, "landing"), scratch_dir(spark, "stream-ckpt")
    db = scratch_database(spark, "areplay")
    schema = _page_schema(spark, sf_dir)
    _land_pages(adapter.table(spark, sf_dir, "events"), landing)
    for _ in range(2):
        stream = ingest.page_stream(spark, landing, schema, PAGES_PER_BATCH)
        ingest.append_with_ledger(_keyless(stream), f"{db}.events", f"{db}.loads", ckpt, EVENT_COLS)
        _forget_last_batch(spark, ckpt)
    return spark.table(f"{db}.events").select(*EVENT_COLS)


# --- the paged source's end -----------------------------------------------------

SMALL_PAGE, SHORT_PAGE, SHORT_ROWS = 100, 3, 40


@gate("paged_source_end", f"""with p as (select event_id, event_id // {SMALL_PAGE} as page, event_id % {SMALL_PAGE} as place from events)
select 1 as run, event_id from p where page < {SHORT_PAGE} or (page = {SHORT_PAGE} and place < {SHORT_ROWS})
union all select 2, event_id from p where page >= {SHORT_PAGE} and page < 8""")
def paged_source_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of which one is short: those after it are not read.  Once
    it has grown, the next run starts there and ends before a page that is missing."""
    landing = scratch_dir(spark, "pages")
    ev = adapter.table(spark, sf_dir, "events").select("event_id", F.floor(F.col("event_id") / SMALL_PAGE).alias("page"))
    full = ev.where("page <> 8")
    late = (F.col("page") == SHORT_PAGE) & (F.col("event_id") % SMALL_PAGE >= SHORT_ROWS)
    pages.land_pages(full.where(~late), landing)
    schema = ev.select("event_id").schema
    first, start = pages.read_pages(spark, landing, schema, SMALL_PAGE, 0)
    first = tables.materialize(first.select(F.lit(1).alias("run"), "event_id"), "run")
    pages.land_pages(full.where(late), landing)
    second, _ = pages.read_pages(spark, landing, schema, SMALL_PAGE, start)
    return first.unionByName(second.select(F.lit(2).alias("run"), "event_id"))
