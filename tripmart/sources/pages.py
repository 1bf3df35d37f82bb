"""Numbered pages of a paged source: landed, and read up to the source's end (SRC-9).

A paged source is asked for page after page until one is empty or shorter than
the page size: that was the last one.  Landed pages are files named by their
number; a run reads them from a first page on, up to and with the first that
is short, and none beyond it, nor beyond a page that has not landed.  The next
run starts at that page again if it was short (it may have grown), else after it.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Pages that a run looks at first; as long as the end isn't among them, eight times as many.
FIRST_LOOK = 1024

#: A page's file name, its number in the group (a folder ``page=7`` counts as well).
PAGE_NUMBER = r"page[_=-]?(\d+)(?:\.json|/[^/]*)$"

#: The same in a name of the landing folder's own listing.
_NAMED = re.compile(r"page[_=-]?(\d+)(?:\.json)?$", re.ASCII)
#: Up to so many paths are read by their names; for more the whole folder is listed.
MOST_NAMED = 10_000
#: A path that is read by its name is a task of the listing, which costs as much as so many files of one folder.
FILES_PER_NAME = 25


# --- landing ---------------------------------------------------------------------

def _page_writer(folder: str, landing_id: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, pages = TaskContext.get().partitionId(), 0
        records = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for page, group in groupby(records, itemgetter(0)):
            # A task that is run again puts the same pages in the same places.
            name = f"{landing_id}-{task}-page_{'none' if page is None else page}.json"
            hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
            with open(hidden, "w", encoding="utf-8") as f:
                f.writelines(f"{text}\n" for _, text in group)
            os.replace(hidden, f"{folder}/{name}")
            pages += 1
        yield pa.RecordBatch.from_pydict({"pages": [pages]})
    return write


def land_pages(rows: DataFrame, landing: str, **json_options: str) -> None:
    """Write the records of every page (column ``page``) to a JSON file of its
    own, beside those that have landed before.  In a folder of the local or a
    shared file system the tasks write the files themselves, all into the one
    folder: Spark's writer makes a folder for every page, with several processes
    to set the rights of each file, and every listing has a task per folder.
    Elsewhere Spark writes, a folder ``page=7`` per page."""
    spark = rows.sparkSession
    by_page = rows.repartition("page")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing)
    where = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    if where.getScheme() != "file":
        # The tasks move their own files to their place, not the driver all of them one by one when the write ends.
        by_page.write.mode("append").partitionBy("page").option("mapreduce.fileoutputcommitter.algorithm.version", "2") \
            .options(**json_options).json(landing)
        return
    os.makedirs(where.getPath(), exist_ok=True)
    texts = by_page.sortWithinPartitions("page").select(F.col("page").cast("long"), F.to_json(F.struct(*rows.columns), json_options))
    texts.mapInArrow(_page_writer(where.getPath(), uuid.uuid4().hex[:12]), "pages long").write.format("noop").mode("overwrite").save()


# --- reading ---------------------------------------------------------------------

#: A name in a landing folder with its page's number; None for a name without one, which may be a folder of pages.
Landed = list[tuple[int | None, str]]


def _landed(spark: SparkSession, landing: str) -> Landed | None:
    """What lies in the landing folder, by one listing of that folder alone;
    None if it has to be left to Spark (a pattern, a folder that is a page itself)."""
    if re.search(r"[{}\[\]*?\\]", landing) or _NAMED.search(landing.rstrip("/")):
        return None
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(landing)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(path))
    # One string (no path has three slashes in a row): a call for every file takes longer than the listing.
    text = getattr(getattr(jvm.scala.collection.immutable, "ArraySeq$"), "MODULE$").unsafeWrapArray(paths).mkString("///")
    found: Landed = []
    for file in text.split("///") if text else []:
        name = file.rsplit("/", 1)[1]
        if not name.startswith(".") and (not name.startswith("_") or "=" in name):
            number = _NAMED.search(name)
            found.append((int(number[1]) if number else None, re.sub(r"([{}\[\]*?\\])", r"\\\1", file)))
    return found


def _within(landed: Landed | None, landing: str, first: int, last: int) -> list[str]:
    """The paths to read for the pages from ``first`` to ``last``: by their
    names if they are few, so that the others are not listed again; none if
    there is no such page."""
    if landed is None:
        return [landing]
    chosen = [file for number, file in landed if number is None or first <= number <= last]
    folders = not all(file.endswith(".json") for file in chosen)
    few = len(chosen) <= MOST_NAMED and (folders or len(chosen) * FILES_PER_NAME <= len(landed))
    return chosen if few or not chosen else [landing]


def _reader(spark: SparkSession, landing: str, paths: list[str]) -> DataFrameReader:
    # Columns in folder names are found below the landing folder, whatever is read of it.
    return spark.read if paths == [landing] else spark.read.option("basePath", landing)


def _number() -> Column:
    return F.regexp_extract("_metadata.file_path", PAGE_NUMBER, 1).try_cast("long")


def last_page(spark: SparkSession, landing: str, page_size: int, first: int = 1, landed: Landed | None = None) -> tuple[int, bool] | None:
    """(number, whether it is full) of the last page to read from ``first`` on;
    None if that page has not landed or is empty.  The stop is the least page
    that is short or has no next one; an empty page ends the source as one that
    has not landed does.  A job counts the lines of the pages from ``first`` on,
    as far as it looks; the files of others are left out by their names, unopened."""
    landed = _landed(spark, landing) if landed is None else landed
    look = FIRST_LOOK
    while True:
        paths = _within(landed, landing, first, first + look - 1)
        if not paths:
            return None
        files = _reader(spark, landing, paths).text(paths)
        pages = files.where(_number().between(first, first + look - 1)).where("trim(value) != ''").groupBy(_number().alias("page")).agg(F.count(F.lit(1)).alias("n"))
        # A page tells the one before it that it has a next one.
        told = F.explode(F.array(F.struct("page", "n"), F.struct((F.col("page") - 1).alias("page"), F.lit(None).cast("long").alias("n"))))
        pages = pages.select(told.alias("t")).select("t.*").groupBy("page").agg(F.max("n").alias("n"), F.bool_or(F.col("n").isNull()).alias("has_next"))
        stops = pages.where("n is not null").agg(
            F.min(F.when((F.col("n") < page_size) | ~F.col("has_next"), F.struct("page", "n"))).alias("found"),
            F.min("page").alias("least")).first()
        # A run begins at its first page: later ones are beyond a gap.
        if stops["least"] != first:
            return None
        number, n = stops["found"]
        # The last page of all that were looked at may have a next one.
        if n < page_size or number < first + look - 1:
            return number, n >= page_size
        look *= 8


def read_pages(spark: SparkSession, landing: str, schema: StructType, page_size: int, first: int = 1) -> tuple[DataFrame, int]:
    """The records of the pages from ``first`` to the source's end, and the
    page at which the next run starts.  A record carries its ``page``; a run
    that starts at a page read before sees its records again, so load them by a
    merge on their key."""
    landed = _landed(spark, landing)
    end = last_page(spark, landing, page_size, first, landed)
    number, full = end or (first, False)
    paths = _within(landed, landing, first, number) or [landing]
    rows = _reader(spark, landing, paths).schema(schema).option("mode", "FAILFAST").json(paths)
    # Folders named page=7 give a column of their own as well.
    rows = rows.select(*[F.col(f"`{c}`") for c in schema.names], _number().alias("page"))
    if end is None:
        return rows.where(F.lit(False)), first
    return rows.where(F.col("page").between(first, number)), number + 1 if full else number
