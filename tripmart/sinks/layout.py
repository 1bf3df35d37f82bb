"""What a range query reads of a stored table, and a layout that lets it read less.

``zone_map`` lists the row groups of Parquet files with the least and greatest
value of chosen columns and the bytes of their chunks, from the footers alone:
tasks read footers, no data page.  ``reached`` intersects it with ranges, as the
reader itself does with pushed filters, and ``scan_cost`` adds up files, row
groups, rows and bytes (INC-7).

``z_ordered`` lays rows out along a Z-order curve over several columns: each
column's values become ranks by quantiles, whose bits are interleaved.  Rows
close on the curve are close in every column, so files and row groups are
narrow in all of them, not just in the first as after a sort (SNK-11).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    DateType, LongType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType)


#: Footers that a task reads.
FOOTERS_PER_TASK = 64


def files_of(spark: SparkSession, table: str) -> list[str]:
    """The data files of a stored table (listed by the driver, as for any scan)."""
    return sorted(spark.table(table).inputFiles())


def _open(path: str):
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def zone_map(spark: SparkSession, files: Sequence[str], columns: StructType) -> DataFrame:
    """One row for each row group of the files: file, row_group, rows, bytes
    (of all its columns) and for every wanted column ``<c>_min``, ``<c>_max``
    (NULL where the footer keeps none) and ``<c>_bytes``.  Values are those of
    the file, so its column must have the wanted type."""
    fields = [StructField("file", StringType()), StructField("row_group", LongType()), StructField("rows", LongType()), StructField("bytes", LongType())]
    for f in columns.fields:
        fields += [StructField(f"{f.name}_min", f.dataType), StructField(f"{f.name}_max", f.dataType), StructField(f"{f.name}_bytes", LongType())]
    schema = StructType(fields)
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        for batch in batches:
            for path in batch.column("file").to_pylist():
                with _open(path) as source:
                    footer = pq.ParquetFile(source).metadata
                rows = []
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    chunks = [group.column(i) for i in range(group.num_columns)]
                    row = {"file": path, "row_group": g, "rows": group.num_rows, "bytes": sum(c.total_compressed_size for c in chunks)}
                    for c in chunks:
                        name, stats = c.path_in_schema, c.statistics
                        if f"{name}_bytes" in arrow.names:
                            known = stats is not None and stats.has_min_max
                            row.update({f"{name}_min": stats.min if known else None, f"{name}_max": stats.max if known else None,
                                        f"{name}_bytes": c.total_compressed_size})
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
    named = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, -(-len(files) // FOOTERS_PER_TASK)), "file")
    return named.mapInArrow(read, schema)


def reached(zones: DataFrame, ranges: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """The row groups that may hold a row with every column in its closed range."""
    for name, (low, high) in ranges.items():
        zones = zones.where(F.col(f"{name}_min").isNull() | ((F.col(f"{name}_min") <= high) & (F.col(f"{name}_max") >= low)))
    return zones


def scan_cost(zones: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """One row: files, row_groups, rows and bytes of the row groups (of the given columns' chunks, else of all)."""
    size = sum((F.coalesce(F.col(f"{c}_bytes"), F.lit(0)) for c in columns), F.lit(0).cast("long")) if columns else F.col("bytes")
    return zones.agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("row_groups"),
                     F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))


def _rank_key(df: DataFrame, name: str) -> Column:
    """A number that rises with the column's values (of text: with its first six bytes)."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, NumericType):
        return c.cast("double")
    if isinstance(kind, DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    raise TypeError(f"no order for {name}: {kind.simpleString()}")


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The place on the Z-order curve: the columns' ranks among 2^bits
    quantiles, bits interleaved; NULL has rank 0.  Fits a table of at most
    10 columns at 6 bits.  Costs one pass for the quantiles, of which 2^bits
    for each column come to the driver."""
    if bits * len(columns) > 62:
        raise ValueError("too many bits")
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(_rank_key(df, c), shares).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    place = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        steps = F.array(*[F.lit(float(b)) for b in bounds[f"q{j}"] or []]).cast("array<double>")
        rank = F.coalesce(F.size(F.filter(steps, lambda b: b < _rank_key(df, c))), F.lit(0)).cast("long")  # noqa: B023
        for i in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, i).bitwiseAND(F.lit(1)), i * len(columns) + j))
    return place


def z_ordered(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 6) -> DataFrame:
    """Rows range-partitioned and sorted along the curve.  A hash of the row
    breaks ties, so rows that share a place, a third of them or more, are
    spread over tasks, and a retried task gets the same rows."""
    z = z_value(df, columns, bits)
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    placed = df.withColumn("__z", z).withColumn("__spread", spread)
    ranged = placed.repartitionByRange(partitions, "__z", "__spread") if partitions else placed.repartitionByRange("__z", "__spread")
    return ranged.sortWithinPartitions("__z", *columns).drop("__z", "__spread")


def write_z_ordered(df: DataFrame, name: str, columns: Sequence[str], partitions: int | None = None, bits: int = 6) -> None:
    """Store ``df`` as a table in Z-order of the columns."""
    z_ordered(df, columns, partitions, bits).write.format("parquet").mode("overwrite").saveAsTable(name)
