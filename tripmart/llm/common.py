"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.sinks.tables import materialize

__all__ = ["materialize", "let", "let_all", "words_of", "word_hashes", "runs_of", "text_slices", "columns_only", "WHITE"]

#: The white space that separates words: blank and the controls 9 to 13.
WHITE = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression that a lambda mentions is evaluated again for every array
    element; bound to a lambda variable it is evaluated once.
    """
    return F.element_at(F.transform(F.array(value), lambda bound: body(bound)), 1)


def let_all(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """As ``let`` for several values, handed to ``body`` as one struct."""
    return let(F.struct(*[v.alias(k) for k, v in values.items()]), body)


def words_of(text: Column) -> Column:
    """The words of a text as an array (NULL text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def runs_of(hashes: Column, size: int) -> Column:
    """Hashes of every run of ``size`` consecutive words; ``hashes`` must be
    bound by ``let`` (the lambda reads it for every position)."""
    whole = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)]))
    return F.slice(whole, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``most_bytes`` of text, so
    that a task's memory follows this bound and not the batch's rows.  A single
    longer text is a run of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start, len(sizes) - start)


def columns_only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that clashing extra columns cannot interfere."""
    return df.select(*[F.col(n) for n in names])
