"""Which partitions a batch's keys can be in: bitmaps of the keys of every partition.

The index of a partitioned table is a table beside it, ``<table>__keys``: for
each partition (as text) and each block of 32,768 places a bitmap of the places
that its keys take.  A single whole-number key has its own value as its place,
so numbers given out in order fill few blocks of few partitions; other keys are
hashed to one of ``HASHED_PLACES``.  A key that is in the table always has its
bit, so a partition without any of a batch's bits holds none of its keys and
need not be read.  Equal bits do not make equal keys: the merge compares the
keys of the partitions that are left.

A batch's bitmaps are appended before its rows are, so a run that fails in
between leaves too many bits and never too few.  The index prunes where keys
and partitions go together (running numbers, times); hashed keys spread over
all partitions, and a large batch of them reaches most.

``Seen`` is the same for one run of a stream, on the driver: which keys the
target holds, so that a batch without any of them need not read it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, IntegralType, StringType, StructField, StructType, TimestampNTZType, TimestampType

#: Places of a bitmap (a fixed value of the bitmap functions).
PLACES = 32_768
#: Places of keys that are no single whole number.
HASHED_PLACES = 1 << 26


def name_of(table: str) -> str:
    return f"{table}__keys"


def _spot(df: DataFrame, keys: Sequence[str]) -> Column:
    """A key's place, NULL for keys that match nothing (a NULL in any column)."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, IntegralType):
        return F.col(keys[0]).cast("long")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return F.when(known, F.pmod(F.xxhash64(*keys), F.lit(HASHED_PLACES)))


def _block(spot: Column) -> tuple[Column, Column]:
    place = F.pmod(spot, F.lit(PLACES))
    return ((spot - place) / PLACES).cast("long"), place


def bitmaps(rows: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """(part, block, map) of the rows' keys."""
    block, place = _block(F.col("spot"))
    return (rows.select(F.col(part).cast("string").alias("part"), _spot(rows, keys).alias("spot")).where(F.col("spot").isNotNull())
            .groupBy("part", block.alias("block")).agg(F.bitmap_construct_agg(place).alias("map")))


def compacted(index: DataFrame) -> DataFrame:
    """One bitmap for each partition and block."""
    return index.groupBy("part", "block").agg(F.bitmap_or_agg("map").alias("map"))


def partitions_with(index: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(part): the partitions that can hold one of the batch's keys."""
    block, place = _block(F.col("spot"))
    wanted = (batch.select(_spot(batch, keys).alias("spot")).where(F.col("spot").isNotNull())
              .select(block.alias("block"), place.cast("int").alias("place")).distinct())
    byte = F.conv(F.hex(F.substring(F.col("map"), F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return index.join(wanted, "block").where(F.getbit(byte, F.col("place") % 8) == 1).select("part").distinct()


# --- the keys that a run has seen ------------------------------------------------

#: Words of 64 places that are kept at most (64 MB): 268 million running numbers, or 4 million scattered keys.
MOST_WORDS = 1 << 22

#: Key types of which equal values have equal hashes.
_HASHED_ALIKE = (IntegralType, BooleanType, DateType, TimestampType, TimestampNTZType, BinaryType)

#: A frame's places: the words that have some, ascending, and the bits in each.
Words = tuple[np.ndarray, np.ndarray]


def _hashes_alike(have: StructField, stored: StructField) -> bool:
    plain = isinstance(have.dataType, _HASHED_ALIKE) or have.dataType == StringType()
    return plain and have.dataType == stored.dataType and not (have.metadata or stored.metadata)


class Seen:
    """The keys of a merge's target during one run, which is its only writer:
    each key has a place, a single whole number its own value, other keys their
    64-bit hash.  A key that the target holds always has its bit here, so a
    batch without any of the bits is new as a whole; one with some of them has
    to be compared.  Memory is bounded: beyond ``MOST_WORDS`` nothing is known
    any more, and every batch has to be compared."""

    def __init__(self, keys: Sequence[str]):
        self.keys, self.full = list(keys), False
        self.words, self.bits = np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def can_tell(rows: StructType, target: StructType, keys: Sequence[str]) -> bool:
        """Whether keys that a join finds equal have the same place."""
        if len(keys) == 1 and all(isinstance(s[keys[0]].dataType, IntegralType) for s in (rows, target)):
            return True
        return all(_hashes_alike(rows[k], target[k]) for k in keys)

    def places(self, rows: DataFrame) -> Words | None:
        """The places of the rows' keys; None if they are more than are kept."""
        if self.full:
            return None
        if len(self.keys) == 1 and isinstance(rows.schema[self.keys[0]].dataType, IntegralType):
            spot, known = F.col(self.keys[0]).cast("long"), F.col(self.keys[0]).isNotNull()
        else:
            spot, known = F.xxhash64(*self.keys), F.lit(True)
            for k in self.keys:
                known = known & F.col(k).isNotNull()
        found = (rows.where(known).select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).alias("word"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63L as int)))").alias("bits")).limit(MOST_WORDS + 1).toArrow())
        if found.num_rows > MOST_WORDS:
            return None
        words, bits = found["word"].to_numpy(), found["bits"].to_numpy()
        order = np.argsort(words)
        return words[order], bits[order]

    def _met(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words are or would be, and which of them are there."""
        at = np.searchsorted(self.words, words)
        there = at < len(self.words)
        there[there] = self.words[at[there]] == words[there]
        return at, there

    def holds_some(self, places: Words | None) -> bool:
        """Whether the target may hold one of these keys."""
        if self.full or places is None:
            return True
        at, there = self._met(places[0])
        return bool((self.bits[at[there]] & places[1][there]).any())

    def add(self, places: Words | None) -> None:
        """The target holds these keys now."""
        if self.full:
            return
        if places is not None:
            words, bits = places
            at, there = self._met(words)
            self.bits[at[there]] |= bits[there]
            self.words = np.insert(self.words, at[~there], words[~there])
            self.bits = np.insert(self.bits, at[~there], bits[~there])
        if places is None or len(self.words) > MOST_WORDS:
            self.full = True
            self.words, self.bits = np.empty(0, np.int64), np.empty(0, np.int64)
