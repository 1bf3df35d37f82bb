"""Prefix trie of conversations in minimal-perfect-hash node tables.

Every conversation is a path of turns.  A node is a distinct prefix, named by
a digest that is chained along the path, so equal prefixes have equal digests
whatever conversation they come from.  The distinct digests are enumerated by
one aggregate, which also counts their members.

Nodes are dealt to shards by subtrees.  A shard builds a minimal perfect hash
of its digests: level by level, digests that hash to a place of their own get
it, the others go on to the next level; the places are numbered without gaps.
The digest stored in a slot verifies every look-up, so neither a collision nor
a foreign digest is taken for a node.  Counts are scattered into flat arrays by
slot, parents become an array of slots, and children, leaves and savings are
accumulated through it, the deepest nodes first.

Nodes of many members (``heavy_from``: at least the square root of the number
of turns) are the top of the trie; a subtree below them has few members and
lies whole in one shard.  There are at most (number of turns) / ``heavy_from``
heavy nodes, so they are small enough to be one last shard, which takes the
sums of the subtrees below it.  So a first turn that a third of all
conversations share is a row of the top and not a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import materialize

#: The root's digest.
ROOT = b"\0" * 16
#: Nodes in a shard, about.
SHARD_NODES = 1 << 15
#: The least number of members of a heavy node.
LEAST_HEAVY = 256
#: Conversation ids that are joined to one text before the ends of a node meet.
ID_BLOCK = 1024
#: Bits of a level of the hash for each digest still without a place.
ROOM = 2.0


class PerfectHash:
    """A minimal perfect hash of distinct 16-byte digests, with verified slots."""

    def __init__(self, digests: np.ndarray):
        """``digests``: rows of two unsigned 64-bit halves, all different."""
        self.levels: list[np.ndarray] = []      # places taken, as numbers of the slots; -1: none
        slots = np.full(len(digests), -1, np.int64)
        rest, given = np.arange(len(digests)), 0
        while len(rest):
            size = max(int(ROOM * len(rest)), 8)
            place = self._place(digests[rest], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            number = np.full(size, -1, np.int64)
            number[alone] = given + np.arange(int(alone.sum()))
            self.levels.append(number)
            slots[rest] = number[place]
            given += int(alone.sum())
            left = rest[slots[rest] < 0]
            if len(left) == len(rest) and len(self.levels) > 200:
                raise ValueError("equal digests")
            rest = left
        self.slots = slots
        self.table = np.empty_like(digests)
        self.table[slots] = digests
        # Every slot is taken once and holds the digest that asked for it.
        if given != len(digests) or not (self.table[slots] == digests).all():
            raise ValueError("slots collide")

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) % (1 << 64))
        mixed = (digests[:, 0] ^ salt) * np.uint64(0xBF58476D1CE4E5B9) + digests[:, 1]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slots of digests; -1 for those that aren't in the table."""
        slots = np.full(len(digests), -1, np.int64)
        rest = np.arange(len(digests))
        for level, number in enumerate(self.levels):
            at = number[self._place(digests[rest], level, len(number))]
            slots[rest] = at
            rest = rest[at < 0]
        known = slots >= 0
        known[known] = (self.table[slots[known]] == digests[known]).all(axis=1)
        return np.where(known, slots, -1)


def _halves(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of 16-byte digests as rows of two unsigned 64-bit halves."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint64).reshape(-1, 2)


_SUMS = ["n_children", "n_leaves", "saved_tokens"]
_SHARD_SCHEMA = ("digest binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
                 "n_children long, n_leaves long, saved_tokens long")


def accumulate(rows: pa.Table) -> pa.Table:
    """One shard: nodes with their members, last text's bytes and what comes
    from subtrees outside the shard; returns their sums over the subtree."""
    digests, parents = _halves(rows["digest"]), _halves(rows["parent"])
    names = PerfectHash(digests)
    n, slots = len(digests), names.slots

    def by_slot(values: np.ndarray) -> np.ndarray:
        out = np.empty(n, values.dtype)
        out[slots] = values
        return out

    depth, members = by_slot(rows["depth"].to_numpy()), by_slot(rows["n_convs"].to_numpy())
    parent = by_slot(names.find(parents))
    parent[depth == 0] = -1
    children, leaves, saved = (by_slot(rows[c].to_numpy()) for c in _SUMS)
    saved = saved + (members - 1) * by_slot(rows["bytes"].to_numpy())
    inside = parent >= 0
    np.add.at(children, parent[inside], 1)
    leaves = leaves + (children == 0)
    order = np.argsort(-depth, kind="stable")
    order = order[inside[order]]
    for part in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        np.add.at(leaves, parent[part], leaves[part])
        np.add.at(saved, parent[part], saved[part])
    first = by_slot(rows["conv_id"].to_numpy())
    over = np.where(inside, first[parent], 0)[slots]
    out = {"n_children": children, "n_leaves": leaves, "saved_tokens": saved}
    return pa.table([
        rows["digest"], rows["parent"], rows["depth"], rows["conv_id"], pa.array(over, pa.int64(), mask=~inside[slots]), rows["n_convs"],
        *[pa.array(out[c][slots], pa.int64()) for c in _SUMS]],
        names=["digest", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", *_SUMS])


def own_head(conv_id: Column) -> Column:
    """How many first turns a conversation takes from its group's first: the crc32 of the decimal id, modulo 9."""
    return (F.crc32(conv_id.cast("string")) % 9).cast("long")


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, digest, bytes): the turns by ``turn``, NULL first, equal
    turns by the digest of their role and text; NULL roles and texts are empty.
    Only digests and lengths of the texts go on.  Rows without an id belong to
    no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    long = lambda c: F.octet_length(c).cast("string")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.sha2(F.concat(long(role), F.lit(":"), role, long(text), F.lit(":"), text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    place = F.expr("row_number() over (partition by conv_id order by turn asc nulls first, digest)")
    return turns.select("conv_id", place.cast("long").alias("i"), F.unhex("digest").alias("digest"), "bytes")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, own, i, digest, bytes): every conversation's first turns from
    its group's first one (id - id % 5), then its own later ones; a
    conversation without a turn is a row without a digest."""
    turns = materialize(numbered(conversations), "turns")
    head = own_head(F.col("conv_id"))
    # A conversation has at most 8 turns of another, and these are at most five conversations' heads.
    ids = turns.where("i = 1").select("conv_id", head.alias("head"))
    heads = turns.where("i <= 8").select(F.col("conv_id").alias("first"), "i", "digest", "bytes")
    lent = (ids.withColumn("first", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "first").where(F.col("i") <= F.col("head"))
            .select("conv_id", F.lit(False).alias("own"), "i", "digest", "bytes"))
    own = turns.where(F.col("i") > head).select("conv_id", F.lit(True).alias("own"), "i", "digest", "bytes")
    none = F.lit(None)
    start = ids.select("conv_id", F.lit(False).alias("own"), F.lit(0).cast("long").alias("i"), none.cast("binary").alias("digest"),
                       F.lit(0).cast("long").alias("bytes"))
    return start.unionByName(lent).unionByName(own)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and turn to prefixes: the digest chained
    over the path, the one before, the depth, and the path's length in the
    last row.  Holds one batch, whatever a conversation's length."""
    now, prefix, depth = None, ROOT, 0
    for batch in batches:
        ids, turns = batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist()
        digests, parents, depths = [], [], []
        for conv, turn in zip(ids, turns):
            if conv != now:
                now, prefix, depth = conv, ROOT, 0
            parents.append(prefix)
            if turn is not None:
                prefix, depth = hashlib.blake2b(prefix + turn, digest_size=16).digest(), depth + 1
            digests.append(prefix)
            depths.append(depth)
        yield pa.record_batch([batch.column("conv_id"), pa.array(depths, pa.int64()), pa.array(digests, pa.binary()),
                               pa.array(parents, pa.binary()), batch.column("bytes")],
                              names=["conv_id", "depth", "digest", "parent", "bytes"])


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, parent, bytes) of every prefix of every conversation, the root included."""
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "own", "i")
            .mapInArrow(_chain, "conv_id long, depth long, digest binary, parent binary, bytes long"))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, ends_sha256) of texts in order of digest and block, joined by commas."""
    now, state = None, None
    for batch in batches:
        done, sums = [], []
        for digest, text in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist()):
            if digest != now:
                if now is not None:
                    done.append(now)
                    sums.append(state.hexdigest())
                now, state = digest, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.record_batch([pa.array(done, pa.binary()), pa.array(sums, pa.string())], names=["digest", "ends_sha256"])
    if now is not None:
        yield pa.record_batch([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["digest", "ends_sha256"])


def ends(paths: DataFrame) -> DataFrame:
    """(digest, ends_sha256): the digest of the ids of the conversations that
    end in a node, ascending.  Ids meet in blocks of ``ID_BLOCK`` numbers first,
    so a node's last step reads a text for each block and holds one."""
    last = paths.groupBy("conv_id").agg(F.max_by("digest", "depth").alias("digest"))
    blocks = (last.groupBy("digest", F.floor(F.col("conv_id") / ID_BLOCK).alias("block"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    return (blocks.repartition("digest").sortWithinPartitions("digest", "block").select("digest", "ids")
            .mapInArrow(_hash_ends, "digest binary, ends_sha256 string"))


def nodes(spark: SparkSession, turns: DataFrame, heavy_from: int | None = None, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The trie of ``rebuilt`` conversations: conv_id (the smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 of every node.

    No conversation, no node, not even a root.  Repeated rows are turns like
    others.  A shard holds about ``shard_nodes`` nodes, or one subtree of fewer
    than ``heavy_from`` conversations, at some 150 bytes a node; no text.
    """
    paths = materialize(prefixes(turns), "prefixes")
    least = heavy_from or max(LEAST_HEAVY, int(paths.count() ** 0.5))
    zero = F.lit(0).cast("long")
    found = materialize(paths.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("parent").alias("parent"),
        F.first("depth").alias("depth"), F.first("bytes").alias("bytes")), "nodes")
    # At most (number of prefixes) / least rows.
    heavy = found.where(F.col("n_convs") >= least)
    light = found.where(F.col("n_convs") < least)
    # The top of a conversation's light part, by which its subtree's nodes come together.
    names = F.broadcast(heavy.select("digest"))
    tops = paths.join(names, "digest", "left_anti").groupBy("conv_id").agg(F.min_by("digest", "depth").alias("top"))
    shards = max(1, -(-found.count() // shard_nodes))
    below = materialize(
        light.join(tops, "conv_id").withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(shards)))
        .select("shard", "digest", "parent", "depth", "conv_id", "n_convs", "bytes", *[zero.alias(c) for c in _SUMS])
        .groupBy("shard").applyInArrow(accumulate, _SHARD_SCHEMA), "subtrees")
    # Subtrees right below a heavy node hand their sums on to it.
    up = below.where(F.col("parent_conv_id").isNull()).groupBy(F.col("parent").alias("digest")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    top = materialize(
        heavy.join(up, "digest", "left").select(
            zero.alias("shard"), "digest", "parent", "depth", "conv_id", "n_convs", "bytes",
            *[F.coalesce(c, zero).alias(c) for c in _SUMS])
        .groupBy("shard").applyInArrow(accumulate, _SHARD_SCHEMA), "top")
    over = F.broadcast(top.select(F.col("digest").alias("parent"), F.col("conv_id").alias("over")))
    known = below.join(over, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.when(F.col("depth") > 0, F.col("over"))))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", *_SUMS]
    every = known.select("digest", *columns).unionByName(top.select("digest", *columns))
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return every.join(ends(paths), "digest", "left").select(*columns, F.coalesce("ends_sha256", nobody).alias("ends_sha256"))

