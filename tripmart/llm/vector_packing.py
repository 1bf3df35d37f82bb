"""Packing of tokenised examples into sequences as vector bin packing.

Every example is a vector (tokens, segments, loss-bearing tokens) and every
sequence a bin with one limit for each of the three.  Bins are filled one
after another: of the examples that fit, the one with the largest weighted dot
product with the bin's remaining room goes in.  The weights are the share of
the limits that the group's examples need altogether, so the scarce limit
counts most.

Whole stretches of ``max_tokens`` are sequences of their own; only the rest of
an example is a vector to be packed.  Rests are dealt to groups of about
``GROUP_ROWS`` by a hash of their identity, so a task holds one bounded group
of small rows whatever the input's size, and a group of copies is dealt out
like any other rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import materialize, text_slices

GROUP_ROWS = 8192
#: The byte-level pattern that cuts a text before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space in a row from which a text goes to the tokenizer itself.
LONG_RUN = 50_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")
PIECES = ("start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, part int")
OUT = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segment"]


@lru_cache(2)
def _tokenizers(json_path: str, ranks_path: str | None):
    """The tokenizer, and the faster encoder of the same vocabulary's ranks if there is one."""
    from tokenizers import Tokenizer
    fast = None
    if ranks_path:
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(json_path), fast


def _token_pieces(batches: Iterator[pa.RecordBatch], json_path: str, ranks_path: str | None, max_tokens: int,
                  end_id: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, start, length, ids_crc32, doc_tokens, loss_tokens, part) of each text."""
    tok, fast = _tokenizers(json_path, ranks_path)
    # Only the tokenizer knows what its added tokens' strings in a text mean, and
    # only it takes any run of white space: the other's pattern goes back over it and fails on a long one.
    special = [t.content for t in tok.get_added_tokens_decoder().values()]

    def ids_of(text: str) -> list[int]:
        if fast is None or any(s in text for s in special) or (len(text) >= LONG_RUN and _LONG_SPACE.search(text)):
            return tok.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    for batch in text_slices(batches, "text"):
        rows: dict[str, list] = {k: [] for k in ("row", "start", "length", "crc", "tokens", "part")}
        for i, text in enumerate(batch.column("text").to_pylist()):
            ids = ids_of(text or "")
            ids.append(end_id)
            blob = array("I", ids).tobytes()
            for part, start in enumerate(range(0, len(ids), max_tokens)):
                piece = blob[4 * start:4 * (start + max_tokens)]
                rows["row"].append(i)
                rows["start"].append(start)
                rows["length"].append(len(piece) // 4)
                rows["crc"].append(zlib.crc32(piece))
                rows["tokens"].append(len(ids))
                rows["part"].append(part)
        at = pa.array(rows["row"], pa.int64())
        long = {k: pa.array(rows[k], pa.int64()) for k in ("start", "length", "crc", "tokens")}
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(at), long["start"], long["length"], long["crc"], long["tokens"], long["length"],
             pa.array(rows["part"], pa.int32())],
            ["id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "part"])


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, max_tokens: int = 1024, end_id: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's token ids (and ``end_id``) cut into pieces of ``max_tokens``.

    ``ranks_path`` may name the same vocabulary as byte ranks with the
    byte-level pattern; it gives the same ids in a fraction of the time.

    A NULL or empty text is the one piece [end_id]; NULL ids and repeated rows
    are examples like any others; other columns are not read.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    return named.mapInArrow(lambda it: _token_pieces(it, tokenizer_path, ranks_path, max_tokens, end_id), f"id {kind}, {PIECES}")


def fill_bins(vectors: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and place within the bin of every vector.

    Equal vectors are interchangeable, so the heuristic chooses among distinct
    vectors.  Ties go to the first in descending order.  A vector that exceeds
    a limit on its own gets a bin of its own.
    """
    n = len(vectors)
    bins, places = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # What fills a limit on its own shares a bin with nothing.
    alone = np.flatnonzero((vectors >= limits).any(axis=1))
    bins[alone] = np.arange(len(alone))
    others = np.flatnonzero(~(vectors >= limits).any(axis=1))
    if not len(others):
        return bins, places
    kinds, which = np.unique(-vectors[others], axis=0, return_inverse=True)
    kinds, which = -kinds, which.ravel()
    order = others[np.argsort(which, kind="stable")]
    left = np.bincount(which, minlength=len(kinds))
    upto = np.cumsum(left)
    share = kinds / limits
    need = (share * left[:, None]).sum(axis=0)
    weighted = share * (need / need.sum())
    bin_no, room, place = len(alone), limits.astype(float), 0
    for _ in range(len(others)):
        while True:
            fits = (kinds <= room).all(axis=1)
            gain = np.where(fits, weighted @ (room / limits), -1.0)
            k = int(gain.argmax())
            if gain[k] >= 0:
                break
            bin_no, room, place = bin_no + 1, limits.astype(float), 0
        left[k] -= 1
        upto[k] -= 1
        bins[order[upto[k]]], places[order[upto[k]]] = bin_no, place
        room, place = room - kinds[k], place + 1
        if not left[k]:
            kinds, left, upto, weighted = (np.delete(x, k, axis=0) for x in (kinds, left, upto, weighted))
    return bins, places


def _pack_group(rows: pa.Table, limits: tuple[int, int, int]) -> pa.Table:
    """One group's pieces with their places; Arrow keeps NULL ids and large ids as they are."""
    rows = rows.sort_by([("length", "descending"), ("loss_tokens", "descending"), ("id", "ascending"),
                         ("start", "ascending"), ("ids_crc32", "ascending")])
    length, group = (rows[c].to_numpy() for c in ("length", "grp"))
    vectors = np.column_stack([length, np.ones(len(length), np.int64), rows["loss_tokens"].to_numpy()])
    bins, places = fill_bins(vectors, np.array(limits, dtype=float))
    order = np.lexsort((places, bins))
    ends = np.cumsum(length[order])
    starts = ends - length[order]
    first = np.flatnonzero(places[order] == 0)
    offset = np.empty_like(starts)
    offset[order] = starts - np.repeat(starts[first], np.diff(np.append(first, len(order))))
    for name, values in (("sequence_id", (group << 32) + bins), ("offset", offset), ("segment", places)):
        rows = rows.append_column(name, pa.array(values, pa.int64()))
    return rows.select(OUT)


def pack(spark: SparkSession, pieces: DataFrame, max_tokens: int = 1024, max_segments: int = 256,
         max_loss_tokens: int = 1024, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Place every piece: adds ``sequence_id``, ``offset`` and ``segment``.

    ``pieces`` needs id, start, length, ids_crc32, doc_tokens and loss_tokens.
    The placed frame has the same rows.  A piece over a limit on its own is a
    sequence of its own.  The number of groups follows the number of pieces.
    """
    pieces = materialize(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_rows))
    keys = [c for c in ("id", "start", "ids_crc32", "length", "part") if c in pieces.columns]
    # Repeated rows have equal keys; the row's place in its file tells them apart.
    salt = F.monotonically_increasing_id()
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(*keys, salt), F.lit(groups)).cast("long"))
    kind = dict(pieces.dtypes)["id"]
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in OUT[1:])
    limits = (max_tokens, max_segments, max_loss_tokens)
    return dealt.groupBy("grp").applyInArrow(lambda rows: _pack_group(rows, limits), schema)
