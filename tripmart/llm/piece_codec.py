"""SentencePiece encoding and decoding of merge-type (BPE) models, exactly.

A merge-type encoding is the only sequence of pieces that covers the text and
whose every two neighbours stay apart when their joined text is merged again.
So the encoder does not run the merges over the text: an Aho-Corasick automaton
finds the longest piece that begins at each position, the encoder takes it if
it agrees with the piece before it (checked by re-merging just these two), goes
on to shorter pieces otherwise, and steps back when none is left.  Positions
from which the rest could not be covered are marked in a bitfield and never
tried again, so the work stays linear in the text.

Characters without a piece become byte pieces, as in the library.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import text_slices

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
CONTROL_LIKE = {UNKNOWN, CONTROL}
#: Entries in each half of a worker's memory of encoded chunks, and in its memory of neighbours.
MEMORY = 250_000
NEIGHBOURS = 1 << 19
#: Runs of letters and runs of other characters, each with the spaces before it.
RUNS = re.compile(f"{SPACE}*(?:[^\\W\\d_¹²³]+|(?:[^\\w{SPACE}]|[\\d_¹²³])+)|{SPACE}+")
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Characters of decoded text that are handed on at once.
DECODED = 4 << 20


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.escape_whitespaces or not norm.add_dummy_prefix or kinds - {NORMAL, BYTE} - CONTROL_LIKE:
            raise ValueError("only merge-type models with plain normalisation and a leading space are supported")
        self.text_of = [p.piece for p in model.pieces]
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_id = [0] * 256
        self.byte_of = {}
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:-1], 16)
                self.byte_id[value] = i
                self.byte_of[i] = value
        if len(self.byte_of) != 256:
            raise ValueError("the model has no byte pieces")
        self.control = {i for i, p in enumerate(model.pieces) if p.type in CONTROL_LIKE}
        for i, p in enumerate(model.pieces):
            if p.type == UNKNOWN:
                self.control.discard(i)
                self.text_of[i] = model.trainer_spec.unk_surface
        #: Stands for the id of a character without a piece.
        self.other = len(self.text_of)
        #: Whether two neighbours agree, by their ids as one number; none of a character without a piece.
        self._agreed: dict[int, bool] = {}

    # What only the encoder needs is made when it is used first.

    @cached_property
    def reachable(self) -> set[str]:
        """Pieces that their own characters merge to; others can't occur in an encoding."""
        return {p for p in self.id_of if len(p) == 1 or self.merge(p) == [p]}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        # A single character always matches, as a piece or as itself.
        out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in self.reachable:
            if len(p) > 1:
                out.add_word(p)
        out.make_automaton()
        return out

    @cached_property
    def shorter(self) -> dict[str, int]:
        """Length of the longest shorter piece that a piece begins with; 0 for a single character."""
        return {p: next(n for n in range(len(p) - 1, -1, -1) if n < 2 or p[:n] in self.reachable) for p in self.reachable}

    @cached_property
    def inner_space(self) -> bool:
        return any(SPACE in p.lstrip(SPACE) for p in self.reachable)

    @cached_property
    def mixed(self) -> bool:
        """Whether a piece has a letter beside another character that isn't a space."""
        return any(len(RUNS.findall(p.strip(SPACE))) > 1 for p in self.id_of)

    def merge(self, text: str) -> list[str]:
        """The encoding by its definition: join the best-scored neighbours, the
        leftmost of equals, until none are left.  For short texts only."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agrees(self, left: str, right: str) -> bool:
        """Whether two neighbours stay apart when their joined text is merged again."""
        found = self.merge(left + right) == [left, right]
        a, b = self.id_of.get(left), self.id_of.get(right)
        if a is not None and b is not None:
            if len(self._agreed) >= NEIGHBOURS:
                self._agreed.clear()
            self._agreed[a * (self.other + 1) + b] = found
        return found

    def _covering(self, text: str) -> tuple[list[str], list[int]]:
        """Pieces of a text by longest matches and backtracking, and their ids;
        a character without a piece stands for itself and has the id ``other``."""
        n, agreed, agrees, shorter = len(text), self._agreed.get, self.agrees, self.shorter.get
        id_of, other, width = self.id_of.get, self.other, self.other + 1
        # Matches come in the order of their ends: the last that begins at a place is the longest.
        longest = {end - size + 1: size for end, size in self.automaton.iter(text)}.get
        failed = None  # the bitfield, from the first dead end on
        out: list[str] = []
        ids: list[int] = []
        pos, size = 0, longest(0, 1)
        while pos < n:
            end = pos + size
            piece = text[pos:end]
            if not (failed and failed[end >> 3] & (1 << (end & 7))):
                i = id_of(piece, other)
                good = True
                if out:
                    good = agreed(ids[-1] * width + i)
                    if good is None:
                        good = agrees(out[-1], piece)
                if good:
                    out.append(piece)
                    ids.append(i)
                    pos, size = end, longest(end, 1)
                    continue
            size = shorter(piece, 0)
            if not size:
                if not out:
                    raise ValueError("no encoding covers the text")
                failed = failed or bytearray((n >> 3) + 1)
                failed[pos >> 3] |= 1 << (pos & 7)
                size = len(out.pop())
                ids.pop()
                pos -= size
        return out, ids

    def pieces(self, text: str) -> list[str]:
        return self._covering(text)[0]

    def ids(self, text: str) -> list[int]:
        """Ids of a normalised text (blanks already replaced)."""
        pieces, out = self._covering(text)
        if self.other in out:
            out = [i for p, known in zip(pieces, out)
                   for i in ([known] if known != self.other else [self.byte_id[b] for b in p.encode()])]
        return out

    def chunks(self, text: str) -> list[str]:
        """The normalised text, cut before every run of spaces, for no piece
        crosses from another character into a space, and between letters and
        other characters, if no piece has both."""
        if not text:
            return []
        normal = SPACE + text.replace(" ", SPACE)
        if self.inner_space:
            return [normal]
        return (WORDS if self.mixed else RUNS).findall(normal)

    def encode(self, text: str) -> list[int]:
        return [i for c in self.chunks(text) for i in self.ids(c)]

    def surface(self, ids: list[int]) -> str:
        """Text of ids without the treatment of the first space."""
        out, held = [], bytearray()

        def flush() -> None:
            # every byte of an invalid sequence becomes one replacement character
            k = 0
            while k < len(held):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(bytes(held[k:k + width]).decode())
                        k += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    k += 1
            held.clear()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            flush()
            if i not in self.control:
                out.append(self.text_of[i].replace(SPACE, " "))
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.without_lead(ids, self.surface(ids))

    def without_lead(self, ids: list[int], text: str) -> str:
        """The text without the space that encoding put before it."""
        lead = next((i for i in ids if i not in self.control), None)
        return text[1:] if lead is not None and self.text_of[lead].startswith(SPACE) else text


@lru_cache(2)
def codec(model_path: str) -> PieceCodec:
    return PieceCodec(model_path)


def _encode_batches(batches: Iterator[pa.RecordBatch], model_path: str) -> Iterator[pa.RecordBatch]:
    c = codec(model_path)
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def remember(chunk: str) -> bytes:
        nonlocal known, older
        if len(known) > MEMORY:  # chunks still in use come back from the older half
            older, known = known, {}
        found = known[chunk] = older.get(chunk) or array("H" if small else "i", c.ids(chunk)).tobytes()
        return found
    small = len(c.text_of) <= 1 << 16
    for batch in text_slices(batches, "text"):
        blobs = []
        for text in batch.column("text").to_pylist():
            blobs.append(b"".join([known.get(p) or remember(p) for p in c.chunks(text or "")]))
        offsets = np.zeros(len(blobs) + 1, dtype=np.int32)
        np.cumsum([len(b) // (2 if small else 4) for b in blobs], out=offsets[1:])
        values = np.frombuffer(b"".join(blobs), dtype="<u2" if small else "<i4").astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))],
            ["id", "ids"])


def _decode_batches(batches: Iterator[pa.RecordBatch], model_path: str) -> Iterator[pa.RecordBatch]:
    c = codec(model_path)
    surface = np.array([c.surface([i]) for i in range(len(c.text_of))], dtype=object)
    is_byte = np.zeros(len(c.text_of), dtype=bool)
    is_byte[list(c.byte_of)] = True
    for batch in batches:
        texts: list[str] = []
        start = held = 0
        for ids in batch.column("ids"):
            if held > DECODED:
                yield _decoded(batch.slice(start, len(texts)), texts)
                start, held, texts = start + len(texts), 0, []
            a = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.array([], np.int32)
            parts = surface[a]
            # Bytes are put together run by run.
            at = np.flatnonzero(is_byte[a])
            if len(at):
                for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                    parts[run[0]] = c.surface(a[run].tolist())
                    parts[run[1:]] = ""
            texts.append(c.without_lead(a, "".join(parts.tolist())))
            held += len(texts[-1])
        yield _decoded(batch.slice(start), texts)


def _decoded(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ids"), pa.array(texts, pa.string())], ["id", "ids", "decoded"])


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``ids`` (array<int>) of every whole text, row by row.

    A NULL or empty text has no ids; NULL ids and repeated rows stay as rows;
    an empty table gives an empty result; other columns are not read.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    return named.mapInArrow(lambda it: _encode_batches(it, model_path), f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``id``, ``ids`` and ``decoded``: the text that the ids of ``encode`` stand for."""
    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "ids").mapInArrow(
        lambda it: _decode_batches(it, model_path), f"id {kind}, ids array<int>, decoded string")
