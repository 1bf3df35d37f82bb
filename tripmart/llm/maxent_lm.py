"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class times that of the token within
its class.  The HEAD most frequent tokens (the end of a text is one) form
classes of neighbouring frequency, and a softmax over each class's words; all
other words belong to tail classes by a hash of their last bytes, within which
they start from their smoothed relative frequency, unknown words sharing one
place.

These two softmaxes are maximum-entropy models over features of the three tokens
before: the last one, the two skips, and the hashed pair of the last two.  In
each round a slice of the training texts gives, for each feature and outcome,
how often it occurred and how often the model expects it; tasks send these sums
through a two-level shuffle, and the weights move by the difference, scaled by
the expectation.  The slices together are all training texts.

Within a tail class a third softmax has a weight for every (last word, word)
that the training texts hold, so what it learns grows with the corpus.  Its
penalty is CONTEXT_PRIOR times the divergence from the relative frequencies p;
a feature n times seen, in a context N times seen with its class, has gradient
n - N q + CONTEXT_PRIOR (p - q), and as the features of a context don't overlap,
one update makes it zero for all: the weight is log(1 + n / (CONTEXT_PRIOR p)),
the log normaliser log(1 + N / CONTEXT_PRIOR).  The counts n and N are summed in
shards of the features, hashed to BUCKETS places a token, so that buckets and
shards grow with the corpus.  Texts lie in
blocks of a bounded number of tokens; a block sends each of its features once to
its shard, with its training count, and gets the sum back.

Counts cover all training tokens.  The most frequent words' counts, bounded in
number and length, are broadcast; all others meet their counts in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import materialize, text_slices
from tripmart.llm.prob_minhash import mixed

HEAD, PER_CLASS, TAIL_CLASSES, TAIL_SYMBOLS = 256, 16, 32, 768
HEAD_CLASSES = HEAD // PER_CLASS
CLASSES = HEAD_CLASSES + TAIL_CLASSES
#: Symbols are head tokens, tail words by a hash of their last bytes, and the place before a text.
START = HEAD + TAIL_SYMBOLS
SYMBOLS = START + 1
PAIRS = 4096
#: Rows of the class weights: last token, the one before, the third last, the hashed pair.
ROWS = 3 * SYMBOLS + PAIRS
#: Rows of the word weights: last token and the one before.
WORD_ROWS = 2 * SYMBOLS
ROUNDS = 5
RATE = 0.35
PRIOR = 4.0
#: Words whose counts are broadcast, at most, and their longest length in bytes.
DICTIONARY, LONGEST = 1 << 18, 64
#: Strength of the tail words' relative frequencies against what a context has shown.
CONTEXT_PRIOR = 40.0
#: Tokens of a block of texts (a longer text is a block of its own), and tokens for each shard of features.
BLOCK_TOKENS, SHARD_TOKENS = 1 << 19, 1 << 20
#: Tokens that are scored at once.
SCORE_TOKENS = 1 << 18
#: Features are hashed to this many buckets a token, rounded up to a power of two.
BUCKETS = 128
#: Words as units: their place in the dictionary; others, from OTHER on, by their
#: tail symbol and a hash of SPREAD bits; the place before a text.
OTHER, SPREAD, START_UNIT = 1 << 31, 20, 1 << 29
#: Second parts of the features that count contexts: this and the class.
CONTEXT = 1 << 30
FLUSH = 300_000
CHUNK = 1 << 13
BLOCK = 1 << 14
NEVER = -1e30


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def tail_symbol(word: bytes) -> int:
    return HEAD + crc32(word[-3:]) % TAIL_SYMBOLS


def tail_class(symbol):
    return (symbol - HEAD) % TAIL_CLASSES


#: The class of each symbol but START.
CLASS_OF = np.concatenate([np.arange(HEAD) // PER_CLASS, HEAD_CLASSES + tail_class(np.arange(HEAD, START))])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) counted within the task, flushed at a bounded size."""
    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
    counts: Counter = Counter()
    for batch in text_slices(batches, "text"):
        for text in batch.column("text").to_pylist():
            counts.update(tokens(text))
        if len(counts) > FLUSH:
            yield table(counts)
            counts = Counter()
    yield table(counts)


@dataclass(frozen=True)
class Vocabulary:
    """What the training counts give besides the counts themselves; bounded."""

    n: int
    distinct: int
    symbol: dict[bytes, int]  # words of the dictionary
    count: np.ndarray  # by their place in the dictionary
    head_words: list[bytes | None]  # None: the end
    head_counts: np.ndarray
    tail_tokens: np.ndarray
    tail_types: np.ndarray

    @property
    def end(self) -> int:
        return self.head_words.index(None)

    def chance(self) -> np.ndarray:
        """Relative frequency within its class of each dictionary word (of head words: not used)."""
        tail = np.array([tail_class(tail_symbol(w)) for w in self.symbol], np.int64)
        head = {w for w in self.head_words if w is not None}
        return np.array([1.0 if w in head else p for w, p in zip(self.symbol, 10 ** self.tail_log(self.count, tail))])

    def base_log(self, c):
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.distinct + 1)))

    def tail_log(self, c, tail):
        return np.log10((c + 0.5) / (self.tail_tokens[tail] + 0.5 * (self.tail_types[tail] + 1)))


def planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes and so on: small or sorted numbers pack well this way."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _arrays(column, kind: str) -> list[np.ndarray]:
    """The arrays whose ``planes`` are in the column."""
    size = np.dtype(kind).itemsize
    return [np.ascontiguousarray(np.frombuffer(b.as_buffer(), np.uint8).reshape(size, -1).T).view(kind).ravel() for b in column]


@dataclass(frozen=True)
class Symbols:
    """The symbol of each place of the dictionary, and that of the end."""

    table: np.ndarray
    end: int

    @staticmethod
    def start(v: Vocabulary, place: dict[bytes | None, int]) -> Symbols:
        return Symbols(np.array([place[w] if w in place else tail_symbol(w) for w in v.symbol] or [0], np.uint16), v.end)

    def of(self, units: np.ndarray) -> np.ndarray:
        """A text's symbols, with the end."""
        out = np.empty(len(units) + 1, "<u2")
        other = units >= OTHER
        out[:-1] = np.where(other, HEAD + ((units >> SPREAD) & 1023), self.table[np.where(other, 0, units)])
        out[-1] = self.end
        return out


def other_unit(word: bytes) -> int:
    return OTHER | (tail_symbol(word) - HEAD) << SPREAD | xxhash.xxh32_intdigest(word) & ((1 << SPREAD) - 1)


def _tail_of(word: str) -> Column:
    """``tail_class(tail_symbol(word))`` as an expression."""
    ends = F.crc32(F.when(F.length(word) > 3, F.substring(word, -3, 3)).otherwise(F.col(word)))
    return F.pmod(F.pmod(ends, F.lit(TAIL_SYMBOLS)), F.lit(TAIL_CLASSES)).cast("int")


def count_words(docs: DataFrame) -> DataFrame:
    """(word, tail, n) of the words of the column ``text``."""
    return docs.select("text").mapInArrow(_count_batches, "word binary, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).select("word", _tail_of("word").alias("tail"), "n")


def vocabulary(counts: DataFrame, n_texts: int) -> tuple[Vocabulary, dict[bytes | None, int]]:
    """What the counts give, and the place of each head token.

    The dictionary holds all words from some frequency on, the lowest that
    keeps it within its bound; longer words can be frequent as well, but they
    stay in the tail.
    """
    step = F.floor(16 * F.log2(F.col("n").cast("double"))).cast("int")
    short = counts.where(F.length("word") <= LONGEST)
    sizes = {r["step"]: r["words"] for r in short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()}
    least, room = 1 << 20, DICTIONARY
    for k in sorted(sizes, reverse=True):
        room -= sizes[k]
        if room < 0:
            break
        least = k
    most = short.where(step >= least).select("word", "n")
    words = [(bytes(r["word"]), r["n"]) for r in most.toLocalIterator(prefetchPartitions=False)]
    words.sort(key=lambda x: (-x[1], x[0]))
    head = sorted([*words[:HEAD - 1], (None, n_texts)], key=lambda x: (-x[1], x[0] is not None, x[0] or b""))
    place = {w: i for i, (w, _) in enumerate(head)}
    tokens_of, types_of = np.zeros(TAIL_CLASSES, np.int64), np.zeros(TAIL_CLASSES, np.int64)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect():
        tokens_of[r["tail"]], types_of[r["tail"]] = r["n"], r["types"]
    n, distinct = int(tokens_of.sum()) + n_texts, int(types_of.sum()) + (n_texts > 0)
    for w, c in head:
        if w is not None:
            tokens_of[tail_class(tail_symbol(w))] -= c
            types_of[tail_class(tail_symbol(w))] -= 1
    return Vocabulary(n, distinct, {w: i for i, (w, _) in enumerate(words)}, np.array([c for _, c in words], np.int64),
                      [w for w, _ in head], np.array([c for _, c in head], np.int64), tokens_of, types_of), place


class _Places(dict):
    """Words' places; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def _token_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Each text's units, its block, its sums over dictionary words, and its other words."""
    v, table = shared.value
    block, held = TaskContext.get().partitionId() << 32, 0
    at = _Places(v.symbol).__getitem__
    symbols = table.table
    count = v.count if len(v.count) else np.zeros(1, np.int64)
    base = v.base_log(count)
    in_tail = symbols >= HEAD
    tail = np.where(in_tail, v.tail_log(count, tail_class(np.where(in_tail, symbols, HEAD))), 0.0)
    end_count = int(v.head_counts[v.end])
    for batch in text_slices(batches, "text"):
        out: dict[str, list] = {k: [] for k in ("block", "n_tokens", "n_known", "base", "tail", "units")}
        rest_words: list[bytes] = []
        rest_times: list[int] = []
        offsets = [0]
        for text in batch.column("text").to_pylist():
            words = tokens(text)
            where = np.fromiter(map(at, words), np.int64, len(words))
            missing = np.flatnonzero(where < 0)
            known = where
            units = where.astype("<u4")
            if held and held + len(words) > BLOCK_TOKENS:
                block, held = block + 1, 0
            held += len(words) + 1
            if len(missing):
                others = [words[i] for i in missing.tolist()]
                units[missing] = [other_unit(w) for w in others]
                known = where[where >= 0]
                times = Counter(others)
                rest_words += times
                rest_times += times.values()
            offsets.append(len(rest_words))
            out["n_tokens"].append(len(words) + 1)
            out["n_known"].append(len(known) + (end_count > 0))
            out["base"].append(float(base[known].sum() + v.base_log(end_count)))
            out["tail"].append(float(tail[known].sum()))
            out["units"].append(planes(units))
            out["block"].append(block)
        rest = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(rest_words, pa.binary()), pa.array(rest_times, pa.int64())], ["word", "times"]))
        kinds = {"block": pa.int64(), "units": pa.binary(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "tail": pa.float64()}
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("row", "id", "training")] + [pa.array(out[c], kinds[c]) for c in out] + [rest],
            ["row", "id", "training", *out, "rest"])


@dataclass
class Weights:
    """Biases and feature weights of both softmaxes."""

    class_bias: np.ndarray
    word_bias: np.ndarray
    by_class: np.ndarray
    by_word: np.ndarray

    @staticmethod
    def start(v: Vocabulary) -> Weights:
        """The smoothed unigram model; outcomes that cannot occur have no probability."""
        counts = np.zeros(HEAD)
        counts[:len(v.head_counts)] = v.head_counts
        real = (np.arange(HEAD) < len(v.head_counts)).reshape(HEAD_CLASSES, PER_CLASS)
        grid = counts.reshape(HEAD_CLASSES, PER_CLASS)
        word = np.where(real, np.log(grid + 0.5), NEVER)
        per_class = np.concatenate([(grid + 0.5 * real).sum(axis=1), v.tail_tokens + 0.5 * (v.tail_types + 1)])
        bias = np.where(per_class > 0, np.log(np.maximum(per_class, 1e-9)), NEVER)
        return Weights((bias - bias.max()).astype(np.float32), (word - word.max(axis=1, keepdims=True).clip(-1e20)).astype(np.float32),
                       np.zeros((ROWS, CLASSES), np.float32), np.zeros((WORD_ROWS * HEAD_CLASSES, PER_CLASS), np.float32))


def contexts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets, their text's number, and the rows of their four features."""
    lengths = np.array([len(t) for t in texts])
    text = np.repeat(np.arange(len(texts)), lengths)
    target = np.concatenate(texts).astype(np.int64)
    at = np.arange(len(text)) + 3 * (text + 1)
    line = np.full(len(text) + 3 * len(texts), START)
    line[at] = target
    one, two, three = line[at - 1], line[at - 2], line[at - 3]
    pair = (two * 2654435761 + one * 40503 * 65537) >> 7
    return target, text, np.stack([one, SYMBOLS + two, 2 * SYMBOLS + three, 3 * SYMBOLS + (pair & (PAIRS - 1))]).astype(np.uint16)


@dataclass(frozen=True)
class Odds:
    """Exponentials of the feature weights, those of the biases multiplied into
    the rows of the last token.  Weights move by bounded steps, so products of
    a token's rows stay in range."""

    by_class: np.ndarray
    by_word: np.ndarray

    @staticmethod
    def of(w: Weights) -> Odds:
        by_class, by_word = np.exp(w.by_class), np.exp(w.by_word)
        by_class[:SYMBOLS] *= np.exp(w.class_bias)
        by_word.reshape(WORD_ROWS, HEAD_CLASSES, PER_CLASS)[:SYMBOLS] *= np.exp(w.word_bias)
        return Odds(by_class, by_word)


def _product(table: np.ndarray, rows) -> np.ndarray:
    out = table.take(rows[0], axis=0)
    for r in rows[1:]:
        out *= table.take(r, axis=0)
    return out


def forward(odds: Odds, target: np.ndarray, rows: np.ndarray):
    """Odds of all classes, of the words in the class of each head target, the
    head targets' places, and their word-weight rows."""
    head = np.flatnonzero(target < HEAD)
    own = target[head] // PER_CLASS
    word_rows = [rows[k][head] * HEAD_CLASSES + own for k in (0, 1)]
    return _product(odds.by_class, rows), _product(odds.by_word, word_rows), head, word_rows


def _totals(odds: np.ndarray) -> np.ndarray:
    return odds @ np.ones(odds.shape[1], odds.dtype)


def chosen_logs(odds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Log probability of one outcome per row."""
    return np.log(odds[np.arange(len(which)), which].astype(np.float64) / _totals(odds))


def chances(odds: np.ndarray) -> np.ndarray:
    odds /= _totals(odds)[:, None]
    return odds


def text_log10(w: Weights, texts: list[np.ndarray]) -> np.ndarray:
    """Log10 probability of each text's symbols: classes, and words of the head."""
    target, text, rows = contexts(texts)
    odds, own, total = Odds.of(w), CLASS_OF[target], np.zeros(len(texts))
    for s in range(0, len(target), CHUNK):
        t, x, r = target[s:s + CHUNK], text[s:s + CHUNK], rows[:, s:s + CHUNK].astype(np.int64)
        classes, words, head, _ = forward(odds, t, r)
        logs = chosen_logs(classes, own[s:s + CHUNK])
        logs[head] += chosen_logs(words, t[head] % PER_CLASS)
        total += np.bincount(x, logs, len(texts))
    return total / math.log(10)


def _add_to(sums: np.ndarray, rows, values: np.ndarray) -> None:
    """Add the values to all their rows of the sums, which lie by columns."""
    for total, column in zip(sums, np.ascontiguousarray(values.T, np.float64)):
        for r in rows:
            np.add.at(total, r, column)


def _add_runs(sums: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add the values to their rows of the sums; the rows are in order."""
    ones, start = np.ones(len(rows), values.dtype), 0
    for end in [*(np.flatnonzero(np.diff(rows)) + 1).tolist(), len(rows)]:
        sums[rows[start]] += ones[start:end] @ values[start:end]
        start = end


class Sums:
    """Observed and expected counts of a slice: one flat array of all four tables."""

    SHAPES = [(ROWS, CLASSES), (ROWS, CLASSES), (WORD_ROWS * HEAD_CLASSES, PER_CLASS), (WORD_ROWS * HEAD_CLASSES, PER_CLASS)]
    SIZE = sum(a * b for a, b in SHAPES)

    def __init__(self, flat: np.ndarray | None = None):
        self.flat = np.zeros(self.SIZE, np.float32) if flat is None else flat
        parts = np.split(self.flat, np.cumsum([a * b for a, b in self.SHAPES])[:-1])
        self.seen, self.expected, self.word_seen, self.word_expected = (p.reshape(s) for p, s in zip(parts, self.SHAPES))

    def add(self, w: Weights, texts: list[np.ndarray]) -> None:
        target, _, rows = contexts(texts)
        order = np.argsort(rows[3], kind="stable")  # so that a pair's tokens are a run
        target, rows = target[order], rows[:, order]
        odds, of = Odds.of(w), CLASS_OF[target]
        expected, word_expected = np.zeros((CLASSES, 3 * SYMBOLS)), np.zeros((PER_CLASS, WORD_ROWS * HEAD_CLASSES))
        seen: list[list[np.ndarray]] = [[], []]
        for s in range(0, len(target), CHUNK):
            t, r, own = target[s:s + CHUNK], rows[:, s:s + CHUNK].astype(np.int64), of[s:s + CHUNK]
            classes, words, head, word_rows = forward(odds, t, r)
            place = t[head] % PER_CLASS
            chance = chances(classes)
            _add_to(expected, r[:3], chance)
            _add_runs(self.expected, r[3], chance)
            _add_to(word_expected, word_rows, chances(words))
            seen[0] += [(row * CLASSES + own).astype(np.int32) for row in r]
            seen[1] += [(row * PER_CLASS + place).astype(np.int32) for row in word_rows]
        self.expected[:3 * SYMBOLS] += expected.T
        self.word_expected += word_expected.T
        for found, into in zip(seen, (self.seen, self.word_seen)):
            if found:
                into += np.bincount(np.concatenate(found), minlength=into.size).reshape(into.shape)

    def step(self, w: Weights, rate: float = RATE) -> Weights:
        """The weights moved along the gradient, scaled by the expectation and the prior."""
        def moved(old, seen, expected):
            gradient = seen.astype(np.float64) - expected
            return (old + rate * np.clip(gradient / (np.sqrt(np.maximum(seen, 0) * expected) + PRIOR), -3, 3)).astype(np.float32)
        return Weights(w.class_bias, w.word_bias, moved(w.by_class, self.seen, self.expected),
                       moved(w.by_word, self.word_seen, self.word_expected))


def _sum_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The task's sums as rows (task, block, data)."""
    w, table = shared.value
    sums = None
    for batch in text_slices(batches, "units", 2 << 20):
        sums = sums or Sums()
        sums.add(w, [table.of(u) for u in _arrays(batch.column("units"), "<u4")])
    if sums is not None:
        task = TaskContext.get().partitionId()
        blocks = [sums.flat[s:s + BLOCK].tobytes() for s in range(0, Sums.SIZE, BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([task] * len(blocks), pa.int32()), pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())],
            ["task", "block", "data"])


def _add_blocks(table: pa.Table) -> pa.Table:
    """One row for a group's rows; added in a fixed order, so that results repeat."""
    table = table.sort_by("task")
    total = np.zeros(len(table["data"][0].as_py()) // 4, np.float64)
    for data in table["data"]:
        total += np.frombuffer(data.as_buffer(), np.float32)
    return pa.table({"task": table["task"].slice(0, 1), "block": table["block"].slice(0, 1),
                     "data": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def gather(slice_: DataFrame, shared) -> Sums:
    """The sums over a slice.  The tasks' sums are added in groups of about the
    square root of their number, then the groups' sums, so that no group grows
    with the input as a whole.  A slice is one of ROUNDS parts of its files, so
    as many of these go to one task, and tasks send as many fewer sums, while
    every core still has one."""
    stored = slice_.rdd.getNumPartitions()
    parts = max(1, min(stored, max(slice_.sparkSession.sparkContext.defaultParallelism, stored // ROUNDS)))
    groups = max(1, math.isqrt(parts))
    schema = "task int, block int, data binary"
    sent = slice_.coalesce(parts).mapInArrow(lambda it: _sum_batches(it, shared), schema)
    first = sent.withColumn("part", F.pmod("task", F.lit(groups))).groupBy("block", "part") \
        .applyInArrow(lambda t: _add_blocks(t.select(["task", "block", "data"])), schema)
    flat = np.zeros(Sums.SIZE, np.float32)
    for r in first.groupBy("block").applyInArrow(_add_blocks, schema).collect():
        data = np.frombuffer(bytes(r["data"]), np.float32)
        flat[r["block"] * BLOCK:r["block"] * BLOCK + len(data)] = data
    return Sums(flat)


@dataclass(frozen=True)
class Tail:
    """A block's tail tokens: their text's number and their unit; the distinct
    features, and the places there of each token's pair and context."""

    text: np.ndarray
    unit: np.ndarray
    known: np.ndarray  # where the word is in the dictionary, so that its pair has a weight
    found: np.ndarray
    pair: np.ndarray  # of the known ones
    context: np.ndarray

    def features(self) -> np.ndarray:
        """All distinct features, ascending."""
        return self.found


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values (unsigned 64-bit), ascending, and the place there of each value.

    Where a value and its position fit into 64 bits together, these numbers are
    sorted, which is several times faster than sorting the positions by value.
    """
    room = len(values).bit_length()
    if not len(values) or int(values.max()).bit_length() + room > 64:
        return np.unique(values, return_inverse=True)
    ordered = np.sort(values << np.uint64(room) | np.arange(len(values), dtype=np.uint64))
    order = (ordered & np.uint64((1 << room) - 1)).astype(np.int64)
    ordered >>= np.uint64(room)
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    place = np.empty(len(ordered), np.int64)
    place[order] = np.cumsum(first) - 1
    return ordered[first], place


def tail_tokens_of(symbols: list[np.ndarray], units: list[np.ndarray], bits: int = 64) -> Tail:
    """The tail tokens of texts (symbols with the end, units without); features are hashes of ``bits`` bits."""
    lengths = np.array([len(u) for u in units], np.int64)
    text = np.repeat(np.arange(len(units)), lengths)
    unit = np.concatenate(units).astype(np.uint64)
    symbol = np.concatenate([s[:-1] for s in symbols]).astype(np.int64)
    last = np.empty_like(unit)
    last[1:] = unit[:-1]
    last[(np.cumsum(lengths) - lengths)[lengths > 0]] = START_UNIT
    tail = np.flatnonzero(symbol >= HEAD)
    text, unit, last = text[tail], unit[tail], last[tail] << np.uint64(32)
    known = np.flatnonzero(unit < OTHER)
    contexts_ = last | (CONTEXT - HEAD_CLASSES + CLASS_OF[symbol[tail]]).astype(np.uint64)
    found, place = ranked(mixed(np.concatenate([(last | unit)[known], contexts_])) >> np.uint64(64 - bits))
    return Tail(text, unit, known, found, place[:len(known)], place[len(known):])


def feature_bits(tokens: int) -> int:
    return min(64, max(1, BUCKETS * tokens - 1).bit_length())


def _shard_bounds(shards: int, bits: int) -> np.ndarray:
    """The first feature of each shard but the first."""
    return np.array([(k << bits) // shards for k in range(1, shards)], np.uint64)


def _features_of_block(table: pa.Table, shards: int, symbols: Symbols, bits: int) -> pa.Table:
    """(shard, block, features, counts): a block's distinct features and their counts in its training texts."""
    units = _arrays(table["units"], "<u4")
    tail = tail_tokens_of([symbols.of(u) for u in units], units, bits)
    found = tail.features()
    training = table["training"].to_numpy()[tail.text]
    seen = np.concatenate([tail.pair[training[tail.known]], tail.context[training]])
    counts = np.bincount(seen, minlength=len(found)).astype("<u4")
    cuts = [0, *np.searchsorted(found, _shard_bounds(shards, bits)).tolist(), len(found)]
    full = [k for k in range(shards) if cuts[k] < cuts[k + 1]]
    return pa.table({
        "shard": pa.array(full, pa.int64()), "block": pa.array([table["block"][0].as_py()] * len(full), pa.int64()),
        "features": pa.array([planes(found[cuts[k]:cuts[k + 1]]) for k in full], pa.binary()),
        "counts": pa.array([planes(counts[cuts[k]:cuts[k + 1]]) for k in full], pa.binary())})


def _sum_shard(table: pa.Table) -> pa.Table:
    """(block, shard, totals): the sums over all blocks, in the order of each block's features."""
    features, counts = _arrays(table["features"], "<u8"), _arrays(table["counts"], "<u4")
    _, at = ranked(np.concatenate(features))
    totals = np.bincount(at, np.concatenate(counts))[at].astype("<u8")
    ends = np.cumsum([len(f) for f in features])
    return pa.table({"block": table["block"], "shard": table["shard"],
                     "totals": pa.array([planes(t) for t in np.split(totals, ends[:-1])], pa.binary())})


def tail_log10(tail: Tail, found: np.ndarray, totals: np.ndarray, chance: np.ndarray, texts: int,
               prior: float = CONTEXT_PRIOR) -> np.ndarray:
    """For each text, what its tail words' contexts add to their relative frequencies' log10,
    given the totals of the tail's features, ``found``."""
    if len(totals) != len(found):
        raise ValueError(f"{len(totals)} totals of {len(found)} features")
    logs = -np.log1p(totals[tail.context] / prior)
    logs[tail.known] += np.log1p(totals[tail.pair] / (prior * chance[tail.unit[tail.known].astype(np.int64)]))
    return np.bincount(tail.text, logs, texts) / math.log(10)


SCORED = ["row", "id", "training", "n_tokens", "n_known", "base", "tail"]


def _score_block(table: pa.Table, sums: pa.Table, shared, prior: float, bits: int) -> pa.Table:
    """The scores of a block's texts, given its features' sums."""
    w, chance, of = shared.value
    units = _arrays(table["units"], "<u4")
    symbols = [of.of(u) for u in units]
    tail = tail_tokens_of(symbols, units, bits)
    totals = _arrays(sums.sort_by("shard")["totals"], "<u8")
    model = tail_log10(tail, tail.features(), np.concatenate(totals) if totals else np.zeros(0), chance, len(symbols), prior)
    del tail, totals, units
    start, held = 0, 0
    for i, s in enumerate([*symbols, None]):
        if s is None or held + len(s) > SCORE_TOKENS and i > start:
            model[start:i] += text_log10(w, symbols[start:i])
            start, held = i, 0
        held += 0 if s is None else len(s)
    return table.select(SCORED).append_column("model", pa.array(model))


def train_and_score(spark: SparkSession, docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS, prior: float = CONTEXT_PRIOR) -> DataFrame:
    """(id, training, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``training`` says which rows the model learns from (NULL: not).  A NULL text
    is empty: its one token is the end.  NULL ids and repeated rows are texts
    like others.  The rounds' slices are dealt by ids and contents, so scores do not
    depend on how the rows are stored, but for the rounding of sums.  Without training texts both models know no words and every
    token has the one probability left.  Other columns are not read.
    """
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.coalesce(training, F.lit(False)).alias("training"))
    learned = named.where("training")
    counts = materialize(count_words(learned), "counts")
    v, place = vocabulary(counts, learned.count())
    symbols = Symbols.start(v, place)
    words = spark.sparkContext.broadcast((v, symbols))
    kind = dict(named.dtypes)["id"]
    texts = materialize(named.mapInArrow(
        lambda it: _token_batches(it, words),
        f"row long, id {kind}, training boolean, block long, n_tokens long, n_known long, base double, tail double, units binary, "
        "rest array<struct<word: binary, times: long>>"), "tokens")
    w = Weights.start(v)
    for k in range(rounds if v.n else 0):
        slice_ = texts.where(F.col("training") & (F.pmod(F.xxhash64("id", "units"), F.lit(rounds)) == k)).select("units")
        shared = spark.sparkContext.broadcast((w, symbols))
        w = gather(slice_, shared).step(w)
        shared.unpersist()
    blocks = texts.select(*SCORED, "block", "units")  # both uses read one shuffle by block
    shared = spark.sparkContext.broadcast((w, v.chance(), symbols))
    n = texts.agg(F.sum("n_tokens")).first()[0] or 0
    bits = feature_bits(n)
    scored = blocks.groupBy("block").cogroup(_feature_sums(blocks, words, n, bits).groupBy("block")).applyInArrow(
        lambda table, found: _score_block(table, found, shared, prior, bits),
        f"row long, id {kind}, training boolean, n_tokens long, n_known long, base double, tail double, model double")
    others = _other_words(texts, counts, v)
    return scored.join(others, "row", "left").select(
        "id", "training", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(v.n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.col("tail") + F.coalesce("more_tail", F.lit(0.0))).alias("score"))


def _feature_sums(texts: DataFrame, words, n: int, bits: int) -> DataFrame:
    """(block, shard, totals) of the features of all blocks, for ``n`` tokens."""
    shards = max(1, -(-n // SHARD_TOKENS))
    sent = texts.groupBy("block").applyInArrow(
        lambda table: _features_of_block(table, shards, words.value[1], bits), "shard long, block long, features binary, counts binary")
    return sent.groupBy("shard").applyInArrow(_sum_shard, "block long, shard long, totals binary")


def _other_words(texts: DataFrame, counts: DataFrame, v: Vocabulary) -> DataFrame:
    """Each row's sums over the words that are not in the broadcast dictionary."""
    used = texts.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.times")
    joined = used.join(counts.select("word", "n"), "word", "left").withColumn("tail", _tail_of("word"))
    c = F.coalesce("n", F.lit(0)) + 0.5
    room = F.array(*[F.lit(float(t + 0.5 * (k + 1))) for t, k in zip(v.tail_tokens.tolist(), v.tail_types.tolist())])
    whole = float(v.n + 0.5 * (v.distinct + 1))
    return joined.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(c / whole)).alias("more_base"),
        F.sum(F.col("times") * F.log10(c / F.get(room, F.col("tail")))).alias("more_tail"))
