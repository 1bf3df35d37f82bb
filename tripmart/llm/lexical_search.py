"""Ranked lexical search by the Best Position Algorithm.

A term's impact list holds the documents with the term by falling impact, the
part of a document's score that the term gives.  A document's score for an item
is the sum of its impacts in the lists of the item's terms.

The algorithm reads the lists of an item side by side from the top.  A document
met for the first time is looked up in the item's other lists at once (direct
access), which also marks the positions it holds there as seen.  The best
position of a list is the end of its run of seen positions from the top; it may
lie far below the last position that was read.  A document not yet seen lies
below the best position of every list, so the sum of the impacts at the best
positions bounds its score.  An item is done when that bound is strictly below
the k-th score, as an equal score could still win by its smaller id.

On Spark: texts are cut into terms once; the counts of the items' terms are
written as rows per document.  Document counts and lengths are two aggregates.
Then every task reads stored rows into shards of a bounded number of postings,
lays them out as flat arrays (lists by term, positions by document) and returns
the shard's k best documents of every item.  The k best of these are the
result: no posting is shuffled, and no shard depends on another.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import materialize, text_slices

#: Bytes that separate terms are blanks here, A-Z are small; bytes from 80 on (all of a character beyond ASCII) stay.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Distinct terms of the items that are searched in one pass over the documents.
MOST_TERMS = 1 << 18
#: Postings in a shard (some 60 bytes each while it is searched).
SHARD_POSTINGS = 4_000_000
#: Positions of each list read in the first round; every further round reads twice as many.
FIRST_READ = 16


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


def _count_terms(vocabulary: dict[bytes, int]):
    """Task function: (id, n, terms, tfs) with the counts of the vocabulary's terms."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            for rows in text_slices([batch], "text"):
                lengths, ends, terms, tfs = [], [0], [], []
                for text in rows.column("text").to_pylist():
                    words = terms_of(text or b"")
                    counts = Counter(words)
                    for word in counts.keys() & known:
                        terms.append(vocabulary[word])
                        tfs.append(counts[word])
                    lengths.append(len(words))
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.record_batch([
                    rows.column("id"), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], schema=schema)
    return run


class Shard:
    """Impact lists of some documents' postings, and their positions by document."""

    def __init__(self, n_terms: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        """Parallel arrays of postings; ``doc`` numbers the documents by ascending id."""
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        # Postings of each document, as positions in the lists one after the other.
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.doc_start = np.searchsorted(self.doc[self.by_doc], np.arange(int(doc.max(initial=-1)) + 2))
        self.term = term[order]
        self.seen = np.zeros(len(doc), bool)
        self.wanted = np.zeros(n_terms, bool)

    def best(self, terms: np.ndarray, k: int, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) of the k best documents with a score above 0,
        best first, and the number of positions that were read or looked up."""
        terms = terms[self.start[terms + 1] > self.start[terms]]
        top = self.start[terms]
        end = self.start[terms + 1]
        best = top.copy()                    # behind the last of the seen positions from the top
        read = top.copy()
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        touched: list[np.ndarray] = []
        met = np.empty(0, np.int64)          # all documents seen, ascending
        self.wanted[terms] = True
        depth, accesses = first_read, 0
        while len(terms):
            upto = np.minimum(read + depth, end)
            places = np.concatenate([np.arange(a, b) for a, b in zip(read, upto)])
            accesses += len(places)
            read = upto
            new = np.unique(self.doc[places])
            if len(met):
                at = np.minimum(np.searchsorted(met, new), len(met) - 1)
                new = new[met[at] != new]
            if len(new):
                # Direct accesses: all postings of the new documents, of which the item's count.
                begin, size = self.doc_start[new], self.doc_start[new + 1] - self.doc_start[new]
                owner = np.repeat(np.arange(len(new)), size)
                flat = self.by_doc[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
                of_item = self.wanted[self.term[flat]]
                flat, owner = flat[of_item], owner[of_item]
                accesses += len(flat)
                self.seen[flat] = True
                touched.append(flat)
                total = np.zeros(len(new), np.int64)
                np.add.at(total, owner, self.impact[flat])
                met = np.union1d(met, new)
                good = total > 0
                docs, scores = np.concatenate([docs, new[good]]), np.concatenate([scores, total[good]])
                if len(docs) > k:
                    keep = np.lexsort((docs, -scores))[:k]
                    docs, scores = docs[keep], scores[keep]
            for i in range(len(terms)):
                best[i] = self._first_unseen(best[i], end[i])
            left = best < end
            # The impact at the best position; nothing is left below the end of a list.
            bound = int(self.impact[np.maximum(best - 1, top)][left].sum())
            if not left.any() or (len(docs) == k and bound < scores.min()):
                break
            depth *= 2
        self.wanted[terms] = False
        for flat in touched:
            self.seen[flat] = False
        keep = np.lexsort((docs, -scores))
        return docs[keep], scores[keep], accesses

    def _first_unseen(self, at: int, end: int) -> int:
        """The first position from ``at`` that was not seen (``end``: none)."""
        step = 64
        while at < end:
            part = self.seen[at:min(at + step, end)]
            stop = int(part.argmin())
            if not part[stop]:
                return at + stop
            at += len(part)
            step *= 4
        return end


def weights(n_docs: int, with_term: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) for every term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in with_term], np.int64)


def _search_shards(items: list[tuple[int | None, np.ndarray]], weight: np.ndarray, n_docs: int, all_terms: int, k: int, shard_postings: int):
    """Task function: (item, id, score) of the k best documents of every shard."""
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def of_shard(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        order = pc.sort_indices(rows, sort_keys=[("id", "ascending")], null_placement="at_start")
        rows = rows.take(order).combine_chunks()
        lists, counts = rows.column("terms").combine_chunks(), rows.column("tfs").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        n = rows.column("n").to_numpy()
        doc = np.repeat(np.arange(len(sizes)), sizes)
        term = lists.flatten().to_numpy()
        tf = counts.flatten().to_numpy().astype(np.int64)
        m = 10 + (90 * n * n_docs) // all_terms
        shard = Shard(len(weight), doc, term, weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])))
        found = [(item, *shard.best(terms, k)[:2]) for item, terms in items]
        docs = np.concatenate([d for _, d, _ in found])
        return pa.record_batch([
            pa.array([i for i, d, _ in found for _ in range(len(d))], pa.int64()), rows.column("id").combine_chunks().take(pa.array(docs)),
            pa.array(np.concatenate([s for _, _, s in found]), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings = [], 0
        for batch in batches:
            held.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= shard_postings:
                yield of_shard(held)
                held, postings = [], 0
        if postings:
            yield of_shard(held)
    return run


def _blocks(items: DataFrame, most_terms: int) -> Iterator[dict[int | None, set[bytes]]]:
    """The items' terms, in blocks of at most ``most_terms`` terms (or one item)."""
    block: dict[int | None, set[bytes]] = {}
    size = 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        terms = set(terms_of(bytes(row["text"] or b"")))
        if block and size + len(terms) > most_terms and row["item_id"] not in block:
            yield block
            block, size = {}, 0
        block.setdefault(row["item_id"], set()).update(terms)
        size += len(terms)
    if block:
        yield block


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10, most_terms: int = MOST_TERMS,
           shard_postings: int = SHARD_POSTINGS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item.

    Items are rows of ``item_id`` and ``text``; rows with the same id, NULL
    included, are one item with the terms of them all.  Every document row is
    a document of its own, so a repeated row is ranked as often as it occurs;
    equal scores rank by ascending id, NULL first.  NULL and empty texts hold
    no terms; an item without a match gives no row, empty tables give none.
    Other columns are left out.

    Items are read in blocks, each searched against all documents in one pass;
    the driver and each task hold a block's terms and never its postings.
    """
    texts = docs.selectExpr(f"cast(`{id_col}` as bigint) as id", f"cast(`{text_col}` as binary) as text")
    questions = items.selectExpr("cast(item_id as bigint) as item_id", "cast(text as binary) as text")
    found = None
    for block in _blocks(questions, most_terms):
        part = _search_block(texts, block, k, shard_postings)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(texts: DataFrame, block: dict[int | None, set[bytes]], k: int, shard_postings: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*block.values())))}
    counted = materialize(texts.mapInArrow(_count_terms(vocabulary), "id long, n long, terms array<int>, tfs array<int>"), "terms")
    n_docs, all_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    with_term = np.zeros(len(vocabulary), np.int64)
    for term, count in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        with_term[term] = count
    items = [(i, np.array(sorted(vocabulary[t] for t in terms), np.int64)) for i, terms in block.items()]
    run = _search_shards(items, weights(n_docs, with_term), n_docs, max(all_terms, 1), k, shard_postings)
    return counted.where(F.size("terms") > 0).mapInArrow(run, "item_id long, doc_id long, score long")
