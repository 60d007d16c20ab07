r"""Ranked lexical search: the best documents for every item, by a Best Position Algorithm.

Terms are maximal runs of ASCII letters and digits (lower-cased) and of any
non-ASCII characters.  A first pass counts documents, terms and, for the terms of
the items, the documents that hold them; with these the impact of a term on a
document is a whole number known wherever the document is.

The second pass cuts the documents into blocks of bounded postings.  In a block
every item term has an impact list, highest first.  An item's lists are read in
step; each document met is looked up directly in the item's other lists, which
gives its score and its place in each list.  The best position of a list is the
last one up to which every place was seen, by reading or by look-up; the impacts
there sum up to the most that an unseen document can score.  Reading ends when
that sum is strictly below the k-th score (an equal score could still win by its
id), which earlier blocks of the task have raised already.  A document's lists
are whole within its block, so the best k of all blocks hold the best k of all
documents; they are merged in two steps.

Items come in blocks of bounded terms, each against all documents: nothing of the
documents reaches the driver but one count per item term.  No posting is shuffled.

Null texts and texts without a term match nothing and are not counted; each row
is a document, repeated ids too; a null id ranks behind equal scores; each item
row is searched for itself; items without terms, empty tables: no rows.  Other
columns are ignored, whatever their names.  Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfeat.llm import textops as tx

TERM = tx.LOWER.copy()  # what a byte of a text counts as: a space between terms
TERM[[b for b in range(128) if not chr(b).isalnum()]] = 0x20

BLOCK_POSTINGS = 1 << 20  # postings of a block of documents
BLOCK_TERMS = 1 << 16  # item terms that go to the tasks at once
BLOCK_ITEMS = 1 << 12
FIRST_STEP = 8  # places read of each list at first; doubled every time
MERGE_WAYS = 64
FOUND = "seq long, item long, doc long, score long"
FOUND_SCHEMA = pa.schema([(c, pa.int64()) for c in ("seq", "item", "doc", "score")])


def terms(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term."""
    data, offs = tx.byte_view(arr)
    data = TERM[data]
    row, start, end = tx.word_spans(data, offs)
    return row, tx.word_hashes(data, start, end)


@dataclass
class Items:
    """A block of items: item j has the terms ``term[at[j]:at[j+1]]`` (places in ``vocab``), ``times`` each."""

    seq: np.ndarray
    item: list[int | None]
    vocab: np.ndarray
    at: np.ndarray
    term: np.ndarray
    times: np.ndarray


def blocks_of_items(items: DataFrame, id_col: str, text_col: str, most_terms: int, most_items: int) -> Iterator[Items]:
    """Items with terms, in blocks of bounded distinct terms (one item at least)."""
    rows = items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator(prefetchPartitions=True)
    held: list[tuple[int, int | None, np.ndarray]] = []
    vocab: set[int] = set()
    for seq, (item, text) in enumerate(rows):
        h = terms(pa.array([text], pa.string()))[1]
        if not len(h):
            continue
        new = set(h.tolist())
        if held and (len(vocab | new) > most_terms or len(held) >= most_items):
            yield _block(held)
            held, vocab = [], set()
        held.append((seq, item, h))
        vocab |= new
    if held:
        yield _block(held)


def _block(held: list[tuple[int, int | None, np.ndarray]]) -> Items:
    counted = [np.unique(h, return_counts=True) for *_, h in held]
    vocab = np.unique(np.concatenate([t for t, _ in counted]))
    at = np.concatenate([[0], np.cumsum([len(t) for t, _ in counted])])
    term = np.searchsorted(vocab, np.concatenate([t for t, _ in counted]))
    return Items(np.array([s for s, *_ in held], np.int64), [i for _, i, _ in held], vocab, at, term, np.concatenate([n for _, n in counted]).astype(np.int64))


def postings(arr: pa.Array, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per row, and the postings (row, place in vocab, count) of the vocabulary, by row, then term."""
    row, h = terms(arr)
    k = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
    hit = vocab[k] == h
    key, n = np.unique(row[hit] * len(vocab) + k[hit], return_counts=True)
    return tx.counts_by_row(row, len(arr)), key // len(vocab), key % len(vocab), n.astype(np.int64)


def corpus_counts(docs: DataFrame, vocab: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term of ``vocab``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(vocab) + 2, np.int64)
        for b in tx.slices(batches, "text"):
            n, _, term, _ = postings(b.column("text"), vocab)
            sums[:-2] += np.bincount(term, minlength=len(vocab))
            sums[-2:] += [np.count_nonzero(n), n.sum()]
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["k", "n"])

    sums = np.zeros(len(vocab) + 2, np.int64)
    for k, n in docs.select("text").mapInArrow(work, "k long, n long").groupBy("k").agg(F.sum("n")).collect():
        sums[k] = n
    return int(sums[-2]), int(sums[-1]), sums[:-2]


def weights(n_docs: int, holders: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holders], np.int64)


def lengths_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's length norm: 25 and 75 times its terms over the mean."""
    if 75 * int(n.max(initial=0)) * n_docs >= 1 << 63:
        return np.array([25 + 75 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 25 + 75 * n * n_docs // n_terms


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.cumsum(n)
    return np.arange(int(total[-1]) if len(n) else 0) - np.repeat(total - n, n) + np.repeat(start, n)


class Block:
    """Impact lists and direct access for some documents."""

    def __init__(self, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_vocab: int):
        self.n_docs, self.term, self.impact = n_docs, term, impact
        self.begin = np.searchsorted(doc, np.arange(n_docs))  # a document's postings
        self.size = np.bincount(doc, minlength=n_docs)
        order = np.lexsort((-impact, term))
        self.length = np.bincount(term, minlength=n_vocab)
        self.list_at = np.cumsum(self.length) - self.length
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.place = np.empty(len(order), np.int64)  # of a posting in its term's list
        self.place[order] = np.arange(len(order)) - np.repeat(self.list_at, self.length)
        self.slot = np.full(n_vocab, -1)

    def best(self, term: np.ndarray, times: np.ndarray, ids: tuple[np.ndarray, np.ndarray], top: "Top") -> int:
        """Puts the documents that can be among the best of an item into ``top``; returns how many were looked up."""
        there = self.length[term] > 0
        term, times = term[there], times[there]
        length, begin = self.length[term], self.list_at[term]
        at = np.cumsum(length) - length
        place_seen = np.zeros(int(length.sum()), bool)
        doc_seen = np.zeros(self.n_docs, bool)
        self.slot[term] = np.arange(len(term))
        position = np.zeros(len(term), np.int64)  # all places before it were seen
        depth, step = 0, FIRST_STEP
        looked_up = 0
        while (position < length).any():
            n = np.clip(length - depth, 0, step)
            met = np.unique(self.list_doc[_ranges(begin + depth, n)])
            met = met[~doc_seen[met]]
            depth, step = depth + step, 2 * step
            if len(met):
                doc_seen[met] = True
                looked_up += len(met)
                p = _ranges(self.begin[met], self.size[met])
                k = self.slot[self.term[p]]
                own = k >= 0
                owner = np.repeat(np.arange(len(met)), self.size[met])[own]
                p, k = p[own], k[own]
                place_seen[at[k] + self.place[p]] = True
                score = np.add.reduceat(self.impact[p] * times[k], np.flatnonzero(np.diff(owner, prepend=-1)))
                top.offer(score, ids[0][met], ids[1][met])
            for j in np.flatnonzero(position < length):
                rest = place_seen[at[j] + position[j] : at[j] + length[j]]
                gap = int(rest.argmin())
                position[j] = length[j] if rest[gap] else position[j] + gap
            open_ = position < length
            most = int((times[open_] * self.list_impact[begin[open_] + position[open_] - 1]).sum())
            if most < top.kth():
                break
        self.slot[term] = -1
        return looked_up


class Top:
    """The best k so far: higher score first, then a known id, then the smaller one."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def kth(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def offer(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        ok = score >= max(self.kth(), 1)
        if not ok.any():
            return
        score, ids, no_id = (np.concatenate([a, b[ok]]) for a, b in ((self.score, score), (self.id, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -score))[: self.k]
        self.score, self.id, self.no_id = score[order], ids[order], no_id[order]


def _found(items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int, most_postings: int):
    """The Arrow task of the second pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in items.item]
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> None:
            n_rows = np.cumsum([0] + [len(x[0]) for x in held])
            ids, no_id, doc, term, impact = (np.concatenate(c) for c in zip(*[(i, z, d + n, t, v) for n, (i, z, d, t, v) in zip(n_rows, held)], strict=True))
            block = Block(len(ids), doc, term, impact, len(items.vocab))
            for j, top in enumerate(tops):
                own = slice(items.at[j], items.at[j + 1])
                block.best(items.term[own], items.times[own], (ids, no_id), top)
            held.clear()

        for b in tx.slices(batches, "text"):
            n, doc, term, tf = postings(b.column("text"), items.vocab)
            m = lengths_norm(n, n_docs, n_terms)
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            if held and sum(len(x[2]) for x in held) + len(doc) > most_postings:
                flush()
            id_ = b.column("doc")
            held.append((id_.fill_null(0).to_numpy(zero_copy_only=False), id_.is_null().to_numpy(zero_copy_only=False), doc, term, impact))
        if held:
            flush()
        for seq, item, top in zip(items.seq, items.item, tops, strict=True):
            rows = len(top.score)
            if rows:
                doc = pa.array(top.id, mask=top.no_id)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(rows, seq)), pa.array([item] * rows, pa.int64()), doc, pa.array(top.score)], schema=FOUND_SCHEMA)

    return work


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_postings: int = BLOCK_POSTINGS,
    block_terms: int = BLOCK_TERMS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``(item, rank, doc, score)``: up to ``k`` documents with a score above 0 for each item row."""
    d = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    found = []
    for block in blocks_of_items(items, item_col, item_text_col, block_terms, block_items):
        n_docs, n_terms, holders = corpus_counts(d, block.vocab)
        if n_docs:
            found.append(d.mapInArrow(_found(block, weights(n_docs, holders), n_docs, n_terms, k, block_postings), FOUND))
    spark: SparkSession = docs.sparkSession
    rows = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], FOUND)
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    way = F.pmod(F.xxhash64("doc", "score"), F.lit(MERGE_WAYS))
    some = rows.withColumn("way", way).withColumn("r", F.row_number().over(Window.partitionBy("seq", "way").orderBy(*order))).where(F.col("r") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("seq").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("item", "rank", "doc", "score")
