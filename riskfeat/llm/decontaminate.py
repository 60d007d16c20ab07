"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items and documents are sets of hashed word shingles (A-Z lower-cased).
An item is reported for a document that holds at least ``threshold`` of the
item's distinct shingles.

Search: items are partitioned by size into classes with upper bounds ``u`` =
16, 32, 64, ... shingles.  For each class a document is seen as overlapping
windows of ``2u`` shingles, one starting every ``u``, so that an item's passage
lies whole in one window and its Jaccard similarity with it stays above a bound
that does not depend on the document's length.  A window is a candidate for an
item when one of ``hashes`` MinHash values agrees; with the default 128 a
passage holding 0.8 of an item is missed with a chance under 1e-9.  Items for
which that bound does not hold, those of a few shingles, are not left to
MinHash: a text that holds enough of an item's shingles holds one of any
``n - needed + 1`` of them, so a lookup of these finds every such text.  Window
minima come from minima of 16-shingle blocks, merged from class to class.
Candidates are verified by exact containment of the item's shingles in the
whole document.

Scale: documents are only scanned, never shuffled.  Items go to the tasks in
blocks of at most ``block_shingles`` shingles, one scan per block.

Edge cases: null or empty texts and items, and those with fewer words than a
shingle, have no shingle and are never reported; repeated rows are reported row
by row; repeated items are reported once each per (id, text); null ids are kept
as null; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.textops import LOWER, byte_view, shingle_hashes, slices, word_hashes, word_spans

BLOCK = 16  # shingles of a minimum block; the smallest size class
MISS = 1e-9  # chance of a miss from which items are looked up by their shingles


def text_shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word shingle, in order."""
    low = LOWER[data]
    row, start, end = word_spans(low, offs)
    return shingle_hashes(row, word_hashes(low, start, end), k)


def multipliers(n: int) -> np.ndarray:
    """Odd multipliers; each orders the hashes differently."""
    return np.random.default_rng(1).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Items:
    """One block of test items: shingle sets, size classes and MinHash values."""

    def __init__(self, texts: list[str | None], k: int, hashes: int, threshold: float) -> None:
        data, offs = byte_view(pa.array(texts, pa.string()))
        row, h = text_shingles(data, offs, k)
        cut = np.searchsorted(row, np.arange(len(texts) + 1))
        self.sets = {i: np.unique(h[cut[i] : cut[i + 1]]) for i in np.unique(row).tolist()}
        self.mult = multipliers(hashes)
        self.classes: dict[int, list[int]] = {}
        direct: list[tuple[int, int]] = []
        for i, s in self.sets.items():
            u = BLOCK
            while u < len(s):
                u *= 2
            needed = max(1, int(np.ceil(threshold * len(s) - 1e-9)))
            if (1 - needed / (2 * u + len(s) - needed)) ** hashes < MISS:
                self.classes.setdefault(u, []).append(i)
            else:
                direct += [(int(x), i) for x in s[: len(s) - needed + 1]]
        direct.sort()
        self.direct = np.array([x for x, _ in direct], np.uint64), np.array([i for _, i in direct], np.int64)
        self.quick_direct = np.zeros(1 << 16, bool)
        self.quick_direct[self.direct[0] >> np.uint64(48)] = True
        # per class and hash: MinHash values in order, and the item of each
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for u, members in self.classes.items():
            least = np.array([[(self.sets[i] * a).min() for i in members] for a in self.mult])
            order = np.argsort(least, axis=1)
            self.tables[u] = np.take_along_axis(least, order, 1), np.array(members)[order]
        # a quick test on the leading bits before the exact lookup
        self.quick = {u: np.zeros((hashes, 1 << 16), bool) for u in self.tables}
        for u, (least, _) in self.tables.items():
            for j in range(hashes):
                self.quick[u][j, least[j] >> np.uint64(48)] = True

    def looked_up(self, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and item of the shingles that stand for small items."""
        at = np.flatnonzero(self.quick_direct[h >> np.uint64(48)])
        lo = np.searchsorted(self.direct[0], h[at], "left")
        count = np.searchsorted(self.direct[0], h[at], "right") - lo
        which = np.repeat(lo, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(row[at], count), self.direct[1][which]

    def candidates(self, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, item) whose MinHash agrees in some window, or that share a small item's shingle."""
        by_row, by_item = self.looked_up(row, h)
        out_row, out_item = [by_row], [by_item]
        if not len(h) or not self.tables:
            pairs = np.unique(np.stack([by_row, by_item]), axis=1)
            return pairs[0], pairs[1]
        n = np.bincount(row)
        first = np.cumsum(n) - n
        blocks = -(-n // BLOCK)
        base = np.cumsum(blocks) - blocks
        of = np.repeat(np.arange(len(n)), blocks)  # row of each block
        starts = first[of] + (np.arange(len(of)) - base[of]) * BLOCK
        top = max(self.tables)
        for j, a in enumerate(self.mult):
            low = np.minimum.reduceat(h * a, starts)
            rows = of
            u = BLOCK
            while u <= top:
                if u > BLOCK:  # merge neighbours of the same row two by two
                    at = np.arange(len(rows)) - np.searchsorted(rows, rows)
                    even = np.flatnonzero(at % 2 == 0)
                    low, rows = np.minimum.reduceat(low, even), rows[even]
                if u in self.tables:
                    window = low.copy()
                    if len(low) > 1:
                        same = rows[1:] == rows[:-1]
                        window[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                    hit = np.flatnonzero(self.quick[u][j][window >> np.uint64(48)])
                    if len(hit):
                        least, items = self.tables[u][0][j], self.tables[u][1][j]
                        lo = np.searchsorted(least, window[hit], "left")
                        count = np.searchsorted(least, window[hit], "right") - lo
                        which = np.repeat(lo, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                        out_row.append(np.repeat(rows[hit], count))
                        out_item.append(items[which])
                u *= 2
        pairs = np.unique(np.stack([np.concatenate(out_row), np.concatenate(out_item)]), axis=1)
        return pairs[0], pairs[1]


def _verified(items: Items, b: pa.RecordBatch, text: str, k: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """(row, item, its shingles, those the text holds) of the items that texts hold."""
    data, offs = byte_view(b.column(text))
    row, h = text_shingles(data, offs, k)
    rows, found = items.candidates(row, h)
    cut = np.searchsorted(row, np.arange(b.num_rows + 1))
    out = []
    own, last = np.zeros(0, np.uint64), -1
    for r, i in zip(rows.tolist(), found.tolist()):
        if r != last:
            own, last = np.sort(h[cut[r] : cut[r + 1]]), r
        want = items.sets[i]
        n = int((own[np.minimum(np.searchsorted(own, want), len(own) - 1)] == want).sum())
        if n >= threshold * len(want) - 1e-9:
            out.append((r, i, len(want), n))
    return out


def _search(items: Items, ids: list, k: int, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            if hits := _verified(items, b, "text", k, threshold):
                row, item, size, shared = zip(*hits)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc").take(pa.array(row)), *(pa.array(v, pa.int64()) for v in ([ids[i] for i in item], size, shared))],
                    ["doc", "item_id", "n_shingles", "n_shared"],
                )

    return run


def _blocks(items: DataFrame, shingle: int, hashes: int, block_shingles: int, threshold: float) -> Iterator[tuple[Items, list]]:
    """The test items in blocks of bounded size, with their ids."""
    it = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0).distinct()
    # an item of n characters has at most n / 2 shingles
    total = it.agg(F.coalesce(F.sum(F.length("text") / 2), F.lit(0.0))).first()[0]
    blocks = max(1, -(-int(total) // block_shingles))
    for i in range(blocks):
        rows = it.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        yield Items([r.text for r in rows], shingle, hashes, threshold), [r.item_id for r in rows]


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    hashes: int = 128,
    block_shingles: int = 1 << 20,
) -> DataFrame:
    """``(id, item_id, n_shingles, n_shared)`` of every item held by a document."""
    d = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    schema = "doc long, item_id long, n_shingles long, n_shared long"
    parts = [d.mapInArrow(_search(block, ids, shingle, threshold), schema) for block, ids in _blocks(items, shingle, hashes, block_shingles, threshold)]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("doc", id_col)


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    hashes: int = 128,
    block_shingles: int = 1 << 20,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no test item."""

    def rows_without(block: Items):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, text_col):
                clean = np.ones(b.num_rows, bool)
                clean[[r for r, *_ in _verified(block, b, text_col, shingle, threshold)]] = False
                yield b.filter(pa.array(clean))

        return run

    for block, _ in _blocks(items, shingle, hashes, block_shingles, threshold):
        docs = docs.mapInArrow(rows_without(block), docs.schema)
    return docs
