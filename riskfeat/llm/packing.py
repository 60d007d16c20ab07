"""Packing of tokenised documents into fixed windows by multiway differencing.

Every document is tokenised once, its end id added, and cut at multiples of the
capacity; full windows stand alone.  What is left of the documents (under one
window each) is dealt by hash into groups of about ``group_windows`` windows;
each group is packed by the Karmarkar-Karp multiway differencing method:
partial partitions are merged two at a time, the one with the largest imbalance
first, with opposing order of sums, until one partition with near-equal windows
is left.

A group's tokens beyond whole windows are set apart first (at most one cut) and
become sequences whose lengths are powers of two, which need no padding.  The
rest fills its windows on average; what differencing leaves above capacity is
cut off and fills the windows below it.  Without cuts (``cut=False``) the
window count rises until no window is over capacity.

Edge cases: a null or empty text is its end id alone; null ids and repeated
rows are packed row by row; an empty table gives no pieces; a text longer than
any window is cut into many.  Columns other than id and text are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.textops import KEPT, LOWER, byte_view, slices, word_hashes, word_spans
from riskfeat.session import checkpoint

CACHE_WORDS = 2_000_000  # encoded words kept by one Python worker until it serves another operator, about 30 bytes each


class WordEncoder:
    """Token ids of texts, put together from those of their words.

    The tokenizer never joins over ASCII white space, nor a letter with a full
    stop or comma after it, and it lower-cases; so a text's ids are those of its
    words and stops one after another.  Words are found and told apart (by a
    64-bit hash) with array operations; only words not met before are encoded.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.forget()

    def forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)  # sorted; the others in its order
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def encode(self, data: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with ``end_id`` last, and their numbers of ids."""
        # combining marks may compose with a small letter only; special tokens are told by case
        if not (np.any((data == 0xCC) | (data == 0xCD)) or b"<|" in data.tobytes()):
            data = LOWER[data]
        row, start, stop = word_spans(data, offs)
        h = np.zeros(0, np.uint64)
        if len(start):
            last, before = data[stop - 1], data[np.maximum(stop - 2, 0)]
            cut = (stop - start > 1) & ((last == 0x2E) | (last == 0x2C)) & (before >= 0x61) & (before <= 0x7A)
            each = 1 + cut
            row, start, stop = (np.repeat(x, each) for x in (row, start, stop))
            second = np.cumsum(each)[cut] - 1
            stop[second - 1] -= 1
            start[second] = stop[second] - 1
            h = word_hashes(data, start, stop)
        words, first, which = np.unique(h, return_index=True, return_inverse=True)
        place = self._find(words, first, data, start, stop)
        n = self.n[place][which]
        total = np.bincount(row, weights=n, minlength=len(offs) - 1).astype(np.int64) + 1
        out = np.full(int(total.sum()), end_id, self.dtype)
        body = np.ones(len(out), bool)
        body[np.cumsum(total) - 1] = False
        out[body] = self.ids[np.repeat(self.at[place][which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return out, total

    def _find(self, words: np.ndarray, first: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Places of the words among those kept, new ones encoded and added."""
        if len(self.hash) > CACHE_WORDS:
            self.forget()
        at = np.searchsorted(self.hash, words)
        new = np.ones(len(words), bool)
        ok = at < len(self.hash)
        new[ok] = self.hash[at[ok]] != words[ok]
        if not new.any():
            return at
        texts = [data[start[i] : stop[i]].tobytes().decode("utf-8") for i in first[new].tolist()]
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.array([len(x) for x in ids], np.int64)
        flat = np.array([y for x in ids for y in x], self.dtype)
        self.at = np.insert(self.at, at[new], len(self.ids) + np.cumsum(n) - n)
        self.n = np.insert(self.n, at[new], n)
        self.hash = np.insert(self.hash, at[new], words[new])
        self.ids = np.concatenate([self.ids, flat])
        return np.searchsorted(self.hash, words)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
        KEPT.append(_ENCODERS[path])
    return _ENCODERS[path]


def tokens(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """``(row, doc, n, ids)``: ids as little-endian integers, as wide as the vocabulary needs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in slices(batches, "text", keep=enc):
            flat, n = enc.encode(*byte_view(b.column("text")), end_id)
            edge = np.r_[0, np.cumsum(n)]
            ids = [flat[x:y].tobytes() for x, y in zip(edge.tolist(), edge[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc", "n", "ids"])

    out = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc long, n long, ids binary")
    return out.withColumn("row", F.monotonically_increasing_id())


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each item: Karmarkar-Karp differencing into ``windows`` parts."""
    n = len(sizes)
    if windows <= 1 or n <= 1:
        return np.zeros(n, np.int64)
    # an entry: (-imbalance, number, sums in falling order); leaves 0..n-1 hold one item
    heap, sums = [], {}
    for i, s in enumerate(sizes.tolist()):
        v = np.zeros(windows, np.int64)
        v[0] = s
        sums[i] = v
        heap.append((-s, i))
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    number = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        v = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-v, kind="stable")
        sums[number] = v = v[order]
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(v[0] - v[-1]), number))
        number += 1
    slots: dict[int, np.ndarray] = {number - 1: np.arange(windows)}
    out = np.empty(n, np.int64)
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        window = slots.pop(n + k)
        at = np.empty(windows, np.int64)
        at[order] = window  # before sorting: slot j of a met slot -j of b
        for part, to in ((a, at), (b, at[::-1])):
            if part < n:
                out[part] = to[0]
            else:
                slots[part] = to
    return out


Piece = tuple[int, int, int]  # row, start, length


def _take(pieces: list[Piece], want: int) -> list[Piece]:
    """Move ``want`` tokens off the end of ``pieces``, cutting at most one."""
    out: list[Piece] = []
    while want > 0:
        row, start, n = pieces.pop()
        if n > want:
            pieces.append((row, start, n - want))
            row, start, n = row, start + n - want, want
        out.append((row, start, n))
        want -= n
    return out


def pack_group(pieces: list[Piece], capacity: int, cut: bool = True) -> list[list[Piece]]:
    """Sequences of one group's pieces, each piece at most one window long.

    With ``cut`` no sequence needs padding; without, pieces stay whole and the
    window count rises whenever a window is over capacity.
    """
    total = sum(p[2] for p in pieces)
    out: list[list[Piece]] = []
    if cut:
        rest = total % capacity
        # a token count is a sum of powers of two, and such sequences are not padded
        pieces = sorted(pieces, key=lambda p: (p[2], p[0], p[1]))
        tail = _take(pieces, rest)[::-1]
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                out.append(_take(tail, 1 << bit))
        total -= rest
    if not pieces:
        return out
    windows = max(1, -(-total // capacity))
    sizes = np.array([p[2] for p in pieces], np.int64)
    while True:
        part = differencing(sizes, windows)
        load = np.bincount(part, weights=sizes, minlength=windows).astype(np.int64)
        over = int(np.maximum(load - capacity, 0).sum())
        if over <= (int(np.maximum(capacity - load, 0).sum()) if cut else 0):
            break
        windows += 1
    held: list[list[Piece]] = [[] for _ in range(windows)]
    for i in np.argsort(sizes, kind="stable").tolist():
        held[part[i]].append(pieces[i])  # the longest piece last
    spare: list[Piece] = []
    for w in np.flatnonzero(load > capacity).tolist():
        spare += _take(held[w], int(load[w] - capacity))
    for w in np.flatnonzero(load < capacity).tolist() if cut else ():
        if not spare:
            break
        have = sum(p[2] for p in spare)
        held[w] += _take(spare, min(have, int(capacity - load[w])))
    return out + [h for h in held if h]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_windows: int = 256,
    cut: bool = True,
) -> DataFrame:
    """Pieces ``(id, start, length, ids, doc_tokens, sequence_id, offset)``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers.
    """
    toks = checkpoint(tokens(docs, id_col, text_col, tokenizer, end_id))
    rest = F.col("n") % capacity
    left = toks.where(rest > 0).select("row", F.col("doc"), (F.col("n") - rest).alias("start"), rest.alias("length"))
    total = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, -(-total // (group_windows * capacity)))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc", "row"])
        group = int(pdf["group"].iloc[0])
        found = pack_group(list(zip(pdf["row"].tolist(), pdf["start"].tolist(), pdf["length"].tolist())), capacity, cut)
        rows = []
        for k, seq in enumerate(found):
            at = 0
            for row, start, n in seq:
                rows.append((row, start, n, (group * 4 * group_windows * capacity + k) * 2, at))
                at += n
        return pd.DataFrame(rows, columns=["row", "start", "length", "sequence_id", "offset"]).astype("int64")

    schema = "row long, start long, length long, sequence_id long, offset long"
    grouped = left.withColumn("group", F.pmod(F.xxhash64("doc", "row"), F.lit(groups)))
    packed = grouped.groupBy("group").applyInPandas(one, schema)
    whole = (
        toks.where(F.col("n") >= capacity)
        .select("row", F.explode(F.sequence(F.lit(0), F.expr(f"n div {capacity}") - 1)).alias("q"))
        .select(
            "row", (F.col("q") * capacity).cast("long").alias("start"), F.lit(capacity).cast("long").alias("length"),
            (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        )
    )
    plan = checkpoint(packed.unionByName(whole))
    per_row = plan.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    width = np.dtype("<u2" if _width(tokenizer) == 2 else "<u4")

    def cut_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out: dict[str, list] = {k: [] for k in ("doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
                for doc, n, ids, pieces in zip(*(part.column(c).to_pylist() for c in ("doc", "n", "ids", "pieces"))):
                    all_ids = np.frombuffer(ids, width)
                    for p in sorted(pieces, key=lambda p: p["start"]):
                        vals = all_ids[p["start"] : p["start"] + p["length"]].astype("<u4").tobytes()
                        for k, v in zip(out, (doc, p["start"], p["length"], vals, n, p["sequence_id"], p["offset"])):
                            out[k].append(v)
                kinds = {"ids": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))

    done = toks.join(per_row, "row").select("doc", "n", "ids", "pieces").mapInArrow(
        cut_up, "doc long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return done.withColumnRenamed("doc", id_col)


def _width(tokenizer: str) -> int:
    return encoder(tokenizer).dtype.itemsize
