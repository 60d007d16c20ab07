r"""Periodic runs: stretches of words that repeat at a period, found and collapsed.

A run is a stretch with smallest period q and at least max(``min_length``, 2 q)
words that no neighbouring word extends.  All runs of a text are found:

* periods below ``SHORT`` are scanned directly, one lag at a time;
* a period q in [2**j, 2**(j+1)) is found at scale j: of every 2**(j-1)
  neighbouring k-grams, k = 2**(j-1), the one with the least hash (the leftmost
  of equals) is a minimizer.  A window of 2**j - 1 <= q words and its shift by q
  both lie inside a run of 2 q words and choose the same place, so the run holds
  two equal minimizers q apart.  Equal minimizers q apart are the seeds.

Equal k-grams at most k/2 apart overlap in a stretch of a smaller period, whose
multiples are no smallest periods; such chains are paired with other chains end
to end, each distance once, so that seeds stay few inside long runs.

Seeds are extended both ways by longest common extensions over the hashes of
power-of-two blocks (each the hash of its two halves), and a run whose length
also has a shorter period q/r (r a prime factor of q) is dropped.  Words and
blocks are told apart by 64-bit hashes.

Numpy works on slices of bounded bytes in Arrow tasks; there is no shuffle.
Memory follows the slice or the longest text: about 8 bytes per word and level
(the level count is the logarithm of the longest text's words).

Null and empty texts have no words and no runs; repeated rows and null ids are
kept, each row is judged by itself; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm import textops as tx

FIRST_SCALE = 5
SHORT = 1 << FIRST_SCALE  # periods below are scanned lag by lag
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
DDL = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Words:
    """The words of some texts in a row: text ``row[i]`` holds word i, [first, last) are its bounds."""

    def __init__(self, hashes: np.ndarray, row: np.ndarray, n_rows: int):
        self.h, self.row = hashes, row
        self.n = tx.counts_by_row(row, n_rows)
        self.last = np.cumsum(self.n)
        self.first = self.last - self.n
        self.levels = [hashes]
        longest = int(self.n.max()) if n_rows else 0
        while 2 << (len(self.levels) - 1) <= longest:
            half, step = self.levels[-1], 1 << (len(self.levels) - 1)
            both = np.zeros_like(half)
            both[:-step] = tx.mix64(half[:-step] * tx.MULT + half[step:])
            self.levels.append(both)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on (a < b, same text)."""
        return self._extend(a, b, self.last[self.row[b]] - b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b."""
        return self._extend(a, b, a - self.first[self.row[a]], -1)

    def _extend(self, a: np.ndarray, b: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
        ext = np.zeros(len(a), np.int64)
        for j in reversed(range(len(self.levels))):
            step = 1 << j
            k = np.flatnonzero(ext + step <= room)
            off = ext[k] if way > 0 else -ext[k] - step
            ext[k[self.levels[j][a[k] + off] == self.levels[j][b[k] + off]]] += step
        return ext


def scan_lags(w: Words, lags: Iterable[int], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Start, length and period of stretches that repeat at a short lag."""
    for q in lags:
        if q >= len(w.h):
            return
        same = np.zeros(len(w.h) - q + 2, bool)
        same[1:-1] = (w.h[:-q] == w.h[q:]) & (w.row[:-q] == w.row[q:])
        turn = np.flatnonzero(same[1:] != same[:-1])
        start, n = turn[::2], turn[1::2] - turn[::2]
        ok = n >= max(q, least - q)
        if ok.any():
            yield start[ok], n[ok] + q, np.full(int(ok.sum()), q, np.int64)


def minimizers(w: Words, j: int) -> np.ndarray:
    """Places of the minimizers of scale j, ascending, of texts that can hold a run of it."""
    span = 1 << (j - 1)
    at = np.flatnonzero((w.n >= 4 * span)[w.row])
    if not len(at):
        return at
    end = w.last[w.row[at]]
    least = w.levels[j - 1][at]
    pick = np.arange(len(at))
    step = 1
    while step < span:  # the least of 2 * step neighbours from that of each half; the left one if equal
        right = least[step:] < least[:-step]
        pick = np.where(right, pick[step:], pick[:-step])
        least = np.where(right, least[step:], least[:-step])
        step *= 2
    whole = at[: len(pick)] + 2 * span - 1 <= end[: len(pick)]  # the window's last k-gram ends inside the text
    return at[np.unique(pick[whole])]


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... n[0] of them, then those of the next."""
    total = np.cumsum(n)
    return np.arange(int(total[-1]) if len(n) else 0) - np.repeat(total - n, n) + np.repeat(start, n)


def seeds(w: Words, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and distance of equal minimizers 2**j to 2**(j+1) - 1 words apart, chains end to end."""
    at = minimizers(w, j)
    none = np.zeros(0, np.int64)
    if len(at) < 2:
        return none, none
    key = tx.mix64(w.levels[j - 1][at] ^ (w.row[at].astype(np.uint64) * tx.MULT))
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    near, far = 1 << j, 2 << j
    gap = np.where(key[1:] == key[:-1], at[1:] - at[:-1], 0)
    close = (gap > 0) & (gap <= 1 << (j - 2))
    even = close.copy()
    even[1:] &= ~close[:-1] | (gap[1:] == gap[:-1])  # a chain has equal gaps; where the gap changes, a new one begins
    begins = np.flatnonzero(np.concatenate([[True], ~even]))
    size = np.diff(np.concatenate([begins, [len(at)]]))
    head, tail = at[begins], at[begins + size - 1]
    pitch = np.where(size > 1, at[np.minimum(begins + 1, len(at) - 1)] - head, 0)
    group = key[begins]
    out_a, out_b = [], []
    c = np.arange(len(begins))
    t = 0
    while len(c):
        t += 1
        c = c[c + t < len(begins)]
        c = c[(group[c] == group[c + t]) & (head[c + t] - tail[c] < far)]
        a, b = c, c + t
        worth = tail[b] - head[a] >= near
        a, b = a[worth], b[worth]
        cross = (size[a] > 1) & (size[b] > 1) & (pitch[a] != pitch[b])
        for left, right, left_all in ((a[~cross], b[~cross], False), (a[~cross], b[~cross], True)):
            many = left if left_all else right
            pairs = at[_ranges(begins[many], size[many])]
            out_a.append(pairs if left_all else np.repeat(head[left], size[many]))
            out_b.append(np.repeat(head[right], size[many]) if left_all else pairs)
        each = _ranges(begins[a[cross]], size[a[cross]])
        other = np.repeat(b[cross], size[a[cross]])
        out_a.append(np.repeat(at[each], size[other]))
        out_b.append(at[_ranges(begins[other], size[other])])
    a = np.concatenate([none, *out_a])
    d = np.concatenate([none, *out_b]) - a
    ok = (d >= near) & (d < far)
    a, d = a[ok], d[ok]
    first = np.unique(d * len(w.h) + a)
    return first % len(w.h), first // len(w.h)


def _shorter(q: int) -> list[int]:
    """q divided by each of its prime factors."""
    out, rest, r = [], q, 2
    while r * r <= rest:
        if rest % r == 0:
            out.append(q // r)
            while rest % r == 0:
                rest //= r
        r += 1
    return out + [q // rest] * (rest > 1)


def runs(w: Words, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (over all words), length and period of every run, by start, then period."""
    found = list(scan_lags(w, range(1, SHORT), least))
    longest = int(w.n.max()) if len(w.n) else 0
    j = FIRST_SCALE
    while 2 << j <= longest:
        a, d = seeds(w, j)
        back, ahead = w.backward(a, a + d), w.forward(a, a + d)
        ok = back + ahead >= np.maximum(d, least - d)
        found.append(((a - back)[ok], (back + ahead + d)[ok], d[ok]))
        j += 1
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (period[1:] != period[:-1])
    start, length, period = start[new], length[new], period[new]
    parts = {int(q): _shorter(int(q)) for q in np.unique(period)}
    which = np.repeat(np.arange(len(period)), [len(parts[int(q)]) for q in period])
    p = np.array([x for q in period for x in parts[int(q)]], np.int64)
    whole = w.forward(start[which], start[which] + p) >= length[which] - p
    smallest = np.ones(len(start), bool)
    smallest[which[whole]] = False
    return start[smallest], length[smallest], period[smallest]


def _join_kept(data: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray, n_rows: int) -> pa.Array:
    """One string per row: its words joined by one space."""
    n = end - start
    later = np.zeros(len(row), bool)
    later[1:] = row[1:] == row[:-1]
    size = n + later
    to = np.cumsum(size) - size + later
    out = np.full(int(size.sum()), 0x20, np.uint8)
    out[_ranges(to, n)] = data[_ranges(start, n)]
    offs = np.zeros(n_rows + 1, np.int64)
    offs[1:] = np.cumsum(np.bincount(row, weights=size, minlength=n_rows).astype(np.int64))
    return pa.Array.from_buffers(pa.string(), n_rows, [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(out)])


def _judge(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    data, offs = tx.byte_view(batch.column("text"))
    rows = batch.num_rows
    row, start, end = tx.word_spans(data, offs)
    w = Words(tx.word_hashes(data, start, end), row, rows)
    at, length, period = runs(w, least)
    step = np.zeros(len(row) + 1, np.int64)
    np.add.at(step, at + period, 1)
    np.add.at(step, at + length, -1)
    kept = np.cumsum(step[:-1]) == 0
    owner = row[at]
    n_runs = np.zeros(rows + 1, np.int32)
    n_runs[1:] = np.cumsum(np.bincount(owner, minlength=rows))
    made = pa.StructArray.from_arrays([pa.array(at - w.first[owner]), pa.array(length), pa.array(period)], fields=list(RUN))
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array(w.n), pa.ListArray.from_arrays(pa.array(n_runs), made), _join_kept(data, row[kept], start[kept], end[kept], rows)],
        schema=SCHEMA,
    )


def collapse_runs(docs: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, runs, collapsed)`` per row of ``docs``.

    ``runs`` lists (start, length, period) in words, by start, then period;
    ``collapsed`` joins by one space the words that no run holds beyond its first
    period.
    """
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.slices(batches, "text"):
            yield _judge(b, min_length)

    return d.mapInArrow(work, DDL)
