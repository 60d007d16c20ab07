"""Line deduplication by an exact set-similarity join.

A line is the set of its words (A-Z lower-cased).  A line goes when an earlier
line (by document id, then place) has a Jaccard similarity of ``threshold`` or
more with it; the earliest of its kind stays.  Every line with a word takes
part; a larger ``min_tokens`` leaves lines of fewer different words alone.

Texts are read once for their sets, which are kept packed (a slice's words as a
dictionary, lines as differences of its numbers) in a checkpoint; all later
steps read those.  The texts are read again to take lines out; only those of
documents that lose a line are shuffled to meet their lines, the others pass by.

Join: words are ordered from rare to frequent.  Two similar sets share a word
among their first ``n - ceil(threshold n) + 1``, so a set is filed under just
those (prefix filter).  Under a word, pairs must pass the length filter, the
positional filter (what can still be shared from the word on) and a lower bound
of their difference from 128-bit parity signatures; what passes is verified on
the full sets.  Sets too small to be similar to any but an equal set are not
filed.

Scale and skew: sets that are equal are one entry per task and word, and equal
lines are found by a pre-aggregated minimum.  Word counts, for order and to
find crowded words, are kept in tables of fixed size; a crowded word's entries
are cut into blocks and each pair of blocks is a cell of its own.  A cell
returns, per line, its ``BEST`` closest earlier candidates rather than all
pairs; the lines for which none of those is verified though there were more
get all their candidates verified in a second round, so nothing is lost.  Steps
pass on checkpoints, so each step's shuffle files go at its end.

Documents are identified by id and text hash; the join carries the hash only where
an id has several texts (a bit set of fixed size tells), elsewhere the id says as much.  Edge cases: null or empty texts
have no lines; rows equal in id and text share their result; null ids come
first; equal places do not remove each other; empty tables give empty results;
very long lines and texts are sets and lines like any other; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.measures import Texts
from riskfeat.llm.textops import LOWER, MULT, byte_view, mix64, pack, release, slices, unpack
from riskfeat.session import brief_shuffles, checkpoint

TABLE_BITS = 20  # word count tables
PLACE_BITS = 24  # bit set of the lines whose words are asked for
CHUNKS = 16
BLOCK = 2048  # entries of one word that a cell's side holds
CELL_ROWS = 1 << 20  # entries, on average, that a bucket of cells takes
BEST = 4
FOLD = 64  # sets of at most as many words have signatures of 64 bits
KEY_BITS, ID_BITS = 40, 48  # of a cell's key, and of what tells sets of one cell, size and signature apart
PAIRS_AT_ONCE = 1 << 20


def _by_group(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order by group, then key, of rows whose groups rise; one sort on both where leading bits tell."""
    if not len(key):
        return np.zeros(0, np.int64)
    bits = max(1, 63 - int(group[-1] - group[0]).bit_length())
    both = (group - group[0]) << bits | (key >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(both)
    both = both[order]
    tied = np.flatnonzero(both[1:] == both[:-1])
    if np.any(key[order[tied + 1]] != key[order[tied]]):
        return np.lexsort((key, group))
    return order


def _planes(v: np.ndarray) -> bytes:
    """Byte planes of whole numbers: the first bytes of all values, then the second ones."""
    kind = np.dtype(f"<u{v.dtype.itemsize}")
    v = np.ascontiguousarray(v).view(kind)
    return b"".join((v >> kind.type(8 * i)).astype(np.uint8).tobytes() for i in range(kind.itemsize))


def _from_planes(raw: np.ndarray, n: int, kind: np.dtype) -> np.ndarray:
    whole = np.dtype(f"<u{kind.itemsize}")
    out = raw[:n].astype(whole)
    for i in range(1, kind.itemsize):
        out |= raw[i * n : (i + 1) * n].astype(whole) << whole.type(8 * i)
    return out.view(kind)


class Sets:
    """Word sets of lines, line by line: row id, text hash, place, and the set's words."""

    def __init__(self, doc: np.ndarray, h: np.ndarray, place: np.ndarray, size: np.ndarray, word: np.ndarray) -> None:
        self.doc, self.h, self.place, self.size, self.word = doc, h, place, size, word
        self.first = np.cumsum(size) - size
        self.owner = np.repeat(np.arange(len(size)), size)

    @classmethod
    def read(cls, b: pa.RecordBatch) -> Sets:
        """Sets of the lines with a word of a slice of texts."""
        data, offs = byte_view(b.column("text"))
        t = Texts(LOWER[data], offs)
        order = _by_group(t.line, t.hash)
        line, word = t.line[order], t.hash[order]
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (word[1:] != word[:-1])
        n = np.bincount(line[new], minlength=len(t.line_row))
        at = np.flatnonzero(n)
        row = t.line_row[at]
        fill = lambda c: np.array([-(1 << 62) if v is None else v for v in b.column(c).to_pylist()], np.int64)
        return cls(fill("doc")[row], fill("h")[row], (at - t.first_line[row]).astype(np.int64), n[at], word[new])

    def of_size(self, least: int) -> Sets:
        keep = self.size >= least
        if keep.all():
            return self
        return Sets(self.doc[keep], self.h[keep], self.place[keep], self.size[keep], self.word[keep[self.owner]])

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums that tell sets apart."""
        total = lambda v: np.add.reduceat(v, self.first) if len(v) else v
        return total(mix64(self.word ^ MULT)), total(mix64(self.word + MULT))

    def packed(self) -> bytes:
        words, local, times = np.unique(self.word, return_inverse=True, return_counts=True)
        often = np.argsort(-times, kind="stable")
        number = np.empty(len(words), np.int64)
        number[often] = np.arange(len(words))
        key = np.sort(self.owner << 32 | number[local])
        step = np.diff(key & 0xFFFFFFFF, prepend=0)
        step[self.first] = key[self.first] & 0xFFFFFFFF
        head = np.array([len(self.size), len(self.word), len(words)], "<i8")
        rows = [_planes(np.diff(v, prepend=0)) for v in (self.doc, self.h)]
        parts = [*rows, _planes(self.place.astype("<u4")), _planes(self.size.astype("<u4")), _planes(words[often]), _planes(step.astype("<u4"))]
        return pack(np.frombuffer(head.tobytes() + b"".join(parts), np.uint8))

    @classmethod
    def unpacked(cls, b: bytes) -> Sets:
        raw = unpack(b, "u1")
        lines, total, kinds = raw[:24].view("<i8").tolist()
        at = 24

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            width = np.dtype(kind).itemsize
            part = _from_planes(raw[at : at + n * width], n, np.dtype(kind))
            at += n * width
            return part

        doc, h = np.cumsum(take(lines, "<i8")), np.cumsum(take(lines, "<i8"))
        place, size = take(lines, "<u4").astype(np.int64), take(lines, "<u4").astype(np.int64)
        words, step = take(kinds, "<u8"), take(total, "<u4").astype(np.int64)
        number = np.cumsum(step)
        first = np.cumsum(size) - size
        number -= np.repeat(number[first] - step[first], size)
        return cls(doc, h, place, size, words[number])


def _kept_sets(batches: Iterable[pa.RecordBatch], min_tokens: int, doubled=None) -> Iterator[Sets]:
    """The packed sets; with ``doubled``, the text hash is 0 where the id alone tells the text."""
    try:
        for b in batches:
            for x in b.column("sets"):
                s = Sets.unpacked(x.as_py()).of_size(min_tokens)
                if doubled is not None:
                    s.h = np.where(_bit(doubled.value, _doc_slot(s.doc)), s.h, 0)
                yield s
    finally:
        release()


def _slot(word: np.ndarray, bits: int) -> np.ndarray:
    return ((word * MULT) >> np.uint64(64 - bits)).astype(np.int64)


def _rarity(counts: np.ndarray) -> np.ndarray:
    """Logarithm of the counts in 4,096 steps."""
    return np.minimum(np.log2(counts + 1.0) * 64, 4095).astype(np.uint64)


def _in_order(s: Sets, rare: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix entries: line, word, position of the word in rarity order.

    A set of n words shares at most n of n + 1 with a different one: where that is
    below the threshold, none is similar to it.
    """
    # rarity, then the hash: one order for all lines
    rarity = rare[_slot(s.word, TABLE_BITS)]
    key = rarity << np.uint64(52) | s.word >> np.uint64(12)
    order = _by_group(s.owner, key)
    if np.any((np.diff(key[order]) == 0) & (s.owner[1:] == s.owner[:-1])):
        order = np.lexsort((s.word, key, s.owner))
    word = s.word[order]
    pos = np.arange(len(word)) - np.repeat(s.first, s.size)
    prefix = s.size - np.ceil(threshold * s.size - 1e-9).astype(np.int64) + 1
    prefix[s.size < threshold * (s.size + 1) - 1e-9] = 0
    ok = pos < np.repeat(prefix, s.size)
    return s.owner[ok], word[ok], pos[ok]


class _Seen:
    """Sets that a task has met lately, by slot of a table of fixed size, with their earliest places."""

    BITS = 18

    def __init__(self) -> None:
        self.id1, self.id2 = np.zeros(1 << self.BITS, np.uint64), np.zeros(1 << self.BITS, np.uint64)
        self.place = np.zeros((3, 1 << self.BITS), np.int64)
        self.used = np.zeros(1 << self.BITS, bool)

    def firsts(self, s: Sets) -> np.ndarray:
        """Lines of which the table knows no earlier line with the same set; they are known from now on."""
        out = np.zeros(len(s.size), bool)
        if not len(out):
            return out
        id1, id2 = s.ids()
        place = np.stack([s.doc, s.h, s.place])
        order = np.argsort(id1)
        if np.any(np.diff(id1[order]) == 0):
            order = np.lexsort((place[2], place[1], place[0], id2, id1))
        x, y = id1[order], id2[order]
        at = order[np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]]  # the slice's earliest line of each set
        id1, id2, place = id1[at], id2[at], place[:, at]
        slot = (id1 >> np.uint64(64 - self.BITS)).astype(np.int64)
        met = self.used[slot] & (self.id1[slot] == id1) & (self.id2[slot] == id2)
        new = ~met | _before(place, self.place[:, slot])
        out[at[new]] = True
        slot, last = np.unique(slot[new][::-1], return_index=True)
        last = np.flatnonzero(new)[::-1][last]
        self.used[slot], self.id1[slot], self.id2[slot], self.place[:, slot] = True, id1[last], id2[last], place[:, last]
        return out


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether places a (document, text hash, line) come before places b."""
    return (a[0] < b[0]) | ((a[0] == b[0]) & ((a[1] < b[1]) | ((a[1] == b[1]) & (a[2] < b[2]))))


def _table(counts: np.ndarray) -> list[tuple[int, bytes]]:
    return [(c, pack(p.astype("<u4"))) for c, p in enumerate(np.split(counts, CHUNKS)) if p.any()]


def _table_batch(counts: np.ndarray) -> pa.RecordBatch:
    rows = _table(counts)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "counts"])


_SETS = "chunk int, counts binary, sets binary, texts binary"


def _write_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed sets and texts (id, hash) by slice, then in how many lines each word is, by slot of the table (with a chunk)."""
    counts = np.zeros(1 << TABLE_BITS, np.int64)
    names = ["chunk", "counts", "sets", "texts"]
    for b in slices(batches, "text"):
        s = Sets.read(b)
        counts += np.bincount(_slot(s.word, TABLE_BITS), minlength=len(counts))
        new = np.ones(len(s.doc), bool)
        new[1:] = (s.doc[1:] != s.doc[:-1]) | (s.h[1:] != s.h[:-1])
        texts = pack(np.concatenate([s.doc[new], s.h[new]]).astype("<i8"))
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int32()), pa.array([None], pa.binary()), pa.array([s.packed()]), pa.array([texts])], names)
    t = _table_batch(counts)
    yield pa.RecordBatch.from_arrays([*t.columns, *[pa.nulls(t.num_rows, pa.binary())] * 2], names)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id and hash of the texts of all slices."""
    for b in batches:
        for x in b.column("texts"):
            doc, h = np.split(unpack(x.as_py(), "<i8"), 2)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(h)], ["doc", "h"])


def _add_tables(t: pa.Table) -> pa.Table:
    total = sum(unpack(c, "<u4").astype(np.int64) for c in t.column("counts").to_pylist())
    return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()], pa.int32()), "counts": pa.array([pack(total.astype("<i8"))], pa.binary())})


def _collect_table(rows: DataFrame) -> np.ndarray:
    """Sum of all tasks' tables: fixed size, whatever the corpus."""
    out = np.zeros(1 << TABLE_BITS, np.int64)
    per = len(out) // CHUNKS
    for r in rows.groupBy("chunk").applyInArrow(_add_tables, "chunk int, counts binary").collect():
        out[r.chunk * per : (r.chunk + 1) * per] = unpack(r.counts, "<i8")
    return out


def _places(min_tokens: int):
    """Every line's set and place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _kept_sets(batches, min_tokens):
            id1, id2 = s.ids()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (id1.view(np.int64), id2.view(np.int64), s.doc, s.h, s.place)], ["id1", "id2", "doc", "h", "line"])

    return run


def _count_prefixes(min_tokens: int, threshold: float, words, doubled):
    """How many sets each prefix word files, by slot of the table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << TABLE_BITS, np.int64), _Seen()
        for s in _kept_sets(batches, min_tokens, doubled):
            owner, word, _ = _in_order(s, words.value, threshold)
            counts += np.bincount(_slot(word[seen.firsts(s)[owner]], TABLE_BITS), minlength=len(counts))
        yield _table_batch(counts)

    return run


_ENTRY = np.dtype([("key", "<u8"), ("id1", "<u8"), ("b1", "<u8"), ("b2", "<u8"), ("doc", "<i8"), ("h", "<i8"), ("line", "<u4"), ("size", "<u4"), ("pos", "<u4"), ("side", "u1")])


def _pack_entries(e: dict[str, np.ndarray]) -> bytes:
    """Field by field, as byte planes but for the bits of signatures; keys and documents as differences."""
    out = []
    for name, v in e.items():
        if name in ("key", "doc", "h"):
            v = np.diff(v, prepend=v.dtype.type(0))
        out.append(v.tobytes() if name in ("b1", "b2") else _planes(v))
    return pack(np.frombuffer(b"".join(out), np.uint8))


def _unpack_entries(b: bytes) -> dict[str, np.ndarray]:
    raw = unpack(b, "u1")
    n = len(raw) // _ENTRY.itemsize
    out, at = {}, 0
    for name in _ENTRY.names:
        kind = _ENTRY[name]
        v = raw[at : at + n * kind.itemsize]
        v = np.ascontiguousarray(v).view(kind) if name in ("b1", "b2") else _from_planes(v, n, kind)
        out[name] = np.cumsum(v, dtype=kind) if name in ("key", "doc", "h") else v
        at += n * kind.itemsize
    return out


def _cell_order(e: dict[str, np.ndarray]) -> np.ndarray:
    """Order by key, size, what tells sets apart, place; sorted by all of these only where key and size are the same."""
    rest = [e[c] for c in ("line", "h", "doc", "b2", "b1", "id1")]
    if int(e["size"].max(initial=0)) >> (64 - KEY_BITS):
        return np.lexsort((*rest, e["size"], e["key"]))
    both = e["key"] | e["size"].astype(np.uint64)
    order = np.argsort(both)
    same = np.diff(both[order]) == 0
    tied = np.flatnonzero(np.r_[False, same] | np.r_[same, False]) if len(same) else np.zeros(0, np.int64)
    some = order[tied]
    order[tied] = some[np.lexsort((*[c[some] for c in rest], both[some]))]
    return order


def _signatures(s: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128-bit parity of the words' hashes: each word flips one bit.  Small sets have it folded to 64 bits."""
    bit = s.word & np.uint64(127)
    one = np.uint64(1) << (bit & np.uint64(63))
    flip = lambda half: np.bitwise_xor.reduceat(np.where(bit >> np.uint64(6) == half, one, np.uint64(0)), s.first)
    b1, b2 = flip(0), flip(1)
    small = s.size <= FOLD
    return np.where(small, b1 ^ b2, b1), np.where(small, np.uint64(0), b2)


def _entries(min_tokens: int, threshold: float, words, crowds, doubled, buckets: int):
    """Packed prefix entries by bucket of cells."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for s in _kept_sets(batches, min_tokens, doubled):
            if not len(s.size):
                continue
            owner, word, pos = _in_order(s, words.value, threshold)
            first = seen.firsts(s)[owner]
            owner, word, pos = owner[first], word[first], pos[first]
            b1, b2 = _signatures(s)
            id1 = s.ids()[0] >> np.uint64(64 - ID_BITS)
            blocks = -(-crowds.value[_slot(word, TABLE_BITS)] // BLOCK)
            key, nth, side = word, np.arange(len(word)), np.full(len(word), 2, np.uint8)
            crowded = blocks > 1
            if crowded.any():
                c, plain = np.flatnonzero(crowded), np.flatnonzero(~crowded)
                n = blocks[c]
                own = np.repeat((id1[owner[c]] % n.astype(np.uint64)).astype(np.int64), n)
                c, total = np.repeat(c, n), np.repeat(n, n)
                other = np.arange(len(c)) - np.repeat(np.cumsum(n) - n, n)
                lo, hi = np.minimum(own, other), np.maximum(own, other)
                key = np.concatenate([word[plain], mix64(word[c] + (lo * total + hi + 1).astype(np.uint64) * MULT)])
                side = np.concatenate([side[plain], np.where(lo == hi, 2, own > other).astype(np.uint8)])
                nth = np.concatenate([plain, c])
            # words that share a key only add candidates
            key = key >> np.uint64(64 - KEY_BITS) << np.uint64(64 - KEY_BITS)
            order = np.argsort(key, kind="stable")
            nth = nth[order]
            at = owner[nth]
            fields = (key[order], id1[at], b1[at], b2[at], s.doc[at], s.h[at], s.place[at], s.size[at], pos[nth], side[order])
            e = {name: v.astype(_ENTRY[name], copy=False) for name, v in zip(_ENTRY.names, fields)}
            of = ((e["key"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            edge = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
            rows = [(int(of[a]), _pack_entries({c: v[a:z] for c, v in e.items()})) for a, z in zip(edge, np.r_[edge[1:], len(of)])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "entries"])

    return run


_PAIR = "doc long, h long, line long, doc2 long, h2 long, line2 long, more boolean"


def _pair_up(threshold: float):
    """Candidates of a bucket's cells: per later line the closest earlier ones."""
    share = threshold / (1 + threshold)

    def one(t: pa.Table) -> pa.Table:
        parts = [_unpack_entries(x) for x in t.column("entries").to_pylist()]
        e = {c: np.concatenate([p[c] for p in parts]) for c in _ENTRY.names}
        del parts
        order = _cell_order(e)
        e = {c: v[order] for c, v in e.items()}
        # a set met by several tasks: its earliest place stands for it
        again = np.zeros(len(order), bool)
        again[1:] = np.logical_and.reduce([e[c][1:] == e[c][:-1] for c in ("key", "id1", "size", "b1", "b2")])
        if again.any():
            e = {c: v[~again] for c, v in e.items()}
        rows = len(e["key"])
        size, left = e["size"].astype(np.int64), e["size"].astype(np.int64) - e["pos"]
        at_place = lambda i: (e["doc"][i], e["h"][i], e["line"][i])
        cell = np.cumsum(np.r_[False, e["key"][1:] != e["key"][:-1]]).astype(np.int64)
        widest = int(size.max(initial=0)) + 2
        rank = cell * widest + size
        limit = np.minimum(np.floor(size / threshold + 1e-9).astype(np.int64), widest - 1)
        n = np.searchsorted(rank, cell * widest + limit, side="right") - np.arange(rows) - 1
        done = np.cumsum(n)
        best = np.zeros((3, 0), np.int64)  # later, apart, earlier: at most BEST for each later one
        more = np.zeros(rows, bool)
        at = 0
        while at < rows:
            base = done[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(done, base + PAIRS_AT_ONCE, side="right")))
            a = np.repeat(np.arange(at, to), n[at:to])
            b = a + 1 + np.arange(len(a)) - np.repeat(done[at:to] - n[at:to] - base, n[at:to])
            at = to
            need = np.ceil(share * (size[a] + size[b]) - 1e-9).astype(np.int64)
            ok = np.minimum(left[a], left[b]) >= need
            ok &= (e["side"][a] == 2) | (e["side"][a] != e["side"][b])
            a, b, need = a[ok], b[ok], need[ok]
            x1, x2 = e["b1"][a] ^ e["b1"][b], e["b2"][a] ^ e["b2"][b]
            folded = np.minimum(size[a], size[b]) <= FOLD
            apart = np.where(folded, np.bitwise_count(x1 ^ x2), np.bitwise_count(x1) + np.bitwise_count(x2)).astype(np.int64)
            ok = apart <= size[a] + size[b] - 2 * need
            a, b, apart = a[ok], b[ok], apart[ok]
            a_later, b_later = _before(at_place(b), at_place(a)), _before(at_place(a), at_place(b))
            ok = a_later | b_later  # two words of one line may share a key
            a, b, apart, a_later = a[ok], b[ok], apart[ok], a_later[ok]
            if not len(a):
                continue
            both = np.concatenate([best, np.stack([np.where(a_later, a, b), apart, np.where(a_later, b, a)])], axis=1)
            both = both[:, np.lexsort((both[2], both[1], both[0]))]
            first = np.flatnonzero(np.r_[True, both[0, 1:] != both[0, :-1]])
            nth = np.arange(both.shape[1]) - np.repeat(first, np.diff(np.r_[first, both.shape[1]]))
            more[both[0, nth == BEST]] = True
            best = both[:, nth < BEST]
        x, _, y = best
        cols = [e[c][i].astype(np.int64) for i in (x, y) for c in ("doc", "h", "line")]
        return pa.table(dict(zip(("doc", "h", "line", "doc2", "h2", "line2"), cols)) | {"more": pa.array(more[x])})

    return one


_SECOND = "cell long, asks boolean, doc long, h long, line long, words array<long>"


def _size_class(size: np.ndarray, threshold: float) -> np.ndarray:
    """Sizes in steps of the threshold: sets of similar ones are at most one class apart."""
    size = np.asarray(size, np.int64)
    return size if threshold >= 1 else np.floor(np.log(size) / -math.log(threshold) + 1e-9).astype(np.int64)


def _in_class(word: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return mix64(word + kind.astype(np.uint64) * MULT)


def _prefix_slots(rare, threshold: float):
    """Slots of the prefix words of some lines with the size classes of their partners, for a bit set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots = [np.zeros(0, np.int64)]
            for w in b.column("words").to_pylist():
                w = np.array(w, np.int64).view(np.uint64)
                order = np.lexsort((w, rare.value[_slot(w, TABLE_BITS)]))
                keep = len(w) - math.ceil(threshold * len(w) - 1e-9) + 1
                kind = _size_class(np.array([len(w)]), threshold)
                slots += [_slot(_in_class(w[order[:keep]], kind + k), PLACE_BITS) for k in (-1, 0, 1)]
            yield from _emit_slots(np.unique(np.concatenate(slots)))

    return run


def _word_lists(s: Sets, lines: np.ndarray) -> pa.ListArray:
    size = s.size[lines]
    edge = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(int(edge[-1])) + np.repeat(s.first[lines] - edge[:-1], size)
    return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(s.word[at].view(np.int64)))


def _second_look(min_tokens: int, threshold: float, words, crowds, doubled, asking, wanted):
    """Lines with a prefix word that an asking line has, with all their words; ``asks`` marks askers.

    A line is filed under its size class and the block that its set falls into, an
    asker under the classes next to its own and all blocks of the word.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for s in _kept_sets(batches, min_tokens, doubled):
            id1 = s.ids()[0] >> np.uint64(64 - ID_BITS)
            owner, word, _ = _in_order(s, words.value, threshold)
            kind = _size_class(s.size, threshold)
            asks = _bit(asking.value, _place_slot(s.doc, s.h, s.place))
            first = seen.firsts(s)
            ok = first[owner] & (_bit(wanted.value, _slot(_in_class(word, kind[owner]), PLACE_BITS)) | asks[owner])
            owner, word = owner[ok], word[ok]
            blocks = np.maximum(1, -(-crowds.value[_slot(word, TABLE_BITS)] // BLOCK))
            asker = np.flatnonzero(asks[owner])
            n = np.repeat(blocks[asker], 3)
            ask, step = np.repeat(np.repeat(asker, 3), n), np.repeat(np.tile([-1, 0, 1], len(asker)), n)
            block = np.arange(len(ask)) - np.repeat(np.cumsum(n) - n, n)
            nth = np.concatenate([np.arange(len(owner)), ask])
            block = np.concatenate([(id1[owner] % blocks.astype(np.uint64)).astype(np.int64), block])
            filed_as = kind[owner[nth]] + np.concatenate([np.zeros(len(owner), np.int64), step])
            cell = _in_class(word[nth] ^ block.astype(np.uint64), filed_as).view(np.int64)
            i = owner[nth]
            cols = [cell, np.arange(len(nth)) >= len(owner), s.doc[i], s.h[i], s.place[i], _word_lists(s, i)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["cell", "asks", "doc", "h", "line", "words"])

    return run


def _verify_cells(threshold: float):
    """Asking lines that a line of their cell, earlier in place, is similar to."""

    def one(t: pa.Table) -> pa.Table:
        at = t.column_names.index("words")
        t = t.set_column(at, "words", t.column(at).cast(pa.large_list(pa.int64())))
        t = t.sort_by([("cell", "ascending"), ("asks", "ascending")]).combine_chunks()
        cell, asks = t.column("cell").to_numpy(), t.column("asks").to_numpy(zero_copy_only=False)
        place = np.stack([t.column(c).to_numpy() for c in ("doc", "h", "line")], axis=1)
        lists = t.column("words").chunk(0)
        words, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
        out = []
        edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(cell)]):
            mid = lo + int((~asks[lo:hi]).sum())
            if mid == lo or mid == hi:
                continue
            flat = words[edges[lo] : edges[mid]]
            size, first = np.diff(edges[lo : mid + 1]), edges[lo:mid] - edges[lo]
            for x in range(mid, hi):
                own = np.sort(words[edges[x] : edges[x + 1]])
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                shared = np.add.reduceat((own[at] == flat).astype(np.int64), first)
                near = np.flatnonzero((1 + threshold) * shared >= threshold * (size + len(own)) - 1e-9) + lo
                if any(tuple(place[y]) < tuple(place[x]) for y in near.tolist()):
                    out.append(x)
        return pa.table({n: pa.array(place[out, i], pa.int64()) for i, n in enumerate(("doc", "h", "line"))})

    return one


def _bit(bits: bytes, slot: np.ndarray) -> np.ndarray:
    return (np.frombuffer(bits, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _place_slot(doc: np.ndarray, h: np.ndarray, line: np.ndarray) -> np.ndarray:
    key = mix64(doc.astype(np.int64).view(np.uint64) * MULT + h.astype(np.int64).view(np.uint64)) + line.astype(np.uint64)
    return (mix64(key) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def _doc_slot(doc: np.ndarray) -> np.ndarray:
    return _slot(mix64(doc.view(np.uint64)), PLACE_BITS)


def _emit_slots(p: np.ndarray) -> Iterator[pa.RecordBatch]:
    per = (1 << PLACE_BITS) // CHUNKS
    cut = np.searchsorted(p, np.arange(CHUNKS + 1) * per)
    rows = [(c, pack((p[cut[c] : cut[c + 1]] - c * per).astype("<u4"))) for c in range(CHUNKS) if cut[c + 1] > cut[c]]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "slots"])


def _mark_places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from _emit_slots(np.unique(_place_slot(*(b.column(c).to_numpy() for c in ("doc", "h", "line")))))


def _mark_docs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from _emit_slots(np.unique(_doc_slot(b.column("doc").to_numpy())))


def _fill_places(t: pa.Table) -> pa.Table:
    out = np.zeros((1 << PLACE_BITS) // CHUNKS, bool)
    for s in t.column("slots").to_pylist():
        out[unpack(s, "<u4")] = True
    return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())})


def _bit_set(slots: DataFrame) -> bytes:
    """Bit set of fixed size; others may share a bit."""
    per = (1 << PLACE_BITS) // CHUNKS // 8
    out = bytearray(per * CHUNKS)
    for r in slots.groupBy("chunk").applyInArrow(_fill_places, "chunk int, bits binary").collect():
        out[r.chunk * per : (r.chunk + 1) * per] = r.bits
    return bytes(out)


def _asked(min_tokens: int, doubled, flags):
    """Sets and words of the lines whose place is in the bit set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _kept_sets(batches, min_tokens, doubled):
            at = np.flatnonzero(_bit(flags.value, _place_slot(s.doc, s.h, s.place)))
            cols = [x[at] for x in (s.doc, s.h, s.place, *(i.view(np.int64) for i in s.ids()))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), _word_lists(s, at)], ["doc", "h", "line", "id1", "id2", "words"])

    return run


def _take_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        n, gone, kept, emptied = [], [], [], []
        for text, lines in zip(*(b.column(c).to_pylist() for c in ("text", "lines"))):
            parts = [] if text is None else text.split("\n")
            out = set(lines or ())
            n.append(len(parts))
            gone.append(sorted(out))
            kept.append("\n".join(x for i, x in enumerate(parts) if i not in out) if out else text)
            emptied.append(bool(out) and not any(x.encode("utf-8").split() for i, x in enumerate(parts) if i not in out))
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("h"), pa.array(n, pa.int64()), pa.array(gone, pa.list_(pa.int64())), pa.array(kept, pa.string()), pa.array(emptied)],
            ["row", "text_hash", "n_lines", "removed", "kept_text", "emptied"],
        )


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, min_tokens: int = 1) -> DataFrame:
    """``(doc, h, line)`` of every line that goes; h is the text's xxhash64."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    both = checkpoint(_identified(docs, id_col, text_col).select("doc", "h", "text").mapInArrow(_write_sets, _SETS))
    sets = both.where("sets IS NOT NULL").select("sets")
    table, slots = "chunk int, counts binary", "chunk int, slots binary"
    # ids with several texts; most tables have none
    texts = both.where("sets IS NOT NULL").select("texts").mapInArrow(_texts, "doc long, h long")
    several = texts.groupBy("doc").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least < most").select("doc")
    doubled = share(_bit_set(several.mapInArrow(_mark_docs, slots)))
    words = share(_rarity(_collect_table(both.where("chunk IS NOT NULL").select("chunk", "counts"))))
    filed = _collect_table(sets.mapInArrow(_count_prefixes(min_tokens, threshold, words, doubled), table))
    crowds = share(filed)
    buckets = max(1, math.ceil(int(filed.sum()) / CELL_ROWS))

    place, place2 = ["doc", "h", "line"], ["doc2", "h2", "line2"]
    entries = sets.mapInArrow(_entries(min_tokens, threshold, words, crowds, doubled, buckets), "bucket long, entries binary")
    pairs = checkpoint(entries.groupBy("bucket").applyInArrow(_pair_up(threshold), _PAIR))
    one_each = pairs.select(*place, *place2).distinct()
    ends = one_each.select(*place).unionByName(one_each.select(*[F.col(b).alias(a) for a, b in zip(place, place2)]))
    asked = share(_bit_set(ends.mapInArrow(_mark_places, slots)))
    kind = ["id1", "id2"]
    lines = checkpoint(sets.mapInArrow(_asked(min_tokens, doubled, asked), "doc long, h long, line long, id1 long, id2 long, words array<long>").dropDuplicates(place))
    other = lines.select(*[F.col(a).alias(b) for a, b in zip(place, place2)], F.col("words").alias("words2"))
    shared = F.size(F.array_intersect("words", "words2"))
    alike = (1 + threshold) * shared >= threshold * (F.size("words") + F.size("words2")) - 1e-9
    similar = checkpoint(one_each.join(lines, place).join(other, place2).where(alike).select(*place, *kind).distinct())
    # second round: lines whose best candidates all failed, though there were more
    rest = pairs.where("more").select(*place).distinct().join(similar, place, "left_anti")
    rest = checkpoint(rest.join(lines, place).select(*place, *kind, "words"))
    if rest.limit(1).count():
        asking = share(_bit_set(rest.mapInArrow(_mark_places, slots)))
        wanted = share(_bit_set(rest.mapInArrow(_prefix_slots(words, threshold), slots)))
        second = sets.mapInArrow(_second_look(min_tokens, threshold, words, crowds, doubled, asking, wanted), _SECOND)
        grouped = second.withColumn("bucket", F.pmod(F.xxhash64("cell"), F.lit(buckets * 8))).groupBy("bucket")
        late = grouped.applyInArrow(_verify_cells(threshold), "doc long, h long, line long")
        similar = similar.unionByName(rest.join(late.distinct(), place, "left_semi").select(*place, *kind))
    places = sets.mapInArrow(_places(min_tokens), "id1 long, id2 long, doc long, h long, line long")
    at = F.struct(*place).alias("at")
    # sets that occur again, and sets similar to an earlier one: all their lines go, but for the first of the former
    marked = places.select(*kind, at, F.lit(False).alias("similar"))
    marked = marked.unionByName(similar.select(*kind, F.lit(None).cast(marked.schema["at"].dataType).alias("at"), F.lit(True).alias("similar")))
    going = marked.groupBy(*kind).agg(F.min("at").alias("first"), F.max("similar").alias("similar"), F.count("at").alias("times"))
    going = going.where("times > 1 OR similar").drop("times")
    return places.join(going, kind).where(F.col("similar") | (F.struct(*place) != F.col("first"))).select(*place)


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"))


def _with_mark(docs: DataFrame, per: DataFrame) -> DataFrame:
    """Adds ``marked``: true for every document of ``per``, by a broadcast bit set of fixed size; others may share a bit."""
    slot = F.pmod(F.xxhash64("doc", "h"), F.lit(1 << PLACE_BITS))
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(F.lit(63)).cast("int")
    bits = per.withColumns({"_word": word, "_bit": bit}).withColumn("_one", F.expr("shiftleft(1L, _bit)"))
    bits = bits.groupBy("_word").agg(F.bit_or("_one").alias("_bits"))
    met = docs.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")
    return met.withColumn("marked", F.coalesce(F.getbit("_bits", "_bit") == 1, F.lit(False))).drop("_word", "_bit", "_bits")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, min_tokens: int = 1, columns: list[str] | None = None
) -> DataFrame:
    """``(row, text_hash, n_lines, removed, kept_text, emptied)`` per row of ``docs``.

    ``row`` holds the row's ``columns`` (all of them by default) as a struct,
    ``removed`` the numbers of the lines that went, ``kept_text`` the rest,
    ``emptied`` whether lines went and no word is left.
    """
    with brief_shuffles(docs.sparkSession):
        gone = removed_lines(docs, id_col, text_col, threshold, min_tokens)
        # read twice: which documents lose lines, and which lines
        per = checkpoint(gone.groupBy("doc", "h").agg(F.collect_set("line").alias("lines")))
    text = F.col(text_col).cast("string")
    d = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62))).alias("doc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), text.alias("text"),
    )
    d = _with_mark(d, per)
    # only texts that lose a line are shuffled; the others pass by
    joined = d.where("marked").join(per, ["doc", "h"], "left").select("row", "h", "text", "lines")
    whole = d.where("NOT marked").select("row", "h", "text", F.lit(None).cast(joined.schema["lines"].dataType).alias("lines"))
    out = joined.unionByName(whole)
    row = out.schema["row"].dataType.simpleString()
    return out.mapInArrow(_take_out, f"row {row}, text_hash long, n_lines long, removed array<long>, kept_text string, emptied boolean")
