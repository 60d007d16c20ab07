"""Removal of repeated substrings by longest-previous-factor arrays.

A byte is removed when a ``length``-byte string covers it that also starts
somewhere else in the corpus; with ``keep="first"`` the first start (by id and
position) stays and only later ones go.

The corpus is never in one suffix array.  Every ``length``-byte window chooses
an anchor, the leftmost smallest hash of the ``GRAM``-byte strings in it, so
equal windows choose equal anchors and meet under the anchor's hash:

1. anchor hashes are counted into a bit set of fixed size (``filter_bits``);
   anchors that no other can equal are dropped in the scan.  A full bit set
   only lets more anchors through, it never loses one;
2. an anchor's context holds the windows that choose it.  Equal contexts
   collapse into one with a count (pre-aggregated, so a passage in a third of
   the documents is one row per task); a context that occurs twice repeats
   whole;
3. of different contexts under one anchor, one representative each goes to a
   bucket of bounded bytes.  There the windows are taken in runs by their offset
   to the anchor: a run whose common bytes are met once repeats nowhere, and
   equal runs collapse; over those left, suffix order and the previous and next
   smaller positions find each window's longest earlier factor;
4. an anchor with more than ``HOT`` different contexts is not put into one
   bucket: its windows are matched one by one by their digests.

Documents are identified by id and text hash; rows equal in both share their
result.  Edge cases: null text is empty; texts under ``length`` bytes lose
nothing; null ids are allowed; empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.lpf import previous_factor
from riskfeat.llm.textops import MULT, byte_view, mix64, slices
from riskfeat.session import checkpoint

GRAM = 48
HOT = 1 << 14  # different contexts of one anchor that a bucket takes (a few MB)
BUCKET_BYTES = 2 << 20
RUN = 32  # windows that are looked at together
CHUNK = 4 << 20  # bytes whose anchors are found at once
CHUNKS = 32  # of the bit set, each built by one task
POS_BITS = 24


def _gram_keys(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes that start at each position.

    Polynomial hashes of 1, 2, 4, ... bytes by doubling; those whose lengths add
    up to GRAM are put together.
    """
    power = lambda n: np.uint64(pow(int(MULT), n, 1 << 64))
    h, have = data.astype(np.uint64) + np.uint64(1), 1
    out, length = None, 0
    while True:
        if GRAM & have:
            n = len(data) - length - have + 1
            out = h if out is None else h[:n] * power(length) + out[have : have + n]
            length += have
        if have * 2 > GRAM:
            return mix64(out)
        h = h[:-have] * power(have) + h[have:]
        have *= 2


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One text's anchors: positions, hashes, first and last start of the windows that choose them."""
    if len(data) < length:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z
    chosen, hashes = [], []
    for at in range(0, len(data) - length + 1, CHUNK):
        h = _gram_keys(data[at : at + CHUNK + length - 1])
        low = np.uint64((1 << POS_BITS) - 1)
        least, have = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
        width = length - GRAM + 1
        while have * 2 <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < width:
            least = np.minimum(least[: have - width], least[width - have :])
        pos = (least & low).astype(np.int64)
        new = np.flatnonzero(np.r_[True, pos[1:] != pos[:-1]])
        chosen.append(np.stack([pos[new] + at, new + at]))
        hashes.append(h[pos[new]])
    (pos, first), h = np.concatenate(chosen, axis=1), np.concatenate(hashes)
    new = np.r_[True, pos[1:] != pos[:-1]]  # the windows of one anchor may be met in two chunks
    pos, h, first = pos[new], h[new], first[new]
    return pos, h, first, np.r_[first[1:] - 1, len(data) - length]


def _scan(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches with (row, text bytes, anchors) of their texts that have a window."""
    for b in slices(batches, "text"):
        data, offs = byte_view(b.column("text"))
        yield b, [
            (i, data[offs[i] : offs[i + 1]], anchors(data[offs[i] : offs[i + 1]], length)) for i in range(b.num_rows) if offs[i + 1] - offs[i] >= length
        ]


def _passes(flags: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set."""
    bits = np.frombuffer(flags, np.uint8)
    slot = _slot(hashes, len(bits) * 8)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _place_hash(doc: np.ndarray | int, h: np.ndarray | int, first: np.ndarray) -> np.ndarray:
    """Hash of a context's document and start."""
    to = lambda v: np.atleast_1d(np.asarray(v, np.int64)).view(np.uint64)
    return mix64(mix64(to(doc) * MULT + to(h)) + to(first))


def _slot(h: np.ndarray, size: int) -> np.ndarray:
    return ((h * MULT) >> np.uint64(64 - (size - 1).bit_length())).astype(np.int64)


_SLOTS = pa.schema([("chunk", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])


def _emit_slots(length: int, bits: int):
    """Slots of each slice's anchors: those met once and those met more often, by chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, out in _scan(batches, length):
            if not out:
                continue
            slot, n = np.unique(_slot(np.concatenate([a[1] for *_, a in out]), bits), return_counts=True)
            per = bits // CHUNKS
            cut = np.searchsorted(slot, np.arange(CHUNKS + 1) * per)
            rows = []
            for c in range(CHUNKS):
                s, m = slot[cut[c] : cut[c + 1]] - c * per, n[cut[c] : cut[c + 1]]
                if len(s):
                    rows.append((c, s[m == 1].astype("<u4").tobytes(), s[m > 1].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(_SLOTS.names, r)) for r in rows], schema=_SLOTS)

    return run


def _fill(bits: int):
    def one(t: pa.Table) -> pa.Table:
        seen, more = np.zeros(bits // CHUNKS, bool), np.zeros(bits // CHUNKS, bool)
        for once, again in zip(t.column("once").to_pylist(), t.column("more").to_pylist()):
            s = np.frombuffer(once, "<u4")
            more[s[seen[s]]] = True
            seen[s] = True
            s = np.frombuffer(again, "<u4")
            seen[s] = more[s] = True
        return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(more, bitorder="little").tobytes()], pa.binary())})

    return one


def _bit_set(rows, bits: int) -> bytes:
    out = bytearray(bits // 8)
    per = bits // 8 // CHUNKS
    for r in rows:
        out[r.chunk * per : (r.chunk + 1) * per] = r.bits
    return bytes(out)


def _emit_occurrences(length: int, flags):
    """(anchor, context digest, doc, hash, first, last) of the anchors that pass."""
    names = ["anchor", "c1", "c2", "doc", "h", "lo", "hi"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, out in _scan(batches, length):
            cols: list[list] = [[] for _ in names]
            doc, key = b.column("doc").to_pylist(), b.column("h").to_pylist()
            for i, own, (pos, h, first, last) in out:
                ok = _passes(flags.value, h)
                if not ok.any():
                    continue
                pos, h, first, hi = pos[ok], h[ok], first[ok], last[ok] + length
                raw = own.tobytes()
                # where the anchor stands in its context is part of the context
                d = [xxhash.xxh3_128_digest(raw[x:y], z) for x, y, z in zip(first.tolist(), hi.tolist(), (pos - first).tolist())]
                d = np.frombuffer(b"".join(d), "<i8").reshape(-1, 2)
                for c, v in zip(cols, (h.view(np.int64), d[:, 0], d[:, 1], np.full(len(pos), doc[i]), np.full(len(pos), key[i]), first, hi)):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names)

    return run


_CONTEXT = "anchor long, doc long, h long, lo long, at long, bytes binary"


def _emit_contexts(length: int, flags):
    """The contexts whose place is in the bit set; ``at`` is the anchor's offset."""
    kinds = [("anchor", pa.int64()), ("doc", pa.int64()), ("h", pa.int64()), ("lo", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, out in _scan(batches, length):
            doc, key = b.column("doc").to_pylist(), b.column("h").to_pylist()
            cols: list[list] = [[] for _ in kinds]
            for i, own, (pos, h, first, last) in out:
                ok = _passes(flags.value, _place_hash(doc[i], key[i], first))
                raw = own.tobytes()
                for p, a, x, y in zip(pos[ok].tolist(), h[ok].view(np.int64).tolist(), first[ok].tolist(), last[ok].tolist()):
                    for c, v in zip(cols, (a, doc[i], key[i], x, p - x, raw[x : y + length])):
                        c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, kinds)], [n for n, _ in kinds])

    return run


_SPANS = "doc long, h long, lo long, hi long"


def _match_bucket(length: int, first: bool):
    """Repeated windows among a bucket's contexts, as spans."""

    def one(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc", "ascending"), ("h", "ascending"), ("lo", "ascending")])
        rows = list(zip(*(t.column(c).to_pylist() for c in ("anchor", "doc", "h", "lo", "at", "bytes"))))
        runs: dict[tuple, list] = {}  # same anchor, offsets and common bytes: place order
        last = None
        for i, (anchor, doc, h, lo, at, raw) in enumerate(rows):
            if (doc, h, lo) == last:
                continue  # one place listed twice
            last = (doc, h, lo)
            windows = len(raw) - length + 1
            for k in range((at - windows + 1) // RUN, at // RUN + 1):
                # windows that start RUN * k to RUN * k + RUN - 1 bytes before the anchor
                x, y = max(at - RUN * k - RUN + 1, 0), min(at - RUN * k, windows - 1)
                common = raw[at - RUN * k : at - RUN * k - RUN + 1 + length]
                runs.setdefault((anchor, k, xxhash.xxh3_128_digest(common)), []).append((i, x, y))
        spans: list[tuple[int, int, int]] = []  # row, start, end
        pieces: list[tuple[int, int, int]] = []
        for own in runs.values():
            if len(own) < 2:
                continue
            same: dict[bytes, list] = {}
            for i, x, y in own:
                same.setdefault(rows[i][5][x : y + length], []).append((i, x, y))
            for group in same.values():
                spans += [(i, x, y + length) for i, x, y in (group[1:] if first else group if len(group) > 1 else ())]
            if len(same) > 1:
                pieces += [group[0] for group in same.values()]
        pieces.sort()
        if pieces:
            text = np.frombuffer(b"".join(rows[i][5][x : y + length] for i, x, y in pieces), np.uint8)
            n = np.array([y - x + 1 for _, x, y in pieces])
            base = np.cumsum(n + length - 1) - (n + length - 1)
            piece = np.repeat(np.arange(len(pieces)), n)
            offset = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
            starts = base[piece] + offset
            back = previous_factor(text, starts, length)
            hit = back >= 0
            if not first:  # the earlier one goes too
                hit[np.searchsorted(starts, back[hit])] = True
            hit = np.flatnonzero(hit)
            new = np.flatnonzero(np.r_[True, (piece[hit[1:]] != piece[hit[:-1]]) | (hit[1:] > hit[:-1] + 1)]) if len(hit) else hit
            for a, z in zip(new.tolist(), np.r_[new[1:] - 1, len(hit) - 1].tolist() if len(hit) else []):
                i, x, _ = pieces[piece[hit[a]]]
                spans.append((i, x + int(offset[hit[a]]), x + int(offset[hit[z]]) + length))
        cols = [[rows[i][1] for i, *_ in spans], [rows[i][2] for i, *_ in spans], [rows[i][3] + x for i, x, _ in spans], [rows[i][3] + y for i, _, y in spans]]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc", "h", "lo", "hi"), cols)})

    return one


def _windows(length: int):
    """(digest, doc, h, lo) of every window in a hot anchor's context."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                cols: list[list] = [[], [], [], []]
                for d, h, lo, x in zip(*(part.column(c).to_pylist() for c in ("doc", "h", "lo", "bytes"))):
                    for i in range(len(x) - length + 1):
                        for c, v in zip(cols, (xxhash.xxh3_128_digest(x[i : i + length]), d, h, lo + i)):
                            c.append(v)
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["digest", "doc", "h", "lo"])

    return run


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join each text's spans and take them out."""
    for b in slices(batches, "text"):
        texts, spans = b.column("text").to_pylist(), b.column("spans").to_pylist()
        n_bytes, removed, merged, kept = [], [], [], []
        for t, own in zip(texts, spans):
            raw = (t or "").encode("utf-8")
            runs: list[list[int]] = []
            for s in sorted((s["lo"], s["hi"]) for s in own or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append([s[0], s[1]])
            at, rest = 0, []
            for lo, hi in runs:
                rest.append(raw[at:lo])
                at = hi
            rest.append(raw[at:])
            kept.append(b"".join(rest))
            n_bytes.append(len(raw))
            removed.append(len(raw) - len(kept[-1]))
            merged.append([{"start": x, "stop": y} for x, y in runs])
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(merged, span), pa.array(kept, pa.binary())],
            ["id", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame,
    length: int = 200,
    keep: str = "first",
    id_col: str = "doc_id",
    text_col: str = "text",
    filter_bits: int = 1 << 27,
) -> DataFrame:
    """``(id, n_bytes, n_removed, spans, kept)`` per row of ``docs``.

    ``keep="first"`` leaves the first start of each repeated string, ``"none"``
    removes every one.  ``spans`` are the removed runs, ``kept`` the other bytes.
    """
    if keep not in ("first", "none") or length <= GRAM:
        raise ValueError("keep is 'first' or 'none'; length is over GRAM")
    first = keep == "first"
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    rows = rows.withColumn("doc", F.coalesce("id", F.lit(-1)))
    d = rows.select("doc", "h", "text")

    def flags(slots: DataFrame):
        filled = slots.groupBy("chunk").applyInArrow(_fill(filter_bits), "chunk int, bits binary")
        return spark.sparkContext.broadcast(_bit_set(filled.collect(), filter_bits))

    shared = flags(d.select("text").mapInArrow(_emit_slots(length, filter_bits), "chunk int, once binary, more binary"))
    occ = d.mapInArrow(_emit_occurrences(length, shared), "anchor long, c1 long, c2 long, doc long, h long, lo long, hi long")
    occ = checkpoint(occ)
    place = F.struct("doc", "h", "lo")
    same = checkpoint(occ.groupBy("anchor", "c1", "c2").agg(F.count("*").alias("n"), F.min(place).alias("at")))
    whole = occ.join(same.where("n > 1"), ["anchor", "c1", "c2"])
    if first:
        # rows equal in id, text and place are one document listed again: all stay or all go
        whole = whole.where(place != F.col("at"))
    spans = whole.select("doc", "h", "lo", "hi")
    kinds = same.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    check = checkpoint(same.join(kinds, "anchor").select("kinds", "at.doc", "at.h", "at.lo"))

    def contexts(which: str) -> tuple[int, DataFrame | None]:
        own = check.where(which)
        n = own.count()
        if not n:
            return 0, None
        mark = flags(own.mapInArrow(_place_slots(filter_bits), "chunk int, once binary, more binary"))
        return n, d.mapInArrow(_emit_contexts(length, mark), _CONTEXT)

    n, cold = contexts(f"kinds <= {HOT}")
    if n:
        buckets = max(1, -(-n * (2 * length - GRAM) // BUCKET_BYTES))
        grouped = cold.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket")
        spans = spans.unionByName(grouped.applyInArrow(_match_bucket(length, first), _SPANS))
    n, hot = contexts(f"kinds > {HOT}")
    if n:
        each = hot.mapInArrow(_windows(length), "digest binary, doc long, h long, lo long")
        often = each.groupBy("digest").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a != z")
        again = each.join(often, "digest")
        if first:
            again = again.where(place != F.col("a"))
        spans = spans.unionByName(again.select("doc", "h", "lo", (F.col("lo") + length).alias("hi")).distinct())
    per = spans.groupBy("doc", "h").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    done = rows.join(per, ["doc", "h"], "left").select("id", "text", "spans").mapInArrow(
        _cut, "id long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary"
    )
    return done.withColumnRenamed("id", id_col)


def _place_slots(bits: int):
    """Slots of places, each marked as met more than once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = np.unique(_slot(_place_hash(*(b.column(c).to_numpy() for c in ("doc", "h", "lo"))), bits))
            per = bits // CHUNKS
            cut = np.searchsorted(slot, np.arange(CHUNKS + 1) * per)
            rows = [(c, b"", (slot[cut[c] : cut[c + 1]] - c * per).astype("<u4").tobytes()) for c in range(CHUNKS) if cut[c + 1] > cut[c]]
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(_SLOTS.names, r)) for r in rows], schema=_SLOTS)

    return run
