"""SimHash near-duplicate groups by multi-index hashing.

A document's fingerprint is the per-bit majority of the XXH64 (seed 42) values
of its word shingles.  Fingerprints link at ``max_distance`` or fewer differing
bits; a group is a connected component.

Multi-index hashing: the 64 bits are cut into ``m`` segments.  With
``r = max_distance = m * q + a``, two linked fingerprints differ in at most
``q`` bits in one of the first ``a + 1`` segments or in at most ``q - 1`` bits
in one of the others.  Each fingerprint stands in a table under its own
segment values and asks for every value in the small Hamming ball around them;
table matches are verified over all 64 bits.  There are three segments, and two
beyond 2**27 fingerprints, so that a segment value stays shared by few of them;
every choice finds every link.

Skew: equal fingerprints collapse before the search.  A segment value shared by
more than ``CELL`` fingerprints is cut into blocks; each asker visits every
block, so no task holds the whole value.  A task verifies its cells in numpy
and returns only the links that join two of its parts (a spanning forest), not
all pairs.

Edge cases: null or empty text has fingerprint zero and links like any other;
documents with a null id are returned with the group of their fingerprint (null
if no document of the group has an id); repeated rows give repeated rows, and
rows of one id with different texts are linked by their own fingerprints;
columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.graph import connected_components
from riskfeat.llm.textops import LOWER_BYTES, slices
from riskfeat.session import checkpoint

BITS = 64
SEED = 42  # contract: XXH64 with seed 42
CELL = 1024  # table rows of one segment value that one task cell holds
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str | None, shingle: int) -> int:
    """Fingerprint of one text as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - [len(w) + 1 for w in words]).tolist()
        stops = (ends - 1)[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, stops)]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 4096):
        ones += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(doc, fp)`` for every row; fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(fp.view(np.int64))], ["doc", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc long, fp long")


def segments(n_rows: int, distance: int) -> list[tuple[int, int, int]]:
    """``(low bit, width, ball radius)`` per segment; radius -1 is never searched."""
    m = 3 if n_rows <= 1 << 27 else 2
    q, a = divmod(distance, m)
    out, low = [], 0
    for i in range(m):
        width = BITS // m + (1 if i < BITS % m else 0)
        out.append((low, width, q if i <= a else q - 1))
        low += width
    return out


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` ones, zero first."""
    return [sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(width), k)]


class _Forest:
    """Union-find over the rows that one task batch links."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(p, p)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _verify(distance: int):
    """Sorted cell rows to linking pairs; a cell's rows are table rows, then askers."""

    def pairs(cell: np.ndarray, asks: np.ndarray, fp: np.ndarray, node: np.ndarray, out: list[tuple[int, int]]) -> None:
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        size = np.diff(np.r_[first, len(cell)])
        tables = np.add.reduceat((~asks).astype(np.int64), first)
        forest = _Forest()
        # every asker row meets every table row of its cell
        per = np.repeat(tables, size)
        per[~asks] = 0
        begin = np.repeat(first, size)
        who = np.flatnonzero(per)
        at = 0
        todo = np.cumsum(per[who])
        while at < len(who):
            base = todo[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(todo, base + PAIRS_AT_ONCE, side="right")))
            w = who[at:to]
            n = per[w]
            a = np.repeat(w, n)
            b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[w], n)
            ok = (np.bitwise_count(fp[a] ^ fp[b]) <= distance) & (node[a] != node[b])
            if ok.any():
                x, y = node[a[ok]], node[b[ok]]
                lo, hi = np.minimum(x, y), np.maximum(x, y)
                for p, q in dict.fromkeys(zip(hi.tolist(), lo.tolist())):
                    if forest.join(p, q):
                        out.append((p, q))
            at = to

    def flush(t: pa.Table) -> pa.RecordBatch:
        col = lambda c: t.column(c).to_numpy()
        out: list[tuple[int, int]] = []
        pairs(col("cell"), col("asks"), col("fp").view(np.uint64), col("node"), out)
        u, v = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None and held.num_rows else t
            if not t.num_rows:
                continue
            cells = t.column("cell").to_numpy()
            cut = int(np.searchsorted(cells, cells[-1], side="left"))  # the last cell may go on
            if cut:
                yield flush(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield flush(held)

    return run


def _asked(segment: int, value: Column):
    """A mask to the key of the segment value it leads to."""
    return lambda mask: F.struct(F.xxhash64(F.lit(segment), value.bitwiseXOR(mask)).alias("key"), F.lit(True).alias("asks"))


def links(nodes: DataFrame, distance: int, n_rows: int) -> DataFrame:
    """Forest edges ``(u, v)`` between the rows of ``nodes (node, fp)`` (distinct fp)."""
    spark = nodes.sparkSession
    table, asker = [], []
    fp = F.col("fp")
    for s, (low, width, radius) in enumerate(segments(n_rows, distance)):
        if radius < 0:
            continue
        value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else fp
        key = F.xxhash64(F.lit(s), value)
        table.append(F.array(F.struct(key.alias("key"), F.lit(False).alias("asks"))))
        asker.append(F.transform(F.array(*[F.lit(x) for x in ball(width, radius)]), _asked(s, value)))
    rows = nodes.select("node", "fp", F.explode(F.concat(*table, *asker)).alias("r")).select("node", "fp", "r.key", "r.asks")
    hot = checkpoint(
        nodes.select(F.explode(F.concat(*table)).alias("r"))
        .groupBy(F.col("r.key").alias("key")).count()
        .where(F.col("count") > CELL)
        .select("key", F.ceil(F.col("count") / CELL).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    each = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).when(
        F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)
    ).otherwise(F.array(block))
    # askers of one value are dealt over parts as well, each part with every block
    part = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).when(
        F.col("asks"), F.array(F.pmod(F.xxhash64("fp", F.lit(9)), F.col("blocks")).cast("int"))
    ).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = (
        rows.join(hot, "key", "left")
        .withColumn("b", F.explode(each))
        .withColumn("p", F.explode(part))
        .select(F.xxhash64("key", "b", "p").alias("cell"), "asks", "node", "fp")
    )
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = cells.repartition(n, "cell").sortWithinPartitions("cell", "asks")
    return dealt.mapInArrow(_verify(distance), "u long, v long")


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int) -> DataFrame:
    """``(doc, fp, component, root)`` per row of ``docs``; root tells groups apart, also those of one least id."""
    fps = checkpoint(fingerprints(docs, id_col, text_col, shingle))
    # a fingerprint is a node of its own, its least id a label: rows of one id may differ in text
    reps = checkpoint(fps.groupBy("fp").agg(F.min("doc").alias("label")))
    named = reps.where(F.col("label").isNotNull()).withColumn("node", F.col("fp"))
    roots = connected_components(links(named.select("node", "fp"), max_distance, named.count()))
    rooted = checkpoint(named.join(roots, named.node == roots.u, "left").select("fp", "label", F.coalesce("root", "node").alias("root")))
    least = checkpoint(rooted.groupBy("root").agg(F.min("label").alias("component")))
    comp = rooted.join(least, "root").select("fp", "component", "root")
    return fps.join(comp, "fp", "left").select("doc", "fp", "component", "root")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """``(id, fingerprint long, component)`` per row of ``docs``."""
    groups = _groups(docs, id_col, text_col, shingle, max_distance)
    return groups.select(F.col("doc").alias(id_col), F.col("fp").alias("fingerprint"), "component")


def hex16(col) -> Column:
    """A long's 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def _judged(rows: DataFrame, groups: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Of rows whose ids repeat, one for each group of which the id is the least."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc"), b.column("h"), pa.array(fp.view(np.int64))], ["row", "doc", "h", "fp"])

    text = F.col(text_col).cast("string")
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))
    marked = whole.mapInArrow(run, f"row {whole.schema['row'].dataType.simpleString()}, doc long, h long, fp long")
    own = groups.where(F.col("component") == F.col("doc")).select("doc", "fp", "root").distinct()
    first = marked.join(own, ["doc", "fp"]).groupBy("doc", "root").agg(F.min_by("row", F.struct("fp", "h")).alias("row"))
    return first.select(*[F.col("row").getField(c).alias(c) for c in rows.columns])


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, one row of each group.

    Rows of one id whose texts are in different groups are judged each by its
    own.  Rows without an id cannot be told from their copies by id and stay.
    """
    groups = checkpoint(_groups(docs, id_col, text_col, shingle, max_distance).where(F.col("doc").isNotNull()))
    ids = checkpoint(groups.groupBy("doc").agg(F.count("*").alias("n"), F.max("component").alias("most")).withColumnRenamed("doc", id_col))
    # an id whose rows are all in groups of smaller ids goes
    kept = docs.join(ids.where(F.col("most") < F.col(id_col)).select(id_col), id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    twice = ids.where((F.col("n") > 1) & (F.col("most") == F.col(id_col))).select(id_col)
    if twice.limit(1).count():
        again = docs.join(twice, id_col, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
        kept = kept.join(twice, id_col, "left_anti").unionByName(_judged(again, groups, id_col, text_col, shingle))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
