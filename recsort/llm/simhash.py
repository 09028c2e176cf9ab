"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code over the lowest 46 bits of a
fingerprint: two binary Golay codes of 23 bits side by side, each perfect with
radius 3, so every fingerprint has exactly one nearest anchor and lies within
R = 6 of it. A fingerprint lives at its nearest anchor and is replicated to
every anchor within R + t bits, t the link threshold. If x and y differ in at
most t bits, y lies within R + t of x's nearest anchor, so the pair meets there.
Per anchor, residents are compared with residents and visitors on all 64 bits.

Only distinct fingerprints are compared, an anchor hands on a spanning forest
of its links instead of the links, and components are taken over the forests.
Anchors with more than ``HOT`` residents are split into groups of equal bits:
fingerprints that differ in at most t of t + 3 pieces agree on three of them,
so each is sent to the groups of all its triples of pieces; nothing is dropped.

Defined results: texts of fewer words than a shingle are one shingle, texts
without words (null, empty, white space) have fingerprint 0 and are linked like
any other; null ids count as larger than any id; repeated rows are ordinary
copies, and exactly one row of each group is marked ``stays``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsort.llm.common import shuffle_partitions, staged, worker_state
from recsort.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
HOT = 4096
COMPARE = 1 << 22  # comparisons held at once

GOLAY = 0b110001110101  # generator polynomial of the binary Golay code of 23 bits
BLOCK = 23
RADIUS = 3


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    words = text.lower().split() if text else []  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text_col: str, keep: list[str], shingle: int) -> DataFrame:
    """Staged (uid, row, fp): the ``keep`` columns of each document and its fingerprint as a signed long."""
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    schema = f"row {src.schema['row'].dataType.simpleString()}, fp bigint"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["row", "fp"])

    return staged(src.mapInArrow(scan, schema).withColumn("uid", F.monotonically_increasing_id()), "simhash-docs")


def syndromes(x: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator; equal for words that differ by a code word."""
    x = x.copy()
    for bit in range(BLOCK - 1, 10, -1):
        x ^= (x >> bit & 1) * (GOLAY << (bit - 11))
    return x


def error_patterns(max_weight: int) -> tuple[np.ndarray, np.ndarray]:
    return worker_state(f"error patterns {max_weight}", lambda: _error_patterns(max_weight))


def _error_patterns(max_weight: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of up to ``max_weight`` bits ordered by (syndrome, weight), and where each (syndrome, weight) begins."""
    every = np.arange(1 << BLOCK, dtype=np.int64)
    weight = np.bitwise_count(every)
    every = every[weight <= max_weight]
    weight = np.bitwise_count(every).astype(np.int64)
    slot = syndromes(every) * (max_weight + 1) + weight
    order = np.argsort(slot, kind="stable")
    return every[order], np.searchsorted(slot[order], np.arange((max_weight + 1) * 2048 + 1))


def anchors(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which, anchor, resident): for each fingerprint every anchor within 2 * RADIUS + bits, and whether it is the nearest."""
    reach = 2 * RADIUS + bits
    patterns, begin = error_patterns(reach)
    mask = (1 << BLOCK) - 1
    low, high = (fps & mask).astype(np.int64), (fps >> np.uint64(BLOCK) & np.uint64(mask)).astype(np.int64)
    s1, s2 = syndromes(low) * (reach + 1), syndromes(high) * (reach + 1)
    nearest = patterns[begin[s1]], patterns[begin[s2]]
    out = []
    for w in range(reach + 1):  # bits to change in the low block; the high block has the rest
        from1, n1 = begin[s1 + w], begin[s1 + w + 1] - begin[s1 + w]
        from2, n2 = begin[s2], begin[s2 + reach - w + 1] - begin[s2]
        n = n1 * n2
        which = np.repeat(np.arange(len(fps)), n)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        e1, e2 = patterns[from1[which] + k // n2[which]], patterns[from2[which] + k % n2[which]]
        out.append((which, (low[which] ^ e1) | (high[which] ^ e2) << BLOCK, (e1 == nearest[0][which]) & (e2 == nearest[1][which])))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Forest:
    """Spanning forest of the links seen so far, by union of the smaller root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        p = self.parent.setdefault(x, x)
        while p != self.parent[p]:
            p = self.parent[p]
        self.parent[x] = p
        return p

    def link(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


class Resident:
    """Compares the rows of one anchor as they stream by, residents first."""

    def __init__(self, bits: int):
        self.bits, self.key, self.home, self.forest = bits, None, [], Forest()

    def feed(self, key: tuple, fps: np.ndarray, n_home: int) -> list[tuple[int, int]]:
        if key != self.key:
            self.key, self.home, self.forest = key, [], Forest()
        out = []
        if n_home:
            self.home.append(fps[:n_home])
        step = max(1, COMPARE // max(1, len(fps)))
        for home in self.home:
            for k in range(0, len(home), step):
                part = home[k:k + step]
                i, j = np.nonzero(np.bitwise_count(part[:, None] ^ fps[None, :]) <= self.bits)
                for x, y in zip(part[i].tolist(), fps[j].tolist(), strict=True):
                    if x != y and self.forest.link(x, y):
                        out.append((x, y))
        return out


def _links(rows: DataFrame, bits: int) -> DataFrame:
    """(a, b) links of a forest per (anchor, part), from rows sorted by (anchor, part, resident first)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Resident(bits)
        for batch in batches:
            key = batch.column("anchor").to_numpy(), batch.column("piece").to_numpy(), batch.column("bits").to_numpy()
            fps, home = batch.column("fp").to_numpy().view(np.uint64), batch.column("resident").to_numpy(zero_copy_only=False)
            new = np.r_[True, functools.reduce(np.logical_or, (k[1:] != k[:-1] for k in key))]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(fps)]
            n_home = np.add.reduceat(home.astype(np.int64), first) if len(first) else first
            out = []
            # Without a resident nothing is compared, except for an anchor that goes on from the batch before.
            busy = (n_home > 0) & ((last - first > 1) | (last == len(fps)))
            if len(busy):
                busy[0] = True
            for g in np.flatnonzero(busy).tolist():
                a = int(first[g])
                out += state.feed(tuple(int(k[a]) for k in key), fps[a:last[g]], int(n_home[g]))
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return rows.mapInArrow(compare, "a bigint, b bigint")


def link_fingerprints(distinct: DataFrame, bits: int, hot: int = HOT) -> DataFrame:
    """(a, b): links that join all of ``distinct`` (column fp, no repeats) that are linked, without all of the pairs."""
    spark = distinct.sparkSession

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(fps), 2000):
                part = fps[k:k + 2000]
                which, anchor, resident = anchors(part, bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(resident), pa.array(part[which].view(np.int64))], ["anchor", "resident", "fp"])

    rows = distinct.mapInArrow(cover, "anchor bigint, resident boolean, fp bigint")
    crowded = rows.filter("resident").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("anchor").checkpoint()
    whole = [F.lit(-1).alias("piece"), F.lit(0).cast("bigint").alias("bits")]
    if crowded.take(1):
        masks = _piece_masks(bits)
        parts = F.array(*[F.struct(F.lit(k).alias("piece"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(masks)])
        split = rows.join(crowded, "anchor", "left_semi").withColumn("p", F.explode(parts)).select("anchor", "resident", "fp", "p.piece", "p.bits")
        rows = rows.join(crowded, "anchor", "left_anti").select("anchor", "resident", "fp", *whole).unionByName(split)
    else:
        rows = rows.select("anchor", "resident", "fp", *whole)
    key = ["anchor", "piece", "bits"]
    rows = rows.repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, F.col("resident").desc())
    return _links(rows, bits).distinct()


def _piece_masks(bits: int) -> list[int]:
    """Masks (as signed longs) of every triple of bits + 3 pieces of the 64 bits."""
    cuts = [64 * k // (bits + 3) for k in range(bits + 4)]
    piece = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [functools.reduce(int.__or__, c) for c in combinations(piece, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                    shingle: int = SHINGLE, bits: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """``row`` (the ``keep`` columns, or all), fp, component_id (smallest id of the group) and stays, for every document."""
    rows = with_fingerprints(docs, text_col, list(dict.fromkeys([id_col, *(keep or docs.columns)])), shingle)
    rows = rows.withColumn("id", F.col(f"row.`{id_col}`"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("uid").alias("uid"))).alias("first")
    distinct = staged(rows.groupBy("fp").agg(first), "simhash-distinct")
    labels = components(link_fingerprints(distinct.select("fp"), bits, hot)).withColumnRenamed("node", "fp")
    own = distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")).checkpoint()
    heads = own.groupBy("label").agg(F.min("first").alias("head")).checkpoint()
    groups = own.select("fp", "label").join(heads, "label").select("fp", "head").checkpoint()
    out = rows.join(groups, "fp")
    return out.select("row", "fp", F.col("head.id").alias("component_id"), (F.col("uid") == F.col("head.uid")).alias("stays"))


def fingerprint_text(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
