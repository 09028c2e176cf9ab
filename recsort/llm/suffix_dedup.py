"""Exact substring dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every byte that lies in a string of ``length`` bytes which also starts earlier
in the corpus goes. The corpus is cut into contexts that can be compared
without the rest of it: each window of ``length`` bytes is represented by its
minimizer, the smallest hash among its ``GRAM``-byte grams (leftmost on ties),
so equal windows have equal minimizers at equal places. A context is the text
under the windows that one occurrence of a minimizer represents. Only
minimizers that occur twice in the corpus are looked at further. Equal contexts
are one string: partial aggregates keep the first place and call the others'
windows repeats, which also keeps hot passages from meeting in one task.

Minimizers with several distinct contexts, whose windows may agree in part, are
joined into one text per block (separators between contexts) and its
Burrows-Wheeler transform is taken. Intervals of rotations that share a prefix
are expanded breadth-first by backward extension: a boundary that is seen for
the first time at depth d has common prefix d, so prefixes are derived by
increasing value. At depth ``length`` it stops: rotations without a boundary
between them start with equal windows, and the first place of each such run is
the one that stays.

A task takes blocks of about ``BLOCK_BYTES``, cut between minimizers. A
minimizer with more distinct contexts than that is taken in passes, each over
the contexts whose windows fall into one class by a hash of their bytes.

Defined results: null text is empty; texts shorter than ``length`` lose
nothing; null ids come after all others; rows that repeat id and text are the
same document (no repeats of each other, equal results), rows that repeat the
id alone are ordered by a hash of the text; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsort.llm.common import shuffle_partitions, staged

LENGTH = 100
GRAM = 32
BLOCK_BYTES = 1 << 20
WIDE = 32  # rotations whose characters are counted rather than looked at
PLACE = np.uint64((1 << 24) - 1)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of every ``gram`` bytes (a power of two) of ``data``."""
    h, step = data.astype(np.uint64) + np.uint64(1), 1
    while step < gram:
        h = h[:-step] * (MULTIPLIER + np.uint64(2 * step)) + h[step:]
        h ^= h >> np.uint64(32)
        step *= 2
    return h * np.uint64(0xBF58476D1CE4E5B9)


def sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` values."""
    low, have = h, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low


def minimizers(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(hash, text, first window, last window, gram's place after the first window) of the minimizers of texts laid end to end.

    Windows that would reach from one text into the next are none.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return np.zeros(0, np.uint64), none, none, none, none
    h = gram_hashes(data, gram)
    # The place in the low bits makes the leftmost gram the smallest among equal ones.
    low = sliding_minimum((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    at = np.arange(len(low))
    text = np.searchsorted(ends, at, "right")
    at = at[inside := text == np.searchsorted(ends, at + length - 1, "right")]
    if not len(at):
        return np.zeros(0, np.uint64), none, none, none, none
    place, text = (low[at] & PLACE).astype(np.int64), text[inside]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:], len(at)] - 1
    return h[place[first]], text[first], at[first], at[last], place[first] - at[first]


def rotations(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the rotations of ``data`` (small integers) in the order of their first ``depth`` characters or more, by doubling."""
    key = data.astype(np.uint64)
    for k in (1, 2, 4):
        key = key << np.uint64(8 * k) | np.roll(key, -k)
    known = 8
    while True:
        order = np.argsort(key)
        if known >= depth:
            return order
        ranked = key[order]
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]])
        if rank[order[-1]] == len(key) - 1:
            return order
        key = rank << np.uint64(32) | np.roll(rank, -known)
        known *= 2


def long_prefixes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations in order, and whether each shares its first ``length`` characters with the one before it.

    Breadth-first expansion of intervals of the Burrows-Wheeler transform: an
    interval holds the rotations with some prefix of d characters, one step of
    backward extension gives those of the prefixes one character longer, and a
    boundary that no shorter prefix had drawn has a common prefix of d. Only
    intervals that draw a boundary go on; after ``length`` steps it stops.
    """
    n = len(data)
    order = rotations(data, length)
    before = data[order - 1]  # the transform: the character before each rotation
    count = np.bincount(before, minlength=256)
    begin = (np.cumsum(count) - count).astype(np.int32)
    by_character = np.argsort(before, kind="stable").astype(np.int32)
    step = np.empty(n, np.int32)  # where the rotation that starts one earlier stands
    step[by_character] = np.arange(n, dtype=np.int32)
    rows_of = {c: by_character[begin[c]:begin[c] + count[c]] for c in np.flatnonzero(count).tolist()}
    drawn = np.zeros(n + 1, bool)
    drawn[0] = drawn[n] = True
    low, high = np.zeros(1, np.int32), np.full(1, n, np.int32)
    for _ in range(length):
        size = high - low
        # A single rotation steps back by itself, and so do two that differ in the character before them.
        two = low[size == 2]
        alike = before[two] == before[two + 1]
        pair, apart = step[two[alike]], two[~alike]
        to = step[np.concatenate([low[size == 1], apart, apart + 1])]
        lows, highs = [to, pair], [to + 1, pair + 2]
        # Few rotations: their characters are looked at.
        if len(own := np.flatnonzero((size > 2) & (size <= WIDE))):
            n_own = size[own]
            row = np.repeat(low[own] - (np.cumsum(n_own) - n_own), n_own) + np.arange(n_own.sum())
            key = np.repeat(np.arange(len(own), dtype=np.int32) << 8, n_own) | before[row]
            by_key = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.r_[True, (k := key[by_key])[1:] != k[:-1]])
            to = step[row[by_key[first]]]
            lows.append(to)
            highs.append(to + np.diff(np.r_[first, len(key)]).astype(np.int32))
        # Many rotations: each character's rows within the interval are counted.
        wide = size > WIDE
        if wide.any():
            for c, rows in rows_of.items():
                a, b = np.searchsorted(rows, low[wide]), np.searchsorted(rows, high[wide])
                some = b > a
                lows.append(begin[c] + a[some].astype(np.int32))
                highs.append(begin[c] + b[some].astype(np.int32))
        low, high = np.concatenate(lows), np.concatenate(highs)
        new = ~drawn[high]
        low, high = low[new], high[new]
        if not len(low):
            break
        drawn[high] = True
    return order, ~drawn[:n]


KEYS = ["did", "th"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, did, th, text): did orders null ids last, did and th name a document."""
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).select(
        "id", F.coalesce("id", F.lit((1 << 63) - 1)).alias("did"), F.xxhash64("text").alias("th"), "text")


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


# windows: first byte of the first one (40 bits), how many follow it and the place of the minimizer after it (12 bits each).
OCCURRENCES = "h bigint, did bigint, th bigint, windows bigint"


def occurrences(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """The minimizers of every text, with the windows (byte numbers) they represent."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, th = batch.column("did").to_numpy(), batch.column("th").to_numpy()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for at, first_byte, data, ends in _pieces(texts, length):
                h, text, first, last, inside = minimizers(data, ends, length, gram)
                shift = first_byte[text] - np.r_[0, ends][text]
                yield _batch(OCCURRENCES, h.view(np.int64), did[at[text]], th[at[text]], first + shift << 24 | last - first << 12 | inside)

    return keyed.mapInArrow(scan, OCCURRENCES)


def _pieces(texts: list[bytes], length: int, size: int = 4 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(which text, its first byte here, bytes, ends) of about ``size`` bytes; longer texts in pieces that share length - 1 bytes."""
    which, begin, parts, total = [], [], [], 0
    for k, text in enumerate(texts):
        for a in range(0, max(1, len(text) - length + 1), size):
            part = text[a:a + size + length - 1]
            which.append(k)
            begin.append(a)
            parts.append(part)
            total += len(part)
            if total >= size:
                yield np.array(which), np.array(begin), np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
                which, begin, parts, total = [], [], [], 0
    if parts:
        yield np.array(which), np.array(begin), np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def repeated(rows: DataFrame) -> DataFrame:
    """The occurrences whose minimizer occurs more than once; ``rows`` are dealt and sorted by it and streamed."""
    columns = [c.split()[0] for c in OCCURRENCES.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, and whether its minimizer was seen before it
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in columns]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.r_[a, b] for a, b in zip(held[0], cols, strict=True)]
            h = cols[0]
            same = h[1:] == h[:-1]
            many = np.r_[held[1] if held else False, same] | np.r_[same, False]
            held = [c[-1:] for c in cols], bool(np.r_[held[1] if held else False, same][-1])
            many[-1] = False  # told once the next batch is known
            yield _batch(OCCURRENCES, *(c[many] for c in cols))
        if held is not None and held[1]:
            yield _batch(OCCURRENCES, *held[0])

    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "h").sortWithinPartitions("h")
    return dealt.mapInArrow(scan, OCCURRENCES)


# text: the context's bytes, or null where all its windows are known to be repeats.
# n: windows of a repeat, or the place of the minimizer in the text.
CONTEXTS = "h bigint, did bigint, th bigint, first int, n int, text binary"
HELD_BYTES = 32 << 20


def contexts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The contexts of (did, th, text, found) rows; those equal to an earlier one of the same task are marked as repeats."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_of: dict[tuple[int, bytes, int], tuple[int, int, int]] = {}
        held = 0
        for batch in batches:
            out = []
            cols = (batch.column(c).to_pylist() for c in ("did", "th", "text", "found"))
            for did, th, text, found in zip(*cols, strict=True):
                for windows in found:
                    first, after, at = windows >> 24, windows >> 12 & 4095, windows & 4095
                    h = xxhash.xxh64_intdigest(text[first + at:first + at + gram]) - (1 << 63)
                    key, here = (h, text[first:first + after + length], at), (did, th, first)
                    there = first_of.setdefault(key, here)
                    if there is here:
                        held += len(key[1]) + 200
                    elif there != here:
                        first_of[key] = min(there, here)
                        out.append((*max(there, here), after))
            if out:
                yield _batch(CONTEXTS, *zip(*((did ^ a, did, th, a, b - a + 1, None) for did, th, a, b in _joined(out)), strict=True))
            if held > HELD_BYTES:
                yield from _first_places(first_of)
                first_of, held = {}, 0
        yield from _first_places(first_of)

    return rows.mapInArrow(scan, CONTEXTS)


def _joined(ranges: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(did, th, first, windows after it) as (did, th, first, last), ranges that follow one another as one."""
    out: list[tuple[int, int, int, int]] = []
    for did, th, first, after in sorted(set(ranges)):
        if out and out[-1][:2] == (did, th) and first <= out[-1][3] + 1:
            out[-1] = (did, th, out[-1][2], max(out[-1][3], first + after))
        else:
            out.append((did, th, first, first + after))
    return out


def _first_places(first_of: dict) -> Iterator[pa.RecordBatch]:
    items = iter(first_of.items())
    while part := [x for _, x in zip(range(20_000), items, strict=False)]:
        yield _batch(CONTEXTS, [k[0] for k, _ in part], [p[0] for _, p in part], [p[1] for _, p in part], [p[2] for _, p in part],
                     [k[2] for k, _ in part], [k[1] for k, _ in part])


REPEATS = "did bigint, th bigint, first int, last int"


def repeats(rows: DataFrame, length: int, gram: int, block_bytes: int) -> DataFrame:
    """Ranges of windows that start earlier too, from all contexts, dealt by minimizer and sorted by (minimizer, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[bytes, tuple[int, int, int]]] = []  # contexts of whole minimizers
        group: list[tuple[bytes, tuple[int, int, int], int]] = []  # distinct contexts of the current one
        size, current, out = 0, None, []
        for batch in batches:
            for h, did, th, first, n, text in zip(*(batch.column(c).to_pylist() for c in ("h", "did", "th", "first", "n", "text")), strict=True):
                here = (did, th, first)
                if text is None:
                    out.append((did, th, first, first + n - 1))
                    continue
                if h != current:
                    block += (some := _comparable(group, length, gram))
                    size += sum(len(t) + 1 for t, _ in some)
                    group, current = [], h
                    if size >= block_bytes:
                        out += repeated_windows(block, length, block_bytes)
                        block, size = [], 0
                if group and group[-1][0] == text:  # sorted, so equal texts come together
                    there = group[-1][1]
                    if here != there:
                        late = max(here, there)
                        out.append((*late, late[2] + len(text) - length))
                        group[-1] = (text, min(here, there), n)
                else:
                    group.append((text, here, n))
            if out:
                yield _batch(REPEATS, *zip(*out, strict=True))
                out = []
        block += _comparable(group, length, gram)
        if block:
            out += repeated_windows(block, length, block_bytes)
        if out:
            yield _batch(REPEATS, *zip(*out, strict=True))

    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "h").sortWithinPartitions("h", "text")
    return dealt.mapInArrow(scan, REPEATS)


def _comparable(group: list[tuple[bytes, tuple[int, int, int], int]], length: int, gram: int) -> list[tuple[bytes, tuple[int, int, int]]]:
    """The distinct contexts of a minimizer that can share a window with another.

    A window goes at least half of ``length - gram`` bytes beyond the minimizer
    on one side, so a context alone with the bytes on both sides has none.
    """
    if len(group) < 2:
        return []
    half = (length - gram + 1) // 2
    left = [t[at - half:at] if at >= half else None for t, _, at in group]
    right = [t[at + gram:at + gram + half] if len(t) >= at + gram + half else None for t, _, at in group]
    n_left, n_right = Counter(left), Counter(right)
    return [(t, p) for (t, p, _), a, b in zip(group, left, right, strict=True) if (a is not None and n_left[a] > 1) or (b is not None and n_right[b] > 1)]


def repeated_windows(block: list[tuple[bytes, tuple[int, int, int]]], length: int, block_bytes: int) -> list[tuple[int, int, int, int]]:
    """Ranges of the windows of ``block``'s contexts that occur earlier in it."""
    total = sum(len(t) + 1 for t, _ in block)
    if total > 4 * block_bytes:
        return _in_passes(block, length, block_bytes, -(-total // block_bytes))
    block = sorted(block, key=lambda x: x[1])
    documents = {d: k for k, d in enumerate(dict.fromkeys(p[:2] for _, p in block))}
    # Bytes of UTF-8 stop at 0xF4; 0xFF separates.
    data = np.frombuffer(b"\xff".join(t for t, _ in block) + b"\xff", np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t, _ in block[:-1]])
    n = np.array([len(t) - length + 1 for t, _ in block])
    at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    place = np.full(len(data), np.iinfo(np.int64).max)
    place[at] = np.repeat([documents[p[:2]] << 40 | p[2] for _, p in block], n) + (at - np.repeat(begin, n))
    order, joined = long_prefixes(data, length)
    place = place[order]
    run = np.flatnonzero(~joined)
    earliest = np.repeat(np.minimum.reduceat(place, run), np.diff(np.r_[run, len(place)]))
    late = np.zeros(len(data), bool)
    late[order] = place > earliest
    late = late[at]
    owner = np.repeat(np.arange(len(block)), n)
    edge = np.flatnonzero(late & ~np.r_[False, late[:-1] & (owner[1:] == owner[:-1])])
    stop = np.flatnonzero(late & ~np.r_[late[1:] & (owner[1:] == owner[:-1]), False])
    return [(*block[o][1][:2], int(block[o][1][2] + a), int(block[o][1][2] + b))
            for o, a, b in zip(owner[edge].tolist(), (at[edge] - begin[owner[edge]]).tolist(), (at[stop] - begin[owner[edge]]).tolist(), strict=True)]


def _in_passes(block: list[tuple[bytes, tuple[int, int, int]]], length: int, block_bytes: int, passes: int) -> list[tuple[int, int, int, int]]:
    """The same for more than a block: equal windows have equal classes, so each pass takes the windows of one class."""
    out = []
    for c in range(passes):
        some, size = [], 0
        for text, (did, th, first) in block:
            data = np.frombuffer(text, np.uint8)
            of = gram_hashes(data, 32)[:len(text) - length + 1] >> np.uint64(33)
            of = of % np.uint64(passes) == c
            for a in np.flatnonzero(of & ~np.r_[False, of[:-1]]).tolist():
                b = a + int(np.argmin(np.r_[of[a:], False]))
                some.append((text[a:b + length - 1], (did, th, first + a)))
                size += b - a + length
        if some and passes > 1:
            out += repeated_windows(some, length, max(block_bytes, size))
    return out


RESULT = "did bigint, th bigint, n_removed bigint, n_spans bigint, kept binary"


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """What is left of each (did, th, text, ranges) row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for did, th, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("did", "th", "text", "ranges")), strict=True):
                spans: list[list[int]] = []
                for r in sorted(ranges, key=lambda r: r["first"]):
                    a, b = r["first"], r["last"] + length
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((did, th, len(text) - len(kept), len(spans), kept))
            if out:
                yield _batch(RESULT, *zip(*out, strict=True))

    return rows.mapInArrow(scan, RESULT)


def texts_by_document(keyed: DataFrame, length: int) -> str:
    """Name of a table of the texts that have a window, bucketed by document without a shuffle of texts: what is found out about them comes to them.

    Few tasks write it, since each writes a file to every bucket.
    """
    spark = keyed.sparkSession
    name, buckets = f"substring_texts_{uuid.uuid4().hex[:16]}", shuffle_partitions(spark)
    texts = keyed.select(*KEYS, F.col("text").cast("binary").alias("text")).filter(F.octet_length("text") >= length)
    (texts.coalesce(max(2 * spark.sparkContext.defaultParallelism, buckets // 4)).write.bucketBy(buckets, *KEYS).sortBy(*KEYS)
     .option("compression", "zstd").format("parquet").saveAsTable(name))
    return name


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                     block_bytes: int = BLOCK_BYTES, with_kept: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row; ``with_kept`` adds the remaining bytes as ``kept``."""
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    name = texts_by_document(keyed, length)
    try:
        found = repeated(occurrences(keyed, length, gram)).groupBy(*KEYS).agg(F.collect_list("windows").alias("found"))
        late = repeats(contexts(spark.table(name).join(found, KEYS).select(*KEYS, "text", "found"), length, gram), length, gram, block_bytes)
        late = late.groupBy(*KEYS).agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
        one = spark.table(name).select(*KEYS, "text")
        cut = _cut(one.join(late, KEYS), length).withColumn("sha", F.sha2("kept", 256))
        cut = staged(cut.dropDuplicates(KEYS) if with_kept else cut.drop("kept").dropDuplicates(KEYS), "substring-results")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = keyed.select("id", *KEYS, F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("whole"),
                        *[F.col("text").cast("binary").alias("all")] * with_kept)
    out = rows.join(cut, KEYS, "left")
    return out.select(F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
                      F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"),
                      *[F.coalesce("kept", "all").alias("kept")] * with_kept)
