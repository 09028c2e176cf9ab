"""Benchmark decontamination by a prefix-filtered set join.

An item's windows (ten consecutive words, or the whole item if shorter) are
sets of word shingles that a document must contain whole. Shingles are ordered
by their count in the corpus; at containment 1 the necessary prefix of a window
is its rarest shingle alone. Documents probe the prefix index with their own
shingles, the positions of the two shingles bound where the window could
start, windows that would not fit into the document are dropped, and what is
left is verified word by word.

The benchmark is the query side: it is taken in blocks of at most
``BLOCK_WORDS`` words, so that what is sent to the tasks has a fixed size
however long the benchmark is; each block passes over all documents. Nothing
of the documents is collected or shuffled.

Defined results: null or empty texts have no words; an item without an id or
without words has no windows; items with the same id are one item; repeated
document rows give a result row each; a word hit by several windows counts
once; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsort.llm.common import staged

WINDOW = 10
SHINGLE = 5
BLOCK_WORDS = 2_000_000
CHUNK_WORDS = 1_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# Letters and digits of ASCII stay (A-Z lower-cased), other ASCII separates, the rest stays.
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def shingle_keys(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key of every run of ``size`` ids; 0 where an id is 0 (a word outside the benchmark)."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide, key, known = ids.astype(np.uint64), np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(size):
        part = wide[k:k + n]
        key = (key ^ part) * MULTIPLIER
        key ^= key >> np.uint64(29)
        known &= part != 0
    return np.where(known, key | np.uint64(1), np.uint64(0))


class Block:
    """Windows of some items: word ids, distinct windows by length, the items of each, and shingle counts."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int, shingle: int):
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.shingle, owners = shingle, defaultdict(set)
        for name, words in items:
            ids = [number(w) for w in words]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1):
                owners[tuple(ids[k:k + size])].add(name)
        self.windows = [np.array(w, np.int32) for w in owners]
        self.owners = [sorted(o) for o in owners.values()]
        # Shingles of each window, as keys; a window shorter than a shingle is one shingle.
        self.sizes = sorted({min(shingle, len(w)) for w in self.windows})
        self.keys = {s: np.unique(np.concatenate([shingle_keys(w, s) for w in self.windows if min(shingle, len(w)) == s])) for s in self.sizes}

    def index(self, counts: dict[int, np.ndarray]) -> PrefixIndex:
        return PrefixIndex(self, counts)


class PrefixIndex:
    """Rarest shingle -> windows that begin ``offset`` words before it. Windows whose prefix is nowhere in the corpus are left out."""

    def __init__(self, block: Block, counts: dict[int, np.ndarray]):
        self.vocabulary, self.windows, self.owners, self.by_size = block.vocabulary, block.windows, block.owners, {}
        rows: dict[int, list[tuple[int, int, int]]] = {s: [] for s in block.sizes}
        for w, ids in enumerate(block.windows):
            s = min(block.shingle, len(ids))
            own = shingle_keys(ids, s)
            n = counts[s][np.searchsorted(block.keys[s], own)]
            at = min(range(len(own)), key=lambda k: (n[k], own[k], k))
            if n[at]:
                rows[s].append((int(own[at]), w, at))
        for s, found in rows.items():
            if found:
                found.sort()
                keys = np.array([r[0] for r in found], np.uint64)
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                self.by_size[s] = (keys[first], first, np.diff(np.r_[first, len(keys)]),
                                   np.array([r[1] for r in found]), np.array([r[2] for r in found]))
        width = max((len(w) for w in self.windows), default=1)
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.matrix = np.zeros((len(self.windows), width), np.int32)
        for k, w in enumerate(self.windows):
            self.matrix[k, :len(w)] = w

    def matches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of every occurrence in ``ids``, documents apart by at least one 0."""
        starts, found = [], []
        for s, (keys, first, many, windows, offsets) in self.by_size.items():
            own = shingle_keys(ids, s)
            at = np.flatnonzero(own)
            if not len(at):
                continue
            slot = np.searchsorted(keys, own[at])
            slot[slot == len(keys)] = 0
            at, slot = at[(hit := keys[slot] == own[at])], slot[hit]
            n = many[slot]
            which = np.repeat(first[slot] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            w, p = windows[which], np.repeat(at, n) - offsets[which]
            # Positional and length bounds: the window has to lie within the words there are.
            fits = (p >= 0) & (p + self.lengths[w] <= len(ids))
            w, p = w[fits], p[fits]
            same = np.ones(len(w), bool)
            for k in range(self.matrix.shape[1]):
                inside = self.lengths[w] > k
                same &= ~inside | (ids[np.minimum(p + k, len(ids) - 1)] == self.matrix[w, k])
            starts.append(p[same])
            found.append(w[same])
        return (np.concatenate(starts), np.concatenate(found)) if starts else (np.zeros(0, np.int64),) * 2


def _chunks(texts: list[bytes | None], get) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, last, ids with a 0 after each document, their starts) of about CHUNK_WORDS words."""
    first, parts, starts, total = 0, [], [], 0
    for k, text in enumerate(texts):
        words = words_of(text)
        ids = np.zeros(len(words) + 1, np.int32)
        ids[:-1] = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        parts.append(ids)
        starts.append(total)
        total += len(ids)
        if total >= CHUNK_WORDS or k + 1 == len(texts):
            yield first, k + 1, np.concatenate(parts), np.array([*starts, total])
            first, parts, starts, total = k + 1, [], [], 0


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _count_shingles(docs: DataFrame, block: Block) -> dict[int, np.ndarray]:
    """How often each shingle of the block stands in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast((block.vocabulary, block.keys))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, keys = sent.value
        sums = {s: np.zeros(len(k), np.int64) for s, k in keys.items()}
        for batch in batches:
            for _, _, ids, _ in _chunks(_texts(batch), vocabulary.get):
                for s, k in keys.items():
                    own = shingle_keys(ids, s)
                    own = own[own != 0]
                    slot = np.searchsorted(k, own)
                    slot[slot == len(k)] = 0
                    sums[s] += np.bincount(slot[k[slot] == own], minlength=len(k))
        for s, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), s, np.int32)), pa.array(at), pa.array(n[at])], ["size", "slot", "n"])

    got = docs.mapInArrow(count, "size int, slot bigint, n bigint").groupBy("size", "slot").agg(F.sum("n").alias("n")).collect()
    counts = {s: np.zeros(len(k), np.int64) for s, k in block.keys.items()}
    for size, slot, n in got:
        counts[size][slot] = n
    return counts


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted spans that neither touch nor overlap, as start, end, start, end ..."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


RESULT = "n_words bigint, spans array<int>, items array<string>"


def _probe(docs: DataFrame, index: PrefixIndex) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(vars(index))  # plain arrays, dicts and lists
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = PrefixIndex.__new__(PrefixIndex)
        vars(ix).update(sent.value)
        for batch in batches:
            n = batch.num_rows
            n_words, spans, items = [0] * n, batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for first, last, ids, starts in _chunks(_texts(batch), ix.vocabulary.get):
                n_words[first:last] = (np.diff(starts) - 1).tolist()
                at, w = ix.matches(ids)
                doc = np.searchsorted(starts, at, "right") - 1
                hits = defaultdict(list)
                for d, a, k in zip(doc.tolist(), (at - starts[doc]).tolist(), w.tolist(), strict=True):
                    hits[d].append((a, k))
                for d, found in hits.items():
                    old = spans[first + d]
                    spans[first + d] = _merge([*zip(old[::2], old[1::2], strict=True), *((a, a + int(ix.lengths[k])) for a, k in found)])
                    items[first + d] = sorted({*items[first + d], *(x for _, k in set(found) for x in ix.owners[k])})
            out = {"n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int32())), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([out.get(c, batch.column(c)) for c in batch.schema.names], batch.schema.names)

    return docs.mapInArrow(probe, schema)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    rows = benchmark.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("binary")).dropna()
    block, size = [], 0
    for name, text in rows.toLocalIterator():
        if words := words_of(bytes(text)):
            block.append((name, words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", keep: list[str] | None = None, window: int = WINDOW,
                  shingle: int = SHINGLE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``row`` (the ``keep`` columns, or all), n_words, spans (word numbers, start and end by turns) and items of every document."""
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
    out = docs.select(kept, F.col(f"`{text_col}`").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
                      F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    counted = docs.select(F.col(f"`{text_col}`").alias("text"))
    blocks = _blocks(benchmark, item_col, item_text_col, block_words)
    items = next(blocks, [])  # without items the documents still get their word counts
    while True:
        block = Block(items, window, shingle)
        out = _probe(out, block.index(_count_shingles(counted, block) if items else {}))
        if (items := next(blocks, None)) is None:
            break
        out = staged(out, "decontaminate")  # one block's index at a time in a task
    return out.drop("text")


def hit_words(spans: Column) -> Column:
    return F.coalesce(F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
