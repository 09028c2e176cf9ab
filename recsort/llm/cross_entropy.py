"""Cross-entropy difference of two matched n-gram models.

The target model is trained on the documents one wants more of, the background
model on all documents. Both share one vocabulary (every word of either, and
one for all others), order and smoothing, and the background's counts are
scaled to the target's number of words, so that a difference in loss comes from
the texts and not from the sizes. A word's loss is minus the log of

    (c(v w) + K p(w)) / (c(v) + K),    p(w) = (c(w) + 1) / (N + |V|)

with v the word before it (or the begin of the text). A document's score is the
mean over its words of target loss minus background loss: lower is closer to
the target.

Every pair and word has its own count, at any size. Texts are packed in chunks
of about ``CHUNK_BYTES``; a chunk counts its distinct pairs and words, deals
them to buckets by a hash, a bucket sums equal ones and sends each chunk the
totals of its own, with which the chunk's documents are scored. So a hot word
or pair is one entry a chunk, buckets are as many as the words ask for, and
nothing of the corpus comes to the driver but three sums. Pairs and words are
named by 80-bit hashes. Chunks are written once, bucketed by their number, so
that flags and totals come to them and the texts are never shuffled, at any
size.

Defined results: null and empty texts have no words and score 0; repeated rows
count and are scored each; an empty target or background scores by what the
smoothing leaves; a very long text is a chunk of its own; extra columns, of
whatever name, pass through in ``row``.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsort.llm.common import shuffle_partitions, staged

SMOOTHING = 20.0
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
TASK_BYTES = 32 << 20  # of texts in a bucket of chunks
PAIR, WORD, BEFORE = 0, 1, 2
BEGIN = np.uint64(0x5851F42D4C957F2D)  # the hash of the begin of a text


def words_of(text: bytes | None) -> list[bytes]:
    """Runs between ASCII white space, A-Z lower-cased."""
    return text.lower().split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _names(before: np.ndarray, word: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """80 bits for each n-gram of hashed words; the kind is in the last two."""
    first = _mix(_mix(before) + np.uint64(3) * word + np.uint64(kind))
    second = _mix(_mix(word ^ np.uint64(0xD6E8FEB86659FD93)) + np.uint64(5) * before) >> np.uint64(48)
    return first, (second & np.uint64(0xFFFC) | np.uint64(kind)).astype(np.uint16)


def _packed(x: np.ndarray) -> bytes:
    """The bytes of numbers, those of equal weight together, compressed."""
    x = np.ascontiguousarray(x)
    return pa.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).view(kind).ravel()


class Chunk:
    """The words of some texts, numbered from 1, and the n-grams whose counts they need, by bucket."""

    def __init__(self, data: bytes, lengths: np.ndarray, buckets: int, wanted: np.ndarray | None = None):
        ends = np.cumsum(lengths)
        whole = pa.decompress(data, decompressed_size=int(ends[-1]), codec="zstd", asbytes=True)
        texts = [whole[b - n:b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
        ids: defaultdict = defaultdict()
        ids.default_factory = ids.__len__
        ids[None] = 0  # the begin of a text
        before, after, self.n_words = [], [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if words := words_of(text):
                own = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                before += [np.zeros(1, np.int64), own[:-1]]
                after.append(own)
                self.n_words[k] = len(own)
        none = [np.zeros(0, np.int64)]
        del whole, texts
        v, self.w, n = np.concatenate(before or none), np.concatenate(after or none), len(ids)
        self.v, self.size = v, n
        pairs, self.pair, n_pairs = np.unique(v * n + self.w, return_inverse=True, return_counts=True)
        self.n_pairs = len(pairs)
        h = np.fromiter((xxhash.xxh64_intdigest(x) if x is not None else 0 for x in ids), np.uint64, n)
        h[0] = BEGIN
        zero = np.zeros(n, np.uint64)
        named = [_names(h[pairs // n], h[pairs % n], PAIR), _names(zero[1:], h[1:], WORD), _names(h, zero, BEFORE)]
        self.first, self.second = (np.concatenate(x) for x in zip(*named, strict=True))
        self.n = np.concatenate([n_pairs, np.bincount(self.w, minlength=n)[1:], np.bincount(v, minlength=n)]).astype(np.uint32)
        if wanted is not None:  # and how many of them stand in the target
            of = np.repeat(wanted, self.n_words)
            self.n_wanted = np.concatenate([np.bincount(self.pair[of], minlength=self.n_pairs), np.bincount(self.w[of], minlength=n)[1:],
                                            np.bincount(v[of], minlength=n)]).astype(np.uint32)
        # Sorted names share their first bytes.
        self.order = np.argsort(self.first, kind="stable")
        self.bucket = ((self.first[self.order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        edges = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1]]) if len(self.bucket) else []
        for at, own in zip(edges, np.split(self.order, edges[1:]), strict=True):
            yield int(self.bucket[at]), own

    def losses(self, counts: np.ndarray, scale: float, n_words: float, n_known: int, smoothing: float) -> np.ndarray:
        """Mean loss of each text, from the counts of ``order``."""
        c = np.empty(len(self.order))
        c[self.order] = counts * scale
        pairs, words, before = np.split(c, [self.n_pairs, self.n_pairs + self.size - 1])
        p = (words + 1) / (n_words * scale + n_known)
        loss = -np.log((pairs[self.pair] + smoothing * p[self.w - 1]) / (before[self.v] + smoothing))
        ends = np.cumsum(self.n_words)
        return np.diff(np.r_[0.0, np.cumsum(loss)][ends], prepend=0.0) / np.maximum(self.n_words, 1)


CHUNK = "wanted binary, lengths binary, texts binary"


def chunked(docs: DataFrame, text_col: str, keep: list[str], target_col: str | None = None, id_col: str | None = None) -> DataFrame:
    """(chunk, rows, ids, wanted, lengths, texts): about ``CHUNK_BYTES`` of texts a row, compressed; ``ids`` only with ``id_col``."""
    wanted = F.lit(False) if target_col is None else F.coalesce(F.col(f"`{target_col}`"), F.lit(False))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(0).alias("none")]).alias("row"),
                      (F.lit(0) if id_col is None else F.col(f"`{id_col}`")).alias("id"),
                      F.col(f"`{text_col}`").cast("binary").alias("text"), wanted.alias("wanted"))
    chunk_bytes = CHUNK_BYTES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, texts, wanted, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        ids = []

        def one() -> pa.RecordBatch:
            rows, keys = pa.concat_arrays(parts), pa.concat_arrays(ids)
            lengths = np.array([len(t) for t in texts], np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), x) for x in (rows, keys)),
                *(pa.array([x], pa.binary()) for x in (_packed(np.array(wanted, bool)), _packed(lengths), pa.compress(b"".join(texts), codec="zstd", asbytes=True)))],
                ["chunk", "rows", "ids", "wanted", "lengths", "texts"])
        for batch in batches:
            begin, rows, keys = 0, batch.column("row"), batch.column("id")
            for k, (text, flag) in enumerate(zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True)):
                texts.append(text or b"")
                wanted.append(flag)
                size += len(texts[-1]) + 64
                if size >= chunk_bytes:
                    parts.append(rows.slice(begin, k + 1 - begin))
                    ids.append(keys.slice(begin, k + 1 - begin))
                    yield one()
                    number, parts, ids, texts, wanted, size, begin = number + 1, [], [], [], [], 0, k + 1
            if begin < len(rows):
                parts.append(rows.slice(begin))
                ids.append(keys.slice(begin))
        if parts:
            yield one()

    kinds = (src.schema[c].dataType.simpleString() for c in ("row", "id"))
    return src.mapInArrow(scan, "chunk bigint, rows array<{}>, ids array<{}>, {}".format(*kinds, CHUNK))


def bucketed(chunks: DataFrame, buckets: int) -> DataFrame:
    """The chunks as a written table, bucketed by their number: a join with them shuffles the other side only."""
    name = f"ngram_chunks_{uuid.uuid4().hex[:16]}"
    chunks.write.bucketBy(buckets, "chunk").sortBy("chunk").format("parquet").saveAsTable(name)
    return chunks.sparkSession.table(name)


def flagged(chunks: DataFrame, ids: DataFrame) -> DataFrame:
    """``chunks`` with ``places``, the numbers of the rows whose id is in ``ids``; only ids and numbers are shuffled."""
    rows = chunks.select("chunk", F.posexplode("ids").alias("place", "id")).filter("id IS NOT NULL")
    found = rows.join(ids.toDF("id"), "id", "left_semi").groupBy("chunk").agg(F.collect_list("place").alias("places"))
    return chunks.join(found, "chunk", "left")


def asked(chunks: DataFrame, buckets: int, target: bool, background: bool, reply: bool) -> DataFrame:
    """The n-grams of each chunk by bucket, with their counts for either model; without ``reply`` their totals are not sent back.

    A chunk's rows count for the target if they are wanted or ``target`` is set.
    """
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int32()), *((c, pa.binary()) for c in ("first", "second", "target", "background"))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                number, n_rows, flags, lengths, texts = (batch.column(c)[k].as_py() for c in ("chunk", "n_rows", "wanted", "lengths", "texts"))
                wanted = _unpacked(flags, n_rows, np.bool_) | target
                wanted[batch.column("places")[k].as_py() or []] = True
                c = Chunk(texts, _unpacked(lengths, n_rows, np.int64), buckets, wanted)
                for bucket, own in c.parts():
                    yield pa.RecordBatch.from_pylist([{
                        "bucket": bucket, "chunk": number if reply else -1, "size": len(own), "first": _packed(c.first[own]), "second": _packed(c.second[own]),
                        "target": _packed(c.n_wanted[own]), "background": _packed(c.n[own] if background else c.n[own] * 0)}], schema)

    places = F.col("places") if "places" in chunks.columns else F.lit(None).cast("array<int>")
    return chunks.select("chunk", F.size("rows").alias("n_rows"), "wanted", places.alias("places"), "lengths", "texts").mapInArrow(
        scan, "bucket int, chunk bigint, size int, first binary, second binary, target binary, background binary")


TOTALS = "chunk bigint, bucket int, target binary, background binary, n_target bigint, n_background bigint, n_known bigint"


def totals(rows: DataFrame) -> DataFrame:
    """Per bucket and chunk the summed counts of its n-grams; a row without chunk has the bucket's words."""

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sizes = [r["size"] for r in rows]
        first, second = (np.concatenate([_unpacked(r[c], r["size"], t) for r in rows]) for c, t in (("first", np.uint64), ("second", np.uint16)))
        order = np.argsort(first)
        if ((first[order][1:] == first[order][:-1]) & (second[order][1:] != second[order][:-1])).any():
            order = np.lexsort((second, first))
        new = np.r_[True, (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])]
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        # Sums of whole numbers below 2^53 are exact.
        sums = [np.bincount(entry, np.concatenate([_unpacked(r[m], r["size"], np.uint32) for r in rows])).astype(np.uint64) for m in ("target", "background")]
        word = (second[order][new] & 3) == WORD
        some = word & ((sums[0] > 0) | (sums[1] > 0))
        out = [{"chunk": None, "bucket": rows[0]["bucket"], "n_target": int(sums[0][word].sum()), "n_background": int(sums[1][word].sum()), "n_known": int(some.sum())}]
        for r, own in zip(rows, np.split(entry, np.cumsum(sizes)[:-1]), strict=True):
            if r["chunk"] >= 0:
                out.append({"chunk": r["chunk"], "bucket": r["bucket"], "target": _packed(sums[0][own]), "background": _packed(sums[1][own])})
        return pa.Table.from_pylist(out, pa.schema([
            ("chunk", pa.int64()), ("bucket", pa.int32()), ("target", pa.binary()), ("background", pa.binary()),
            ("n_target", pa.int64()), ("n_background", pa.int64()), ("n_known", pa.int64())]))

    return rows.groupBy("bucket").applyInArrow(add, TOTALS)


def exact_difference(docs: DataFrame, target: DataFrame | str | None, background: DataFrame | None, text_col: str, keep: list[str],
                     smoothing: float, target_ids: DataFrame | None) -> DataFrame:
    spark = docs.sparkSession
    flag = target if isinstance(target, str) else None
    size = F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("bigint")).alias("n")
    own_bytes, *other_bytes = (d.select(size).first()["n"] or 0 for d in (docs, target, background) if isinstance(d, DataFrame))
    buckets = max(shuffle_partitions(spark), -(-sum((own_bytes, *other_bytes)) // BUCKET_BYTES))
    chunks = bucketed(chunked(docs, text_col, keep, flag, target_ids.columns[0] if target_ids is not None else None),
                      max(shuffle_partitions(spark), -(-own_bytes // TASK_BYTES)))
    rows = asked(chunks if target_ids is None else flagged(chunks, target_ids), buckets, False, background is None, True)
    if isinstance(target, DataFrame):
        rows = rows.unionByName(asked(chunked(target, text_col, []), buckets, True, False, False))
    if background is not None:
        rows = rows.unionByName(asked(chunked(background, text_col, []), buckets, False, True, False))
    counted = staged(totals(rows), "ngram-totals")
    n = counted.filter("chunk IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_target", "n_background", "n_known")]).first()
    n_target, n_background, known = n["n_target"], n["n_background"], n["n_known"] + 1
    scales = ((1.0, n_target), (n_target / max(1, n_background), n_background))
    own = counted.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "target", "background")).alias("counts"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column("rows")[k].values
                lengths, texts, counts = (batch.column(c)[k].as_py() for c in ("lengths", "texts", "counts"))
                c = Chunk(texts, _unpacked(lengths, len(rows), np.int64), buckets)
                parts, loss = {x["bucket"]: x for x in counts or []}, []
                for model, (scale, total) in zip(("target", "background"), scales, strict=True):
                    of = [_unpacked(parts[bucket][model], len(own), np.uint64) for bucket, own in c.parts()]
                    loss.append(c.losses(np.concatenate(of).astype(np.float64), scale, total, known, smoothing))
                yield pa.RecordBatch.from_arrays([rows, pa.array(c.n_words), pa.array(loss[0]), pa.array(loss[1]), pa.array(loss[0] - loss[1])],
                                                 ["row", "n_words", "target_loss", "background_loss", "score"])

    kind = chunks.schema["rows"].dataType.elementType.simpleString()
    return chunks.join(own, "chunk", "left").select("rows", "lengths", "texts", "counts").mapInArrow(
        scan, f"row {kind}, n_words bigint, target_loss double, background_loss double, score double")


def cross_entropy_difference(docs: DataFrame, target: DataFrame | str | None = None, background: DataFrame | None = None, text_col: str = "text",
                             keep: list[str] | None = None, smoothing: float = SMOOTHING, target_ids: DataFrame | None = None) -> DataFrame:
    """``row`` (the ``keep`` columns, or all), n_words, target_loss, background_loss (means) and score of every document.

    ``target`` is a table of its own or a boolean column of ``docs``;
    ``target_ids`` is a table of one column, named as the column of ``docs``
    it holds values of (null is none): the rows with these are the target.
    """
    return exact_difference(docs, target, background, text_col, keep or docs.columns, smoothing, target_ids)
