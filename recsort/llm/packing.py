"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents in id order, served in packets of at
most ``packet`` tokens. A round credits source s with ``quantum_s`` tokens, its
target share of one window, and the source sends packets while its credit
lasts; what is left is carried. So a packet whose last token is number e of its
queue goes out in round ``(e - 1) div quantum_s``: the credit carried over all
windows and partitions is in that quotient, and no state has to travel from
task to task. Packets ordered by (round, source, place in the queue) form one
stream, cut every ``length`` tokens into sequences; all are full but the last.

The two running totals (place in the queue, place in the stream) are taken
over range-partitioned narrow rows: sums within a part plus the sums of the
parts before it, so no source, however large, meets in one task.

Defined results: null text has no ids but the end token; null source is a queue
of its own; repeated rows and ids are packed once each, in the order they were
stored; an empty table gives no pieces. Sources missing from ``weights`` are
served after all others. With no weights the target is each source's share of
the tokens, so that every queue ends together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsort.llm.common import shuffle_partitions, staged
from recsort.llm.tokens import tokenizer

LENGTH = 4096
PACKET = 512
END_ID = 2
LATE = 1 << 52  # rounds of sources without a weight


def tokenized(docs: DataFrame, id_col: str, text_col: str, source_col: str, path: str, end_id: int) -> DataFrame:
    """Staged (uid, doc_id, source, n, ids): the packed little-endian ids of each row's whole text and the end id."""
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("")).alias("source"),
                      F.col(f"`{text_col}`").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        end = np.array([end_id], t.dtype).tobytes()
        for batch in batches:
            texts = batch.column("text")
            for k in range(0, batch.num_rows, 1000):
                ids = [t.encode(x) + end for x in texts.slice(k, 1000).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(k, 1000), batch.column("source").slice(k, 1000),
                     pa.array([len(x) // t.dtype.itemsize for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "source", "n", "ids"])

    out = src.mapInArrow(encode, "doc_id bigint, source string, n bigint, ids binary")
    return staged(out.withColumn("uid", F.monotonically_increasing_id()), "pack-tokens")


def running_total(df: DataFrame, order: list[str], value: str, name: str, group: str | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before in ``order`` (unique), within ``group`` if given.

    Staged, so that the parts stay as they were drawn.
    """
    keys = ["part"] + ([group] if group else [])
    parts = staged(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn("part", F.spark_partition_id()), f"pack-{name}")
    sums = parts.groupBy(*keys).agg(F.sum(value).alias("own"))
    ahead = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, F.coalesce(F.sum("own").over(ahead), F.lit(0)).alias("ahead")).checkpoint()
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.withColumn("inside", F.coalesce(F.sum(value).over(within), F.lit(0))).join(sums, keys)
            .withColumn(name, F.col("inside") + F.col("ahead")).drop("inside", "ahead", "part"))


def plan(narrow: DataFrame, length: int, packet: int, weights: dict[str, float] | None) -> DataFrame:
    """(uid, start, length, sequence_id, offset) of every piece, from (uid, doc_id, source, n)."""
    queue = running_total(narrow, ["source", "doc_id", "uid"], "n", "place", "source")
    if weights is None:
        share = narrow.groupBy("source").agg(F.sum("n").alias("weight"))
    else:
        scaled = [("=" + s, max(1, round(w * 1e9))) for s, w in weights.items() if w > 0]
        share = narrow.sparkSession.createDataFrame(scaled, "source string, weight bigint")
    total = share.agg(F.sum("weight").alias("total"))
    share = share.crossJoin(F.broadcast(total)).checkpoint()  # one row per source, times one row
    big = lambda c: c.cast("decimal(18,0)")
    packets = (queue.join(share, "source", "left")
               .withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(packet).cast("bigint"))))
               .withColumn("many", F.least(F.lit(packet), F.col("n") - F.col("start")))
               .withColumn("from", F.col("place") + F.col("start"))
               .withColumn("credit", big(F.lit(length)) * big(F.col("weight")))
               .withColumn("due", big(F.col("from") + F.col("many") - 1) * big(F.col("total")))
               .withColumn("round", F.coalesce(F.expr("due div credit"), F.lit(LATE)))
               .select("uid", "source", "from", "start", "many", "round"))
    stream = running_total(packets, ["round", "source", "from"], "many", "at")
    cut = (stream.withColumn("sequence_id", F.explode(F.expr(f"sequence(at div {length}, (at + many - 1) div {length})")))
           .withColumn("lo", F.greatest(F.col("at"), F.col("sequence_id") * length))
           .withColumn("hi", F.least(F.col("at") + F.col("many"), (F.col("sequence_id") + 1) * length)))
    return cut.select("uid", (F.col("start") + F.col("lo") - F.col("at")).alias("start"), (F.col("hi") - F.col("lo")).alias("length"),
                      "sequence_id", (F.col("lo") - F.col("sequence_id") * length).alias("offset"))


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         tokenizer_path: str | None = None, weights: dict[str, float] | None = None, length: int = LENGTH,
         packet: int = PACKET, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves as ``ids array<int>``."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    tokens = tokenized(docs, id_col, text_col, source_col, tokenizer_path, end_id)
    pieces = plan(tokens.select("uid", "doc_id", "source", "n"), length, packet, weights)
    per_doc = pieces.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = tokenizer(tokenizer_path).dtype
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                yield from _rows(batch.slice(k, 500), dtype, with_ids)

    joined = tokens.join(per_doc, "uid").select("doc_id", "source", "n", "ids", "pieces")
    return joined.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else "")).withColumn(
        "source", F.when(F.col("source") != "", F.expr("substring(source, 2)")))


def _rows(batch: pa.RecordBatch, dtype: np.dtype, with_ids: bool) -> Iterator[pa.RecordBatch]:
    out: dict[str, list] = {c.split()[0]: [] for c in PIECES.split(", ")}
    own = []
    cols = (batch.column(c).to_pylist() for c in ("doc_id", "source", "n", "ids", "pieces"))
    for doc_id, source, n, packed, pieces in zip(*cols, strict=True):
        ids = np.frombuffer(packed, dtype).astype("<u4")
        for p in merged(pieces):
            part = ids[p["start"]:p["start"] + p["length"]]
            row = p | {"doc_id": doc_id, "source": source, "doc_tokens": n, "ids_crc32": zlib.crc32(part.tobytes())}
            for c, v in row.items():
                out[c].append(v)
            if with_ids:
                own.append(part.astype(np.int32))
    types = {"source": pa.string()}
    cols = [pa.array(v, types.get(c, pa.int64())) for c, v in out.items()]
    yield pa.RecordBatch.from_arrays(cols + [pa.array(own, pa.list_(pa.int32()))] * with_ids, [*out, *["ids"] * with_ids])


def merged(pieces: list[dict]) -> list[dict]:
    """Packets of a document that follow one another in the same sequence as one piece."""
    out: list[dict] = []
    for p in pieces:
        last = out[-1] if out else None
        if last and (last["sequence_id"], last["start"] + last["length"], last["offset"] + last["length"]) == (p["sequence_id"], p["start"], p["offset"]):
            last["length"] += p["length"]
        else:
            out.append(dict(p))
    return out
