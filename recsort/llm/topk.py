"""Exact top-k by inner product, in the three phases of a uniform threshold.

A score is a sum of ``LISTS`` partial scores, one per slice of the components;
each task holds, for its rows, one local score list per slice and query.

1. Gather: every task names the best rows of each of its lists and sends the
   exact scores of those it named. The k-th best of them over all tasks is a
   safe cutoff: k rows reach it, so no row below it is among the best k.
2. Collect: the cutoffs (one number a query) are broadcast. A row whose partial
   score is below the uniform share cutoff / LISTS in every list is below the
   cutoff in sum, so the rows that reach the share in a list are sufficient.
3. Resolve: the exact scores of those rows alone are added up, the ones at or
   above the cutoff stay, and a task sends its best k of a query; Spark ranks
   the few that remain.

Queries are taken in blocks of at most ``QUERY_BYTES``, numbered by ranges of a
stored table; a block and its cutoffs are broadcast, the candidates are read in
place and are never shuffled, and what is sent does not grow with ties (of
equal scores the smaller ids win in each task as in the end). Equal queries
are answered once.

Scores are exact integers: products run in 32-bit or 64-bit floats only where
every partial sum fits their mantissa, else in Python integers; a score beyond
a long is held at its end.

Defined results: vectors that are null or hold null or non-finite components
(also once multiplied) take no part; components that one of two vectors lacks
count as zero, so an empty vector scores 0 with all; a row never answers itself,
other rows of its id may; repeated rows are candidates each and are answered
each; null ids are candidates (last among ties) but no queries; with fewer rows
than k all are returned; an empty table gives an empty table; other columns are
not read, so that they cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsort.llm.common import staged

LISTS = 2
SCALE = 256
QUERY_BYTES = 8 << 20     # of a block of queries, as 64-bit numbers
QUERY_TILE = 512          # queries and rows multiplied at a time
ROW_TILE = 4096
LONG = (1 << 63) - 1
FOUND = "q long, score long, id long"


def usable(v: Column) -> Column:
    """The vector as doubles, null if it takes no part."""
    d = v.cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x * float(SCALE)) == float("inf"))
    return F.when(F.exists(d, bad), None).otherwise(d)


def _matrix(vectors: pa.ListArray, dim: int) -> np.ndarray:
    """floor(SCALE * x) per component, ``dim`` wide: cut, or filled with zeros."""
    size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * float(SCALE))
    if (size == dim).all():
        return flat.reshape(len(size), dim)
    out = np.zeros((len(size), dim))
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[row[col < dim], col[col < dim]] = flat[col < dim]
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.dtype:
    """The narrowest type in which every sum of products of the two is exact."""
    most = max(1.0, float(np.abs(a).max(initial=0))) * max(1.0, float(np.abs(b).max(initial=0))) * max(1, a.shape[1])
    return np.dtype("f4") if most < 2 ** 24 else np.dtype("f8") if most < 2 ** 53 else np.dtype(object)


def _as(x: np.ndarray, kind: np.dtype) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(x) if kind == object and x.size else x.astype(kind)


def _partials(q: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """One (queries x rows) matrix of partial scores per slice."""
    cuts = np.linspace(0, q.shape[1], LISTS + 1).astype(int)
    return [q[:, a:b] @ rows[:, a:b].T for a, b in zip(cuts, cuts[1:])]


class _Best:
    """The best k (score, id) of each query, ties to the smaller id, null ids last."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.rows: list[list[tuple]] = [[] for _ in range(queries)]

    def add(self, query: np.ndarray, score: np.ndarray, ids: list) -> None:
        for i, s, x in zip(query.tolist(), score.tolist(), ids):
            self.rows[i].append((-max(-LONG - 1, min(LONG, int(s))), x is None, x))
        for i in np.unique(query).tolist():
            if len(self.rows[i]) > 4 * self.k:
                self.cut(i)

    def cut(self, i: int) -> None:
        self.rows[i] = sorted(self.rows[i], key=lambda r: (r[0], r[1], r[2] or 0))[: self.k]

    def batch(self) -> pa.RecordBatch:
        for i in range(len(self.rows)):
            self.cut(i)
        out = [(i, -s, x) for i, rows in enumerate(self.rows) for s, _, x in rows]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["q", "score", "id"])


def _scan(block, k: int, cutoffs=None):
    """Phase 1 without ``cutoffs`` (a float per query, -inf for none), phases 2 and 3 with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value
        limit = None if cutoffs is None else cutoffs.value
        best = _Best(len(queries), k)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROW_TILE):
                part = batch.slice(lo, ROW_TILE)
                rows, ids = _matrix(part.column("v"), queries.shape[1]), part.column("id").to_pylist()
                kind = _exact(queries, rows)
                held = _as(rows, kind)
                for at in range(0, len(queries), QUERY_TILE):
                    lists = _partials(_as(queries[at:at + QUERY_TILE], kind), held)
                    if limit is None:
                        named = np.unique(np.concatenate([_top(p, k) for p in lists]))
                    else:
                        share = limit[at:at + QUERY_TILE, None] / LISTS
                        reach = lists[0] >= share
                        for p in lists[1:]:
                            reach |= p >= share
                        named = np.flatnonzero(reach)
                    total = sum(p.ravel()[named] for p in lists)
                    who, row = named // len(ids) + at, named % len(ids)
                    if limit is not None:
                        stay = total >= limit[who]
                        who, row, total = who[stay], row[stay], total[stay]
                    who, row, total = _first(who, row, total, ids, k)
                    best.add(who, total, [ids[r] for r in row])
        yield best.batch()

    return run


def _top(p: np.ndarray, k: int) -> np.ndarray:
    """Flat places of the k largest of each row of ``p``."""
    n = p.shape[1]
    if n <= k:
        return np.arange(p.size)
    if p.dtype == object:
        cols = np.array([sorted(range(n), key=lambda j: -r[j])[:k] for r in p])  # noqa: B023
    else:
        cols = np.argpartition(p, n - k, axis=1)[:, n - k:]
    return (cols + np.arange(len(p))[:, None] * n).ravel()


def _first(who: np.ndarray, row: np.ndarray, total: np.ndarray, ids: list, k: int):
    """The best k of each query of a tile, so that a tie of thousands adds k."""
    if not len(who):
        return who, row, total
    rank = np.array([LONG if x is None else x for x in ids], object if any(x == LONG for x in ids) else np.int64)
    if total.dtype == object:
        order = np.array(sorted(range(len(who)), key=lambda i: (who[i], -total[i], rank[row[i]])), np.int64)
    else:
        order = np.lexsort((rank[row], -total, who))
    who, row, total = who[order], row[order], total[order]
    start = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
    nth = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
    return who[nth < k], row[nth < k], total[nth < k]


def _kth(found: DataFrame, k: int, queries: int) -> np.ndarray:
    """The k-th best score of each query of a block, -inf where there are fewer."""
    w = Window.partitionBy("q").orderBy(F.desc("score"))
    out = np.full(queries, -np.inf)
    # One row a query of the block.
    for r in found.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") == k).collect():
        # Never above the exact score, also where it is no double.
        out[r.q] = r.score if abs(r.score) < 2 ** 53 else np.nextafter(float(r.score), -np.inf)
    return out


def search(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", is_query: Column | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest of each row that ``is_query`` holds for, against every other row."""
    spark = vectors.sparkSession
    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), usable(F.col(f"`{vector_col}`")).alias("v"),
                           (F.lit(True) if is_query is None else is_query).alias("is_query"))
    rows = named.filter("v IS NOT NULL").select("id", "v")
    asked = named.filter("is_query AND id IS NOT NULL AND v IS NOT NULL").groupBy("id", "v").agg(F.count(F.lit(1)).alias("times"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    asked = staged(asked.withColumn("h", F.xxhash64("id", "v")), "topk-queries")
    n, dim, least, most = asked.agg(F.count(F.lit(1)), F.max(F.size("v")), F.min("id"), F.max("id")).first()
    results = None
    # Blocks by a hash of the distinct queries: half full on average, so that none comes near the bound.
    blocks = max(1, -(-n * 8 * max(dim or 1, 1) * 2 // QUERY_BYTES))
    for b in range(blocks if n else 0):
        own = asked.filter(F.pmod(F.col("h"), F.lit(blocks)) == b).select("id", "v", "times").toArrow().combine_chunks()
        if not own.num_rows:
            continue
        table = own.to_batches()[0]
        block = spark.sparkContext.broadcast(_matrix(table.column("v"), dim))
        found = staged(rows.mapInArrow(_scan(block, k + 1), FOUND), "topk-gathered")
        cutoffs = spark.sparkContext.broadcast(_kth(found, k + 1, own.num_rows))
        sent = rows.mapInArrow(_scan(block, k + 1, cutoffs), FOUND)
        w = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        ranked = sent.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= k + 1)
        m = _matrix(table.column("v"), dim)
        exact = [max(-LONG - 1, min(LONG, sum(int(x) * int(x) for x in r))) for r in m]
        told = spark.createDataFrame(pa.table({"q": pa.array(range(own.num_rows), pa.int64()), "query_id": table.column("id"),
                                               "self": pa.array(exact, pa.int64()), "times": table.column("times")}))
        # The row itself is one of the entries with its own score and id, if it is among the first at all.
        mine = F.min(F.when((F.col("score") == F.col("self")) & F.col("id").eqNullSafe(F.col("query_id")), F.col("nth"))).over(Window.partitionBy("q"))
        ranked = ranked.join(told, "q").withColumn("mine", F.coalesce(mine, F.lit(k + 1)))
        ranked = ranked.filter("nth <> mine").select(
            "query_id", F.when(F.col("nth") > F.col("mine"), F.col("nth") - 1).otherwise(F.col("nth")).alias("rank"), F.col("id").alias("vec_id"), "score",
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy")).drop("copy")
        ranked = staged(ranked, "topk-found")
        results = ranked if results is None else results.unionByName(ranked)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return results
