"""Merkle manifest of a table: per-group trees, a tree over the groups, proofs.

A leaf is the digest of a row's fields. The leaves of a group ascend by key;
every ``FAN`` consecutive nodes (the last run: fewer, even one) become their
parent while a group has more than one node. What remains is the group's
subroot, and the subroots, ordered by group, give the root the same way.

A level is a pass of lag and lead columns at fixed offsets. Rows are numbered
within their group; in blocks of ``FAN ** HEIGHT`` rows, which no run crosses,
the node of a level stands at the first row below it, so that its siblings are
``offset`` and ``2 * offset`` rows before and behind, masked by its slot and by
the group's number of nodes, and the first row of a run hashes the parent. The
same offsets hand the siblings of upper levels down to the rows. The tops of
the blocks are the rows of the next pass, which therefore has one row in 729:
three passes reach 387 million rows a group. A block is at most 729 narrow
rows, so a group with a third of all rows is as many blocks as it needs.

Rows are numbered without a window over a group: they are range-partitioned and
sorted by (group, key, leaf), and every partition's part of a group starts where
the parts before it end. Texts are read in the first pass alone and are not
shuffled.

Defined results: a null field is hashed as ``-``; null groups are a group of
their own, ordered first; null keys come first in their group; rows that repeat
a key are ordered by their leaf (equal ones are interchangeable) and all of them
are leaves; empty and very long texts are fields as any other; an empty table
has no root and gives no rows; other input columns than the named ones are not
read, so that they cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsort.llm.common import staged

FAN = 3
HEIGHT = 6
BLOCK = FAN ** HEIGHT
STEP = "array<struct<l:string,r:string>>"


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def field(c: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(*fields: Column) -> Column:
    return digest(F.concat(*map(field, fields)))


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with pos, the number of a row in its group ``g`` by ``order`` from 0, and n, the group's rows."""
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # Equal rows are told apart by where they are read, so that a much repeated row is not one partition.
    rows = staged(nodes.withColumn("tie", F.monotonically_increasing_id())
                  .repartitionByRange(parts, "g", *order, "tie").sortWithinPartitions("g", *order, "tie").drop("tie")
                  .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "merkle-rows")
    runs = rows.groupBy("g", "part").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("n_run"))
    # One row per group and partition that holds it.
    by_group = Window.partitionBy("g")
    runs = runs.select("g", "part", F.sum("n_run").over(by_group).alias("n"),
                       (F.sum("n_run").over(by_group.orderBy("part")) - F.col("n_run") - F.col("begin")).alias("shift"))
    return rows.join(runs, ["g", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _climb(nodes: DataFrame, with_path: bool) -> DataFrame:
    """``nodes`` (g, block, pos, n, h) after ``HEIGHT`` levels.

    h0 .. hK: the node of each level at the first row below it. ``path``: per
    level with more than one node, the siblings before and behind.
    """
    w = Window.partitionBy("g", "block").orderBy("pos")
    d = nodes.withColumnRenamed("h", "h0")
    for k in range(HEIGHT):
        off = FAN ** k
        h, slot = F.col(f"h{k}"), F.expr(f"pos div {off}") % FAN
        many = F.col("n") > off
        d = d.select("*", *[F.lag(h, j * off).over(w).alias(f"b{j}") for j in range(1, FAN)], *[F.lead(h, j * off).over(w).alias(f"f{j}") for j in range(1, FAN)])
        side = lambda name, js, mask: F.concat(*[F.coalesce(F.when(mask(j), F.col(f"{name}{j}")), F.lit("")) for j in js])
        at_node = F.col("pos") % off == 0
        left = side("b", range(FAN - 1, 0, -1), lambda j: slot >= j)  # noqa: B023
        right = side("f", range(1, FAN), lambda j: slot + j < FAN)  # noqa: B023
        d = d.withColumn(f"s{k}", F.when(at_node, F.struct(left.alias("l"), right.alias("r"))))
        up = F.when(many, digest(F.concat(h, F.col(f"s{k}.r")))).otherwise(h)
        d = d.withColumn(f"h{k + 1}", F.when(F.col("pos") % (off * FAN) == 0, up)).drop(*[f"{x}{j}" for x in "bf" for j in range(1, FAN)])
    if not with_path:
        return d.filter(F.col("pos") % BLOCK == 0)
    none = F.array().cast(STEP)
    d = d.withColumn("path", none)
    for k in reversed(range(HEIGHT)):
        off = FAN ** k
        slot = F.expr(f"pos div {off}") % FAN
        above = d.select("*", *[F.lag("path", j * off).over(w).alias(f"p{j}") for j in range(1, FAN)])
        own = F.when(F.col("n") > off, F.array(F.col(f"s{k}")).cast(STEP)).otherwise(none)
        upper = F.col("path")
        for j in range(1, FAN):
            upper = F.when(slot == j, F.col(f"p{j}")).otherwise(upper)
        d = above.withColumn("path", F.when(F.col("pos") % off == 0, F.concat(own, upper))).drop(*[f"p{j}" for j in range(1, FAN)])
    return d


def _trees(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``path`` and their group's ``top``, one row (g, top) per group) of numbered nodes (g, pos, n, h, ...)."""
    nodes = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    climbed = _climb(nodes.select("g", "block", "pos", "n", "h"), with_path=False)
    tops = staged(climbed.select("g", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col(f"h{HEIGHT}").alias("h")), "merkle-tops")
    most = tops.agg(F.max("n")).first()[0]
    if most is not None and most > 1:
        tops, groups = _trees(tops)
    else:
        tops = tops.withColumn("path", F.array().cast(STEP)).withColumn("top", F.col("h"))
        groups = tops.select("g", "top")
    upper = tops.select("g", F.col("pos").alias("block"), F.col("path").alias("upper"), "top")
    low = _climb(nodes, with_path=True).drop(*[f"h{k}" for k in range(1, HEIGHT + 1)], *[f"s{k}" for k in range(HEIGHT)]).withColumnRenamed("h0", "h")
    # The rows are already dealt by (g, block); one row a block comes to them.
    return low.join(upper, ["g", "block"]).withColumn("path", F.concat("path", "upper")).drop("upper", "block"), groups


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, start, lambda acc, s: digest(F.concat(s["l"], acc, s["r"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf to the root and left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""))


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "source", **carry: Column) -> DataFrame:
    """(key as ``key``, leaf, subroot, root, path, and the ``carry`` columns) per row of ``docs``.

    ``fields`` are hashed in their order; ``carry`` names narrow columns of
    ``docs`` to be carried along (a digest of an altered row, say).
    """
    named = lambda c: F.col(f"`{c}`")
    # A null group sorts before every other, also before the empty name.
    g = F.coalesce(F.concat(F.lit("="), named(group).cast("string")), F.lit(""))
    leaves = docs.select(named(key).alias("key"), g.alias("g"), leaf(*map(named, fields)).alias("h"), *[c.alias(n) for n, c in carry.items()])
    low, groups = _trees(numbered(leaves, "key", "h"))
    subroots = numbered(groups.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("top").alias("h")), "name")
    high, _ = _trees_named(subroots)
    return low.join(high, low["g"] == high["name"]).select(
        "key", low["h"].alias("leaf"), low["top"].alias("subroot"), high["top"].alias("root"),
        F.concat(low["path"], high["path"]).alias("path"), *[low[n].alias(n) for n in carry])


def _trees_named(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    d, groups = _trees(nodes)
    return d.select("name", "path", "top"), groups
