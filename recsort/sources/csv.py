"""CSV record sources.

The source workflow reads a CSV by trying encodings in order and moving
on only when decoding fails. Spark's CSV reader never fails on bad bytes
(it substitutes), so the charset is chosen **per file** by a strict decode.
A line feed is never part of a longer character in UTF-8, GBK or GB18030, so
files are tested line by line in splits, with one partial result per task and
file; only lines with other than ASCII bytes, of files that are not UTF-8,
reach Python. Files are read in groups of equal charset and header and put
together by column name, so that files may differ in the order and number of
their columns. A file is read in splits unless a quoted cell of it holds a
line break (then some line has an odd number of quotes). Of the files only
paths, charsets and header lines reach the driver, which lists the paths anyway.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.constants import PANDAS_NULL_TOKENS

# Order used when scoring and when training (Python codec names).
SCORING_ENCODINGS = ("utf-8", "utf-8-sig", "gbk", "gb18030")
TRAINING_ENCODINGS = ("utf-8", "gbk", "gb18030", "utf-8-sig")

# Python codec -> JVM charset for the CSV reader (UTF-8 strips a BOM).
_JAVA_CHARSET = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "gbk": "GBK", "gb18030": "GB18030"}


class CharsetError(ValueError):
    pass


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, begin, nth, value): the lines of every file as they are, their bytes not decoded."""
    files = (spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path))
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin"),
                        F.monotonically_increasing_id().alias("nth"), "value")


def _decodes(encodings: Sequence[str]):
    """Per batch and file: which of ``encodings`` decode all its lines strictly."""
    encs = tuple(encodings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok: dict[str, list[bool]] = {}
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("raw").to_pylist()):
                own = ok.setdefault(path, [True] * len(encs))
                for k, enc in enumerate(encs):
                    if own[k]:
                        try:
                            raw.decode(enc, errors="strict")
                        except UnicodeDecodeError:
                            own[k] = False
            yield pa.RecordBatch.from_arrays([pa.array(list(ok), pa.string()), pa.array(list(ok.values()), pa.list_(pa.bool_()))], names=["path", "ok"])

    return run


def detect_charsets(spark: SparkSession, path: str, encodings: Sequence[str] = SCORING_ENCODINGS,
                    glob: str = "*.csv") -> DataFrame:
    """(path, charset, header, split) per file that has a line.

    ``charset`` is null when no encoding decodes the file, ``header`` is its
    first line as bytes, ``split`` tells that it may be read in splits.
    """
    lines = _lines(spark, path, glob)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    files = lines.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_and(quotes % 2 == 0).alias("split"),
                                      F.min_by("value", F.struct("begin", "nth")).cast("binary").alias("header"))
    others = [e for e in encodings if not e.startswith("utf-8")]
    other = F.lit(None).cast("string")
    if others:
        ascii_only = F.octet_length("value") == F.length("value")
        odd = (lines.filter(~(ascii_only & F.is_valid_utf8("value"))).join(files.filter("NOT utf8").select("path"), "path", "left_semi")
               .select("path", F.col("value").cast("binary").alias("raw")).mapInArrow(_decodes(others), "path string, ok array<boolean>")
               .groupBy("path").agg(*[F.bool_and(F.col("ok")[k]).alias(f"ok{k}") for k in range(len(others))]))
        files = files.join(odd, "path", "left")
    charset = F.coalesce(*[F.when(F.col("utf8") if e.startswith("utf-8") else F.col("utf8") | F.col(f"ok{others.index(e)}"), F.lit(e)) for e in encodings], other)
    return files.select("path", charset.alias("charset"), "header", "split")


def read_records(spark: SparkSession, path: str, encodings: Sequence[str] = SCORING_ENCODINGS,
                 columns: Sequence[str] | None = None, glob: str = "*.csv",
                 null_tokens: Sequence[str] | None = PANDAS_NULL_TOKENS, order_col: str | None = None) -> DataFrame:
    """All CSV files under ``path`` as string columns, charset chosen per file.

    Columns are put together by name: a file without one of them gives nulls.
    Line breaks inside a quoted cell are read as one line feed.
    ``columns`` prunes the scan; ``null_tokens`` reproduces the null
    handling of a pandas reader (pass ``None`` to keep cells as text);
    ``order_col`` names a column that orders rows by file and place in it.
    """
    try:
        found = detect_charsets(spark, path, encodings, glob).collect()  # one row per file
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    bad = sorted(r.path for r in found if r.charset is None)
    if bad:
        raise CharsetError(f"no encoding in {list(encodings)} decodes: {bad[:5]}")
    if not found:
        raise FileNotFoundError(f"no {glob} files under {path}")
    groups: dict[tuple, list[str]] = {}
    for r in found:
        groups.setdefault((_JAVA_CHARSET[r.charset], bytes(r.header).removeprefix(b"\xef\xbb\xbf").rstrip(b"\r"), r.split), []).append(r.path)
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    out = None
    for (charset, _, split), paths in sorted(groups.items()):
        df = (spark.read.option("header", True).option("multiLine", not split)
              .option("escape", '"').option("encoding", charset).option("inferSchema", False)
              .option("nullValue", None).option("emptyValue", "")
              .csv(sorted(paths)))
        if order_col:
            df = df.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                         F.monotonically_increasing_id().alias("nth")).alias(order_col))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if columns:
        require_columns(out, columns)
        out = out.select(*columns, *([order_col] if order_col else []))
    if null_tokens is not None:
        out = normalise_nulls(out, [c for c in out.columns if c != order_col], null_tokens)
    return out


def normalise_nulls(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    """Cells equal to one of ``tokens`` become null (the CSV reader takes only one)."""
    toks = list(tokens)
    return df.withColumns({c: F.when(F.col(c).isin(toks), F.lit(None).cast("string")).otherwise(F.col(c))
                           for c in cols})


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found; available columns: {df.columns}")
