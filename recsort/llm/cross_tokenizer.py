"""Alignment of two tokenizers on whole texts, and counts of the linked ids.

Tokenizer A is a byte-level BPE file run on a space and the text, B a
sentencepiece model run on the text, which puts that space itself. Every token
ends at a byte offset. The offsets where both end, found by galloping
intersection, cut a text into groups; an A and a B token whose byte ranges
overlap are linked.

Galloping: of a document's two ascending end lists the shorter one drives. Each
of its ends starts where an earlier end was found in the longer list, doubles
its step until it is passed and then halves the bracket (``gallop``, numpy
lanes: every 64th end starts at its document's first token, the ends between
start at the place found for the one before them, by ``STRIDES``). The places are ranks
in the longer list: those of two neighbours bound the range of longer tokens
that a shorter token overlaps, so links are ranges and are never searched for.

Counts over all documents: texts are packed in chunks of ``CHUNK_BYTES``; a
chunk counts its distinct id pairs, Spark sums equal pairs over the chunks and
joins the totals back to the chunks that hold them, so the most frequent pair
is one row a chunk. Each B id's highest count comes from the same totals.

Token ids are the libraries' own. For texts of plain Latin characters A's ranks
and word pattern, read from its file, run in ``tiktoken``, which is faster; this
is only done if the file is of that kind and each entry of its vocabulary is
its own encoding. Any other text or file is encoded by ``tokenizers``.

Defined results: null and empty texts, and texts whose joined A or B bytes
differ from a space and the text, have no tokens: zeros and an empty string;
the tokenizers' special strings in a text are plain text; repeated rows count
and are answered each; very long texts are a chunk of their own; an empty table
gives an empty table; input columns (or those of ``keep``) are in ``row``, so
that they cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from recsort.llm.common import packed, staged, worker_state
from recsort.llm.tokens import PLAIN

CHUNK_BYTES = 8 << 20
BATCH_BYTES = 1 << 20   # texts aligned together
STRIDES = (64, 8, 1)    # ends that are searched for before those between them
WIDE = 1 << 20          # pairs are coded A id * WIDE + B id

# The words of the byte-level pre-tokenizer.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Tokens:
    """``ids`` of a text, None if their joined bytes differ from it; ``pieces`` holds the bytes of each id."""

    pieces: list[bytes]

    def same(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids)) == data

    def lengths(self) -> np.ndarray:
        if len(self.pieces) > WIDE:
            raise ValueError(f"a vocabulary of more than {WIDE} ids")
        return np.array([len(p) for p in self.pieces], np.int64)

    def ids(self, text: str, plain: bool) -> np.ndarray | None:
        """``text`` begins with the space that both tokenizers see."""
        ids = self.encode(text)
        return np.array(ids, np.int64) if self.same(ids, text.encode()) else None


class ByteLevel(_Tokens):
    """A ``tokenizers`` file of byte-level BPE."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # The printable stand-in of each byte: its own character if it has one, else the next from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = iter(range(256, 512))
        byte = {chr(b if b in own else next(rest)): b for b in range(256)}
        data = lambda piece: bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
        self.pieces = [b""] * self.library.get_vocab_size()
        for piece, i in self.library.get_vocab().items():
            self.pieces[i] = data(piece)
        self.fast = self._ranks(spec, data)

    def _ranks(self, spec: dict, data):
        """The same tokenizer in ``tiktoken``, or None if the file is of another kind."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (spec.get("normalizer") is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or model.get("type", "BPE") != "BPE" or model.get("dropout")):
            return None
        vocab = model["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", [])}
        made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        if None in made or made != sorted(made):
            return None
        if any([t.id for t in self.library.model.tokenize(p)] != [i] for p, i in vocab.items() if p not in special):
            return None
        import tiktoken
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks={data(p): i for p, i in vocab.items() if p not in special}, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str, plain: bool) -> np.ndarray | None:
        if not plain or self.fast is None:
            return super().ids(text, plain)
        # Every byte is in some token, so the joined bytes are the text.
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


class Pieces(_Tokens):
    """A ``sentencepiece`` model."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        byte = [re.fullmatch(r"<0x([0-9A-F]{2})>", p) for p in names]
        self.pieces = [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for p, m in zip(names, byte)]

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text[1:])


def gallop(longer: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per wanted value the first place at or after ``start`` whose value is at least it (it must exist)."""
    low = start.copy()            # everything before low is smaller than the value
    high = start.copy()
    step = 1
    last = len(longer) - 1
    active = np.flatnonzero(longer[high] < wanted)
    while len(active):            # double the step until the value is reached
        low[active] = high[active] + 1
        high[active] = np.minimum(high[active] + step, last)
        active = active[longer[high[active]] < wanted[active]]
        step *= 2
    active = np.flatnonzero(low < high)
    while len(active):            # halve the bracket
        mid = (low[active] + high[active]) >> 1
        less = longer[mid] < wanted[active]
        low[active[less]] = mid[less] + 1
        high[active[~less]] = mid[~less]
        active = active[low[active] < high[active]]
    return high


def intersect(shorter: np.ndarray, longer: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of the shorter list's ends in the longer list; ``first`` is a place not beyond each."""
    start, before = first, 0
    for stride in STRIDES:
        own = slice(None, None, stride)
        # A later document's first token may lie beyond the place found for the end before it.
        known = first[own] if not before else np.maximum(np.repeat(start, before // stride)[: len(first[own])], first[own])
        start, before = gallop(longer, shorter[own], known), stride
    return start


class _Aligner:
    """Aligns batches of texts; ``names`` are the strings of both vocabularies with their separators."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.len_a, self.len_b = self.a.lengths(), self.b.lengths()
        na, nb = len(self.a.pieces), len(self.b.pieces)
        self.offsets = {"a,": 0, "a|": na, "b,": 2 * na, "b;": 2 * na + nb}
        number = lambda n, end: [b"%d%s" % (i, end) for i in range(n)]
        self.names = number(na, b",") + number(na, b"|") + number(nb, b",") + number(nb, b";")

    def tokens(self, text: str | None):
        if not text:
            return None
        plain = PLAIN.fullmatch(text) is not None
        a = self.a.ids(" " + text, plain)
        b = self.b.ids(" " + text, plain) if a is not None else None
        return None if b is None or not len(a) or not len(b) else (a, b)

    def align(self, texts: list[str | None]):
        """Per text (n_a, n_b, n_groups, n_links, groups text), and the links as (text number, pair, times), sorted."""
        out = [(0, 0, 0, 0, None)] * len(texts)
        found = [(k, *t) for k, x in enumerate(texts) if (t := self.tokens(x)) is not None]
        if not found:
            none = np.empty(0, np.int64)
            return out, none, none, none
        drives = np.array([len(a) <= len(b) for _, a, b in found])  # A is the shorter list
        n_s = np.array([min(len(a), len(b)) for _, a, b in found])
        n_l = np.array([max(len(a), len(b)) for _, a, b in found])
        s_ids = np.concatenate([a if d else b for (_, a, b), d in zip(found, drives)])
        l_ids = np.concatenate([b if d else a for (_, a, b), d in zip(found, drives)])
        s_is_a, l_is_a = np.repeat(drives, n_s), np.repeat(~drives, n_l)
        size = lambda ids, is_a: np.where(is_a, self.len_a[np.where(is_a, ids, 0)], self.len_b[np.where(is_a, 0, ids)])
        # Both sides of a text have as many bytes, so ends go on from text to text.
        s_end, l_end = np.cumsum(size(s_ids, s_is_a)), np.cumsum(size(l_ids, l_is_a))
        l_first = np.cumsum(n_l) - n_l
        place = intersect(s_end, l_end, np.repeat(l_first, n_s))
        common = l_end[place] == s_end
        # Links: a shorter token overlaps the longer ones from behind the last place (or on it, if no common end) to its own.
        low = np.concatenate([[0], place[:-1] + common[:-1]])
        times = place - low + 1
        of_s = np.repeat(np.arange(len(s_ids)), times)
        of_l = np.arange(len(of_s)) - np.repeat(np.cumsum(times) - times - low, times)
        x, y = s_ids[of_s], l_ids[of_l]
        pair = np.where(s_is_a[of_s], x * WIDE + y, y * WIDE + x)
        number = np.repeat(np.arange(len(found)), n_s)
        links = np.bincount(number, times, len(found)).astype(np.int64)
        groups = np.bincount(number, common, len(found)).astype(np.int64)
        # Text of the groups: within each, A's names and then B's.
        l_common = np.zeros(len(l_ids), bool)
        l_common[place[common]] = True
        s_stop, l_stop = np.flatnonzero(common) + 1, np.flatnonzero(l_common) + 1
        s_group, l_group = np.cumsum(common) - common, np.cumsum(l_common) - l_common
        s_start, l_start = np.concatenate([[0], s_stop[:-1]]), np.concatenate([[0], l_stop[:-1]])
        code = np.empty(len(s_ids) + len(l_ids), np.int64)
        at = lambda is_a, last: np.where(is_a, np.where(last, self.offsets["a|"], self.offsets["a,"]),
                                         np.where(last, self.offsets["b;"], self.offsets["b,"]))
        code[np.arange(len(s_ids)) + np.where(s_is_a, l_start[s_group], l_stop[s_group])] = s_ids + at(s_is_a, common)
        code[np.arange(len(l_ids)) + np.where(l_is_a, s_start[l_group], s_stop[l_group])] = l_ids + at(l_is_a, l_common)
        stops = np.cumsum(n_s + n_l)
        for i, (k, a, b) in enumerate(found):
            text = b"".join(map(self.names.__getitem__, code[stops[i] - len(a) - len(b):stops[i]].tolist()))[:-1]
            out[k] = (len(a), len(b), int(groups[i]), int(links[i]), text)
        # Distinct pairs of each text: one sort by (text, pair).
        who = np.array([k for k, _, _ in found])[number][of_s]
        if len(texts) * WIDE * WIDE < 1 << 63:
            both = who * (WIDE * WIDE) + pair
            both.sort()
            who, pair = both // (WIDE * WIDE), both % (WIDE * WIDE)
        else:
            order = np.lexsort((pair, who))
            who, pair = who[order], pair[order]
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (who[1:] != who[:-1])]))
        return out, who[new], pair[new], np.diff(np.append(new, len(pair)))


def _aligner(path_a: str, path_b: str) -> _Aligner:
    return worker_state(f"aligner {path_a} {path_b}", lambda: _Aligner(path_a, path_b))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list, int]]:
    """(rows, texts, bytes) of about ``BATCH_BYTES`` of text each."""
    for batch in batches:
        rows, texts = batch.column("row"), batch.column("text").to_pylist()
        begin = size = 0
        for i, t in enumerate(texts):
            size += len(t or "") + 1
            if size >= BATCH_BYTES or i + 1 == len(texts):
                yield rows[begin:i + 1], texts[begin:i + 1], size
                begin, size = i + 1, 0


def alignments(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row``, n_a, n_b, n_groups, n_links and ``groups`` (``a1,a2|b1;a3|b2,b3``, empty without tokens) per document."""
    src = packed(docs if keep is None else docs.select(*{*keep, text_col}), text=text_col)
    if keep is not None:
        src = src.select(F.struct(*[F.col(f"row.`{c}`").alias(c) for c in keep]).alias("row"), "text")
    schema = StructType([StructField("row", src.schema["row"].dataType), *[StructField(c, LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                         StructField("groups", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for rows, texts, _ in _batches(batches):
            cols = list(zip(*aligner.align(texts)[0]))
            yield pa.RecordBatch.from_arrays([rows, *[pa.array(c, pa.int64()) for c in cols[:4]],
                                              pa.array([(x or b"").decode() for x in cols[4]], pa.string())], schema=arrow)

    return src.mapInArrow(run, schema)


def _chunks(path_a: str, path_b: str, schema: StructType):
    """One row a chunk: its documents' rows and numbers, its distinct pairs and how often, and the documents' links by place of the pair."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        rows, told, links, base, size = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            who, pair, times = (np.concatenate(x) for x in zip(*links))
            pairs, place = np.unique(pair, return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, place, times)
            entries = np.bincount(who, minlength=base)
            one = lambda x, t: pa.array([x], pa.list_(t))
            numbers = [one([d[i] for d in told], pa.int64()) for i in range(4)]
            sha = one([d[4] for d in told], pa.string())
            row = pa.ListArray.from_arrays(pa.array([0, base], pa.int32()), pa.concat_arrays(rows))
            data = place.astype("<u4").tobytes() + times.astype("<u4").tobytes()
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([row, *numbers, sha, one(entries.tolist(), pa.int64()), one(pairs, pa.int64()), one(sums, pa.int64()), pa.array([data], pa.binary())], arrow)], schema=arrow)

        for part, texts, n in _batches(batches):
            out, who, pair, times = aligner.align(texts)
            told += [(*d[:4], hashlib.sha256(d[4]).hexdigest() if d[4] is not None else "") for d in out]
            rows.append(part)
            links.append((who + base, pair, times))
            base, size = base + len(texts), size + n
            if size >= CHUNK_BYTES:
                yield flush()
                rows, told, links, base, size = [], [], [], 0, 0
        if base:
            yield flush()

    return run


def _resolve(schema: StructType):
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda c: batch.column(c)[i]  # noqa: E731,B023
                entries = cell("entries").values.to_numpy(zero_copy_only=False)
                data = np.frombuffer(cell("links").as_py(), "<u4")
                place, times = data[: len(data) // 2], data[len(data) // 2:].astype(np.int64)
                totals = cell("totals").values.to_numpy(zero_copy_only=False) if len(place) else np.empty(0, np.int64)
                best = cell("best").values.to_numpy(zero_copy_only=False).astype(bool) if len(place) else np.empty(0, bool)
                stop = np.cumsum(entries)

                def per_document(x):
                    run_ = np.concatenate([[0], np.cumsum(x)])
                    return run_[stop] - run_[stop - entries]  # noqa: B023

                yield pa.RecordBatch.from_arrays(
                    [cell("rows").values, *[cell(c).values for c in ("n_a", "n_b", "n_groups", "n_links")],
                     pa.array(per_document(np.where(best[place], times, 0)), pa.int64()),
                     pa.array(per_document(totals[place] * times), pa.int64()), cell("sha").values], schema=arrow)

    return run


def align(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 per document.

    A pair's count is the number of links of all documents that hold it; n_best
    counts a document's links whose count is the highest of their B id, and
    count_sum adds up its links' counts.
    """
    src = packed(docs if keep is None else docs.select(*{*keep, text_col}), text=text_col)
    if keep is not None:
        src = src.select(F.struct(*[F.col(f"row.`{c}`").alias(c) for c in keep]).alias("row"), "text")
    row = src.schema["row"].dataType
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    longs = lambda *names: [StructField(c, ArrayType(LongType())) for c in names]
    chunk = StructType([StructField("rows", ArrayType(row)), *longs(*numbers), StructField("sha", ArrayType(StringType())),
                        *longs("entries", "pairs", "sums"), StructField("links", BinaryType())])
    chunks = staged(src.mapInArrow(_chunks(path_a, path_b, chunk), chunk).withColumn("chunk", F.monotonically_increasing_id()), "aligned-chunks")
    asked = lambda *cols: chunks.select("chunk", F.explode(F.arrays_zip("pairs", "sums")).alias("x")).select(*cols)
    totals = asked(F.col("x.pairs").alias("pair"), F.col("x.sums").alias("n")).groupBy("pair").agg(F.sum("n").alias("total"))
    # At most one row per A id shares a B id.
    top = F.max("total").over(Window.partitionBy(F.col("pair") % WIDE))
    totals = staged(totals.select("pair", "total", (F.col("total") == top).cast("long").alias("best")), "aligned-totals")
    reply = (asked("chunk", F.col("x.pairs").alias("pair")).join(totals, "pair")
             .groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("pair", "total", "best"))).alias("r"))
             .select("chunk", F.col("r.total").alias("totals"), F.col("r.best").alias("best")))
    full = chunks.drop("pairs", "sums").join(reply, "chunk", "left").drop("chunk")
    out = StructType([StructField("row", row), *[StructField(c, LongType()) for c in (*numbers, "n_best", "count_sum")], StructField("groups_sha256", StringType())])
    return full.mapInArrow(_resolve(out), out)
