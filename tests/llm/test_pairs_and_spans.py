"""Brute-force checks of the dedup, decontamination, WARC and packing operators."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

from recsort.session import scratch_path

DOCS = "doc_id bigint, text string, h int, key string, row string"


def docs_of(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 1, "k", None) for i, t in zip(ids, texts, strict=True)], DOCS).repartition(3)


# --- line dedup ---------------------------------------------------------------

def brute_lines(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    big = float("inf")
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(big if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == (big if i is None else i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n_batches,fanout", [(1, 2), (5, 2), (7, 3)])
def test_line_dedup(spark, n_batches, fanout):
    from recsort.llm.line_dedup import dedup_lines
    r = random.Random(n_batches)
    pool = ["a common line here", "  A Common Line here\t", "ÉCOLE normale sup", "école normale sup", "short", "", "another long line 1", "x" * 10, "y" * 9]
    texts = ["\n".join(r.choice(pool) for _ in range(r.randint(0, 6))) for _ in range(40)] + [None, "", "\n", "\n\n", "a common line here\n" * 300]
    ids = [*range(40), 41, None, 42, 43, None]
    ids[7] = 6  # two rows of one document
    got = dedup_lines(docs_of(spark, texts, ids), n_batches=n_batches, fanout=fanout)
    rows = sorted(((x.row.doc_id, x.kept_text, x.n_lines, x.n_dropped) for x in got.collect()), key=repr)
    assert rows == brute_lines(list(zip(ids, texts, strict=True)))
    assert dedup_lines(docs_of(spark, [])).count() == 0


# --- SimHash ------------------------------------------------------------------

def test_anchor_covering_meets_every_pair():
    from recsort.llm.simhash import anchors
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    y = x.copy()
    for k in range(len(y)):
        for bit in r.choice(64, k % 3, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(bit)
    wx, ax, home = anchors(x, 2)
    wy, ay, _ = anchors(y, 2)
    for k in range(len(x)):
        assert home[wx == k].sum() == 1
        assert ax[(wx == k) & home][0] in ay[wy == k]
        near = np.bitwise_count(ax[wx == k] ^ (int(x[k]) & (1 << 46) - 1))
        assert near.max() <= 8 and len(set(ax[wx == k].tolist())) == (wx == k).sum()


def brute_components(fps, ids, bits):
    parent = list(range(len(fps)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                parent[root(a)] = root(b)
    groups = {}
    for k in range(len(fps)):
        groups.setdefault(root(k), []).append(ids[k])
    return [min((i for i in groups[root(k)] if i is not None), default=None) for k in range(len(fps))]


@pytest.mark.parametrize("hot", [4096, 2])
def test_link_fingerprints(spark, hot):
    from recsort.llm.components import components
    from recsort.llm.simhash import link_fingerprints
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:12]:
        for _ in range(r.randint(1, 12)):
            f ^= 1 << r.randrange(64)
            f ^= (1 << r.randrange(64)) * r.randrange(2)
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp bigint").repartition(3), 2, hot)
    label = {x.node: x.label for x in components(links).collect()}
    assert [label.get(f, f) for f in signed] == brute_components(fps, signed, 2)


def test_near_duplicates(spark):
    import xxhash

    from recsort.llm.simhash import fingerprint_text, near_duplicates
    r = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    base = [[r.choice(words) for _ in range(400)] for _ in range(8)]
    texts = [" ".join(b) for b in base]
    for b in base[:5]:
        for _ in range(3):
            c = list(b)
            c[r.randrange(400)] = "other"
            texts.append("\t".join(c).upper())
    texts += [None, "", " \n", "one", "one two", "One  two", "a b c", texts[0], "Ünï çode ÉÉ"]
    ids = list(range(len(texts)))
    ids[-2], ids[3], ids[4] = 0, None, 77
    got = near_duplicates(docs_of(spark, texts, ids)).withColumn("fpt", fingerprint_text("fp")).collect()

    def fp(t):
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in (zip(*(w[k:] for k in range(3))) if len(w) > 3 else [w] * bool(w))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    fps = [fp(t) for t in texts]
    want = sorted((str(i), f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_components(fps, ids, 2), strict=True))
    assert sorted((str(x.row.doc_id), x.fpt, x.component_id) for x in got) == want
    assert sum(x.stays for x in got) == len({c for _, _, c in want})
    assert near_duplicates(docs_of(spark, [])).count() == 0


# --- suffix dedup -------------------------------------------------------------

def brute_substrings(rows, length):
    rows = sorted(rows, key=lambda x: (x[0] is None, x[0]))
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for a in range(len(b) - length + 1):
            if b[a:a + length] in seen:
                gone[a:a + length] = [True] * length
            seen.add(b[a:a + length])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 18, 40])
def test_suffix_dedup(spark, block_bytes):
    from recsort.llm.suffix_dedup import dedup_substrings
    r = random.Random(9)

    def noise(n):
        return "".join(r.choice("abé ") for _ in range(n))
    shared = [noise(60) for _ in range(4)]
    texts = [noise(r.randint(0, 50)) + r.choice(shared)[r.randint(0, 20):r.randint(20, 60)] + noise(r.randint(0, 90)) for _ in range(60)]
    texts += [None, "", "ab", "a" * 500, "ab" * 200, texts[3], texts[3], shared[0] * 3]
    ids = [*range(len(texts) - 1), None]
    got = dedup_substrings(docs_of(spark, texts, ids), length=40, gram=8, block_bytes=block_bytes)
    rows = sorted((str(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got.collect())
    assert rows == brute_substrings(list(zip(ids, texts, strict=True)), 40)


def test_suffix_dedup_edges(spark):
    from recsort.llm.suffix_dedup import dedup_substrings
    text = "0123456789" * 3 + "abcdefghij" * 2
    same = dedup_substrings(docs_of(spark, [text, text], [5, 5]), length=40, gram=8, with_kept=True).collect()
    assert len({(x.n_removed, x.kept_sha256) for x in same}) == 1 and same[0].n_removed == 0 and same[0].kept == text.encode()
    assert dedup_substrings(docs_of(spark, [])).count() == 0


def test_suffix_dedup_tells_texts_with_equal_short_hashes_apart(spark):
    from pyspark.sql import functions as F

    from recsort.llm.suffix_dedup import dedup_substrings
    passage = "the quick brown fox jumps over the lazy dog and runs away "
    some = lambda head: spark.range(300_000).select(F.concat(F.lit(head), F.col("id").cast("string")).alias("t")).withColumn("h", F.hash("t"))
    long, short = some(passage).join(some("short ").withColumnRenamed("t", "u"), "h").orderBy("t", "u").select("t", "u").first()
    texts, ids = [passage, long, short], [0, None, None]
    got = dedup_substrings(docs_of(spark, texts, ids), length=40, gram=8)
    rows = sorted((str(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got.collect())
    assert rows == brute_substrings(list(zip(ids, texts, strict=True)), 40)


def test_suffix_dedup_shuffles_no_texts(spark):
    """Texts are dealt by document as they are written: neither the write nor a join by document exchanges them."""
    from recsort.llm import suffix_dedup as S
    keyed = S._keyed(docs_of(spark, ["a" * 50, "b" * 50, "short", None, "a" * 50], [1, 2, 3, 4, None]), "doc_id", "text")
    name = S.texts_by_document(keyed, 40)
    try:
        found = keyed.groupBy(*S.KEYS).count().hint("merge")
        joined = spark.table(name).join(found, S.KEYS)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and joined.count() == 3
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_long_prefixes_against_sorting():
    from recsort.llm.suffix_dedup import long_prefixes
    r = random.Random(4)
    for _ in range(100):
        n, length = r.randint(2, 200), r.choice([1, 3, 8])
        a = np.array([r.randrange(3) for _ in range(n)], np.uint8)
        order, joined = long_prefixes(a, length)
        d = bytes(a) * (2 + 2 * length // n)
        keys = [d[k:k + length] for k in order]
        assert keys == sorted(keys) and list(joined) == [False] + [x == y for x, y in zip(keys, keys[1:], strict=False)]


# --- decontamination ----------------------------------------------------------

def brute_hits(text, items):
    def words(t):
        return "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in t or "").split(" ")
    own = [w for w in words(text) if w]
    hit, found = set(), set()
    for name, t in items:
        w = [x for x in words(t) if x]
        n = min(10, len(w))
        if name is None or not n:
            continue
        windows = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
        for a in range(len(own) - n + 1):
            if tuple(own[a:a + n]) in windows:
                hit.update(range(a, a + n))
                found.add(str(name))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [2_000_000, 15])
def test_decontamination(spark, block_words):
    from recsort.llm.decontaminate import decontaminate, hit_words
    r = random.Random(8)
    v = ["the", "of", "été", "Zug", "x1", "b", "c", "d"]
    items = [(k, " ".join(r.choice(v) for _ in range(r.choice([0, 1, 3, 9, 10, 14, 30])))) for k in range(12)]
    items += [(3, "the of the of"), (None, "b c d"), (20, None), (10, "zug")]
    texts = [" ".join(r.choice(v) for _ in range(r.randint(0, 60))) for _ in range(30)]
    texts += [None, "", "...", "Foo, " + (items[6][1] or "b").upper() + "! bar", items[5][1], items[11][1] + ". " + items[10][1]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate(docs_of(spark, texts), bench, block_words=block_words).withColumn("n_hit", hit_words("spans")).collect()
    assert {x.row.doc_id: (x.n_words, x.n_hit, x["items"]) for x in got} == {k: brute_hits(t, items) for k, t in enumerate(texts)}
    none = decontaminate(docs_of(spark, ["a b"]), bench.limit(0)).collect()
    assert [(x.n_words, x["items"]) for x in none] == [(2, [])]
    assert decontaminate(docs_of(spark, []), bench).count() == 0


# --- WARC ---------------------------------------------------------------------

@pytest.mark.parametrize("min_bytes", [0, 5])
def test_warc_round_trip(spark, min_bytes):
    from recsort.llm.warc import read_archives, write_archives
    r = random.Random(3)
    html = [None, "", "é" * 40, "same page", "same page", "x"] * 4 + ["b" * 3_000_000] + [f"<p>{r.random()}" for _ in range(50)]
    ids = list(range(len(html)))
    ids[-1], ids[-2] = None, 3
    html[-2] = "same page"
    rows = [(i, None if i == 2 else f"http://h/{i} \r\nX: y", t, 1) for i, t in zip(ids, html, strict=True)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, kind int").repartition(3)
    outs = [scratch_path(spark, "warc-test") for _ in range(2)]
    for o in outs:
        write_archives(pages, o, min_bytes=min_bytes, roll_bytes=2000)
    got = read_archives(spark, outs[0], with_payload=True).collect()
    assert len(got) == len(html)
    first = {}
    for i, t in zip(ids, html, strict=True):
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    text = {str(i): t or "" for i, t in zip(ids, html, strict=True)}
    responses = {}
    for x in got:
        b = text[str(x.page_id)].encode()
        assert (x.payload_bytes, x.payload_digest) == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode())
        if x.record_type == "response":
            assert x.payload == b and x.refers_to is None
            responses.setdefault(b, []).append(x.page_id)
        else:
            assert x.refers_to == first[b.decode()] and len(b) >= min_bytes and x.payload == b""
    assert all(len(v) == 1 and v[0] == first.get(b.decode()) for b, v in responses.items() if len(b) >= max(1, min_bytes))
    names = [spark.read.json(f"{o}/manifest.jsonl").orderBy("name").collect() for o in outs]
    assert names[0] == names[1] and len(names[0]) > 3  # equal files, byte for byte
    empty = scratch_path(spark, "warc-empty")
    write_archives(pages.limit(0), empty)
    assert read_archives(spark, empty).count() == 0


# --- packing ------------------------------------------------------------------

def test_tokens_match_the_library():
    import public_tokenizers
    from recsort.llm.tokens import PLAIN, WordTokenizer
    t = WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(1)
    chars = [chr(c) for c in range(0x250)] + ["'s", "'ll", " ", "\n", "'", "ΑΣ ", "é", "日本", "<|endoftext|>"] * 4
    texts = ["".join(r.choice(chars) for _ in range(r.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(r.choice([c for c in chars if PLAIN.fullmatch(c)]) for _ in range(30)) for _ in range(4000)]
    for text in texts:
        assert t.encode(text) == t._whole(text) if text else t.encode(text) == b""
    assert t.by_words
    other = WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["Hello World, the Cat", *texts[:200]]:
        assert np.frombuffer(other.encode(text), other.dtype).tolist() == other.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "b": 1.0}])
def test_packing(spark, weights):
    import public_tokenizers
    from tokenizers import Tokenizer

    from recsort.llm.packing import pack
    r = random.Random(6)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sources = ["a"] * 30 + ["b"] * 10 + [None, "c"]
    texts = [" ".join(r.choice(["cat", "Strange", "été", "zzxy", "12"]) for _ in range(r.randint(0, 90))) for _ in sources]
    texts[3], texts[4] = None, ""
    rows = [(i, t, s, 5) for i, (t, s) in enumerate(zip(texts, sources, strict=True))] + [(7, texts[7], "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n int").repartition(3)
    got = pack(docs, weights=weights, length=64, packet=16, with_ids=True).collect()
    ids = {i: [*(lib.encode(t or "", add_special_tokens=False).ids), 2] for i, t, *_ in rows}
    for x in got:
        part = ids[x.doc_id][x.start:x.start + x.length]
        assert x.ids == part and x.doc_tokens == len(ids[x.doc_id]) and x.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    total = sum(len(ids[i]) for i, *_ in rows)
    filled = {}
    for x in got:
        filled.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for k, spans in filled.items():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == (64 if k < len(filled) - 1 else total - 64 * (len(filled) - 1))
    assert sum(x.length for x in got) == total and sorted(filled) == list(range(len(filled)))
    # Target proportions within a packet and a window's share, as long as both queues last.
    if weights is None:
        own = {s: sum(len(ids[i]) for i, _, z, _ in rows if z == s) for s in ("a", "b")}
        half = [x for x in got if x.sequence_id < len(filled) // 2]
        for s in own:
            assert abs(sum(x.length for x in half if x.source == s) - own[s] / total * 64 * (len(filled) // 2)) <= 64 + 16
    assert pack(docs.limit(0), weights=weights).count() == 0
