"""Cross-tokenizer alignment, Merkle manifest and exact top-k against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from recsort.llm import cross_tokenizer as X
from recsort.llm import merkle as M
from recsort.llm import topk as K

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


# ------------------------------------------------------------- op11

@pytest.fixture(scope="module")
def libraries():
    return X.ByteLevel(A), X.Pieces(B)


def brute_alignment(texts, a, b):
    """Per text (n_a, n_b, n_groups, links, groups text), by the definitions."""
    out = []
    for t in texts:
        ia = a.library.encode(" " + t, add_special_tokens=False).ids if t else []
        ib = b.library.encode(t) if t else []
        data = (" " + t).encode() if t else b""
        if not t or b"".join(a.pieces[i] for i in ia) != data or b"".join(b.pieces[i] for i in ib) != data:
            out.append((0, 0, 0, [], ""))
            continue
        ea, eb = np.cumsum([len(a.pieces[i]) for i in ia]).tolist(), np.cumsum([len(b.pieces[i]) for i in ib]).tolist()
        groups, pa, pb = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            qa, qb = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, ia[pa:qa])) + "|" + ",".join(map(str, ib[pb:qb])))
            pa, pb = qa, qb
        links = [(x, y) for x, e, s in zip(ia, ea, [0, *ea]) for y, f, r in zip(ib, eb, [0, *eb]) if s < f and r < e]
        out.append((len(ia), len(ib), len(groups), links, ";".join(groups)))
    return out


TEXTS = ["Hello World, the Cat sat.", "", None, "Hello World, the Cat sat.", "naïve façade  2x²  \n\n\tdon't <|endoftext|> <s> ▁x", "a", " ", "  lead",
         "漢字かな交じり文 \u0085 mixed İſ", "unbelievably"*40, "x y\nz\n", "the the the the", "\x00null", "… — “q”"]


def test_token_ids_are_the_libraries(libraries):
    a, b = libraries
    rng = random.Random(3)
    alphabet = "ab cd  \n\t'sét²½0123456789.,!?ſİ漢▁"
    for _ in range(400):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        plain = X.PLAIN.fullmatch(t) is not None
        for tok, ids in ((a, a.library.encode(" " + t, add_special_tokens=False).ids), (b, b.library.encode(t))):
            want = ids if tok.same(ids, (" " + t).encode()) else None
            got = tok.ids(" " + t, plain)
            assert (None if got is None else got.tolist()) == want


def test_gallop_finds_first_places():
    rng = np.random.default_rng(5)
    for _ in range(50):
        longer = np.cumsum(rng.integers(1, 9, rng.integers(1, 400)))
        shorter = np.unique(rng.choice(longer, rng.integers(1, len(longer) + 1)) - rng.integers(0, 2))
        got = X.intersect(shorter, longer, np.zeros(len(shorter), np.int64))
        assert got.tolist() == np.searchsorted(longer, shorter).tolist()


@pytest.mark.parametrize("chunk", [1, 8 << 20])
def test_alignment_equals_brute_force(spark, libraries, monkeypatch, chunk):
    monkeypatch.setattr(X, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(X, "BATCH_BYTES", 40)
    docs = spark.createDataFrame([(i if i != 3 else None, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, pairs string").repartition(3)
    want = brute_alignment(TEXTS, *libraries)
    count = Counter(x for w in want for x in w[3])
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    rows = X.align(docs, A, B).collect()
    got = Counter((r.row.text, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows)
    assert got == Counter((t, w[0], w[1], w[2], len(w[3]), sum(count[x] == top[x[1]] for x in w[3]), sum(count[x] for x in w[3]),
                           hashlib.sha256(w[4].encode()).hexdigest() if w[4] else "") for t, w in zip(TEXTS, want))
    assert set(rows[0].row.asDict()) == {"doc_id", "text", "pairs"}
    groups = Counter((r.row.text, r.groups) for r in X.alignments(docs, A, B).collect())
    assert groups == Counter((t, w[4]) for t, w in zip(TEXTS, want))


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert X.align(docs, A, B).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [(r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in X.align(blank, A, B).collect()] == [(0, 0, 0, "")] * 2


def test_alignment_query_on_the_table(spark, libraries):
    from recsort.llm.queries import op11_cross_tokenizer
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_alignment([t for _, t in texts if t is None or len(t) < 4000], *libraries)
    got = {r.doc_id: r for r in op11_cross_tokenizer(spark, sf).collect()}
    assert len(got) == len(texts)
    for (d, _), w in zip([x for x in texts if x[1] is None or len(x[1]) < 4000], want):
        r = got[d]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (w[0], w[1], w[2], len(w[3]))
        assert r.groups_sha256 == (hashlib.sha256(w[4].encode()).hexdigest() if w[4] else "")


# ------------------------------------------------------------- op12

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_tree(hashes):
    """(root, per leaf the list of (left, right) of each level)."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, p in enumerate(at):
            s = p // 3 * 3
            paths[i].append(("".join(level[s:p]), "".join(level[p + 1:s + 3])))
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        at = [p // 3 for p in at]
    return level[0], paths


def brute_manifest(rows):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by = defaultdict(list)
    for d, s, t in rows:
        by[s].append((d, sha(enc(d) + enc(s) + enc(t))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([h for _, h in sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]) for s in order}
    root, tops = brute_tree([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, tops):
        leaves = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        out += [(d, h, trees[s][0], root, sha("".join(x + y for x, y in p + above))) for (d, h), p in zip(leaves, trees[s][1])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_brute_force(spark, monkeypatch, height):
    monkeypatch.setattr(M, "HEIGHT", height)
    monkeypatch.setattr(M, "BLOCK", 3 ** height)
    rng = random.Random(height)
    rows = [(rng.randint(-5, 400), rng.choice([None, "", "a", "a", "a", "é", "z"]), rng.choice([None, "", "x\ny", "long " * 50])) for _ in range(300)]
    rows += [(None, "a", "n"), (None, None, None), (7, "lone", "x"), (1, "two", "x"), (2, "two", "y"), *[(9, "a", "same")] * 40]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("pos", F.lit(1)).repartition(4)
    out = M.manifest(docs, ["doc_id", "source", "text"], flipped=M.leaf(F.lit("other")))
    out = out.select("*", M.proof_digest(F.col("path")).alias("proof"), M.fold(F.col("leaf"), F.col("path")).alias("again"),
                     M.fold(F.col("flipped"), F.col("path")).alias("wrong"))
    got = out.collect()
    assert sorted([(r.key, r.leaf, r.subroot, r.root, r.proof) for r in got], key=repr) == brute_manifest(rows)
    assert all(r.again == r.root and r.wrong != r.root for r in got)


def test_manifest_of_no_rows_and_of_one(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert M.manifest(docs, ["doc_id", "source", "text"]).count() == 0
    one = M.manifest(spark.createDataFrame([(1, None, "t")], "doc_id long, source string, text string"), ["doc_id", "source", "text"]).first()
    assert one.leaf == one.subroot == one.root == sha("1:1-1:t") and one.path == []


# ------------------------------------------------------------- op13

def brute_topk(rows, k, is_query):
    ok = [(r, i, [math.floor(256 * x) for x in v]) for r, (i, v) in enumerate(rows)
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for r, i, v in ok:
        if i is not None and is_query(i):
            best = sorted([(-sum(x * y for x, y in zip(v, w)), j is None, j or 0, j) for s, j, w in ok if s != r])[:k]
            out += [(i, n + 1, b[3], -b[0]) for n, b in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [64, 8 << 20])
def test_topk_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(K, "QUERY_BYTES", block)
    monkeypatch.setattr(K, "QUERY_TILE", 3)
    monkeypatch.setattr(K, "ROW_TILE", 7)
    rng = random.Random(block)
    rows = [(i, [rng.choice([-0.5, 0.1, 0.25, 0.7, -0.031]) for _ in range(4)]) for i in range(60)]
    rows += [(3, rows[3][1]), (3, [0.1] * 4), (None, [0.7] * 4), (70, None), (71, [0.1, None, 0.2, 0.3]), (72, [float("nan"), 0.0, 0.0, 0.0]),
             (75, [float("inf"), 0.0, 0.0, 0.0]), (80, [0.5]), (85, [0.5] * 7), (90, []), *[(100 + i, [0.7] * 4) for i in range(30)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).repartition(3)
    got = K.search(df, 5, is_query=F.col("vec_id") % 5 == 0)
    assert sorted([tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()], key=repr) == brute_topk(rows, 5, lambda i: i % 5 == 0)


def test_topk_of_large_components_and_few_rows(spark):
    rows = [(0, [2.0 ** 40, 1.0]), (5, [2.0 ** 13, -3.0]), (10, [2.0 ** 13, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in K.search(df, 5, is_query=F.col("vec_id") % 5 == 0).select("query_id", "rank", "vec_id", "score").collect())
    want = sorted((i, n, j, max(-2 ** 63, min(2 ** 63 - 1, s))) for i, n, j, s in brute_topk(rows, 5, lambda i: True))
    assert [(a, b, d) for a, b, _, d in got] == [(a, b, d) for a, b, _, d in want]
    assert K.search(df.limit(0), 5).count() == 0
    assert K.search(df.filter("vec_id = 5"), 5).count() == 0
