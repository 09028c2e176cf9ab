"""Checks of the quality rules, license scan, toxicity, language model and pipeline against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from recsort.llm.oracle import SQL
from recsort.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SPACE = " \t\n\x0b\x0c\r"


def brute_statistics(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if x.strip(SPACE)]
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    again = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again),
            len(w) < 50 or 100 * len(again) > 50 * len(w))


def test_quality_rules(spark):
    from recsort.llm.quality_rules import judge
    r = random.Random(1)
    syllables = ["ka", "lo", "mé", "tri", "sun", "ba", "or", "ent"]

    def prose(n, symbols=0.0):
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) + "#" * (r.random() < symbols) for _ in range(n))
    rows = [(k, prose(r.randint(60, 400)), "en", "s1", 1.0) for k in range(400)]
    rows += [(1000 + k, " ".join(f"{r.getrandbits(700):x}##$$%%" for _ in range(60)), "en", "s1", 1.0) for k in range(3)]  # far from all others
    rows += [(2000 + k, t, None, None, None) for k, t in enumerate([None, "", " \n\t", "a b c", "a b c a b c " * 20, "x\nx\nx\ny " * 30, "é " * 60, "word"])]
    rows += [rows[5], rows[6]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, d2 double").repartition(3)
    got = judge(docs).collect()
    by = {x.row.doc_id: x for x in got}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        x = by[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == brute_statistics(t)
        assert not (x.base_failed and x.kept)
    assert not any(by[1000 + k].kept for k in range(3))
    assert sum(by[k].kept or by[k].base_failed for k in range(400)) == 400
    assert by[2005].distance is None or by[2005].base_failed  # no verdict but the base one without a vector
    assert judge(docs.limit(0)).count() == 0
    assert set(got[0].row.asDict()) == set(docs.columns)
    assert [set(x.row.asDict()) for x in judge(docs, keep=["doc_id"]).limit(1).collect()] == [{"doc_id"}]


def _texts(r, n, words=(60, 400)):
    syllables = ["ka", "lo", "mé", "tri", "sun", "ba", "or", "ent"]
    return [" ".join("".join(r.choice(syllables) for _ in range(r.randint(2, 4))) + str(r.randint(0, 9)) * (r.random() < 0.3) for _ in range(r.randint(*words))) for _ in range(n)]


def test_repetition_alone_is_an_outlier(spark):
    """Below the base limit of half the words, among texts that repeat nothing."""
    from recsort.llm.quality_rules import judge
    r = random.Random(4)
    texts = _texts(r, 300)
    body = _texts(r, 1, (155, 155))[0]
    odd = body + " " + " ".join(body.split()[:45])  # 90 of 200 words
    docs = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate([*texts, odd])], "doc_id long, text string, lang string, source string")
    got = {x.row.doc_id: x for x in judge(docs, keep=["doc_id"]).collect()}
    assert not got[300].base_failed and not got[300].kept
    assert sum(got[k].kept for k in range(300)) >= 297


def test_small_groups_are_judged_by_language_and_by_all(spark):
    from recsort.llm.quality_rules import judge
    r = random.Random(5)
    absurd = " ".join("#$%&" * 40 for _ in range(3000))
    rows = [(k, t, "en", f"s{k % 6}") for k, t in enumerate(_texts(r, 300))]                 # sources of 50 in a language of 300
    rows += [(1000 + k, t, "xx", "lone") for k, t in enumerate(_texts(r, 51))]               # a language of 51
    rows += [(2000, absurd, "en", "s1"), (2001, absurd, "xx", "lone"), (2002, absurd, None, None)]
    got = {x.row.doc_id: x for x in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), keep=["doc_id"]).collect()}
    assert not any(got[k].kept or got[k].base_failed and got[k].n_repeat_words == 0 for k in (2000, 2001, 2002))
    assert sum(got[k].kept for k in range(300)) >= 294 and sum(got[1000 + k].kept for k in range(51)) >= 49


def brute_mcd(x):
    """Location and Cholesky factor by the definitions, on whole rows instead of bins."""
    from recsort.llm import quality_rules as Q

    def factor(rows, scale=1.0):
        m = rows.mean(0)
        c = (len(rows) * scale * np.cov(rows.T, bias=True) + Q.PRIOR_ROWS * np.diag(np.square(Q.PRIOR))) / (len(rows) + Q.PRIOR_ROWS)
        return m, chol(c)

    def chol(c):
        low = np.zeros((5, 5))
        for i in range(5):
            for j in range(i + 1):
                v = c[i, j] - low[i, :j] @ low[j, :j]
                low[i, j] = np.sqrt(max(v, Q.FLOORS[i] ** 2)) if i == j else v / low[j, j]
        return low

    def d2(m, low):
        return (np.linalg.solve(low, (x - m).T) ** 2).sum(0)
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    starts = [factor(x), (q[1], chol(np.diag(((q[2] - q[0]) / 1.349) ** 2)))]
    for _ in range(Q.STEPS):
        starts = [factor(x[np.argsort(d2(*s), kind="stable")[:int(np.ceil(Q.SUPPORT * len(x)))]]) for s in starts]
    best = min(starts, key=lambda s: np.log(np.diag(s[1])).sum())
    d = d2(*best)
    return d2(*factor(x[d <= Q.CHI2_975 * max(np.median(d) / Q.CHI2_MEDIAN, 1.0)], Q.TRUNCATED))


def test_verdicts_against_brute_force_mcd(spark):
    from recsort.llm.quality_rules import CUTOFF, X, judge, vector
    r = random.Random(6)
    rows, texts = [], _texts(r, 500)
    for k, t in enumerate(texts):
        w = t.split()
        if k % 10 == 0:
            t = t + " " + " ".join(w[:r.randint(3, 25)])          # some words repeated
        if k % 7 == 0:
            t = " ".join(x + "#" * (r.random() < 0.02) for x in t.split())
        if k % 50 == 3:
            t = " ".join(x + "#$%" * r.randint(1, 4) for x in w)  # far off
        if k % 50 == 9:
            t = "\n".join(w[:20] + ["same line"] * 20 + w)
        rows.append((k, t, "en", "a" if k < 350 else "b"))
    out = judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), keep=["doc_id", "source"])
    got = out.select("row.doc_id", "row.source", "base_failed", "kept", "distance", *vector()).toPandas()
    seen = 0
    for _, g in got[~got.base_failed].groupby("source"):
        d = brute_mcd(g[X].to_numpy())
        clear = (d < CUTOFF * 0.75) | (d > CUTOFF * 1.33)
        assert ((d <= CUTOFF) == g.kept)[clear].all() and clear.mean() > 0.9
        seen += (~g.kept).sum()
    assert seen >= 15 and not got.kept[got.base_failed].any()


def test_mcd_estimate_against_numpy(spark):
    """Location and scatter of clean rows are found although a fifth of the rows lies elsewhere."""
    from recsort.llm.quality_rules import DIM, X, fit_mcd
    r = np.random.default_rng(0)
    clean = r.normal(size=(800, DIM)) @ np.diag([1.0, 2.0, 0.5, 1.5, 1.0])
    x = np.r_[clean, r.normal(size=(200, DIM)) * 0.1 + 30]
    fit = fit_mcd(spark.createDataFrame([("g", *map(float, v)) for v in x], "g string, " + ", ".join(f"{c} double" for c in X)).repartition(3)).collect()[0]
    center = np.array([fit[f"m{i}"] for i in range(DIM)])
    factor = np.array([[fit[f"l{i}{j}"] if j <= i else 0.0 for j in range(DIM)] for i in range(DIM)])
    assert np.abs(center - clean.mean(0)).max() < 0.15
    assert np.abs(factor @ factor.T - np.cov(clean.T)).max() < 0.4


def test_license_scan(spark):
    from recsort.llm.license_scan import scan_licenses
    texts = [None, "", "Foo under the MIT-license.", "under the MITX license", "UNDER\nTHE mit license; under the mit license", "cc by nc CC-BY-NC",
             "apache license version 2", "Released under this MIT License, ok", "the GNU general public license this work is licensed version",
             "redistribution and use in source and\nbinary forms", "ünder the mit license é", "Mozilla source code is subject to the terms of the public license " + "x " * 3000]
    docs = spark.createDataFrame([(k % 11, t, 1) for k, t in enumerate(texts)], "doc_id bigint, text string, th int").repartition(2)
    got = sorted(((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels, x.labels) for x in scan_licenses(docs).collect()), key=repr)

    def places(t, phrase):
        w, p = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), phrase.split()
        return len(w), [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
    want = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    for (i, n, base, first, last, labels, _), (k, t) in zip(got, sorted(((k % 11, t) for k, t in enumerate(texts)), key=lambda x: repr((x[0], places(x[1], "a")[0]))), strict=True):
        found = {v: places(t, p)[1] for v, p in want.items()}
        every = sorted(x for v in found.values() for x in v)
        assert (i, n, base) == (k, places(t, "a")[0], len(every))
        assert (first, last) == ((every[0], every[-1]) if every else (None, None))
        assert labels == ",".join(sorted(v for v, x in found.items() if x))
    own = {x.doc_id: x.labels for x in scan_licenses(docs).collect() if x.n_base == 0}
    assert own[7] == "mit" and own[8] == "gpl-3" and own[9] == ""
    assert scan_licenses(docs.limit(0)).count() == 0


def test_license_blocks_cross_line_ends_and_match_brute_force(spark):
    from recsort.llm.license_scan import TEMPLATES, prepared, scan_licenses
    r = random.Random(12)
    grant = TEMPLATES["bsd"][0].split()
    filler = [f"w{k}" for k in range(50)]
    texts = [None, "", " ".join(grant), " ".join(grant[:10]) + "\n" + " ".join(grant[10:]), "\n".join(grant), "x " * 30_000 + " ".join(grant) + " y" * 30_000,
             " ".join(w + " " + " ".join(filler[:9]) for w in grant), " ".join(reversed(grant)), " ".join(grant) + " " + " ".join(grant)]
    every = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    for ts in TEMPLATES.values():
        for t in ts:
            for _ in range(6):
                words = [w if r.random() < 0.87 else r.choice(every + filler) for w in t.split()]
                for _ in range(r.randrange(4)):
                    words.insert(r.randrange(len(words)), r.choice(every + filler))
                texts.append(" ".join(r.choices(filler, k=r.randrange(30)) + words + r.choices(every, k=r.randrange(60))))
    texts += texts[2:4]
    docs = spark.createDataFrame([(k, t, "?") for k, t in enumerate(texts)], "doc_id bigint, text string, label string").repartition(3)
    got = {x.doc_id: x for x in scan_licenses(docs).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        best = {}
        for label, ws, size in prepared(TEMPLATES):
            for i in range(max(len(w) - size + 1, 1)):
                n = len(set(ws) & set(w[i:i + size])) / len(ws)
                if n >= 0.8 - 1e-9:
                    best[label] = max(best.get(label, 0), n)
        base = set(filter(None, got[k].base_labels.split(",")))
        assert got[k].labels == ",".join(sorted(best.keys() | base)), t
        assert base or got[k].score == pytest.approx(max(best.values(), default=0.0))
    assert [got[k].labels for k in range(9)] == ["", "", "bsd", "bsd", "bsd", "bsd", "", "bsd", "bsd"]


def test_subsequence_kernel_against_definition():
    from itertools import combinations

    from recsort.llm.toxicity import DECAY, ORDER, Model, first_parts, fold, gram, weight_table
    words = ["trash", "t.r-ash", "trassh", "moron", "banana", "scum", "élève", "ab"]

    def features(w):
        codes, places = (x[:, 0] for x in first_parts([w])[w])
        out = Counter()
        for at in combinations(range(len(codes)), ORDER):
            out[tuple(codes[list(at)])] += DECAY ** (places[at[-1]] - places[at[0]] + 1)
        return out

    def kernel(a, b):
        dot = lambda x, y: sum(v * y[k] for k, v in x.items())
        return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5
    used = [w for w in words if w in first_parts(words)]
    assert used == words[:-1]
    marks = [first_parts([w])[w] for w in used]
    g = gram(used, marks)
    assert np.allclose(g, [[kernel(features(a), features(b)) for b in used] for a in used], atol=1e-5)
    assert g[0, 1] > 0.8 and g[0, 2] > 0.5 and g[0, 3] < 0.1
    # The written-out table decides as the sum over landmarks does.
    weights = np.linspace(-1, 1, len(used))
    model = Model(weight_table(marks, weights), 0.25, (1.0, 0.0, 0.0))
    for p in fold(used):
        assert np.allclose(model.decide(p), g[p.owner] @ weights + 0.25, atol=1e-4)


def test_toxicity_held_out(spark):
    from recsort.llm.toxicity import score, train
    r = random.Random(4)
    syllables = ["an", "the", "er", "ou", "ti", "on", "re", "ha", "st", "en"]
    insults = ["blockhead", "dimwit", "numbskull", "nitwit"]

    def prose():
        return ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(0, 80))]
    rows, labels = [], []
    for i in range(700):
        w, y = prose(), int(i % 4 == 0)
        for _ in range(3 * y):
            x = r.choice(insults)
            if zlib.crc32(str(i).encode()) % 5 == 0 and r.random() < 0.5:
                x = x[:3] + r.choice(".*-") + x[3:]
            w.insert(r.randint(0, len(w)), x)
        rows.append((i, " ".join(w), 0.5))
        labels.append((i, y))
    rows += [(900, None, 0.0), (901, "", 0.0), (902, "b l o c k h e a d n i t w i t " * 3, 0.0), (903, "x" * 100_000, 0.0), (None, "a", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double").repartition(3)
    model = train(docs, spark.createDataFrame([*labels, labels[1], (None, 1), (5, None)], "doc_id bigint, toxic int"))
    got = {x.row.doc_id: x.score for x in score(docs, model).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == y for i, y in held]) > 0.95
    assert len(got) == len(rows) and all(0 <= v <= 1 for v in got.values()) and got[900] == got[901] < 0.5 and got[903] < 0.5
    none = train(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert all(x.score < 0.5 for x in score(docs.limit(3), none).collect()) and score(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_duckdb(spark, key):
    import duckdb

    from tests.test_entry import _rows
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert _rows(QUERIES[key](spark, SF_SMALL).toPandas()) == _rows(con.execute(SQL[key]).df())


def test_pipeline(spark):
    """Each stage against the decisions of its own input."""
    from recsort.llm.common import staged
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes)
        before, after = ({x.doc_id: x.text for x in d.collect()} for d in (docs, out))
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert all(not brute_statistics(t)[-1] for t in after.values())
            good = {x.doc_id for x in spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("quality = 1").collect()}
            passing = {i for i, t in before.items() if not brute_statistics(t)[-1]}
            assert len((passing & good) - set(after)) <= 0.03 * len(passing & good)
            assert len(passing) - len(after) <= 0.1 * n
        elif name == "line_dedup":
            from tests.llm.test_pairs_and_spans import brute_lines
            assert {i: t for i, t, *_ in brute_lines(list(before.items()))} == after
        elif name == "decontamination":
            from tests.llm.test_pairs_and_spans import brute_hits
            items = [tuple(x) for x in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(after) == {i for i, t in before.items() if not brute_hits(t, items)[2]}
        else:
            assert all(after[i] == before[i] for i in after)
        kept[name], docs = len(after), out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {x.doc_id for x in pieces} == {x.doc_id for x in docs.collect()} and kept["decontamination"] > 0.3 * n


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_on_odd_rows(spark, name):
    """Null ids, texts, languages and sources, empty and very long texts, repeated rows, extra columns, no rows."""
    stage, r = dict(corpus_pipeline.STAGES)[name], random.Random(3)
    prose = [" ".join(r.choice("abcdefghij") + str(r.randrange(3000)) for _ in range(120)) for _ in range(40)]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(prose)]
    rows += [(100, None, "en", "s", None), (101, "", None, None, 0), (None, prose[0] + " x", "en", None, 1), (None, None, None, None, None),
             (3, prose[3], "en", "s", 1), (3, prose[3], "en", "s", 1), (102, " ".join(prose) * 5, "en", "s", 1), (103, prose[5], None, "s", 1)]
    extra = ["row", "id", "th", "words", "kept", "uid", "n", "place", "stays", "items", "fp", "h1", "kept_text"]
    docs = spark.createDataFrame([x + (1,) * len(extra) for x in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 + ", ".join(f"{c} int" for c in extra)).repartition(3)
    out, none = stage(spark, docs, SF_SMALL), stage(spark, docs.limit(0), SF_SMALL)
    assert none.count() == 0 and none.columns == out.columns
    got = out.collect()
    if name == "packing":
        assert Counter(x.doc_id for x in got if x.start == 0) == Counter(x[0] for x in rows)
        return
    assert out.columns == docs.columns and all(x[c] == 1 for x in got for c in extra)
    ids = Counter(x.doc_id for x in got)
    if name == "quality_rules":  # too short: null and empty
        assert all(x.text for x in got) and ids[100] == ids[101] == 0 and ids[3] in (0, 3)
        assert sum(ids[k] > 0 for k in range(40)) >= 38
    elif name == "line_dedup":  # every row stays, with "" for a null text; the copy under a larger id loses its line
        assert ids == Counter(x[0] for x in rows) and all(x.text is not None for x in got)
        assert {x.text for x in got if x.doc_id == 103} == {""} and {x.text for x in got if x.doc_id == 3} == {prose[3]}
    elif name == "simhash_dedup":  # texts without words are one group, as are copies
        assert ids[103] == 0 and all(ids[k] == 1 for k in range(40)) and sum(not x.text for x in got) == 1
    else:
        assert ids == Counter(x[0] for x in rows)


def test_cross_entropy_counts_every_pair_and_word(spark, monkeypatch):
    from recsort.llm import cross_entropy as ce
    r = random.Random(8)
    texts = [" ".join(f"w{r.choice((r.randrange(20), r.randrange(200_000)))}" for _ in range(r.randint(0, 900))) for _ in range(500)] + [None, "", "Rare RARE rare"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    split = lambda t: (t or "").encode().lower().split()
    known = {w for t in texts for w in split(t)}
    assert len(known) > 65_536

    def check(got, own, other, scored):
        size = lambda ts: sum(len(split(t)) for t in ts)
        vocab = len({w for t in [*own, *other] for w in split(t)}) + 1

        def model(ts, scale):
            one, before, pair = Counter(), Counter(), Counter()
            for t in ts:
                w = split(t)
                one.update(w)
                before.update([None, *w][:len(w)])
                pair.update(zip([None, *w], w, strict=False))
            n = sum(one.values()) * scale
            return lambda v, w: -np.log((pair[v, w] * scale + 20.0 * (one[w] * scale + 1) / (n + vocab)) / (before[v] * scale + 20.0))
        models = model(own, 1.0), model(other, size(own) / max(1, size(other)))
        for k, t in enumerate(scored):
            p = list(zip([None, *split(t)], split(t), strict=False))
            want = [np.mean([f(*x) for x in p]) if p else 0.0 for f in models]
            assert min(want) >= 0 and got[k].n_words == len(p)
            assert np.allclose([got[k].target_loss, got[k].background_loss, got[k].score], [*want, want[0] - want[1]], atol=1e-6)

    target = docs.filter("doc_id % 2 = 0")
    got = {x.row.doc_id: x for x in ce.cross_entropy_difference(docs, target, keep=["doc_id"]).collect()}
    assert len(got) == len(texts)
    check(got, texts[::2], texts, texts)
    got = {x.row.doc_id: x for x in ce.cross_entropy_difference(docs.withColumn("t", docs.doc_id % 2 == 0), "t", keep=["doc_id"]).collect()}
    check(got, texts[::2], texts, texts)
    ids = spark.createDataFrame([(k,) for k in range(0, len(texts), 2)] + [(0,), (None,), (10**6,)], "doc_id bigint")
    got = {x.row.doc_id: x for x in ce.cross_entropy_difference(docs, target_ids=ids, keep=["doc_id"]).collect()}
    check(got, texts[::2], texts, texts)
    # A background of its own, and many chunks and buckets.
    monkeypatch.setattr(ce, "CHUNK_BYTES", 100_000)
    monkeypatch.setattr(ce, "BUCKET_BYTES", 100_000)
    got = {x.row.doc_id: x for x in ce.cross_entropy_difference(docs, target, docs.filter("doc_id % 2 = 1")).collect()}
    check(got, texts[::2], texts[1::2], texts)
    got = {x.row.doc_id: x for x in ce.cross_entropy_difference(docs, target_ids=ids).collect()}
    check(got, texts[::2], texts, texts)
    assert ce.cross_entropy_difference(docs.limit(0), docs.limit(0)).count() == 0
    assert ce.cross_entropy_difference(docs.limit(0), target_ids=ids).count() == 0
