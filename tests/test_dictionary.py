"""Keyword matching forms, article cleaning, corrections, recovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsort.operators import dictionary as D
from recsort.sources import fixtures as FX
from recsort.sources.tables import table
from tests.conftest import SF_CHECK, SF_SMALL


def _pairs(df):
    return sorted(tuple(r) for r in df.select("doc_id", "keyword", "category").collect())


def _brute(docs, kw):
    return sorted({(r.doc_id, k.keyword, k.category) for k in kw.collect() for r in docs.collect() if r.text and k.keyword and k.keyword in r.text})


def test_keyword_join_agrees_with_rules_on_the_fixture(spark):
    docs = table(spark, SF_CHECK, "documents", "doc_id", "text")
    kw = FX.keywords_df(spark)
    a = _pairs(D.keyword_match(docs, kw))
    assert a == _pairs(D.rule_matches(docs, kw))
    assert len(a) == 39


def test_keyword_join_on_many_keywords(spark):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text")
    words = docs.select(F.explode(F.split("text", r"[^\p{L}]+")).alias("keyword")) \
        .filter(F.length("keyword") >= 1).distinct().orderBy(F.xxhash64("keyword")).limit(400)
    kw = words.select("keyword", F.substring("keyword", 1, 2).alias("category"))
    a = _pairs(D.keyword_match(docs, kw))
    assert a == _brute(docs, kw) and len(a) > 300


def test_overlapping_short_and_repeated_keywords(spark):
    docs = spark.createDataFrame([(1, "abcabc MIT License MIT"), (2, None), (3, ""), (4, "x"), (5, "né 漢字かな \U00020000z\nline"), (1, "MIT"), (None, "xy")], "doc_id long, text string")
    kw = spark.createDataFrame([("abc", "x"), ("bca", "y"), ("MIT", "p"), ("MIT License", "p"), ("MIT", "p"), ("MIT", "q"), ("x", "one"), ("é", "one"), ("漢字かな", "four"),
                                ("\U00020000z", "two"), ("z\nli", "break"), ("", "empty"), (None, "null"), ("absent", "a"), ("abcd", "a")], "keyword string, category string")
    want = [(1, "MIT", "p"), (1, "MIT", "q"), (1, "MIT License", "p"), (1, "abc", "x"), (1, "bca", "y"), (4, "x", "one"), (5, "é", "one"),
            (5, "漢字かな", "four"), (5, "\U00020000z", "two"), (5, "z\nli", "break"), (None, "x", "one"), (1, "MIT", "p"), (1, "MIT", "q")]
    for got in (D.keyword_match(docs, kw), D.rule_matches(docs, kw)):
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert D.keyword_match(docs.limit(0), kw).count() == 0 and D.keyword_match(docs, kw.limit(0)).count() == 0


def test_rule_classify_catch_all_and_sorting(spark):
    rec = spark.createDataFrame([("a", "MIT License and CC BY-NC"), ("b", "nothing"), ("c", None)],
                                "vc_id string, text_combined string")
    got = {r.vc_id: (r.rule_categories, r.n_keywords) for r in D.rule_classify(rec, FX.keywords_df(spark)).collect()}
    assert got == {"a": ("noncommercial||permissive", 2), "b": ("其他违法行为", 0), "c": ("其他违法行为", 0)}


def test_clean_edges_reaches_fixed_point(spark):
    lines = FX.f8_article_lines(spark, SF_CHECK)
    once = D.clean_edges(D.normalise_article(F.col("line")), FX.EDGE_RULES)
    twice = D.clean_edges(once, FX.EDGE_RULES)
    out = lines.select(once.alias("a"), twice.alias("b"))
    assert out.filter(F.col("a") != F.col("b")).count() == 0
    licences = out.filter(F.col("a").contains("icense") | F.col("a").startswith("CC"))
    assert sorted(r[0] for r in licences.select("a").distinct().collect()) == [
        "Apache License", "CC BY-NC 4.0", "GNU General Public License", "MIT License"]


def test_nested_edges_are_all_taken(spark):
    df = spark.createDataFrame([("Licensed under " * 5 + "Licensed under the X, version 2.0., version 3..",)], "line string")
    got = df.select(D.clean_edges(F.col("line"), FX.EDGE_RULES)).first()[0]
    assert got == "X"


def test_interleaved_rules_reach_the_fixed_point_and_the_log_agrees(spark):
    rules = [("a", "lead", "A "), ("b", "lead", "B+ "), ("dot", "tail", "[.]"), ("v", "tail", " v[0-9]")]
    lines = ["A B A x", "BBB A B x. v1. v2..", "x", "", "A ", "A B", " v1", "A x v1 A"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, line string")
    got = {r.line: r.c for r in df.select("line", D.clean_edges(F.col("line"), rules).alias("c")).collect()}
    assert got == {"A B A x": "x", "BBB A B x. v1. v2..": "x", "x": "x", "": "", "A ": "", "A B": "B", " v1": "", "A x v1 A": "x v1 A"}
    log = {r.before: (r.after, r.rule) for r in D.clean_edges_log(df, rules).collect()}
    assert log == {"A B A x": ("x", "a+b+a"), "BBB A B x. v1. v2..": ("x", "b+a+b+dot+dot+v+dot+v+dot"), "A ": ("", "a"), "A B": ("B", "a"), " v1": ("", "v"), "A x v1 A": ("x v1 A", "a")}
    # leads one piece at a time, then tails one piece at a time, until no rule matches any more
    import random
    import re
    rng = random.Random(2)
    texts = ["".join(rng.choice(["A ", "B ", "BB ", ".", " v1", "x", "A"]) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, line string")
    for r in df.select("line", D.clean_edges(F.col("line"), rules).alias("c")).collect():
        t, before = r.line, None
        while t != before:
            before = t
            for side in ("lead", "tail"):
                last = None
                while t != last:
                    last = t
                    for _, s, p in rules:
                        if s == side:
                            t = re.sub(f"^(?:{p})" if side == "lead" else f"(?:{p})\\Z", "", t)
        assert r.c == t, (r.line, r.c, t)


def test_rules_may_be_a_table(spark):
    rules = spark.createDataFrame([("a", "lead", "A ")], "name string, side string, pattern string")
    assert D.edge_rules(rules) == [("a", "lead", "A ")]
    df = spark.createDataFrame([("A A x",)], "line string")
    assert df.select(D.clean_edges(F.col("line"), rules)).first()[0] == "x"


def test_normalise_article_folds_width_and_space(spark):
    df = spark.createDataFrame([("　ＭＩＴ　　License\t",)], "line string")
    assert df.select(D.normalise_article(F.col("line"))).first()[0] == "MIT License"


def test_normalise_article_on_every_space_and_width(spark):
    """Texts with white space of any kind, full-width forms or neither, against a fold and split by hand."""
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    some = [f"a{c}b" for c in spaces] + [f"{c}é{c} {c}b{c}" for c in spaces] + ["a  b", " a b ", "", " ", "é  ü", "“q” – 「x」、。", "ｱ\u2007", "\U0001f600  x"]
    some += [f"x{chr(c)} y" for c in range(0xFF01, 0xFF5F)] + [f"{chr(c)}z" for c in (0x7F, 0x84, 0x86, 0xA1, 0x200B, 0x2030, 0xFEFF, 0xFF5F)]
    df = spark.createDataFrame([(t,) for t in [*some, None]], "line string")
    fold = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 0x20}
    got = {r.line: r.n for r in df.select("line", D.normalise_article(F.col("line")).alias("n")).collect()}
    assert got == {t: " ".join(t.translate(fold).split()) for t in some} | {None: None}


def test_citations_are_cut_once(spark):
    """The texts are matched and the citations cleaned at one place of the plan; rows without a key, text, citation or category are kept."""
    docs = spark.range(6).select(F.when(F.col("id") < 5, F.col("id") % 4).alias("doc_id"),
                                 F.when(F.col("id") != 2, F.concat(F.lit("《MIT License.》 《MIT License》 《x "), F.col("id"), F.lit("》"))).alias("cited_text"))
    pairs = spark.range(1).select(F.lit("MIT License").alias("article"), F.lit("permissive").alias("category"))
    found = D.citation_lookup(docs, pairs, FX.EDGE_RULES)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count(r"[Vv]ersion") == 1
    assert {r.doc_id: (r.n_citations, r.categories) for r in found.collect()} == {
        0: (6, "permissive"), 1: (3, "permissive"), 2: (0, ""), 3: (3, "permissive"), None: (3, "")}


def test_corrections_recovery_and_logs(spark):
    pairs = spark.createDataFrame([("GNU General Public License", "copyleft"), ("CC BY-NC 4.0", "noncommercial"),
                                   ("MIT License", "permissive")], "article string, category string")
    corrected = D.correct_mapping(pairs, FX.corrections_df(spark))
    assert sorted(tuple(r) for r in D.correction_log(corrected).collect()) == [
        ("CC BY-NC 4.0", "noncommercial", "noncommercial share"),
        ("GNU General Public License", "copyleft", "strong copyleft")]
    rec = sorted(tuple(r) for r in D.recover_removed(pairs, FX.REMOVED_CATEGORIES, "General").collect())
    assert rec == [("GNU General Public License", "copyleft", True), ("MIT License", "permissive", False)]


def test_citations_per_document(spark):
    docs = spark.createDataFrame([(1, "see 《Licensed under the MIT License.》 and 《Unknown Act》"), (2, "none")],
                                 "doc_id long, cited_text string")
    pairs = spark.createDataFrame([("MIT License", "permissive"), ("MIT License", "osi")], "article string, category string")
    got = {r.doc_id: (r.n_citations, r.categories)
           for r in D.citation_lookup(docs, pairs, FX.EDGE_RULES).collect()}
    assert got == {1: (2, "osi||permissive"), 2: (0, "")}


def test_groups_and_terms(spark):
    df = spark.createDataFrame([("ECONOMY",), ("LARGE",), ("SMALL",)], "category string")
    got = sorted(tuple(r) for r in D.map_categories(df, FX.groups_df(spark)).select("category", "big_group").collect())
    assert got == [("ECONOMY", "BUDGET"), ("LARGE", "LARGE"), ("SMALL", "BUDGET")]
    names = spark.createDataFrame([("old hot red old bolt",)], "p_name string")
    assert names.select(D.remove_terms(F.col("p_name"), FX.STOP_TERMS)).first()[0] == "red||bolt"


def test_corrections_are_followed_to_their_end(spark):
    chain = [("x", f"c{i}", f"c{i + 1}") for i in range(20)]
    ring = [("y", f"r{i}", f"r{(i + 1) % 5}") for i in range(5)] + [("y", "into", "r0")]
    more = [("z", "a", "b"), ("z", "a", "c"), ("z", "self", "self"), ("x2", "c0", "end"), (None, "n", "m")]
    df = spark.createDataFrame(chain + ring + more, "article string, old_category string, new_category string")
    got = {(r.article, r.old_category): (r.new_category, r.cycle) for r in D.resolve_corrections(df).collect() if r.article is not None}
    want = {("x", f"c{i}"): ("c20", False) for i in range(20)} | {("y", f"r{i}"): (None, True) for i in range(5)} | {("y", "into"): (None, True)}
    assert got == want | {("z", "a"): ("b", False), ("x2", "c0"): ("end", False)}
    assert D.resolve_corrections(df.limit(0)).count() == 0


def test_final_dictionary(spark):
    pairs = spark.createDataFrame([("GNU General Public License", "copyleft"), ("CC BY-NC 4.0", "noncommercial"), ("MIT License", "permissive"),
                                   ("Apache License", "permissive"), ("Other", "permissive")], "article string, category string")
    got = sorted(tuple(r) for r in D.final_dictionary(pairs, FX.more_corrections_df(spark), FX.REMOVED_CATEGORIES, "General").collect())
    assert got == [("Apache License", "permissive", "permissive", "cycle"), ("GNU General Public License", "copyleft", "copyleft", "recovered"),
                   ("MIT License", "permissive", "osi permissive", "corrected"), ("Other", "permissive", "permissive", "kept")]


def test_rules_in_the_row_and_by_join_agree(spark, monkeypatch):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-1, None)], "doc_id long, text string"))
    words = docs.select(F.explode(F.split("text", r"[^\p{L}]+")).alias("keyword")) \
        .filter(F.length("keyword") >= 7).distinct().orderBy("keyword").limit(40)
    kw = words.select("keyword", F.substring("keyword", 1, 1).alias("category")).unionByName(FX.keywords_df(spark))
    rec = docs.select(F.col("doc_id").cast("string").alias("vc_id"), F.col("text").alias("text_combined"))
    rows = lambda: sorted(tuple(r) for r in D.rule_classify(rec, kw).collect())
    inline = rows()
    monkeypatch.setattr(D, "INLINE_RULES", 3)
    assert rows() == inline and len(inline) == docs.count() and sum(r[2] > 0 for r in inline) > 20


def test_category_lists_map_to_distinct_groups(spark, tmp_dir):
    groups = spark.createDataFrame([("a", "G"), ("b", "G"), ("c", "H")], "category string, big_group string")
    df = spark.createDataFrame([("1", "c||a||b"), ("2", " x || c||x"), ("3", ""), ("4", None), ("5", "||")], "vc_id string, cats string")
    got = {r.vc_id: r.big_groups for r in D.map_category_lists(df, groups, "cats").collect()}
    assert got == {"1": "H||G", "2": "x||H", "3": "", "4": "", "5": ""}
    counts = D.group_counts(D.map_categories(df.selectExpr("explode(split('c,a,b,a,z', ',')) AS category"), groups))
    D.write_group_sorted(counts, f"{tmp_dir}/sorted")
    back = spark.read.parquet(f"{tmp_dir}/sorted").withColumn("f", F.col("_metadata.file_name")).orderBy("f", F.monotonically_increasing_id())
    assert [(r.big_group, r.category) for r in back.collect()] == [("G", "a"), ("G", "b"), ("H", "c"), ("z", "z")]
