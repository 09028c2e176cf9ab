"""Keyword and citation dictionary: match, build, clean, correct, recover.

A keyword table of any size is matched by a join on rare q-grams
(``recsort.operators.keywords``). A short list of rules, up to
``INLINE_RULES``, is matched in the row instead: no shuffle, one ``instr`` a
rule. Both give the same matches.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsort.constants import CATCH_ALL_CATEGORY, CATEGORY_SEP, WS_CLASS
from recsort.functions.text import fold_width
from recsort.operators.joins import broadcast_if_bounded, is_bounded
from recsort.operators.keywords import keyword_match
from recsort.session import checkpoint_root

INLINE_RULES = 64
# White space except the plain space
_OTHER_WS = f"(?! ){WS_CLASS}"
# How characters begin in UTF-8 that are white space other than the plain space, or full-width: a text without these bytes has neither
_UNUSUAL = [chr(i).encode() for i in range(0x3001) if chr(i).isspace() and chr(i) != " "] + [b"\xef\xbc", b"\xef\xbd"]
MATCHES = "array<struct<keyword:string,category:string>>"


def with_matches(df: DataFrame, text: Column, keywords: DataFrame, out: str = "_m") -> DataFrame:
    """``df`` with the (keyword, category) structs of the keywords that ``text`` contains, sorted.

    ``keywords`` (keyword, category) may be of any size: a short table becomes a
    literal list that is filtered in the row, a longer one is joined.
    """
    kw = keywords.filter("length(keyword) > 0").select("keyword", "category").distinct()
    if is_bounded(kw, INLINE_RULES):
        rules = sorted((r.keyword, r.category or "") for r in kw.collect())  # at most INLINE_RULES rows
        listed = F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(c).alias("category")) for k, c in rules]) if rules else F.array().cast(MATCHES)
        return df.withColumn(out, F.filter(listed, lambda r: F.instr(text, r["keyword"]) > 0))
    named = df.withColumn("_text", F.md5(text.cast("binary")))
    texts = df.select(F.md5(text.cast("binary")).alias("_text"), text.alias("_body")).dropDuplicates(["_text"])
    found = keyword_match(texts, kw.select("keyword", F.coalesce("category", F.lit("")).alias("category")), "_text", "_body") \
        .groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("keyword", "category"))).alias(out))
    return named.join(found, "_text", "left").withColumn(out, F.coalesce(out, F.array().cast(MATCHES))).drop("_text")


def rule_matches(docs: DataFrame, keywords: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, keyword, category) for every keyword that the text contains, for a rule list or a table."""
    return with_matches(docs.select(key, text), F.col(text), keywords).select(key, F.explode("_m").alias("m")).select(key, "m.keyword", "m.category")


def sorted_categories(cats: Column) -> Column:
    """Distinct, sorted, '||'-joined."""
    return F.array_join(F.array_sort(F.array_distinct(cats)), CATEGORY_SEP)


def rule_classify(records: DataFrame, keywords: DataFrame, key: str = "vc_id",
                  text: str = "text_combined", catch_all: str = CATCH_ALL_CATEGORY,
                  keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Strong-rule classifier, one output row per record; in the row for a short rule list.

    Categories of every contained keyword (distinct, sorted); no match ->
    the catch-all category. ``keep`` carries more record columns along.
    """
    staged = with_matches(records.select(key, *keep, text), F.coalesce(F.col(text), F.lit("")), keywords)
    m = F.col("_m")
    cats = sorted_categories(F.transform(m, lambda s: s["category"]))
    return staged.select(
        key, *keep,
        F.when(F.size(m) > 0, cats).otherwise(F.lit(catch_all)).alias("rule_categories"),
        F.size(F.array_distinct(F.transform(m, lambda s: s["keyword"]))).alias("n_keywords"),
    )


# ---------------------------------------------------------------------------
# Article text cleaning

def normalise_article(c: Column) -> Column:
    """Fold full-width forms, collapse whitespace runs to one space, strip.

    Each step only touches texts that need it: most have no character to fold
    and no white space but plain spaces, which a search for their bytes tells
    sooner than a pattern, and after the collapse only a plain space can stand
    at an end.
    """
    folded = F.when(F.octet_length(c) != F.length(c), fold_width(c)).otherwise(c)
    collapsed = F.when(folded.rlike(f"{WS_CLASS}{{2}}|{_OTHER_WS}"), F.regexp_replace(folded, f"{WS_CLASS}+", " ")).otherwise(folded)
    unusual = reduce(or_, [F.contains(c.cast("binary"), F.lit(u)) for u in _UNUSUAL])
    return F.btrim(F.when(unusual, collapsed).when(c.contains("  "), F.regexp_replace(c, " +", " ")).otherwise(c))


def edge_rules(rules) -> list[tuple[str, str, str]]:
    """(name, side, pattern) rows of a rule table, a DataFrame or a list; ``side`` is lead or tail.

    A pattern matches one piece of an edge and never nothing; it has no anchors
    and looks at nothing beside the piece.
    """
    rows = [(r.name, r.side, r.pattern) for r in rules.select("name", "side", "pattern").collect()] if isinstance(rules, DataFrame) else list(rules)
    if bad := [r for r in rows if r[1] not in ("lead", "tail")]:
        raise ValueError(f"edge rules for neither lead nor tail: {bad}")
    return rows


def edge_patterns(rules, side: str) -> tuple[str, str] | None:
    """(one piece, the whole edge) of all rules of a side: pieces in any order and number, so one match is the closure."""
    parts = "|".join(f"(?:{p})" for _, s, p in edge_rules(rules) if s == side)
    if not parts:
        return None
    return parts, f"^(?:{parts})+" if side == "lead" else f"(?:{parts})+\\z"


def clean_edges(c: Column, rules) -> Column:
    """``c`` without its edges, leads first: afterwards no rule matches at its side, whatever the order of the rules.

    What is left is a fixed point: the match of a side ends only where none of
    its rules goes on, and taking off a tail makes no new lead.
    """
    out = c
    for side in ("lead", "tail"):
        if (found := edge_patterns(rules, side)) is not None:
            out = F.regexp_replace(out, found[1], "")
    return out


def rules_fired(c: Column, rules) -> Column:
    """Names of the rules that ``clean_edges`` applies, one per piece: leads from the left, then tails from the right, joined with '+'."""
    rows, names = edge_rules(rules), []
    rest = c
    for side in ("lead", "tail"):
        if (found := edge_patterns(rows, side)) is None:
            continue
        pieces = F.regexp_extract_all(F.regexp_extract(rest, found[1], 0), F.lit(found[0]), F.lit(0))
        of = [(n, p) for n, s, p in rows if s == side]
        named = F.transform(pieces if side == "lead" else F.reverse(pieces),
                            lambda u: F.coalesce(*[F.when(u.rlike(f"^(?:{p})\\z"), F.lit(n)) for n, p in of], F.lit("?")))  # noqa: B023
        names.append(named)
        rest = F.regexp_replace(rest, found[1], "")
    return F.array_join(F.concat(*names), "+") if names else F.lit("")


def clean_edges_log(lines: DataFrame, rules, text: str = "line") -> DataFrame:
    """Audit rows for every line the edge rules changed."""
    after = clean_edges(F.col(text), rules)
    changed = lines.select("doc_id", F.col(text).alias("before"), after.alias("after")).filter(~F.col("before").eqNullSafe(F.col("after")))
    return changed.withColumn("rule", rules_fired(F.col("before"), rules))


def article_entries(lines: DataFrame, keywords: DataFrame, rules) -> DataFrame:
    """(doc_id, article, category) from cited lines: normalise, clean edges, match."""
    art = lines.select("doc_id", clean_edges(normalise_article(F.col("line")), rules).alias("article"))
    return with_matches(art, F.col("article"), keywords).select(
        "doc_id", "article", F.explode(F.array_distinct(F.transform("_m", lambda s: s["category"]))).alias("category"))


def article_dictionary(entries: DataFrame) -> DataFrame:
    """article -> sorted distinct categories, with line and document counts."""
    return entries.groupBy("article").agg(
        sorted_categories(F.collect_set("category")).alias("categories"),
        F.count(F.lit(1)).alias("n_entries"),
        F.countDistinct("doc_id").alias("n_docs"),
    )


def dictionary_pairs(entries: DataFrame) -> DataFrame:
    return entries.select("article", "category").distinct()


def correct_mapping(pairs: DataFrame, corrections: DataFrame) -> DataFrame:
    """Correction rules override dictionary categories, each once."""
    corr = broadcast_if_bounded(corrections.select("article", F.col("old_category").alias("category"), "new_category"))
    j = pairs.join(corr, ["article", "category"], "left")
    return j.select("article", F.col("category").alias("old_category"),
                    F.coalesce("new_category", "category").alias("category"))


def resolve_corrections(corrections: DataFrame) -> DataFrame:
    """(article, old_category, new_category, cycle): every correction followed to the end of its chain.

    Pointer jumping within an article: each round doubles how far a correction
    has been followed, so a chain of n takes log n joins. Corrections that run
    into a cycle have no end: ``cycle`` is true and ``new_category`` null. Of two
    corrections of the same entry the smaller new category counts; a correction
    of a category to itself is none.
    """
    checkpoint_root(corrections.sparkSession)
    at = (corrections.filter(F.col("old_category") != F.col("new_category")).groupBy("article", "old_category")
          .agg(F.min("new_category").alias("at")).checkpoint())
    longest = at.groupBy("article").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    reached = 1
    while True:
        onward = at.select("article", F.col("old_category").alias("at"), F.col("at").alias("next"))
        at = at.join(onward, ["article", "at"], "left").select("article", "old_category", F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("open")).checkpoint()
        # Chains are at most as long as an article has corrections: what is open beyond that runs in a circle.
        if reached > longest or at.filter("open").isEmpty():
            break
        at, reached = at.drop("open"), reached * 2
    return at.select("article", "old_category", F.when(~F.col("open"), F.col("at")).alias("new_category"), F.col("open").alias("cycle"))


def final_dictionary(pairs: DataFrame, corrections: DataFrame, stop: Iterable[str], recover_contains: str) -> DataFrame:
    """(article, old_category, category, origin): the dictionary after removing, correcting and recovering.

    Entries of a ``stop`` category are removed; the others take the end of their
    chain of corrections (origin ``corrected``; ``cycle``, unchanged, if it has
    no end; else ``kept``); removed entries that the recovery rule asks for come
    back as they were (``recovered``).
    """
    ends = broadcast_if_bounded(resolve_corrections(corrections))
    removed = F.col("category").isin(list(stop))
    j = pairs.filter(~removed | F.col("article").contains(recover_contains)).withColumn("removed", removed).join(
        ends.withColumnRenamed("old_category", "category"), ["article", "category"], "left")
    changed = F.col("new_category").isNotNull()
    origin = F.when(F.col("removed"), "recovered").when(F.col("cycle"), "cycle").when(changed, "corrected").otherwise("kept")
    return j.select("article", F.col("category").alias("old_category"),
                    F.when(~F.col("removed") & changed, F.col("new_category")).otherwise(F.col("category")).alias("category"), origin.alias("origin"))


def correction_log(corrected: DataFrame) -> DataFrame:
    return corrected.filter(F.col("category") != F.col("old_category")) \
        .select("article", "old_category", F.col("category").alias("new_category"))


def remove_categories(pairs: DataFrame, stop: Iterable[str]) -> DataFrame:
    return pairs.filter(~F.col("category").isin(list(stop)))


def recover_removed(pairs: DataFrame, stop: Iterable[str], recover_contains: str) -> DataFrame:
    """Final entries = kept + removed entries that the recovery rule puts back, in one pass."""
    removed = F.col("category").isin(list(stop))
    return pairs.filter(~removed | F.col("article").contains(recover_contains)).withColumn("recovered", removed)


# ---------------------------------------------------------------------------
# Citations

def extract_citations(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("《([^》]+)》"), F.lit(1))


def citation_lookup(docs: DataFrame, pairs: DataFrame, rules,
                    key: str = "doc_id", text: str = "cited_text") -> DataFrame:
    """Per record: number of citations and the dictionary categories they stand for.

    One pass over the texts gives counts and cleaned citations. The dictionary
    enters the join with one row per article; articles are compared by their
    MD5, so that no line is shuffled as text. Articles are computed in the row's
    array and the array is exploded as outer: a condition on the exploded rows
    would otherwise be tried below, on the patterns themselves, once more each.
    """
    digest = lambda c: F.md5(c.cast("binary"))
    cited = docs.select(F.col(key).alias("_key"), extract_citations(F.coalesce(F.col(text), F.lit(""))).alias("_citations"))
    articles = F.array_distinct(F.transform("_citations", lambda c: digest(clean_edges(normalise_article(c), rules))))
    each = cited.select("_key", F.size("_citations").alias("_n"), F.posexplode_outer(articles).alias("_pos", "_article"))
    # A record without citations meets no article; its key spreads such records over the tasks.
    each = each.select("_key", F.when(F.coalesce("_pos", F.lit(0)) == 0, F.col("_n")).otherwise(0).alias("_n"),
                       F.coalesce("_article", F.concat(F.lit("none "), F.coalesce(F.col("_key").cast("string"), F.lit("")))).alias("_article"))
    by_article = pairs.groupBy("article").agg(F.collect_set("category").alias("_own")).select(digest(F.col("article")).alias("_article"), "_own")
    # Records without a key are counted, and have no categories.
    own = F.when(F.col("_key").isNotNull(), F.col("_own"))
    return each.join(by_article, "_article", "left").groupBy("_key").agg(F.sum("_n").alias("n_citations"), F.collect_set(own).alias("_own")).select(
        F.col("_key").alias(key), "n_citations", sorted_categories(F.flatten("_own")).alias("categories"))


# ---------------------------------------------------------------------------
# Category groups and term removal

def map_categories(df: DataFrame, groups: DataFrame, category: str = "category") -> DataFrame:
    """Fine category -> major group; unmapped categories keep their own name."""
    g = broadcast_if_bounded(groups.select(F.col("category").alias(category), "big_group"))
    return df.join(g, category, "left").withColumn("big_group", F.coalesce("big_group", category))


def map_category_lists(df: DataFrame, groups: DataFrame, categories: str, key: str = "vc_id", out: str = "big_groups") -> DataFrame:
    """(key, ``out``): the distinct major groups of a ``||`` list, in the order in which the list first names them.

    Rows that share a key share one list, the later entries of all of them
    behind; an empty or null list gives an empty one.
    """
    parts = F.filter(F.transform(F.split(F.coalesce(F.col(categories), F.lit("")), r"\|\|"), lambda c: F.btrim(c)), lambda c: c != "")
    each = df.select(key, F.posexplode_outer(parts).alias("_pos", "category"))
    mapped = map_categories(each, groups)
    first = mapped.groupBy(key, "big_group").agg(F.min("_pos").alias("_pos"))
    named = F.array_sort(F.collect_list(F.when(F.col("big_group").isNotNull(), F.struct("_pos", "big_group"))))
    return first.groupBy(key).agg(named.alias("_g")).select(key, F.array_join(F.transform("_g", lambda g: g["big_group"]), CATEGORY_SEP).alias(out))


def write_group_sorted(counts: DataFrame, path: str) -> None:
    """The counts of ``group_counts`` as files that follow each other in its order, and are sorted within."""
    order = ["big_group", F.desc("n"), "category"]
    counts.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def group_counts(mapped: DataFrame, category: str = "category") -> DataFrame:
    return mapped.groupBy("big_group", category).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy("big_group", F.desc("n"), category)


def remove_terms(c: Column, stop_terms: Iterable[str], sep: str = " ") -> Column:
    """Drop stop terms from a separated list, keep order and repeats, rejoin with '||'."""
    stop = F.array(*[F.lit(t) for t in stop_terms]) if stop_terms else F.array().cast("array<string>")
    return F.array_join(F.filter(F.split(c, sep), lambda w: ~F.array_contains(stop, w)), CATEGORY_SEP)
