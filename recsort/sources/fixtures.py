"""Fixture tables derived from the given data set (see FIXTURES.md).

Each builder is a lazy DataFrame over the parquet tables, so the work of
every query grows with the data. The same rows are produced by the DuckDB
SQL in ``recsort.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.constants import CATCH_ALL_CATEGORY, STATUS_OK, STATUS_PARSE_FAIL, STATUS_REQUEST_FAIL
from recsort.sources.tables import table

# --- fixture values (ours) -------------------------------------------
# F7 vocabulary
VOCABULARY = ("permissive", "copyleft", "noncommercial", CATCH_ALL_CATEGORY)
# F8 keyword -> category rules
KEYWORDS = (
    ("Apache License", "permissive"),
    ("MIT License", "permissive"),
    ("General Public License", "copyleft"),
    ("CC BY-NC", "noncommercial"),
)
# F8 article edge rules: (name, side, pattern of one piece)
EDGE_RULES = (
    ("licensed", "lead", r"(?:This work is licensed|Licensed) under (?:the )?"),
    ("released", "lead", r"Released under the "),
    ("version", "tail", r", [Vv]ersion [0-9.]+"),
    ("stop", "tail", r"[.]"),
)
# F8 corrections: (article, old category, new category)
CORRECTIONS = (
    ("GNU General Public License", "copyleft", "strong copyleft"),
    ("CC BY-NC 4.0", "noncommercial", "noncommercial share"),
)
# more of them: a chain, and one that leads back
MORE_CORRECTIONS = (
    ("MIT License", "permissive", "open source"),
    ("MIT License", "open source", "osi approved"),
    ("MIT License", "osi approved", "osi permissive"),
    ("Apache License", "permissive", "patent grant"),
    ("Apache License", "patent grant", "permissive"),
)
# F8 removal stop list on dictionary categories, and the recovery rule
REMOVED_CATEGORIES = ("copyleft", "noncommercial")
RECOVER_IF_ARTICLE_CONTAINS = "General"
# F9 fine category -> major group
GROUPS = (("ECONOMY", "BUDGET"), ("SMALL", "BUDGET"), ("STANDARD", "CORE"), ("MEDIUM", "CORE"))
# groups of the reply categories
REPLY_GROUPS = (("permissive", "open"), ("copyleft", "open"), ("noncommercial", "restricted"))
# F9 stop terms on part names
STOP_TERMS = ("old", "hot", "cold")


def _vc_id(doc_id: Column) -> Column:
    sid = doc_id.cast("string")
    return (
        F.when(doc_id % 101 == 0, F.translate(sid, "0123456789", "abcdefghij"))
        .otherwise(F.concat(
            F.when(doc_id % 5 == 0, F.lit("B")).otherwise(F.lit("A")),
            F.when(doc_id % 3 == 0, F.lit("-00")).otherwise(F.lit("-")),
            sid,
        ))
    )


def f1_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    q = j.quality.cast("string")
    return j.select(
        F.concat(F.lit("VC-"), j.doc_id.cast("string")).alias("vc_id"),
        F.when(j.doc_id % 17 == 0, F.lit(None).cast("string")).otherwise(j.text).alias("text_combined"),
        F.when(j.doc_id % 23 == 0, F.lit("x?"))
        .when(j.quality.isNull(), F.lit(None).cast("string"))
        .when(j.doc_id % 7 == 0, F.concat(q, F.lit(".0")))
        .otherwise(q).alias("isneedai"),
    )


def f2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    m6 = j.doc_id % 6
    vc = (
        F.when(m6 == 0, F.lit(None).cast("string"))
        .when(m6 == 1, F.lit("permissive || copyleft"))
        .when(m6 == 2, F.lit("nan"))
        .when(m6 == 3, F.lit(" permissive||" + CATCH_ALL_CATEGORY + "|| "))
        .when(m6 == 4, F.lit(CATCH_ALL_CATEGORY))
        .otherwise(F.lit("\tcopyleft||||copyleft "))
    )
    return j.select(
        j.doc_id,
        _vc_id(j.doc_id).alias("vc_id"),
        F.when(j.doc_id % 17 == 0, F.lit(None).cast("string")).otherwise(j.text).alias("text_combined"),
        j.source,
        F.when(j.quality.isNull(), (j.doc_id % 2).cast("int")).otherwise(1 - j.quality).alias("need_ai"),
        vc.alias("violation_categories"),
    )


def f5_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    m = d.doc_id % 10
    nl = "\n"
    reply = (
        F.when(m == 0, F.concat(F.lit("【违规类别】：permissive||copyleft" + nl + "【判断理由】：quotes "),
                                F.translate(d.text, "【】", "  ")))
        .when(m == 1, F.lit("【违规类别】: permissive" + nl + "【判断理由】: line one" + nl + nl + "line two "))
        .when(m == 2, F.lit("【判断理由】：reason first" + nl + "【违规类别】：copyleft"))
        .when(m == 3, F.lit("违规类别：permissive判断理由：plain labels"))
        .when(m == 4, F.lit("【违规类别】：permissive"))
        .when(m == 5, F.translate(d.text, "：:【】", "    "))
        .when(m == 6, F.lit(""))
        .when(m == 7, F.lit("【违规类别】：permissive||permissive||copyleft【判断理由】：repeats"))
        .when(m == 8, F.lit("【违规类别】：homemade(自创)||unknown【判断理由】：off list"))
        .otherwise(F.lit(None).cast("string"))
    )
    return d.select(
        d.doc_id,
        _vc_id(d.doc_id).alias("vc_id"),
        F.when(m == 9, F.lit("timeout")).otherwise(F.lit(None).cast("string")).alias("error"),
        reply.alias("reply"),
    )


def f5_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 replies wrapped in the accepted response-body shapes (by doc_id % 5)."""
    r = f5_replies(spark, sf_dir)
    content = F.struct(F.col("reply").alias("content"))
    choice = F.struct(content.alias("message"))
    k = F.col("doc_id") % 5
    body = (
        # a bare JSON string (its quotes taken from a one-field object), arrays, then objects
        F.when(F.col("doc_id") % 35 == 11, F.regexp_replace(F.to_json(F.struct(F.col("reply").alias("r"))), r"(?s)^\{\"r\":|\}\z", ""))
        .when(F.col("doc_id") % 35 == 12, F.to_json(F.array("reply")))
        .when(F.col("doc_id") % 35 == 13, F.lit('["choices"]'))
        .when(k == 0, F.to_json(F.struct(F.array(choice).alias("choices"))))
        .when(k == 1, F.to_json(F.struct(F.col("reply").alias("response"))))
        .when(k == 2, F.to_json(F.struct(F.col("reply").alias("content"))))
        .when(k == 3, F.to_json(F.struct(F.array().cast("array<string>").alias("choices"),
                                         F.col("reply").alias("response"))))
        .otherwise(F.to_json(F.struct(F.lit("x1").alias("id"), F.array(choice).alias("choices"))))
    )
    return r.select("doc_id", "vc_id", "error",
                    F.when(F.col("error").isNull(), body).alias("body"))


def f6_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = f2_records(spark, sf_dir)
    m = x.doc_id % 12
    return x.filter((x.doc_id % 4).isin(0, 1)).select(
        x.doc_id, x.vc_id,
        F.lit("old").alias("ai_violation_categories"),
        F.when(m == 0, F.lit(STATUS_PARSE_FAIL))
        .when(m == 1, F.lit(STATUS_REQUEST_FAIL))
        .when(m == 4, F.lit(None).cast("string"))
        .when(m == 5, F.lit("  "))
        .otherwise(F.lit(STATUS_OK)).alias("process_status"),
    )


def f8_article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))


def cited_text(text: Column) -> Column:
    """Every line that is not empty as a citation in 《》."""
    return F.regexp_replace(text, "(?md)^([^\n]+)$", "《$1》")


def lookup(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small lookup table (caller's configuration) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def keywords_df(spark: SparkSession) -> DataFrame:
    return lookup(spark, KEYWORDS, "keyword string, category string")


def vocabulary_df(spark: SparkSession) -> DataFrame:
    return lookup(spark, [(v,) for v in VOCABULARY], "category string")


def groups_df(spark: SparkSession) -> DataFrame:
    return lookup(spark, GROUPS, "category string, big_group string")


def corrections_df(spark: SparkSession) -> DataFrame:
    return lookup(spark, CORRECTIONS, "article string, old_category string, new_category string")


def more_corrections_df(spark: SparkSession) -> DataFrame:
    return lookup(spark, CORRECTIONS + MORE_CORRECTIONS, "article string, old_category string, new_category string")


def part_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword table that grows with ``part``: names with their key, names, and the words of names."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    own = p.select(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("keyword"), F.col("p_type").alias("category"))
    names = p.select(F.col("p_name").alias("keyword"), F.lit("name").alias("category"))
    words = p.select(F.explode(F.split("p_name", " ")).alias("keyword"), F.lit("word").alias("category"))
    return own.unionByName(names).unionByName(words).distinct()


def stop_terms_df(spark: SparkSession) -> DataFrame:
    return lookup(spark, [(t,) for t in STOP_TERMS], "term string")


# Categories the fixture service answers with, by the length of the prompt
SERVICE_CATEGORIES = ("permissive", "copyleft", "noncommercial")


def fixture_service():
    """A service as callers write them: one request body in, one response body out, by rules on the prompt's length.

    Length mod 101 = 1: longer than any timeout; mod 11 = 0: refused; 2: no
    body; 3: a reply without sections; 4: an error at the first attempt.
    """
    categories = SERVICE_CATEGORIES
    tried: set[str] = set()

    def service(request: str) -> str | None:
        import json
        import time
        prompt = json.loads(request)["messages"][1]["content"]
        n = len(prompt)
        if n % 101 == 1:
            time.sleep(5)
        if n % 11 == 0:
            raise ConnectionError("refused")
        if n % 11 == 2:
            return None
        if n % 11 == 3:
            return json.dumps({"response": "no sections"})
        if n % 11 == 4 and request not in tried:
            tried.add(request)
            raise ConnectionError("busy")
        reply = f"【违规类别】：{categories[n % 3]}\n【判断理由】：length {n}"
        return json.dumps({"choices": [{"message": {"content": reply}}]}, ensure_ascii=False)

    return service
