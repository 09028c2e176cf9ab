"""Reply handling: pull the text out of a chat-completion body and parse
it into (category, reason, status). All built-in expressions.

Parsing rules (same order as the source workflow):

1. Find every ``【tag】`` + colon + body section. With two or more, the
   first is the category and the second the reason, by position.
2. A field still empty is looked up with three patterns in order; the
   first pattern that *matches* wins, even when its body is blank.
3. Category: strip, delete line breaks, strip. Reason: strip, each run of
   line breaks becomes one space.
4. An empty field becomes the parse-failure word; the status is success
   only when neither field is that word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsort.constants import (
    RAW_REPLY_MAX_CHARS,
    STATUS_OK,
    STATUS_PARSE_FAIL,
    STATUS_REQUEST_FAIL,
    WS_CLASS,
)
from recsort.functions.text import strip_u

# --- fixed values: reply patterns (Python re syntax, DOTALL) ----------
SECTION_PATTERN = r"【[^】]+】[：:]\s*(.+?)(?=【[^】]+】|$)"
CATEGORY_PATTERNS = (
    r"【违规类别】[：:]\s*(.+?)(?=【|$)",
    r"违规类别[：:]\s*(.+?)(?=【|判断|$)",
    r"类别[：:]\s*(.+?)(?=【|$)",
)
REASON_PATTERNS = (
    r"【判断理由】[：:]\s*(.+?)(?=【|$)",
    r"判断理由[：:]\s*(.+?)(?=【|$)",
    r"理由[：:]\s*(.+?)(?=【|$)",
)


def java_regex(py_pattern: str) -> str:
    """Python (DOTALL, str) pattern -> Java pattern with the same meaning.

    ``\\s`` becomes Python's Unicode whitespace set; ``(?d)`` makes ``$``
    match only before a final ``\\n``, as in Python.
    """
    return "(?sd)" + py_pattern.replace(r"\s", WS_CLASS)


def clean_category(c: Column) -> Column:
    return strip_u(F.regexp_replace(strip_u(c), r"[\n\r]", ""))


def clean_reason(c: Column) -> Column:
    return strip_u(F.regexp_replace(strip_u(c), r"[\n\r]+", " "))


def _first_matching(text: Column, patterns, cleaner) -> Column:
    expr = None
    for p in patterns:
        jp = java_regex(p)
        hit = text.rlike(jp)
        val = cleaner(F.regexp_extract(text, jp, 1))
        expr = F.when(hit, val) if expr is None else expr.when(hit, val)
    return expr.otherwise(F.lit(""))


# Each step below is its own projection: a value used several times by the
# next step is a column there, so it is computed once per row (Catalyst does
# not re-inline a non-trivial expression that is consumed more than once).

def with_parsed_reply(df: DataFrame, text: str, ok: Column | None = None, suffix: str = "") -> DataFrame:
    """Add the four result columns for the reply text in column ``text``.

    ``ok`` false (transport failure) or a null text gives the request-failure
    literal in category, reason and status and an empty raw reply.
    """
    t = F.col(text)
    ok_c = (F.lit(True) if ok is None else ok) & t.isNotNull()
    df = df.withColumns({"_ok": ok_c,
                         "_secs": F.regexp_extract_all(t, F.lit(java_regex(SECTION_PATTERN)), F.lit(1))})
    two = F.size("_secs") >= 2
    df = df.withColumns({
        "_c1": F.when(two, clean_category(F.element_at("_secs", 1))).otherwise(F.lit("")),
        "_r1": F.when(two, clean_reason(F.element_at("_secs", 2))).otherwise(F.lit("")),
    })
    # each step reads the one before exactly once, so an inlined filter stays linear
    df = df.withColumns({
        "_c": F.coalesce(F.nullif(F.col("_c1"), F.lit("")),
                         F.nullif(_first_matching(t, CATEGORY_PATTERNS, clean_category), F.lit("")),
                         F.lit(STATUS_PARSE_FAIL)),
        "_r": F.coalesce(F.nullif(F.col("_r1"), F.lit("")),
                         F.nullif(_first_matching(t, REASON_PATTERNS, clean_reason), F.lit("")),
                         F.lit(STATUS_PARSE_FAIL)),
    })
    fail_parse = F.lit(STATUS_PARSE_FAIL)
    status = F.when((F.col("_c") == STATUS_PARSE_FAIL) | (F.col("_r") == STATUS_PARSE_FAIL), fail_parse) \
        .otherwise(F.lit(STATUS_OK))
    fail = F.lit(STATUS_REQUEST_FAIL)
    ok_col = F.col("_ok")
    df = df.withColumns({
        "ai_violation_categories" + suffix: F.when(ok_col, F.col("_c")).otherwise(fail),
        "ai_reason" + suffix: F.when(ok_col, F.col("_r")).otherwise(fail),
        "ai_raw_response" + suffix: F.when(ok_col, F.substring(t, 1, RAW_REPLY_MAX_CHARS)).otherwise(F.lit("")),
        "process_status" + suffix: F.when(ok_col, status).otherwise(fail),
    })
    return df.drop("_ok", "_secs", "_c1", "_r1", "_c", "_r")


def _vget(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def with_extracted_reply(df: DataFrame, body: str, text_out: str = "reply_text",
                         ok_out: str = "reply_ok") -> DataFrame:
    """Reply text out of a chat-completion response body.

    Non-empty ``choices`` -> first message content (missing -> '');
    else ``response``; else ``content``; else the whole body as text.
    A body that is a JSON string is its own text, an array its JSON text,
    unless one of the three names stands in it (in the string, or as an
    element), which fails the lookup. A null or non-text value, any other
    body, or a ``choices`` entry that is not an object gives a null text and
    ``ok_out`` false (the request-failure path). The whole-body fallback
    keeps the JSON text.
    """
    df = df.withColumn("_v", F.try_parse_json(F.col(body)))
    v = F.col("_v")
    df = df.withColumns({
        "_choices": _vget(v, "$.choices"), "_first": _vget(v, "$.choices[0]"),
        "_message": _vget(v, "$.choices[0].message"), "_content": _vget(v, "$.choices[0].message.content"),
        "_response": _vget(v, "$.response"), "_alt": _vget(v, "$.content"),
    })
    df = df.withColumns({
        "_k_top": F.schema_of_variant(v), "_k_choices": F.schema_of_variant("_choices"),
        "_k_first": F.schema_of_variant("_first"), "_k_message": F.schema_of_variant("_message"),
        "_k_content": F.schema_of_variant("_content"), "_k_response": F.schema_of_variant("_response"),
        "_k_alt": F.schema_of_variant("_alt"), "_j_choices": F.to_json("_choices"),
    })
    k = F.col
    ch_nonempty = k("_k_choices").startswith("ARRAY") & k("_first").isNotNull()
    # any other non-empty value under "choices" makes the lookup raise
    ch_other = k("_choices").isNotNull() & ~k("_k_choices").startswith("ARRAY") & \
        ~k("_j_choices").isin('""', "{}")
    first_ok = k("_k_first").startswith("OBJECT") & (k("_message").isNull() | k("_k_message").startswith("OBJECT"))

    def text_of(x: str) -> Column:
        return F.try_variant_get(k(x), "$", "string")

    own = F.try_variant_get(v, "$", "string")
    names = F.array(*[F.lit(x) for x in ("choices", "response", "content")])
    named = F.coalesce(F.arrays_overlap(F.try_variant_get(v, "$", "array<string>"), names), F.lit(False))
    text = (
        F.when(k("_k_top") == "STRING", F.when(~own.rlike("choices|response|content"), own))
        .when(k("_k_top").startswith("ARRAY"), F.when(~named, F.to_json(v)))
        .when(v.isNull() | ~k("_k_top").startswith("OBJECT"), F.lit(None).cast("string"))
        .when(ch_nonempty & first_ok & k("_content").isNull(), F.lit(""))
        .when(ch_nonempty & first_ok & (k("_k_content") == "STRING"), text_of("_content"))
        .when(ch_nonempty | ch_other, F.lit(None).cast("string"))
        .when(k("_response").isNotNull(), F.when(k("_k_response") == "STRING", text_of("_response")))
        .when(k("_alt").isNotNull(), F.when(k("_k_alt") == "STRING", text_of("_alt")))
        .otherwise(F.to_json(v))
    )
    df = df.withColumn(text_out, text).withColumn(ok_out, F.col(text_out).isNotNull())
    return df.drop("_v", "_choices", "_first", "_message", "_content", "_response", "_alt",
                   "_k_top", "_k_choices", "_k_first", "_k_message", "_k_content", "_k_response",
                   "_k_alt", "_j_choices")

