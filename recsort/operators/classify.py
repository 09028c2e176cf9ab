"""Expert classification: prompts -> responder -> parsed results -> merge.

A responder turns request rows ``(key, request)`` into response rows
``(key, body, error)``: ``body`` is the response body text (JSON) and
``error`` is set when the call failed (timeout, non-200, exception).

* ``RuleResponder`` answers from keyword rules with built-in expressions
  (deterministic, offline, no Python on the hot path).
* ``CallResponder`` and ``PandasResponder`` (``recsort.operators.calls``) run a
  caller's function of one request, or of a batch, isolated call by call, and
  keep every outcome in a journal that a rerun reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsort.constants import (
    CATCH_ALL_CATEGORY,
    CATEGORY_LABEL,
    REASON_LABEL,
    STATUS_OK,
    STATUS_REQUEST_FAIL,
)
from recsort.functions.prompts import HINT_TEMPLATE, PLAIN_TEMPLATE, build_prompt, build_request
from recsort.functions.replies import with_extracted_reply, with_parsed_reply
from recsort.functions.text import clean_rule_categories
from recsort.operators.calls import NO_RESPONSE, CallResponder, PandasResponder, call_id  # noqa: F401  responders of this module's interface
from recsort.operators.dictionary import sorted_categories, with_matches
from recsort.operators.state import resume_pending, retry_failed
from recsort.session import checkpoint_root

NO_RULE_REASON = "no rule matched"


def reply_text(categories, reason):
    """A reply in the section grammar the parser reads."""
    return F.concat(F.lit(f"【{CATEGORY_LABEL}】："), categories, F.lit("\n"),
                    F.lit(f"【{REASON_LABEL}】："), reason)


def chat_body(content):
    """Response body in the chat-completion shape."""
    msg = F.struct(F.struct(content.alias("content")).alias("message"))
    return F.to_json(F.struct(F.array(msg).alias("choices")))


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows are computed exactly once.

    A reliable checkpoint in the shared ``spark.checkpoint.dir`` survives
    executor loss, keeps paid calls from being repeated by a later action,
    and stops the optimizer from inlining reply expressions into every
    downstream filter. Used on responder output (paid path) and on parsed
    result rows (key and four short strings).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


class RuleResponder:
    """Answers with the categories of every keyword found in the prompt.

    Row-wise and Spark-native, so ``classify`` runs it on the record rows
    themselves (``respond_rows``) and needs no join back to the records.
    """

    row_wise = True

    def __init__(self, keywords: DataFrame, catch_all: str = CATCH_ALL_CATEGORY):
        self.keywords = keywords
        self.catch_all = catch_all

    def reply(self, m) -> F.Column:
        """Reply for the matched-keyword array ``m`` (a column)."""
        cats = sorted_categories(F.transform(m, lambda s: s["category"]))
        kws = F.array_sort(F.array_distinct(F.transform(m, lambda s: s["keyword"])))
        quoted = F.array_join(F.transform(kws, lambda k: F.concat(F.lit("“"), k, F.lit("”"))), ", ")
        # empty match list -> '' -> null -> the fallback words
        return reply_text(F.coalesce(F.nullif(cats, F.lit("")), F.lit(self.catch_all)),
                          F.coalesce(F.concat(F.lit("rule: "), F.nullif(quoted, F.lit(""))),
                                     F.lit(NO_RULE_REASON)))

    def __call__(self, requests: DataFrame, key: str) -> DataFrame:
        # use the prompt column when the caller kept it (then the request JSON
        # is never built: column pruning drops it), else read the body
        prompt = F.col("prompt") if "prompt" in requests.columns else \
            F.get_json_object(F.col("request"), "$.messages[1].content")
        m = with_matches(requests.select(key, F.coalesce(prompt, F.lit("")).alias("_prompt")), F.col("_prompt"), self.keywords)
        return m.select(key, chat_body(self.reply(F.col("_m"))).alias("body"),
                        F.lit(None).cast("string").alias("error"))

    def respond_rows(self, rows: DataFrame) -> DataFrame:
        """Add ``body`` and ``error`` to rows that carry a ``prompt`` column."""
        m = with_matches(rows, F.coalesce(F.col("prompt"), F.lit("")), self.keywords)
        return m.withColumns({"body": chat_body(self.reply(F.col("_m"))),
                              "error": F.lit(None).cast("string")}).drop("_m")


def with_requests(records: DataFrame, text: str = "text_combined", rule_col: str = "violation_categories",
                  plain_template: str = PLAIN_TEMPLATE, hint_template: str = HINT_TEMPLATE,
                  **request_kw) -> DataFrame:
    """Add ``prompt`` and ``request`` (the JSON body) to every record."""
    rc = clean_rule_categories(F.col(rule_col)) if rule_col in records.columns else F.lit("")
    prompts = records.withColumn("prompt", build_prompt(F.col(text), rc, plain_template, hint_template))
    return prompts.withColumn("request", build_request(F.col("prompt"), **request_kw))


def requests_for(records: DataFrame, key: str = "vc_id", **kw) -> DataFrame:
    """(key, prompt, request) per record."""
    return with_requests(records, **kw).select(key, "prompt", "request")


def complete(records: DataFrame, responder, key: str = "vc_id", **kw) -> DataFrame:
    """Responses for the records: (call_id, body, error), or (key, body, error) of a responder that answers row by row."""
    return responder(requests_for(records, key, **kw), key)


def with_results(responses: DataFrame, suffix: str = "", keep_reply: bool = False) -> DataFrame:
    """Add the four result columns to rows carrying ``body`` and ``error``.

    Drops the prompt, request and body; ``keep_reply`` keeps ``error`` and the
    full reply text as ``reply``.
    """
    df = with_extracted_reply(responses, "body", "_reply_text", "_reply_ok")
    df = with_parsed_reply(df, "_reply_text", F.col("error").isNull() & F.col("_reply_ok"), suffix)
    if keep_reply:
        df = df.withColumnRenamed("_reply_text", "reply")
    drop = ["_reply_ok", "body", "prompt", "request"] + ([] if keep_reply else ["_reply_text", "error"])
    return df.drop(*[c for c in drop if c in df.columns])


def classify(records: DataFrame, prior: DataFrame | None, responder, mode: str = "new",
             key: str = "vc_id", suffix: str = "", keep_reply: bool = False, **kw) -> DataFrame:
    """Routed records still to do ('new') or failed before ('retry') -> result rows.

    Returns the input columns plus the four result columns, ready for
    ``upsert`` (with ``keep_reply``, also ``error`` and ``reply``).
    """
    status_col = "process_status" + suffix
    if prior is None:
        if mode == "retry":
            raise ValueError("retry mode needs a prior results table")
        from recsort.operators.state import route_need_ai
        todo = route_need_ai(records)
    elif mode == "new":
        todo = resume_pending(records, prior, status_col, key)
    elif mode == "retry":
        todo = retry_failed(records, prior, status_col, key)
    else:
        raise ValueError(f"mode must be 'new' or 'retry', not {mode!r}")
    if getattr(responder, "row_wise", False):
        # answer on the record rows themselves: no join back, no shuffle of text
        return materialise(with_results(responder.respond_rows(with_requests(todo, **kw)), suffix, keep_reply))
    # Rows are named by id and request: repeated ids neither multiply nor share replies they did not ask for.
    rows = with_requests(todo, **kw).withColumn("_call", call_id(key)).drop("prompt", "request")
    replies = responder(requests_for(todo, key, **kw), key).withColumnRenamed("call_id", "_call")
    out = rows.join(materialise(with_results(replies, suffix, keep_reply)), "_call", "left").drop("_call")
    # a record that the responder does not answer is a request failure
    none = F.col(status_col).isNull()
    fill = {c + suffix: STATUS_REQUEST_FAIL for c in ("ai_violation_categories", "ai_reason", "process_status")} | {"ai_raw_response" + suffix: ""}
    if keep_reply:
        fill["error"] = NO_RESPONSE
    return out.withColumns({c: F.when(none, F.lit(v)).otherwise(F.col(c)) for c, v in fill.items()})


def status_summary(results: DataFrame, transport_error: str = "error",
                   status_col: str = "process_status") -> DataFrame:
    """Rows and distinct ids per status, and how many had transport success."""
    agg = [F.count(F.lit(1)).alias("n_rows"), F.countDistinct("vc_id").alias("n_ids")]
    if transport_error in results.columns:
        agg.append(F.sum(F.col(transport_error).isNull().cast("int")).alias("n_transport_ok"))
    return results.groupBy(status_col).agg(*agg)


def merge_results(base: DataFrame, ai: DataFrame, dictionary: DataFrame, rules: DataFrame | None = None,
                  key: str = "doc_id", catch_all: str = CATCH_ALL_CATEGORY) -> DataFrame:
    """One labelled row per record, priority: expert success > dictionary > rule > fallback.

    ``ai`` (key, ai_violation_categories, process_status), ``dictionary``
    (key, categories); the rule branch is either a ``rule_categories``
    column of ``base`` (map-side, no join) or a ``rules`` DataFrame
    (key, rule_categories). All joins are on the same key, so they can
    reuse one hash partitioning.
    """
    # Status and categories leave each row as one exploded value: a filter on columns that are
    # parsed from a reply would be tried below the join, and parse every reply once more.
    reply = F.array(F.struct("process_status", F.col("ai_violation_categories").alias("_ai")))
    a = ai.select(key, F.explode_outer(reply).alias("_reply")).filter(F.col("_reply.process_status") == STATUS_OK).select(key, "_reply._ai")
    d = dictionary.filter(F.col("categories") != "").select(key, F.col("categories").alias("_dict"))
    out_cols = [c for c in base.columns if c != "rule_categories"]
    if rules is None:
        j = base.withColumnRenamed("rule_categories", "_rule")
    else:
        j = base.join(rules.select(key, F.col("rule_categories").alias("_rule")), key, "left")
    j = j.join(a, key, "left").join(d, key, "left")
    rule_real = F.col("_rule").isNotNull() & (F.col("_rule") != catch_all)
    return j.select(
        *out_cols,
        F.coalesce("_ai", "_dict", F.when(rule_real, F.col("_rule")), F.lit(catch_all)).alias("final_categories"),
        F.when(F.col("_ai").isNotNull(), F.lit("expert"))
        .when(F.col("_dict").isNotNull(), F.lit("dictionary"))
        .when(rule_real, F.lit("rule"))
        .otherwise(F.lit("fallback")).alias("source"),
    )


def event_log(rows: DataFrame, mode: str = "batch", key: str = "vc_id") -> DataFrame:
    """Request / response / error events of classified rows, in one pass.

    ``rows`` carries the record (``text_combined``, ``violation_categories``),
    the transport ``error``, the raw ``reply`` and the parsed result columns.
    Every row emits a request event and then either a response or an error
    event; ``inline`` expands them without a union (no second scan). A reply
    body without usable text (null ``reply``) is an error event. The HTTP
    ``status_code`` is taken from ``rows`` if they have it.
    """
    null = F.lit(None).cast("string")
    number = F.lit(None).cast("int")
    code = F.col("status_code").cast("int") if "status_code" in rows.columns else number
    rc = clean_rule_categories(F.col("violation_categories"))

    def event(kind, **cols):
        names = ["rule_categories", "text_len", "prompt", "status", "ai_category", "ai_reason",
                 "raw_response", "status_code", "error"]
        return F.struct(F.lit(kind).alias("event"), F.col(key).alias(key),
                        *[cols.get(n, number if n in ("text_len", "status_code") else null).alias(n) for n in names], F.lit(mode).alias("mode"))

    request = event("request", rule_categories=rc,
                    text_len=F.length(F.coalesce("text_combined", F.lit(""))),
                    prompt=build_prompt(F.col("text_combined"), rc))
    response = event("response", status=F.col("process_status"), ai_category=F.col("ai_violation_categories"),
                     ai_reason=F.col("ai_reason"), raw_response=F.col("reply"))
    error = event("error", status_code=code, error=F.coalesce("error", F.lit("unusable reply body")))
    second = F.when(F.col("error").isNull() & F.col("reply").isNotNull(), response).otherwise(error)
    return rows.select(F.inline(F.array(request, second)))
