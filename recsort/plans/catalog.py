"""Registered queries: one ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the given tables (through the fixture builders), so its
work grows with the data. Integer outputs are BIGINT and computed columns
carry the same names as the DuckDB SQL in ``recsort.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.functions import text as T
from recsort.functions.prompts import build_prompt, build_request
from recsort.functions.replies import with_extracted_reply, with_parsed_reply
from recsort.operators import classify as C
from recsort.operators import dictionary as D
from recsort.operators import embeddings as E
from recsort.operators import quality as Q
from recsort.operators import state as S
from recsort.operators import training as TR
from recsort.sinks.results import sink_rows
from recsort.sources import fixtures as FX
from recsort.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _long(c):
    return c.cast("long")


# --------------------------------------------------------------------- F1

def _clean(spark, sf):
    return TR.train_clean(FX.f1_training(spark, sf))


@query("train_clean")
def q_train_clean(spark, sf):
    return _clean(spark, sf).select("vc_id", "text", _long(F.col("label")).alias("label"))


@query("label_rejects")
def q_label_rejects(spark, sf):
    return TR.label_rejects(FX.f1_training(spark, sf))


@query("label_distribution")
def q_label_distribution(spark, sf):
    return TR.label_distribution(_clean(spark, sf)).select(_long(F.col("label")).alias("label"), "n")


@query("text_preview")
def q_text_preview(spark, sf):
    return TR.text_preview(_clean(spark, sf)).withColumn("label", _long(F.col("label")))


# --------------------------------------------------------------------- F2

@query("triage_input")
def q_triage_input(spark, sf):
    r = FX.f2_records(spark, sf)
    return r.select("doc_id", "vc_id", F.coalesce(F.col("text_combined").cast("string"), F.lit("")).alias("text_combined"))


@query("route_need_ai")
def q_route_need_ai(spark, sf):
    return S.route_need_ai(FX.f2_records(spark, sf)).select("doc_id", "vc_id", _long(F.col("need_ai")).alias("need_ai"))


@query("triage_stats")
def q_triage_stats(spark, sf):
    from recsort.plans.jobs import prediction_stats
    return prediction_stats(FX.f2_records(spark, sf))


@query("sort_natural_id")
def q_sort_natural_id(spark, sf):
    r = S.route_need_ai(FX.f2_records(spark, sf))
    n_len, z = T.natural_key(F.col("vc_id"))
    return r.select("vc_id", _long(n_len).alias("nat_len"), z.alias("nat_key")) \
        .orderBy("nat_len", "nat_key", "vc_id")


@query("widen_schema")
def q_widen_schema(spark, sf):
    from recsort.sinks.results import result_column_names
    return S.widen_schema(FX.f6_prior(spark, sf), result_column_names())


@query("flatten_whitespace")
def q_flatten_whitespace(spark, sf):
    r = FX.f2_records(spark, sf).withColumn("need_ai", _long(F.col("need_ai")))
    return T.flatten_string_columns(r)


@query("clean_text")
def q_clean_text(spark, sf):
    r = FX.f2_records(spark, sf)
    return r.select("vc_id", T.clean_text("violation_categories").alias("clean_violation"),
                    T.clean_text("text_combined").alias("clean_text"))


@query("clean_rule_categories")
def q_clean_rule_categories(spark, sf):
    r = FX.f2_records(spark, sf)
    return r.select("vc_id", T.clean_rule_categories("violation_categories").alias("rule_categories"))


def _prompts(spark, sf):
    r = FX.f2_records(spark, sf)
    return r.select("vc_id", build_prompt(F.col("text_combined"),
                                          T.clean_rule_categories("violation_categories")).alias("prompt"))


@query("build_prompt")
def q_build_prompt(spark, sf):
    return _prompts(spark, sf)


@query("build_request")
def q_build_request(spark, sf):
    req = _prompts(spark, sf).select("vc_id", build_request(F.col("prompt")).alias("request"))
    g = lambda p: F.get_json_object("request", p)
    return req.select(
        "vc_id",
        g("$.model").alias("model"),
        _long(F.json_array_length(g("$.messages"))).alias("n_messages"),
        g("$.messages[0].role").alias("first_role"),
        g("$.messages[1].content").alias("user_content"),
        g("$.temperature").cast("double").alias("temperature"),
        g("$.max_tokens").cast("long").alias("max_tokens"),
        g("$.stream").cast("boolean").alias("stream"),
    )


# --------------------------------------------------------------------- F5

RESULT = ["vc_id", "ai_violation_categories", "ai_reason", "ai_raw_response", "process_status"]


def _parsed(spark, sf) -> DataFrame:
    """F5 replies -> result rows (request failures for transport errors)."""
    return with_parsed_reply(FX.f5_replies(spark, sf), "reply", F.col("error").isNull())


@query("extract_reply")
def q_extract_reply(spark, sf):
    return with_extracted_reply(FX.f5_bodies(spark, sf), "body").select("vc_id", "reply_text", "reply_ok")


@query("parse_reply")
def q_parse_reply(spark, sf):
    r = FX.f5_replies(spark, sf).filter(F.col("error").isNull())
    return with_parsed_reply(r, "reply").select(*RESULT)


@query("request_failure_rows")
def q_request_failure_rows(spark, sf):
    return _parsed(spark, sf).select(*RESULT)


@query("status_summary")
def q_status_summary(spark, sf):
    return C.status_summary(_parsed(spark, sf))


@query("event_log")
def q_event_log(spark, sf):
    p = _parsed(spark, sf)
    f2 = FX.f2_records(spark, sf).select("doc_id", "text_combined", "violation_categories")
    return C.event_log(p.join(f2, "doc_id"))


# --------------------------------------------------------------------- F6

@query("resume_pending")
def q_resume_pending(spark, sf):
    return S.resume_pending(FX.f2_records(spark, sf), FX.f6_prior(spark, sf)).select("doc_id", "vc_id")


@query("retry_failed")
def q_retry_failed(spark, sf):
    return S.retry_failed(FX.f2_records(spark, sf), FX.f6_prior(spark, sf)).select("doc_id", "vc_id")


@query("upsert_results")
def q_upsert_results(spark, sf):
    # record fields are stored as text in the results table
    f2 = FX.f2_records(spark, sf).withColumn("need_ai", F.col("need_ai").cast("string"))
    p = _parsed(spark, sf).filter(F.col("doc_id") % 3 == 0) \
        .select("doc_id", "ai_violation_categories", "ai_reason", "ai_raw_response", "process_status")
    batch = sink_rows(f2.join(p, "doc_id"))
    return S.upsert(FX.f6_prior(spark, sf), batch)


@query("upsert_second_strategy")
def q_upsert_second_strategy(spark, sf):
    """A run with the ``_v2`` columns over the first run's table: the plain result columns stay."""
    p = _parsed(spark, sf).filter(F.col("doc_id") % 3 == 0).select(
        "doc_id", "vc_id", F.col("ai_violation_categories").alias("ai_violation_categories_v2"),
        F.col("process_status").alias("process_status_v2"))
    return S.upsert(FX.f6_prior(spark, sf), sink_rows(p))


@query("results_upsert")
def q_results_upsert(spark, sf):
    """The same upsert through the stored table: only the buckets of the batch's keys are rewritten."""
    from recsort.session import scratch_path
    from recsort.sinks.results import KeyedResults
    f2 = FX.f2_records(spark, sf).withColumn("need_ai", F.col("need_ai").cast("string"))
    p = _parsed(spark, sf).filter(F.col("doc_id") % 3 == 0) \
        .select("doc_id", "ai_violation_categories", "ai_reason", "ai_raw_response", "process_status")
    table_ = KeyedResults(spark, scratch_path(spark, "results-upsert"))
    table_.upsert(FX.f6_prior(spark, sf))
    return table_.upsert(sink_rows(f2.join(p, "doc_id")))


@query("responder_calls")
def q_responder_calls(spark, sf):
    """A caller's service that refuses, stalls, stays silent, answers at the second attempt or without sections; every seventh record stands thrice."""
    copies = F.when(F.col("doc_id") % 7 == 0, F.array(F.lit(0), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rec = FX.f2_records(spark, sf).withColumn("copy", F.explode(copies)).withColumn("copy", F.col("copy").cast("long")).withColumn(
        "text_combined", F.when(F.col("copy") == 1, F.concat(F.coalesce("text_combined", F.lit("")), F.lit(" again"))).otherwise(F.col("text_combined")))
    responder = C.CallResponder(FX.fixture_service(), concurrency=8, timeout=1.0, attempts=2, backoff=0.05, calls_per_task=512)
    return C.classify(rec, None, responder, keep_reply=True).select("doc_id", "copy", *RESULT, "error")


@query("last_write_wins")
def q_last_write_wins(spark, sf):
    ev = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    best = S.last_write_wins(ev, "user_id", ["ts", "event_id"])
    return best.select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
                       "event_type", "value", "props")


# ---------------------------------------------------------------- F5 + F7

def _exploded(spark, sf):
    e = Q.explode_categories(_parsed(spark, sf))
    return e.withColumn("pos", _long(F.col("pos")))


@query("explode_categories")
def q_explode_categories(spark, sf):
    return _exploded(spark, sf)


@query("off_vocab_categories")
def q_off_vocab(spark, sf):
    return Q.off_vocab_categories(_exploded(spark, sf), FX.vocabulary_df(spark))


@query("category_frequency")
def q_category_frequency(spark, sf):
    return Q.category_frequency(_exploded(spark, sf))


@query("category_contract")
def q_category_contract(spark, sf):
    f2 = FX.f2_records(spark, sf).select("doc_id", "text_combined")
    res = _parsed(spark, sf).join(f2, "doc_id")
    return Q.category_contract(res).withColumn("n_categories", _long(F.col("n_categories")))


def _end_to_end(spark, sf) -> DataFrame:
    records = FX.f2_records(spark, sf)
    responder = C.RuleResponder(FX.keywords_df(spark))
    rows = C.classify(records, FX.f6_prior(spark, sf), responder, mode="new")
    return sink_rows(rows)


@query("classify_end_to_end")
def q_classify_end_to_end(spark, sf):
    return _end_to_end(spark, sf).select(*RESULT)


@query("evidence_check")
def q_evidence_check(spark, sf):
    r = Q.evidence_check(_end_to_end(spark, sf))
    return r.select("vc_id", _long(F.col("n_spans")).alias("n_spans"), _long(F.col("n_found")).alias("n_found"),
                    "evidence_ok")


# --------------------------------------------------------------------- F8

@query("rule_classify")
def q_rule_classify(spark, sf):
    r = FX.f2_records(spark, sf).filter(F.col("need_ai") == 0)
    out = D.rule_classify(r, FX.keywords_df(spark))
    return out.withColumn("n_keywords", _long(F.col("n_keywords")))


def _docs(spark, sf):
    return table(spark, sf, "documents", "doc_id", "text")


@query("keyword_match")
def q_keyword_match(spark, sf):
    return D.rule_matches(_docs(spark, sf), FX.keywords_df(spark))


@query("keyword_match_indexed")
def q_keyword_match_indexed(spark, sf):
    return D.keyword_match(_docs(spark, sf), FX.part_keywords(spark, sf))


def _entries(spark, sf):
    return D.article_entries(FX.f8_article_lines(spark, sf), FX.keywords_df(spark), FX.EDGE_RULES)


def _pairs(spark, sf):
    return D.dictionary_pairs(_entries(spark, sf))


@query("article_dictionary")
def q_article_dictionary(spark, sf):
    return D.article_dictionary(_entries(spark, sf))


def _citations(spark, sf, pairs):
    d = _docs(spark, sf).select("doc_id", FX.cited_text(F.col("text")).alias("cited_text"))
    return D.citation_lookup(d, pairs, FX.EDGE_RULES)


def _final(spark, sf):
    return D.final_dictionary(_pairs(spark, sf), FX.more_corrections_df(spark), FX.REMOVED_CATEGORIES, FX.RECOVER_IF_ARTICLE_CONTAINS)


@query("final_dictionary")
def q_final_dictionary(spark, sf):
    return _final(spark, sf)


@query("citation_lookup")
def q_citation_lookup(spark, sf):
    return _citations(spark, sf, _pairs(spark, sf))


@query("normalise_article")
def q_normalise_article(spark, sf):
    lines = FX.f8_article_lines(spark, sf)
    return lines.select("doc_id", "line", D.normalise_article(F.col("line")).alias("article_norm"))


@query("clean_edges")
def q_clean_edges(spark, sf):
    lines = FX.f8_article_lines(spark, sf)
    art = D.clean_edges(D.normalise_article(F.col("line")), FX.EDGE_RULES)
    return lines.select("doc_id", "line", art.alias("article"))


@query("clean_edges_log")
def q_clean_edges_log(spark, sf):
    return D.clean_edges_log(FX.f8_article_lines(spark, sf), FX.EDGE_RULES)


@query("correct_mapping")
def q_correct_mapping(spark, sf):
    return D.correct_mapping(_pairs(spark, sf), FX.corrections_df(spark))


@query("correction_log")
def q_correction_log(spark, sf):
    return D.correction_log(D.correct_mapping(_pairs(spark, sf), FX.corrections_df(spark)))


@query("recover_removed")
def q_recover_removed(spark, sf):
    return D.recover_removed(_pairs(spark, sf), FX.REMOVED_CATEGORIES, FX.RECOVER_IF_ARTICLE_CONTAINS)


@query("merge_results")
def q_merge_results(spark, sf):
    f2 = FX.f2_records(spark, sf)
    # rule branch as a column of the base rows: no second pass, no join
    base = D.rule_classify(f2, FX.keywords_df(spark), key="doc_id", keep=["vc_id"]).drop("n_keywords")
    return C.merge_results(base, _parsed(spark, sf), _citations(spark, sf, _final(spark, sf)), key="doc_id")


# --------------------------------------------------------------------- F9

def _mapped(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_type").withColumnRenamed("p_type", "category")
    return D.map_categories(part, FX.groups_df(spark))


@query("category_to_group")
def q_category_to_group(spark, sf):
    return _mapped(spark, sf).select("p_partkey", "category", "big_group")


@query("category_group_sorted")
def q_category_group_sorted(spark, sf):
    return D.group_counts(_mapped(spark, sf))


@query("category_list_groups")
def q_category_list_groups(spark, sf):
    """Major groups of every reply's list of categories."""
    groups = FX.lookup(spark, FX.REPLY_GROUPS, "category string, big_group string")
    return D.map_category_lists(_parsed(spark, sf), groups, "ai_violation_categories")


@query("remove_terms")
def q_remove_terms(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_name")
    return part.select("p_partkey", D.remove_terms(F.col("p_name"), FX.STOP_TERMS).alias("terms"))


# ---------------------------------------------------------------- vectors

def _vectors(spark, sf):
    v = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    return v.withColumn("label", _long(F.col("label")))


@query("embedding_cosine")
def q_embedding_cosine(spark, sf):
    return E.cosine_to_centroid(_vectors(spark, sf))


@query("centroid_classify")
def q_centroid_classify(spark, sf):
    return E.centroid_classify(_vectors(spark, sf))


# ------------------------------------------------------- rows-only checks

@query("embedding_head")
def q_embedding_head(spark, sf):
    v = _vectors(spark, sf)
    return E.apply_vector_head(E.fit_vector_head(v), v)


@query("contrastive_pairs")
def q_contrastive_pairs(spark, sf):
    return TR.contrastive_pairs(_clean(spark, sf), k=2).withColumns({c: _long(F.col(c)) for c in ("anchor_label", "partner_label", "j")})


@query("seeded_sample")
def q_seeded_sample(spark, sf):
    return TR.seeded_sample(_clean(spark, sf)).select("vc_id", _long(F.col("label")).alias("label"), T.preview(F.col("text"), 30).alias("preview"))


@query("holdout_counts")
def q_holdout_counts(spark, sf):
    """Rows of each label on either side of the split that the confusion matrix is counted on."""
    sides = [d.select(F.lit(n).alias("side"), _long(F.col("label")).alias("label")) for n, d in zip(("fit", "test"), TR.holdout_split(_clean(spark, sf)))]
    return sides[0].unionByName(sides[1]).groupBy("side", "label").agg(F.count(F.lit(1)).alias("n"))


@query("ml_triage_score")
def q_ml_triage_score(spark, sf):
    model = TR.fit_triage(_clean(spark, sf))
    return TR.score(model, FX.f2_records(spark, sf).select("vc_id", "text_combined")) \
        .select("vc_id", "need_ai")


@query("contrastive_score")
def q_contrastive_score(spark, sf):
    """The projection learnt from ``contrastive_pairs`` and its head, on all records."""
    from recsort.operators.contrastive import fit_contrastive
    return fit_contrastive(_clean(spark, sf)).score(FX.f2_records(spark, sf))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    fit, test = TR.holdout_split(_clean(spark, sf))
    return TR.confusion_matrix(TR.fit_triage(fit), test)


@query("src_csv_encodings")
def q_src_csv_encodings(spark, sf):
    from recsort.sources.export import export_encoded_records
    from recsort.sources.csv import read_records
    path = export_encoded_records(spark, FX.f2_records(spark, sf))
    return read_records(spark, path, null_tokens=None)


@query("src_csv_pruned")
def q_src_csv_pruned(spark, sf):
    from recsort.sources.csv import TRAINING_ENCODINGS, read_records
    from recsort.sources.export import export_encoded_records
    path = export_encoded_records(spark, FX.f2_records(spark, sf))
    return read_records(spark, path, TRAINING_ENCODINGS, columns=["vc_id", "text_combined", "need_ai"])


@query("src_null_tokens")
def q_src_null_tokens(spark, sf):
    from recsort.sources.csv import read_records
    from recsort.sources.export import export_encoded_records
    path = export_encoded_records(spark, FX.f2_records(spark, sf))
    return read_records(spark, path).select("vc_id", "violation_categories", "text_combined")


@query("stream_incremental")
def q_stream_incremental(spark, sf):
    from recsort.streaming.incremental import run_incremental_demo
    return run_incremental_demo(spark, sf)

