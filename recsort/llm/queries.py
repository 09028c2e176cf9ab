"""The thin ``opN_<name>`` queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsort.llm.common import read
from recsort.session import scratch_path


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.warc import read_archives, write_archives
    out_dir = scratch_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages", "page_id", "url", "html"), out_dir)
    return read_archives(spark, out_dir).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.simhash import fingerprint_text, near_duplicates
    out = near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), fingerprint_text("fp").alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.toxicity import FOLDS, score, train
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    out = score(docs, train(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")), keep=["doc_id"])
    # A null id has no digits: it is in no fold, and not held out.
    held_out = F.coalesce(F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return out.select(F.col("row.doc_id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.suffix_dedup import dedup_substrings
    return dedup_substrings(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.quality_rules import judge
    out = judge(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), keep=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "distance")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.packing import pack
    return pack(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op7_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.cross_entropy import cross_entropy_difference
    wanted = read(spark, sf_dir, "labels", "doc_id", "quality").filter("quality = 1").select("doc_id")
    out = cross_entropy_difference(read(spark, sf_dir, "documents", "doc_id", "text"), target_ids=wanted, keep=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "target_loss", "background_loss", "score")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.license_scan import scan_licenses
    return scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.decontaminate import decontaminate, hit_words
    out = decontaminate(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"), keep=["doc_id"])
    out = out.withColumn("n_hit", hit_words(F.col("spans")))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.line_dedup import dedup_lines
    out = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from recsort.llm.cross_tokenizer import align
    out = align(read(spark, sf_dir, "documents", "doc_id", "text"), str(public_tokenizers.path("byte_bpe_50k.json")),
                str(public_tokenizers.path("piece_bpe_32k.model")), keep=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.merkle import fold, leaf, manifest, proof_digest
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = read(spark, sf_dir, "documents", *fields)
    # A null id has no decimal digits: its row is not tampered with.
    odd_rows = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = leaf(*[F.col(c) for c in fields[:-1]], F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    out = manifest(docs, fields, tampered=F.when(odd_rows & (F.instr("text", "\n") > 0), tampered))
    out = out.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                     fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from recsort.llm.topk import search
    out = search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=5, is_query=F.col("vec_id") % 50 == 0)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_simhash_dedup, op3_toxicity, op4_suffix_dedup, op5_quality_rules, op6_packing, op7_cross_entropy, op8_license_scan, op9_decontamination,
    op10_line_dedup, op11_cross_tokenizer, op12_merkle_manifest, op13_exact_topk)}
