"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardtide.llm import merkle
from cardtide.llm.common import HIDDEN, landed, not_held_out, table
from cardtide.llm.divergence import divergences
from cardtide.llm.kneser_ney import TOXICITY, Model, learned, scored
from cardtide.llm.mixing import COPIES, RATE, mixed_rates, repeated
from cardtide.llm.oracle import ORACLE
from cardtide.llm.perspectives import rotated
from cardtide.llm.pivots import nearest
from cardtide.llm.repeats import KEPT, N_BYTES, N_REMOVED, N_SPANS, repeated_bytes
from cardtide.llm.reputation import HOST, PATH, RULE, VERDICT, UrlRule, judged_urls, url_parts
from cardtide.llm.rules import BASE, COUNTS, FURTHER, KEPT as RULES_KEPT, cascaded, ordered, sampled
from cardtide.llm.sentencepieces import IDS, PARITY, ROUND_TRIP, encoded, read_model
from cardtide.llm.simhash import GROUP, hex_fingerprint, simhash_groups
from cardtide.llm.subwords import ACCEPTED, LABEL, POSTERIOR, SCORE, TOKENS, Subwords, classified, fitted
from cardtide.llm.tokencounts import N_BYTES as TEXT_BYTES, N_TOKENS, read_tokenizer, token_counts

#: The least score of a document that counts as toxic.
TOXIC_FROM = 0.3


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, read_model()).select(
        "doc_id",
        F.size(IDS).cast("long").alias("n_tokens"),
        F.xxhash64(IDS).alias("ids_hash"),
        F.col(ROUND_TRIP).alias("round_trip"),
        F.col(PARITY).alias("parity"),
    )


def learned_language(docs: DataFrame) -> Subwords:
    """The language classifier of the queries: text and lang of rows that are not held out, by hash of the id."""
    return fitted(docs.where(not_held_out(F.col("doc_id"))), "text", "lang", F.col("doc_id"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return classified(docs.select("doc_id", "text"), learned_language(docs)).select(
        "doc_id",
        (~not_held_out(F.col("doc_id"))).alias("held_out"),
        F.col(LABEL).alias("lang_pred"),
        F.col(SCORE).alias("score"),
        F.col(ACCEPTED).alias("accepted"),
    )


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as domains: rates that move their shares of words to the present ones to the power 0.7."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learned_language(docs)
    rows = landed(classified(docs.select("doc_id", "text"), model).select("doc_id", LABEL, POSTERIOR, TOKENS), "posteriors")
    return repeated(mixed_rates(rows, model.labels), "doc_id").select(
        "doc_id",
        F.col(LABEL).alias("domain"),
        F.col(TOKENS).alias("n_tokens"),
        F.col(POSTERIOR).alias("posterior"),
        F.col(RATE).alias("rate"),
        F.col(COPIES).alias("copies"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = ordered([*BASE, *FURTHER], sampled(docs, "text", F.col("doc_id")))
    counts = {c: F.col(HIDDEN + c) for c in COUNTS}
    failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
    return cascaded(docs, rules, counts=COUNTS).select(
        "doc_id", *(column.alias(c) for c, column in counts.items()), failed.alias("base_failed"), F.col(RULES_KEPT).alias("kept")
    )


#: The rules that the query is given.
URL_RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the same number."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(F.max("quality").alias("good"))
    outcomes = pages.join(labels, "page_id", "left").select(url_parts(F.col("url"))[0].alias("host"), "good")
    return judged_urls(pages, outcomes, URL_RULES).select(
        "page_id", F.col(HOST).alias("host"), F.col(PATH).alias("path"), F.col(RULE).alias("rule"), F.col(VERDICT).alias("verdict")
    )


def learned_toxicity(spark: SparkSession, sf_dir: str) -> Model:
    """The toxicity model of the queries: texts with a label, of rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").where(not_held_out(F.col("doc_id")))
    labels = table(spark, sf_dir, "labels").where("toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    # Written, they have a size: texts are shuffled to them only where they are too many to be sent around.
    labels = landed(labels, "toxic-labels")
    return learned(docs.join(labels, "doc_id"), "text", "toxic", F.col("doc_id"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, learned_toxicity(spark, sf_dir)).select(
        "doc_id",
        (~not_held_out(F.col("doc_id"))).alias("held_out"),
        F.col(TOXICITY).alias("score"),
        (F.col(TOXICITY) >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_bytes(docs).select(
        "doc_id",
        F.col(N_BYTES).alias("n_bytes"),
        F.col(N_REMOVED).alias("n_removed"),
        F.col(N_SPANS).alias("n_spans"),
        F.sha2(KEPT, 256).alias("kept_sha256"),
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated(table(spark, sf_dir, "conversations"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs).select("doc_id", hex_fingerprint().alias("fingerprint"), F.col(GROUP).alias("component_id"))


#: Documents of more tokens do not fit into a window.
TOKEN_LIMIT = 512


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, read_tokenizer()).select(
        "doc_id",
        F.col(TEXT_BYTES).alias("n_bytes"),
        F.col(N_TOKENS).alias("n_tokens"),
        (F.col(N_TOKENS) > TOKEN_LIMIT).alias("over_limit"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every fifth id by hash are tampered with: their texts lose their capital letters."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    other = merkle.leaf_hash([lowered if c == "text" else F.col(c) for c in fields])
    found = merkle.manifest(docs, fields, altered=F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, other))
    return found.select(
        F.col(merkle.ID).alias("doc_id"),
        F.col(merkle.LEAF).alias("leaf"),
        F.col(merkle.SUBROOT).alias("subroot"),
        F.col(merkle.ROOT).alias("root"),
        merkle.proof_hash(F.col(merkle.PROOF)).alias("proof_sha256"),
        merkle.folded(F.coalesce(merkle.ALTERED, merkle.LEAF), F.col(merkle.PROOF)).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filters": op4_url_filters,
    "op5_toxicity": op5_toxicity,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_source_divergence": op12_source_divergence,
    "op13_merkle_manifest": op13_merkle_manifest,
}

__all__ = ["ORACLE", "QUERIES"]
