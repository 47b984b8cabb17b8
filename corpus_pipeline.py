"""A training corpus from the documents table, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardtide.llm.common import landed, prepared, release_shuffles, table
from cardtide.llm.kneser_ney import TOXICITY, scored
from cardtide.llm.mixing import COPIES, mixed_rates, repeated
from cardtide.llm.queries import TOXIC_FROM, learned_language, learned_toxicity
from cardtide.llm.repeats import KEPT, N_REMOVED, repeated_bytes
from cardtide.llm.sentencepieces import IDS, encoded, read_model
from cardtide.llm.simhash import simhash_dedup
from cardtide.llm.subwords import classified
from cardtide.session import discard, scratch_made

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def begun(spark: SparkSession) -> None:
    """What every stage starts with: its settings, and the room that the shuffles of the stage before took up."""
    prepared(spark)
    release_shuffles(spark)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels table, does not reject."""
    begun(spark)
    return scored(docs, learned_toxicity(spark, sf_dir)).where(F.col(TOXICITY) < TOXIC_FROM).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 3-word shingles, 3 differing bits."""
    begun(spark)
    return simhash_dedup(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a document of a smaller id has too; n_chars follows the text.

    Where a cut goes through a character, the rest of that character goes as well. A null text stays null, and a
    document stays even where nothing of its text does.
    """
    begun(spark)
    cut = F.col(N_REMOVED) > 0
    return (
        repeated_bytes(docs, as_text=True)
        .withColumn("text", F.when(cut, F.col(KEPT)).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated until the languages' shares of words are their present ones to the power 0.7; none goes."""
    begun(spark)
    model = learned_language(docs)
    rows = landed(classified(docs, model), "posteriors")
    rates = repeated(mixed_rates(rows, model.labels, least=1.0), "doc_id")
    return rates.withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))).select(*docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their texts."""
    begun(spark)
    return encoded(docs, read_model()).select(*docs.columns, F.col(IDS).alias("token_ids"), F.size(IDS).cast("long").alias("n_tokens"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("mixing", mixed),
    ("sentencepiece", tokenized),
]

#: No SQL engine has the trained models and tokenizers of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next.

    Once a stage's rows are written, nothing reads what it wrote on the way, nor the rows of the stage before: both go.
    """
    docs, kept = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch_made() as made:
            docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(spark, [*kept, *made[:-1]])
        kept = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
