"""Corpus pipeline: language, near duplicates, personal data, source mix, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame; all but the last keep the columns of
``documents``.  ``run`` writes each stage's result as Parquet in the shared
folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.llm import langid, minmax, mixing, packing, pii
from farelens.llm.common import materialize, read_table
from farelens.llm.queries import tokenizer_path


# Rows of an Arrow batch: a worker holds a batch of whole texts, several times over.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of at most BATCH_ROWS (a session setting, kept if smaller)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the others (no text, no letter, unsure) go.

    Repeated rows are judged alike; an empty table gives no rows.
    """
    small_batches(spark)
    return langid.keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; texts without words stay (see ``keep_one_of_each``)."""
    small_batches(spark)
    return minmax.keep_one_of_each(docs)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; ``n_chars``, if there, follows the text.

    NULL and empty texts stay as they are (0 characters), as do repeated rows.
    """
    masked = pii.pseudonymize(docs, counts=False)
    if "n_chars" not in docs.columns:
        return masked.select(*docs.columns)
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", n_chars).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources: a row per drawn block, by shard and within it by the keyed hash.

    Texts without words are never drawn; repeated rows are drawn one by one;
    a NULL source is a source; an empty table gives no rows.
    """
    small_batches(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full token sequences.

    A NULL or empty text is its end id alone; repeated rows are packed one by
    one; an empty table gives no rows.
    """
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("language_id", identify), ("near_dedup", deduplicate), ("pii", mask), ("mix_sources", mix), ("pack", pack)]

# The stages hash, sample and tokenize in ways SQL cannot express; they are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
