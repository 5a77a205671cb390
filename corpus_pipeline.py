"""From raw documents to encoded training text: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it back for the next stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm import chunk_bpe, forest_join, mixing, pii, quality
from strandweave.llm.common import stored, table, with_text_key


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.assess(docs).filter("_q_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest doc_id."""
    return forest_join.one_of_each_class(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; n_chars follows where it was given."""
    clean = pii.redact(pii.find_pii(docs, out="_pii"), pii="_pii")
    changed = F.size("_pii") > 0
    return clean.withColumn("n_chars", F.when(changed & F.col("n_chars").isNotNull(), F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their target weights."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix: its number of tokens, and digests of its ids and of their decoding."""
    return (with_text_key(docs).select("doc_id", "lang", "source", "text_key")
            .join(chunk_bpe.encoded_digests(docs), "text_key")
            .select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("personal data", personal_data),
          ("source mix", source_mix), ("encoding", encode)]

#: Components, tilts and tokens are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
