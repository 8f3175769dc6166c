"""A training corpus from raw documents, in stages that each take what the one before kept.

Every stage but the last keeps the columns of its documents, whatever their names, and passes an
empty table on. Rows without doc_id go through all stages as documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terracell.llm import langid, line_dedup, mixing, packing, simhash
from terracell.llm.common import shared_folder, table
from terracell.llm.queries import tokenizer_path

LEAST_LANGUAGE = 0.4  # of a document's letters, in one language
SEQUENCE = 4096


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null and empty texts, texts without letters, and those whose
    letters no learned language explains or holds to LEAST_LANGUAGE. Repeated rows are judged alike."""
    return langid.accepted(docs, langid.fit(langid.learned(docs)), LEAST_LANGUAGE)


def line_templates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from the texts; no document goes, null texts stay null,
    a document of nothing but such lines stays as it is. Documents with equal texts count as one."""
    return line_dedup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that of smallest doc_id, by five words and a similarity
    of 0.8; null and empty texts are one group, rows without doc_id all stay."""
    return simhash.first_of_each(docs, words=5, similarity=0.8)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix takes, at most three times their words; null texts,
    having none, go. A null source is a source; repeated rows are documents of their own."""
    return mixing.mix_texts(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: every piece of every document with its place; a null or empty text is one end token."""
    return packing.pack(docs, tokenizer_path(), SEQUENCE)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_templates),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mix),
    ("best_fit_packing", packed),
]

# Language models, sketches and seeded draws are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    at = shared_folder(spark, "pipeline")  # goes when the application ends
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
