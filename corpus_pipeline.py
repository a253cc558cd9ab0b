"""A corpus pipeline over documents: language, lines, near duplicates, mixing, packing.

Each stage works on all that the one before it kept and is written as Parquet before the next reads it. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import staged
from rosterline.llm.language import in_a_language
from rosterline.llm.lines import line_dedup
from rosterline.llm.mixing import mixture
from rosterline.llm.near import one_of_each
from rosterline.llm.packing import pack_sequences, vocabulary_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learned from the input; texts without a letter and undecided ones go.

    Null texts go. Repeated rows are judged alike; an empty table stays empty; other columns stay, whatever their names.
    """
    return in_a_language(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that other documents hold too; n_chars follows the text.

    Null texts are empty ones then. A line stays in the largest identifier; rows with one identifier are one document and
    all stay. An empty table stays empty; other columns stay, whatever their names.
    """
    kept = line_dedup(docs.select("doc_id", "text", F.struct("*").alias("row")), carry=("row",))
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least identifier.

    Texts without words are one class. A row with a null identifier stays only if its whole class has none; of repeated
    rows one stays. An empty table stays empty; other columns stay, whatever their names.
    """
    return one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, repeated as it repeats them.

    Texts without words are never taken; a null source is a source; repeated rows count each; which of the documents of a
    length are taken depends on a seeded hash. An empty table stays empty; other columns stay, whatever their names.
    """
    return mixture(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: see ``pack_sequences`` for null texts, repeated rows and empty tables. Columns of documents go."""
    return pack_sequences(docs, vocabulary_path())


STAGES = [
    ("language", language_stage), ("line_dedup", line_stage), ("near_dedup", near_stage), ("mixing", mixing_stage), ("packing", packing_stage),
]

#: Language models, classes of near duplicates and packing can't be expressed in SQL; tests hold each stage to a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
