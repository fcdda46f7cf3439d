"""A corpus pipeline: language, near-duplicates, repeated passages, mixture and packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_star.llm import language, mixing, packing, simhash, substrings
from catalog_star.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that are in one of the labelled languages; ``lang`` becomes the language found.

    Texts in which none is found go: null ones and those without a letter. A score is no ground to go, as languages of low score are mostly right. Rows of null or repeated ids are judged by
    themselves; an empty table stays empty. The network learns from a bounded draw of the labelled rows of ``docs`` (400 a language).
    """
    network = language.fit(language.draw_labelled(docs, "doc_id", "text", "lang", rows_per_language=400))
    found = language.identify(docs, network, {"doc_id": "doc_id", "text": "text", "source": "source", "n_chars": "n_chars"})
    told = found.where(F.col("lang_pred") != language.UNDETERMINED)
    return told.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose SimHash fingerprints link (three-word shingles, three bits), the one of smallest id stays; of equal ids one.

    A null id stays only where its group has no other. Texts that are null or have no word are one group. An empty table stays empty.
    """
    return simhash.first_of_groups(docs.select(*COLUMNS), shingle=3, radius=3)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 words or more that another document holds as well; one copy of each stays.

    Null and short texts have none; rows equal in id and text are one document; an empty table stays empty.
    """
    passages = substrings.repeated_passages(docs)
    cut = substrings.without_passages(docs, passages)
    return cut.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mixture takes them: a row per document and pass, with the words taken in that pass.

    Null and blank texts are not taken. Rows equal in id, source and text are taken as one document. An empty table stays empty.
    """
    mixture = mixing.mix_sources(docs)
    return mixing.mixed_texts(docs, mixture).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens; a null text is empty, every row is a document of its own."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("passages", cut_repeated_passages),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the network, the chains or the genetic algorithm; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
