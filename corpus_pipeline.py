"""A training corpus from the raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps
with the columns of ``documents``; the last returns packed pieces. ``run``
writes every stage's result to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.mixing import mixed_rows
from tidemark.llm.ngram_join import one_of_each_group
from tidemark.llm.packing import pack_documents
from tidemark.llm.queries import held_out, importable, query
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.tables import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model accepts; null and letterless texts go.

    The model learns from labelled documents alone, each text once. Rows with null or
    equal ids are decided by their own text; repeated rows all stay or all go.
    """
    importable(spark)
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs.where(~held_out()))
    return language_id.identify(docs, model).where("accepted").select(*COLUMNS)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of equal and similar texts.

    Null ids come after all others. Of rows with one id and different texts of a
    group one stays; a row repeated as a whole stays once.
    """
    importable(spark)
    return one_of_each_group(docs.select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; those with nothing left go.

    What is left keeps its white space. Null and blank texts go. Rows repeated as a
    whole repeat each other, also with null ids.
    """
    importable(spark)
    left = remove_repeats(docs.select(*COLUMNS), spaces=True).where("n_words > n_removed")
    text = F.col("kept_text")
    return left.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source. Rows with null or equal ids are taken by id and text;
    repeated rows take equal shares. Null and wordless texts are not taken.
    """
    importable(spark)
    return mixed_rows(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their tokens, and their places in sequences.

    Null and empty texts are the end token alone; repeated rows are packed as often
    as they are there.
    """
    importable(spark)
    return pack_documents(docs.select(*COLUMNS), with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_near_duplicates),
    ("substring_dedup", without_repeats),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

#: No SQL trains the language model or tokenizes; tests hold the stages against brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
