"""Registered queries of the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, minmax_dedup, ordinal_quality
from tidemark.llm.filter_audit import audit
from tidemark.llm.html_extract import extract
from tidemark.llm.mixing import mix
from tidemark.llm.ngram_join import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality_rules import verdicts
from tidemark.llm.spelling import variants
from tidemark.llm.spotsigs import as_text, fingerprints
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver does."""
    paths = spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    if _ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = f"{_ROOT}{os.pathsep}{paths}"


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        def started(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return run(spark, sf_dir)

        QUERIES[name] = started
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that no language model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out()))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.col("accepted").alias("kept")
    )


@query("op4_document_fingerprints")
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("signatures").alias("fingerprint"),
        as_text("edited_signatures").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_ngram_jaccard_join")
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_copies", "n_links", "group_id", "group_key")


def grades(labels: DataFrame) -> DataFrame:
    """Grade 0 for low quality, 1 for good but toxic, 2 for good texts."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("quality is not null and toxic is not null").select("doc_id", grade.alias("grade"))


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = grades(table(spark, sf_dir, "labels")).where(~held_out())
    model = ordinal_quality.train(docs, rated)
    return ordinal_quality.rate(docs, model).select("doc_id", "expected_grade", "top_probability", F.col("selected").alias("kept"))


@query("op8_source_mixing")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return verdicts(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def sample_edits(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Three edits of each text at places given by its id: a deletion, an insertion, a replacement."""
    n_chars = F.coalesce(F.length(text), F.lit(0))
    picks = [F.xxhash64(doc_id, F.lit(number)) for number in range(3)]
    starts = [F.pmod(pick, n_chars + 1).cast("int") for pick in picks]
    sizes = [F.pmod(F.shiftright(pick, 24), F.lit(most)).cast("int") for pick, most in zip(picks, (80, 200, 20), strict=True)]
    texts = [F.lit(""), F.substring(text, F.lit(1), sizes[1]), F.concat(F.lit(" edit "), F.col(doc_id).cast("string"))]
    removed = [sizes[0], F.lit(0), sizes[2]]
    return F.array(
        *(
            F.struct(
                F.lit(number).alias("order"),
                starts[number].alias("start"),
                removed[number].alias("removed"),
                texts[number].alias("replacement"),
            )
            for number in range(3)
        )
    )


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", sample_edits())
    return count_tokens(docs, edits_col="edits", details=False).select(
        "doc_id", "n_tokens", "n_edits", "n_tokens_edited", "chars_encoded"
    )


AUDIT_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM docs
), marks AS (
    SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
    SELECT s.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
        (len(s.words) < 100)::INT
        + 2 * (100 * len(list_distinct(s.words)) < 80 * len(s.words))::INT
        + 4 * (100 * (length(s.t) - length(regexp_replace(s.t, '[A-Z]', '', 'g'))) > 10 * length(s.t))::INT
        + 8 * regexp_matches(s.t, '[#$%&*|]')::INT
        + 16 * coalesce(s.doc_id > min(s.doc_id) OVER (PARTITION BY s.t), false)::INT AS mask
    FROM split s LEFT JOIN marks m ON s.doc_id = m.doc_id
), counts AS (
    SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM failed GROUP BY part, mask
), letters(letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
    SELECT o.filter_order, s.step, l.bit,
        (SELECT coalesce(sum(x.bit), 0) FROM letters x WHERE instr(o.filter_order, x.letter) < s.step)::INT AS prior
    FROM orders o, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step) s, letters l
    WHERE l.letter = substr(o.filter_order, s.step, 1)
), found AS (
    SELECT c.part, s.filter_order, s.step, s.bit,
        sum(c.n) FILTER (WHERE c.mask & (s.prior | s.bit) = 0) AS kept,
        sum(c.n) FILTER (WHERE c.mask & s.prior = 0 AND c.mask & s.bit <> 0) AS removed,
        sum(c.n) FILTER (WHERE c.mask & s.prior <> 0 AND c.mask & s.bit <> 0) AS redundant,
        sum(c.n) FILTER (WHERE c.mask = s.bit) AS unique_fails,
        sum(c.good) FILTER (WHERE c.mask & s.prior = 0 AND c.mask & s.bit <> 0) AS good_lost,
        sum(c.toxic) FILTER (WHERE c.mask & s.prior = 0 AND c.mask & s.bit <> 0) AS toxic_lost
    FROM counts c, steps s GROUP BY c.part, s.filter_order, s.step, s.bit
)
SELECT part, filter_order, step,
    coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM found
"""


@query("op12_filter_audit", AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return audit(docs, table(spark, sf_dir, "labels"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_minmax_dedup")
def op11_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
