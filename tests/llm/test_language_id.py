import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm.language_id import LENGTHS, UNKNOWN, _score_texts, fit, identify, subword_buckets, train
from tidemark.llm.queries import held_out


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return train(docs.where(~held_out()))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", held_out())
    rows = identify(docs, model).collect()
    assert {r.doc_id for r in rows if r.held_out} == {
        r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2
    }
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.lang_pred in model.languages for r in rows)
    assert sum(r.accepted for r in rows) / len(rows) > 0.99


def test_only_the_text_counts(docs, model):
    shuffled = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", -F.col("doc_id"))
    plain = {-r.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    assert {r.doc_id: (r.lang_pred, r.score) for r in identify(shuffled, model).collect()} == plain


def test_odd_rows(odd, model):
    found = identify(odd.withColumn("score", F.lit("x")), model)
    rows = found.collect()
    assert len(rows) == odd.count() and found.columns[:5] == ["doc_id", "text", "lang_pred", "score", "accepted"]
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.accepted) == (UNKNOWN, 0.0, False)
        else:
            assert r.lang_pred in model.languages


def test_empty_tables(none, docs, model):
    assert identify(none, model).count() == 0
    nothing = train(none)
    assert {r.lang_pred for r in identify(docs, nothing).collect()} == {UNKNOWN}


def test_same_model_on_every_run(docs):
    one, two = train(docs), train(docs.repartition(7))
    assert (one.scores == two.scores).all() and one.thresholds == two.thresholds


def test_one_language():
    model = fit(["some words here", "and a few more"] * 10, ["en"] * 20)
    assert model.languages == ("en",)


@pytest.mark.parametrize("left_out", ["de", "en", "es"])
def test_a_language_left_out_is_rejected(spark, left_out):
    """Rejected in the texts of a language it never saw, accepted in held-out texts of the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and text is not null")
    model = train(docs.where(~held_out() & (F.col("lang") != left_out)))
    assert left_out not in model.languages
    rows = identify(docs.where((F.col("lang") == left_out) | held_out()).where(F.length("text") > 40), model).collect()
    strange = [r.accepted for r in rows if r.lang == left_out]
    known = [r.accepted for r in rows if r.lang != left_out]
    assert len(strange) > 50 and sum(strange) / len(strange) < 0.15
    assert sum(known) / len(known) > 0.97


def test_scores_are_means_over_subwords(odd):
    """The vectorised scoring against one text at a time."""
    scores = np.random.Generator(np.random.PCG64(2)).normal(size=(1 << 16, 3))
    texts = [r.text for r in odd.collect()] + ["Ünï" * 50, "a", "é b c"]
    means, counted = _score_texts(pa.array(texts).slice(1), scores)
    for text, mean, count in zip(texts[1:], means, counted, strict=True):
        buckets = subword_buckets(text or "")
        assert count == len(buckets)
        assert np.allclose(mean, scores[buckets].mean(axis=0) if len(buckets) else 0)


def test_scoring_takes_little_memory():
    """Of a batch of 6 MB, also with many languages; a text scores the same whatever its neighbours."""
    scores = np.random.Generator(np.random.PCG64(3)).normal(size=(1 << 16, 30)).astype(np.float32)
    texts = [f"text {n} of some words, " * (n % 40 * 7 + 1) for n in range(2000)] + ["Ünd éin länger " * 40_000, "end"]
    batch = pa.array(texts)
    tracemalloc.start()
    means, counted = _score_texts(batch, scores)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 60e6
    for at in [*range(0, len(texts), 97), len(texts) - 2, len(texts) - 1]:
        buckets = subword_buckets(texts[at])
        assert counted[at] == len(buckets) and np.allclose(means[at], scores[buckets].mean(axis=0, dtype=float))
        assert (means[at] == _score_texts(batch.slice(at, 1), scores)[0]).all()


def test_the_sample_is_bounded_by_texts(spark):
    """One id in all rows, and one text in most."""
    rows = [(None, f"text number {n} {'abc' * (n % 7)} words", "en") for n in range(300)]
    rows += [(None, "one text again and again", "en")] * 3000 + [(7, "ein deutscher Text mit Worten", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    import tidemark.llm.language_id as module

    def spy(snippets, labels, held, rejected):
        seen.append(len(set(snippets)))
        return fit(snippets, labels, held, rejected)

    before, module.fit = module.fit, spy
    try:
        model = train(df, sample_docs=50)
    finally:
        module.fit = before
    assert model.languages == ("de", "en") and len(model.thresholds) == len(LENGTHS)
    assert seen[0] <= 4 * 2 * 50


def test_thresholds_by_length(model):
    assert all(0.3 < value <= 1 for value in model.thresholds)
    assert list(model.least(np.array([0, 10, 100000]))) == [model.thresholds[0], model.thresholds[0], model.thresholds[-1]]
