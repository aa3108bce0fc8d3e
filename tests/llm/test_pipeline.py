from collections import Counter

import pytest

import corpus_pipeline
from corpus_pipeline import COLUMNS, STAGES
from tidemark.llm.packing import END, encoder, vocabulary_path
from test_ngram_join import expected
from test_substring_dedup import left


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages(spark, sf_dir, docs):
    stages, now = dict(STAGES), docs
    known = stages["language_id"](spark, now, sf_dir).cache()
    assert known.columns == list(COLUMNS)
    assert known.count() >= 0.99 * docs.count()

    alone = stages["ngram_jaccard_join"](spark, known, sf_dir).cache()
    groups = {key: group for key, *_, group in expected(pairs(known))}
    assert {r.doc_id for r in alone.collect()} == set(groups.values())

    cleaned = stages["substring_dedup"](spark, alone, sf_dir).cache()
    wanted = [(key, text) for key, words, gone, text in left(pairs(alone), 35) if words > gone]
    assert sorted(((r.doc_id, " ".join(r.text.split())) for r in cleaned.collect()), key=repr) == sorted(wanted, key=repr)
    whole = {key: words == " ".join((text or "").split()) for key, words in wanted for at, text in pairs(alone) if at == key}
    before = dict(pairs(alone))
    assert any(whole.values()) and all(r.text == before[r.doc_id] for r in cleaned.collect() if whole[r.doc_id])
    assert all(r.n_chars == len(r.text) for r in cleaned.collect())

    mix = stages["source_mixing"](spark, cleaned, sf_dir).cache()
    assert mix.columns == list(COLUMNS)
    assert set(pairs(mix)) <= set(pairs(cleaned))
    assert max(Counter(r.doc_id for r in mix.collect()).values()) <= 3

    packed = stages["best_fit_packing"](spark, mix, sf_dir).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mix.collect())


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert rows and max(used.values()) <= 2048


@pytest.mark.parametrize("name", [name for name, _ in STAGES])
def test_odd_rows(spark, sf_dir, odd, name):
    found = dict(STAGES)[name](spark, odd, sf_dir)
    assert found.count() > 0


@pytest.mark.parametrize("name", [name for name, _ in STAGES])
def test_empty_table(spark, sf_dir, none, name):
    assert dict(STAGES)[name](spark, none, sf_dir).count() == 0


def test_packed_tokens_are_the_texts(spark, sf_dir, odd):
    found = {}
    for r in dict(STAGES)["best_fit_packing"](spark, odd.dropDuplicates(["doc_id"]), sf_dir).collect():
        assert len(r.ids) == r.length
        found.setdefault(r.doc_id, {})[r.piece] = r.ids
    texts = {r.doc_id: r.text or "" for r in odd.dropDuplicates(["doc_id"]).collect()}
    tokens = {key: [token for _, ids in sorted(pieces.items()) for token in ids] for key, pieces in found.items()}
    decode = encoder(vocabulary_path()).decode
    assert {key: decode(ids[:-1]) for key, ids in tokens.items()} == texts
    assert {ids[-1] for ids in tokens.values()} == {END}
