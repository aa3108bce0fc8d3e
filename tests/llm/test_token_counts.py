import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.packing import encoder, vocabulary_path
from tidemark.llm.queries import sample_edits
from tidemark.llm.token_counts import CountedText, SegmentTree, count_tokens, cuts

PIECE = st.lists(st.sampled_from([*"ab  'st1.\né漢²_。」", "<|endoftext|>"]), max_size=40).map("".join)
EDIT = st.tuples(st.integers(-2, 200), st.integers(-1, 60), PIECE)


def count(text):
    return len(encoder(vocabulary_path()).encode(text, allowed_special="all"))


@pytest.fixture(scope="module")
def tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return tokenizer


@settings(deadline=None)
@given(st.lists(PIECE, max_size=5), st.lists(EDIT, max_size=5), st.integers(1, 20))
def test_edits(pieces, edits, leaf_chars):
    text = "".join(pieces)
    found = CountedText(text, count, leaf_chars)
    assert found.tree.total == count(text)
    for start, removed, replacement in edits:
        start = min(max(start, 0), len(text))
        found.edit(start, removed, replacement)
        text = text[:start] + replacement + text[min(start + max(removed, 0), len(text)) :]
        assert found.text == text
        assert found.tree.total == count(text)
        assert found.tree.chars[1] == len(text)
    again = CountedText(text, count, leaf_chars, found.sizes())
    assert again.tree.total == count(text) and again.encoded == 0


@given(PIECE, st.integers(1, 10))
def test_cuts_join_up(text, leaf_chars):
    assert "".join(cuts(text, leaf_chars)) == text
    assert sum(map(count, cuts(text, leaf_chars))) == count(text)


def test_tree_finds_leaves():
    tree = SegmentTree([3, 0, 2, 4], [1, 0, 1, 2])
    assert [tree.at(place) for place in range(10)] == [(0, 0)] * 3 + [(2, 3)] * 2 + [(3, 5)] * 5


def test_documents(docs, texts, tokenizer):
    edited = docs.withColumn("edits", sample_edits())
    edits = {r.doc_id: r.edits for r in edited.collect()}
    rows = count_tokens(edited, edits_col="edits").collect()
    for r in rows:
        text = texts[r.doc_id]
        assert r.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)
        for e in edits[r.doc_id]:
            text = text[: e.start] + e.replacement + text[e.start + e.removed :]
        assert r.edited == text and r.n_edits == 3
        assert r.n_tokens_edited == len(tokenizer.encode(text, add_special_tokens=False).ids)
    long = [r for r in rows if len(r.edited) > 10_000]
    assert long and all(r.chars_encoded < len(r.edited) / 2 for r in long)


def test_stored_trees_are_brought_up_to_date(docs):
    first = count_tokens(docs.withColumn("edits", sample_edits()), edits_col="edits")
    kept = first.select("doc_id", "edited", "leaf_chars", "leaf_tokens", "n_tokens_edited")
    later = kept.withColumn("edits", sample_edits("doc_id", "edited"))
    again = count_tokens(later, text_col="edited", edits_col="edits", sizes=("leaf_chars", "leaf_tokens"))
    fresh = count_tokens(later, text_col="edited", edits_col="edits")
    pick = lambda df: sorted((r.doc_id, r.n_tokens, r.n_tokens_edited) for r in df.collect())
    assert pick(again) == pick(fresh)


def test_odd_rows(odd, none):
    rows = count_tokens(odd).collect()
    assert len(rows) == odd.count()
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {0}
    assert all(r.n_tokens == r.n_tokens_edited == sum(r.leaf_tokens) for r in rows)
    assert count_tokens(none).count() == 0


def test_leaves_stay_small():
    """Insertions are cut into leaves of their own, also in texts without spaces."""
    words, marks = "many words stand here and there ", "这是一个句子，没有空格。"
    for piece in (words, marks):
        found = CountedText(piece * 100, count, 64)
        text = found.text
        for at in (0, 500, 100, 2000):
            found.edit(at, 7, piece * 200)
            text = text[:at] + piece * 200 + text[at + 7 :]
        assert found.text == text and found.tree.total == count(text) and found.tree.chars[1] == len(text)
        chars, tokens = found.sizes()
        assert max(chars) <= 64 + 2 * len(piece) and sum(tokens) == count(text) and len(chars) > len(text) // 100
        found.encoded = 0
        found.edit(len(text) // 2, 1, "x")
        assert found.encoded < 200


def test_without_details(odd):
    plain = count_tokens(odd, details=False)
    assert plain.columns == ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "chars_encoded"]
    assert sorted((r.n_tokens for r in plain.collect())) == sorted(r.n_tokens for r in count_tokens(odd).collect())
