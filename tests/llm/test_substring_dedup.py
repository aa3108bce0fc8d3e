from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.substring_dedup import _cut, remove_repeats, repeated_suffixes


def left(rows, window):
    """Brute force over (id, text): id, words, removed words, kept text."""
    split = [(key, (text or "").encode().split()) for key, text in rows]
    seen = Counter(tuple(w[at : at + window]) for _, w in split for at in range(len(w) - window + 1))
    found = []
    for key, words in split:
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if seen[tuple(words[at : at + window])] > 1:
                gone[at : at + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        found.append((key, len(words), sum(gone), kept))
    return sorted(found, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"group_rows": 1}, {"window": 10, "anchor": 3}, {"window": 6, "anchor": 6}])
def test_documents(docs, texts, options):
    assert result(remove_repeats(docs, **options)) == left(texts.items(), options.get("window", 35))


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = remove_repeats(odd, window=8, anchor=3)
    assert result(found) == left(rows, 8)
    assert found.columns == ["doc_id", "kept_text", "n_words", "n_removed", "lang", "source", "n_chars", "kept", "_text", "size"]
    assert {r._text for r in found.collect()} == {"mine"}


def test_text_ids(odd):
    found = remove_repeats(odd.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))), window=8, anchor=3)
    rows = [(None if r.doc_id is None else f"d{r.doc_id}", r.text) for r in odd.collect()]
    assert result(found) == left(rows, 8)


def test_empty_table(none):
    assert remove_repeats(none).count() == 0


@given(st.lists(st.lists(st.integers(0, 2), min_size=4, max_size=12), min_size=1, max_size=5), st.data())
def test_tree_nodes_are_the_repeats(stretches, data):
    groups = data.draw(st.lists(st.integers(0, 1), min_size=len(stretches), max_size=len(stretches)))
    first = np.concatenate([[0], np.cumsum([len(s) for s in stretches])])
    words = np.array([w for s in stretches for w in s], dtype=np.int64)
    owner, offset = repeated_suffixes(np.array(groups), words, first, 4)
    seen = Counter((g, tuple(s[at : at + 4])) for g, s in zip(groups, stretches, strict=True) for at in range(len(s) - 3))
    expected = {
        (i, at)
        for i, s in enumerate(stretches)
        for at in range(len(s) - 3)
        if seen[groups[i], tuple(s[at : at + 4])] > 1
    }
    assert set(zip(owner, offset, strict=True)) == expected


@pytest.mark.parametrize("copies", [2, 3])
@pytest.mark.parametrize("group_rows", [1, 20_000])
def test_whole_rows_repeated(spark, copies, group_rows):
    passage = " ".join(f"p{n}" for n in range(10))
    repeated = (1, " ".join(f"a{n}" for n in range(9)) + f" {passage} and the end of it")
    rows = [*[repeated] * copies, (2, f"another start {passage}"), (None, f"{passage} clean words after it")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(remove_repeats(df, window=8, anchor=3, group_rows=group_rows)) == left(rows, 8)


def test_many_copies_of_a_row(spark):
    """Rows repeated as a whole take no more than their own marks, whatever their number."""
    text = " ".join(f"w{n}" for n in range(600))
    rows = [(None, text)] * 10_000 + [(1, text + " and an end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = remove_repeats(df).groupBy("doc_id", "n_words", "n_removed", "kept_text").count().collect()
    assert {tuple(r) for r in found} == {(None, 600, 600, "", 10_000), (1, 603, 600, "and an end", 1)}


def test_columns_that_differ_in_case_only(spark):
    df = spark.createDataFrame([(1, "some words", "x", 2)], "doc_id long, text string, `_` string, N_WORDS int")
    (row,) = remove_repeats(df).collect()
    assert row.asDict() == {"doc_id": 1, "kept_text": "some words", "n_words": 2, "n_removed": 0, "_": "x"}


def test_the_rest_keeps_its_spaces(spark):
    shared = " ".join(f"s{n}" for n in range(40))
    texts = [f"\n a  b\n{shared}\n\nc\td ", f"{shared}\n e\n", f"f  {shared}", shared, " x \n y ", None, " \t"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.kept_text for r in remove_repeats(df, spaces=True).collect()}
    assert found == {0: "\n a  b\n\nc\td ", 1: "e\n", 2: "f", 3: "", 4: " x \n y ", 5: "", 6: " \t"}
    plain = {r.doc_id: r.kept_text for r in remove_repeats(df).collect()}
    assert {key: " ".join(text.split()) for key, text in found.items()} == plain


@pytest.mark.parametrize("spaces", [True, False])
def test_texts_leave_in_small_batches(spaces):
    """A worker does not hold the texts of a whole batch once more."""
    texts = [None, "", *(f"{n} text of words " * 100 for n in range(4000)), "x " * 1_000_000, "end"]
    starts = pa.array([[2, 4] if n == 7 else None for n in range(len(texts))], pa.list_(pa.int32()))
    marks = pa.array([[1, 1] if n == 7 else None for n in range(len(texts))], pa.list_(pa.int64()))
    columns = [pa.array(range(len(texts))), pa.array([{"a": n} for n in range(len(texts))]), pa.array(texts), starts, marks]
    batch = pa.RecordBatch.from_arrays(columns, names=["_id", "_rest", "_text", "starts", "marks"])
    parts = list(_cut(3, spaces)(iter([batch])))
    assert max(part.nbytes for part in parts) < 4e6
    rows = [row for part in parts for row in part.to_pylist()]
    assert [(r["_id"], r["_rest"]["a"]) for r in rows] == [(n, n) for n in range(len(texts))]
    split = [(text or "").split() for text in texts]
    split[7] = split[7][:2] + split[7][7:]
    assert [r["kept_text"].split() for r in rows] == split
    assert [r["n_removed"] for r in rows] == [5 if n == 7 else 0 for n in range(len(texts))]
