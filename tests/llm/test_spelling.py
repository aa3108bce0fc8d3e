import re
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.spelling import (
    affected,
    decompose,
    dictionary,
    near_pairs,
    near_words,
    tokens,
    variants,
    vocabulary,
)


def counted(rows):
    """Words of texts and their counts, run by run."""
    n = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {word: count for word, count in n.items() if len(word) >= 5 and count >= 3}


def shorter(word):
    return {word[:at] + word[at + 1 :] for at in range(len(word))}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and a in shorter(b)


def neighbours(words):
    """Near words by what is left when one character is taken out."""
    left, found = {}, {word: set() for word in words}
    for word in words:
        for at in range(len(word)):
            left.setdefault((at, word[:at] + word[at + 1 :]), []).append(word)
    for same in left.values():
        for a, b in combinations(same, 2):
            found[a].add(b)
            found[b].add(a)
    for word in words:
        for less in shorter(word) & set(words):
            found[word].add(less)
            found[less].add(word)
    return found


def expected(n):
    """word: form, root, n, n_near, form_n."""
    around = neighbours(list(n))
    form = {}
    for word, others in around.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    found = {}
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        found[word] = (form[word], root, n[word], len(around[word]), n.get(form[word]))
    return found


def result(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("options", [{}, {"list_words": 3, "most_grams": 500}, {"low": 2, "high": 6, "most_grams": 2000}])
def test_documents(docs, texts, options):
    n = counted(texts.items())
    assert result(variants(docs, **options)) == expected(n)


def test_neighbours_by_definition():
    words = ["abcde", "abcdef", "abxde", "bcdef", "aabcde", "zzzzz", "zzzzé"]
    found = neighbours(words)
    assert {(a, b) for a in words for b in found[a]} == {(a, b) for a in words for b in words if near(a, b)}


def test_odd_rows(odd, spark):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(variants(odd)) == expected(counted(rows))
    extra = [
        (None, "École école ÉCOLE École école Ècole Ècole Ècole" * 2),
        (5, "STRASSE straße Straße straße × ×÷×÷× ×÷×÷× ×÷×÷× naïveté naivete naivete naivete"),
        (6, "x" * 3000 + " " + ("x" * 3000 + " ") * 3 + ("x" * 2999 + " ") * 8),
        (7, " ".join(["houses"] * 3 + ["houseS"] * 3 + ["house"] * 20 + ["hause"] * 3 + ["mouse"] * 200)),
    ]
    df = spark.createDataFrame(extra, "doc_id long, text string").withColumns({"word": F.lit("a"), "n": F.lit(1)})
    assert result(variants(df)) == expected(counted(extra))


def test_no_words(none, spark):
    assert variants(none).count() == 0
    assert variants(spark.createDataFrame([(1, "a 1 b 2"), (2, None)], "doc_id long, text string")).count() == 0


def test_alike_words_in_lists_dealt_out(spark):
    """All words of two letters: every list is hot, and every word has many near words."""
    random = np.random.Generator(np.random.PCG64(5))
    words = ["".join(w) for size in (5, 6, 7) for w in product("ab", repeat=size)]
    n = {word: int(count) for word, count in zip(words, random.integers(3, 40, len(words)), strict=True)}
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    wanted = {word: (f[3], f[0]) for word, f in expected(n).items()}
    for options in ({}, {"list_words": 16}, {"most_grams": 8}, {"high": 3, "most_grams": 50}):
        found = {r.word: (r.n_near, r.best) for r in near_words(df, **options).collect()}
        assert {word: near for word, (near, _) in found.items()} == {w: k for w, (k, _) in wanted.items() if k}
        for word, (_, best) in found.items():
            assert best.n == max(n[o] for o in neighbours(words)[word])
            if best.n >= 2 * n[word]:
                assert best.word == wanted[word][1]


def test_affected_bounds_hold(spark):
    """One edit never takes more grams away than the bound, and near words share an indexed gram."""
    random = np.random.Generator(np.random.PCG64(9))
    words = ["".join(random.choice(list("abc"), int(size))) for size in random.integers(5, 12, 400)]
    for low, high, least in ((2, 4, 20), (2, 3, 5), (2, 6, 10), (3, 5, 10)):
        grams = Counter()
        for word in words:
            marked = "^" * (high - 2) + word + "$" * (high - 2)
            grams.update(marked[at : at + size] for size in range(low, high + 1) for at in range(len(marked) - size + 1))
        frequent = {gram: count for gram, count in grams.items() if count > least}
        for word in words[:150]:
            mine, ends = decompose(word, frequent, low, high)
            bound = affected(ends, len(word), high)
            edits = shorter(word) | {
                word[:at] + c + word[at + gone :] for at in range(len(word) + 1) for c in "abcd" for gone in (0, 1)
            }
            for other in edits - {word}:
                if len(other) < 5:
                    continue
                shared = set(mine) & set(decompose(other, frequent, low, high)[0])
                assert len(shared) >= max(len(set(mine)) - bound, 1)
                assert set(tokens(word, frequent, low, high)) & set(tokens(other, frequent, low, high))


def test_dictionary_is_bounded(spark):
    df = spark.createDataFrame([(f"word{n}x{n % 7}y",) for n in range(500)], "word string")
    for most in (5, 50, 5000):
        assert len(dictionary(df, 2, 4, most)) <= most


def test_pairs_of_lists():
    words = [b"abcde", b"abcdf", b"abcd", b"xbcde", b"abcde", b"abcdef"]
    lists, part = np.array([1, 1, 1, 1, 2, 2]), np.array([0, 0, 0, 1, 0, 0])

    def found(across):
        return {tuple(sorted(p)) for x, y in near_pairs(words, lists, part, across, 2) for p in zip(x, y, strict=True)}

    assert found(np.zeros(6, bool)) == {(0, 1), (0, 2), (0, 3), (1, 2), (4, 5)}
    assert found(np.array([True] * 4 + [False] * 2)) == {(0, 3), (4, 5)}


def test_repeated_rows_and_text_ids(spark):
    rows = [("a", "color colour colour"), ("a", "color colour colour"), ("b", "colour Color COLOR")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert result(variants(df)) == expected(counted(rows))
    assert {r.word: r.n for r in vocabulary(df).collect()} == {"color": 4, "colour": 5}
