import hashlib
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidemark.llm.queries import QUERIES
from tidemark.llm.spotsigs import as_text, fingerprints, followers, near_pairs, with_signatures


def test_followers_of_odd_rows(odd):
    found = {(r.id, r.text_hash): (r.next_id, r.next_hash) for r in followers(odd, "doc_id", "text").collect()}
    rows = {(r.doc_id, r.h) for r in odd.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    assert found.keys() == rows
    order = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1]), reverse=True)
    assert found == dict(zip(order, [*order[1:], order[0]], strict=True))


def test_documents(spark, sf_dir, texts):
    rows = QUERIES["op4_document_fingerprints"](spark, sf_dir).collect()
    order = sorted(texts, reverse=True)
    prints = {r.doc_id: {r.fingerprint[at : at + 8] for at in range(0, len(r.fingerprint), 8)} for r in rows}
    by_text, by_print = {}, {}
    for r in rows:
        following = order[(order.index(r.doc_id) + 1) % len(order)]
        text, after = texts[r.doc_id], texts[following]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other = prints[r.doc_id], prints[following]
        assert r.near_next == pytest.approx(len(own & other) / len(own | other))
        new = {r.edited_fingerprint[at : at + 8] for at in range(0, len(r.edited_fingerprint), 8)}
        assert r.near_edited == pytest.approx(len(own & new) / len(own | new))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_print.setdefault(r.fingerprint, text) == text
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint


def test_spots(spark):
    rows = [
        (1, "The council of the town met on Tuesday"),
        (2, "Yesterday the council of the town met. On Tuesday!"),
        (3, None),
        (4, ""),
        (5, "???"),
        (6, "word"),
        (7, "only content words here"),
    ]
    df = with_signatures(spark.createDataFrame(rows, "id int, text string"), "text", "s")
    sets = {r.id: set(r.s) for r in df.collect()}
    assert sets[1] == sets[2] and len(sets[1]) == 4  # the, of, the, on
    assert sets[3] == sets[4] == set() and len(sets[5]) == len(sets[6]) == 1 and len(sets[7]) == 3
    assert {r.t for r in df.where("id in (3, 4)").select(as_text("s").alias("t")).collect()} == {""}


def test_odd_rows(odd):
    found = fingerprints(odd)
    rows = found.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.signatures == sorted(set(r.signatures))


def test_one_document(spark):
    (row,) = fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert (row.edited, row.near_next) == ("abab", 1.0)


def test_empty_table(none):
    assert fingerprints(none).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_near_pairs(spark, docs, threshold):
    prints = with_signatures(docs.select(F.col("doc_id").alias("id"), "text"), "text", "signatures")
    classes = {}
    for r in prints.collect():
        key = tuple(r.signatures)
        classes[key] = min(r.id, classes.get(key, r.id))
    named = [(name, set(key)) for key, name in classes.items() if key]
    expected = {
        (min(a, b), max(a, b))
        for (a, x), (b, y) in combinations(named, 2)
        if len(x & y) >= threshold * len(x | y)
    }
    found = near_pairs(prints.select("id", "signatures"), threshold).collect()
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in found} == expected and len(found) == len(expected)


def test_near_pairs_with_null_and_equal_ids(spark):
    base = list(range(20))
    rows = [(1, base), (1, base[:-1]), (None, base[1:]), (None, list(range(100, 120))), (None, list(range(100, 119))), (2, []), (2, base)]
    found = near_pairs(spark.createDataFrame(rows, "id long, signatures array<int>")).collect()
    assert {frozenset([r.a, r.b]) for r in found} == {frozenset([1]), frozenset([1, None]), frozenset([None])}
    assert sorted(round(r.likeness, 3) for r in found) == [0.9, 0.95, 0.95, 0.95]
    assert len({(r.a_key, r.b_key) for r in found}) == 4 and all(r.a_key < r.b_key for r in found)
