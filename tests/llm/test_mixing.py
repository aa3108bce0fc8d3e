from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.mixing import mix, mixed_rows, source_targets


def targets(sizes):
    """Iterated: share by weight, cap, reshare the excess."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[at % 3] for at, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def check(df, options):
    rows = mix(df, **options).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == len((r.text or "").encode().split())
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    goal = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
    for source in sizes:
        assert abs(taken[source] - goal[source]) <= 3
    return rows


@pytest.mark.parametrize("range_docs", [20_000, 10, 1])
def test_documents(docs, range_docs):
    check(docs, {"range_docs": range_docs})


def test_odd_rows(odd):
    found = mix(odd)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "_text", "size", "source_size", "target", "taken"]
    assert len(check(odd, {})) == odd.count()
    assert check(odd, {"range_docs": 1})


def test_same_mix_on_every_run(docs):
    rows = lambda df: sorted((r.doc_id, r.taken) for r in mix(df).collect())
    assert rows(docs) == rows(docs.repartition(5, "n_chars"))


def test_rows_of_the_mix(docs):
    taken = {r.doc_id: r.taken / r.size for r in mix(docs).collect() if r.size}
    found = mixed_rows(docs)
    copies = Counter(r.doc_id for r in found.collect())
    assert found.columns == docs.columns
    assert all(abs(copies[key] - share) <= 0.5 for key, share in taken.items())


def test_empty_table(none):
    assert mix(none).count() == 0 and mixed_rows(none).count() == 0


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.none() | st.sampled_from("abcdefé"), st.integers(0, 50), max_size=6))
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(df).collect()}
    expected = targets(sizes)
    assert found.keys() == expected.keys()
    assert all(found[s] == pytest.approx(expected[s]) for s in expected)


def test_targets_of_sources_alike(spark):
    """Equal caps and weights: the level is that of the first of them."""
    df = spark.createDataFrame([(None, 1), ("a", 1), ("b", 0), ("c", 0)], "source string, source_size long")
    found = {r.source: r.target for r in source_targets(df).collect()}
    assert found == pytest.approx({"a": 1.0, "b": 0.0, "c": 0.0, None: 1.0})
