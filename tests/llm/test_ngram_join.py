from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.ngram_join import leaders, matched_depth, near_duplicates, one_of_each_group


def shingles(text):
    words = (text or "").encode().split()
    return {tuple(words[at : at + 5]) for at in range(max(len(words) - 4, min(len(words), 1)))}


def expected(rows, threshold=0.8):
    """Brute force: id, class, copies, links, group."""
    by_text = {}
    for key, text in rows:
        by_text.setdefault(text, []).append(key)
    order = list(by_text)
    sets = [shingles(text) for text in order]
    root, links = list(range(len(order))), [0] * len(order)

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for a, b in combinations(range(len(order)), 2):
        if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) > 0:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)

    def least(keys):
        return min((key for key in keys if key is not None), default=None)

    found = []
    for at, text in enumerate(order):
        group = [key for b, other in enumerate(order) if find(b) == find(at) for key in by_text[other]]
        found += [
            (key, least(by_text[text]), len(by_text[text]), links[at], least(group)) for key in by_text[text]
        ]
    return sorted(found, key=repr)


def result(df):
    return sorted(((r.doc_id, r.class_id, r.n_copies, r.n_links, r.group_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"node_texts": 2, "block_texts": 2, "block_shingles": 300}])
def test_documents(docs, texts, options):
    assert result(near_duplicates(docs, **options)) == expected(texts.items())


def test_odd_rows(odd):
    assert result(near_duplicates(odd)) == expected([(r.doc_id, r.text) for r in odd.collect()])


def test_one_of_each_group(odd):
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(set(rows))
    groups = {row[4] for row in expected([(r.doc_id, r.text) for r in odd.collect()])}
    assert {key for key, _ in rows} == groups


def test_text_ids(odd):
    named = odd.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 2, "0")))
    rows = [(None if r.doc_id is None else f"d{r.doc_id:02d}", r.text) for r in odd.collect()]
    assert result(near_duplicates(named)) == expected(rows)
    assert one_of_each_group(named).count() == one_of_each_group(odd).count()


def test_empty_table(none):
    assert near_duplicates(none).count() == 0 and one_of_each_group(none).count() == 0


def test_a_large_group_of_near_copies(spark):
    base = [f"w{n}" for n in range(60)]
    rows = [(n, " ".join([*base[: n % 50], f"x{n}", *base[n % 50 + 1 :]])) for n in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, block_texts=64, node_texts=50)) == expected(rows)


def test_prefixes_shorten_until_the_recall():
    assert matched_depth(0.8, 32, 8, 0.9) > matched_depth(0.8, 32, 8, 0.9999) >= 1
    for recall in (0.9, 0.99, 0.9999):
        depth = matched_depth(0.8, 32, 8, recall)
        assert 1 - (1 - 0.8**depth) ** 32 >= recall


def test_every_text_is_tied_or_leads():
    random = np.random.Generator(np.random.PCG64(1))
    signs = random.integers(0, 4, (50, 64)).astype(np.uint8)
    assert {at for leader, tied in leaders(signs) for at in [leader, *tied]} == set(range(50))


def test_components(spark):
    edges = [(1, 2), (3, 2), (4, 5), (9, 8), (8, 7), (7, 6), (6, 10), (11, 11), (5, 4), (12, 1)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    roots = {1: 1, 2: 1, 3: 1, 12: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6}
    assert {r.node: r.root for r in found.collect()} == roots and found.count() == len(roots)


def test_near_duplicates_with_tied_and_null_ids(spark):
    def near(word):
        words = [f"{word}{n}" for n in range(60)]
        return " ".join(words), " ".join([*words[:-1], "changed"])

    (a, a2), (b, b2), (c, c2), (d, d2) = map(near, "abcd")
    rows = [(1, a), (1, a2), (None, b), (None, b2), (None, c), (None, c2), (None, d), (4, d2), (1, "alone"), (4, d2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    groups = [{a, a2}, {b, b2}, {c, c2}, {d, d2}, {"alone"}]
    kept = [(r.doc_id, r.text) for r in one_of_each_group(df).collect()]
    assert [sum(text in group for _, text in kept) for group in groups] == [1] * len(groups) and len(kept) == len(groups)
    assert (4, d2) in kept and set(kept) <= set(rows)
    found = near_duplicates(df)
    assert result(found) == expected(rows)
    keys = {}
    for r in found.collect():
        keys.setdefault(r.group_key, []).append(r.doc_id)
    assert sorted(map(len, keys.values())) == [1, 2, 2, 2, 3]
