import re
from collections import Counter

import numpy as np

from tidemark.llm.quality_rules import estimate, judge, rules, verdicts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    seen = Counter(tuple(words[at : at + 8]) for at in range(len(words) - 7))
    covered = [False] * len(words)
    for at in range(len(words) - 7):
        if seen[tuple(words[at : at + 8])] > 1:
            covered[at : at + 8] = [True] * 8
    repeated = sum(covered)
    failed = len(words) < 20 or 100 * repeated > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed


def test_documents(docs, texts):
    for r in verdicts(docs).collect():
        assert tuple(r[name] for name in COUNTS) == counts(texts[r.doc_id])
        assert not (r.kept and r.base_failed) and 0 <= r.quality <= 1


def test_verdicts_follow_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in verdicts(spark.read.parquet(f"{folder}/documents.parquet")).collect() if r.doc_id in labels]
    good = [r.kept for r in rows if labels[r.doc_id] and not r.base_failed]
    bad = [r.kept for r in rows if not labels[r.doc_id]]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def test_odd_rows(odd):
    found = judge(odd)
    rows = found.collect()
    assert len(rows) == odd.count() and found.columns[:2] == ["doc_id", "text"]
    assert all(tuple(r[name] for name in COUNTS) == counts(r.text) for r in rows)
    assert found.columns.count("kept") == 1 and "size" in found.columns


def test_empty_table(none):
    assert verdicts(none).count() == 0 and judge(none).count() == 0


def test_estimate_finds_the_classes():
    random = np.random.Generator(np.random.PCG64(5))
    good = random.random(20_000) < 0.85
    right = np.array([0.99, 0.97, 0.98, 0.95, 0.99])
    found = np.array([0.4, 0.6, 0.5, 0.7, 0.3])
    chance = random.random((len(good), len(right)))
    votes = np.where(good[:, None], np.where(chance < right, 1, -1), np.where(chance < found, -1, 1))
    votes[random.random(votes.shape) < 0.2] = 0
    patterns, at, number = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior = estimate(patterns, number.astype(float))[at]
    assert ((posterior > 0.5) == good).mean() > 0.95
    assert abs(posterior.mean() - good.mean()) < 0.05


def test_estimate_of_nothing():
    assert len(estimate(np.zeros((0, len(rules())), dtype=int), np.zeros(0))) == 0
