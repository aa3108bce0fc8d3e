from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.filter_audit import FILTERS, audit, potentials, shapley, worths
from tidemark.llm.queries import AUDIT_SQL

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def brute(rows, marks):
    """Every order applied document by document. rows: id, text, lang; marks: id to (good, toxic)."""
    failed = []
    for key, text, lang in rows:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": key is not None
            and any(other is not None and other < key and (t or "") == text for other, t, _ in rows),
        }
        failed.append((lang or "", {f for f in FILTERS if fails[f]}, *marks.get(key, (False, False))))
    found = {}
    for part in {row[0] for row in failed}:
        sums = dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            left = [row for row in failed if row[0] == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone = [row for row in left if f in row[1]]
                left = [row for row in left if f not in row[1]]
                sums[f] += len(gone)
                found[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f in row[1] for row in everything) - len(gone),
                    sum(row[1] == {f} for row in everything),
                    sum(row[2] for row in gone),
                    sum(row[3] for row in gone),
                ]
        for (p, order, step), values in found.items():
            if p == part:
                values.append(sums[order[step - 1]])
    return found


def result(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): [r[name] for name in names] for r in df.collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 1), (2, 0, 1), (4, 0, 1), (10, 1, None), (None, 1, 1), (99, 1, 1), (11, 1, 1)],
        "doc_id long, quality int, toxic int",
    ).withColumns({"part": F.lit("x"), "mask": F.lit(3)})


def test_odd_rows(odd, labels):
    shout = odd.limit(1).select(
        F.lit(20).cast("long").alias("doc_id"), F.lit("LOUD # and | loud").alias("text"), F.lit("en").alias("lang")
    )
    docs = odd.unionByName(shout, allowMissingColumns=True).withColumns({"part": F.lit("p"), "failed": F.lit(1)})
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    marks = {1: (True, False), 2: (True, True), 4: (False, True), 10: (True, False), 99: (True, True), 11: (True, True)}
    assert result(audit(docs, labels)) == brute(rows, marks)


def test_documents_against_sql(docs, sf_dir, spark):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    found = con.execute(AUDIT_SQL)
    names = [d[0] for d in found.description]
    expected = sorted(found.fetchall())
    assert sorted(tuple(r) for r in audit(docs, labels).select(*names).collect()) == expected
    assert len(expected) == 600 * docs.select("lang").distinct().count()


def test_no_rows(none, labels):
    assert audit(none, labels).count() == 0


def test_no_labels(odd, labels):
    assert {(r.good_lost, r.toxic_lost) for r in audit(odd, labels.where("false")).collect()} == {(0, 0)}


def test_shapley_is_the_mean_of_the_orders():
    random = np.random.Generator(np.random.PCG64(3))
    worth = worths(np.arange(32), random.integers(0, 50, 32))
    sums = [0] * 5
    for order in permutations(range(5)):
        before = 0
        for at in order:
            sums[at] += worth[before | 1 << at] - worth[before]
            before |= 1 << at
    assert shapley(worth) == sums
    assert sum(sums) == 120 * worth[31] and potentials(worth)[1] == worth[1]
