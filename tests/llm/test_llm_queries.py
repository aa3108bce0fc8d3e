"""Every registered query of the subpackage runs over its whole tables."""

import pytest

from tidemark.llm.queries import QUERIES

PAGES = {"op2_html_extraction"}
#: one row for each word, or for each part, order and step
OTHERS = {"op12_filter_audit": ("part", "filter_order", "step"), "op13_spelling_variants": ("word",)}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline", *OTHERS}))
def test_a_row_for_each_row(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    key, table = ("page_id", "pages") if name in PAGES else ("doc_id", "documents")
    ids = {r[key] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()}
    assert {r[key] for r in rows} == ids
    assert len(rows) == len(ids) or name == "op5_best_fit_packing"


@pytest.mark.parametrize("name", sorted(OTHERS))
def test_a_row_for_each_key(spark, sf_dir, name):
    keys = [tuple(r[column] for column in OTHERS[name]) for r in QUERIES[name](spark, sf_dir).collect()]
    assert keys and len(keys) == len(set(keys))


def test_thirteen_operators_and_the_pipeline():
    import corpus_pipeline  # noqa: F401

    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES if name != "pipeline") == list(range(1, 14))
    assert "pipeline" in QUERIES
