"""What each filter of a chain removes, in every order the filters could run in.

Whether a text fails a filter does not depend on the others, so a corpus comes
down to counts by the set of filters that a text fails: 32 sets at most for five
filters, in each part. The worth of a coalition of filters is the number of
documents that fail any of them. From the worths of the 32 coalitions come

* the steps of any order: what a filter removes after others is the worth of the
  coalition with it less that without it;
* the Hart-Mas-Colell potential of every coalition, by recursion over its
  members: P(S) = (worth(S) + sum of P(S without i)) / |S|. The Shapley value of a
  filter is the potential of all filters less that of all but this one.

Potentials are kept as whole numbers, |S|! times P(S), so nothing is rounded.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import quoted, spread_join, stored
from tidemark.names import whole_key

FILTERS = "ABCDE"
#: Least words, least percentage of distinct words, greatest percentage of capitals.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
_ALL = (1 << len(FILTERS)) - 1
_ROWS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    n_chars = F.length(text).cast("long")
    capitals = n_chars - F.length(F.regexp_replace(text, "[A-Z]", ""))
    failed = [
        n_words < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n_words,
        100 * capitals > MOST_CAPITALS * n_chars,
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(fails, 1 << at).otherwise(0) for at, fails in enumerate(failed)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    quality_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """Documents, good ones and toxic ones by ``part`` and ``mask``, the bits of the filters they fail.

    Texts are equal if two 64-bit hashes are. Copies are folded in the map tasks
    before their least id is found, and no text is shuffled.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(
        quoted(id_col).alias("id"),
        F.coalesce(quoted(part_col), F.lit("")).alias("part"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(7), text).alias("h2"),
        text_failures(text).alias("failed"),
    )
    rows = stored(rows, "failures")
    first = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"))
    rows = spread_join(rows, first, ["h1", "h2"])
    repeated = F.coalesce(F.col("l.id") > F.col("first"), F.lit(False))
    marks = (
        labels.where(quoted(id_col).isNotNull())
        .groupBy(quoted(id_col).alias("id"))
        .agg(
            F.max(F.coalesce(quoted(quality_col) == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(quoted(toxic_col) == 1, F.lit(False))).alias("toxic"),
        )
    )
    marked = rows.alias("l").join(marks.alias("r"), whole_key(["id"], "l") == whole_key(["id"], "r"), "left")
    return marked.groupBy(
        "part", (F.col("failed") + F.when(repeated, 1 << FILTERS.index("E")).otherwise(0)).alias("mask")
    ).agg(
        F.count("*").alias("documents"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def worths(mask: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each coalition, how much of ``counts`` fails any of its filters."""
    coalitions = np.arange(_ALL + 1)
    return ((coalitions[:, None] & mask[None, :]) != 0).astype(np.int64) @ counts


def potentials(worth: np.ndarray) -> list[int]:
    """|S|! times the Hart-Mas-Colell potential of each coalition S, by number of its bits."""
    found = [0] * len(worth)
    for coalition in range(1, len(worth)):  # smaller coalitions have smaller numbers
        members = [bit for bit in (1 << at for at in range(len(FILTERS))) if coalition & bit]
        found[coalition] = factorial(len(members) - 1) * int(worth[coalition]) + sum(
            found[coalition ^ bit] for bit in members
        )
    return found


def shapley(worth: np.ndarray) -> list[int]:
    """120 times each filter's Shapley value: what it removes, summed over all orders."""
    potential = potentials(worth)
    return [potential[_ALL] - len(FILTERS) * potential[_ALL ^ (1 << at)] for at in range(len(FILTERS))]


def _orders(part: pd.DataFrame) -> pd.DataFrame:
    mask = part["mask"].to_numpy()
    total = int(part["documents"].sum())
    lost, good, toxic = (worths(mask, part[name].to_numpy()) for name in ("documents", "good", "toxic"))
    values = shapley(lost)
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, at in enumerate(order, 1):
            bit = 1 << at
            after = before | bit
            removed = lost[after] - lost[before]
            rows.append(
                (
                    part["part"].iloc[0],
                    "".join(FILTERS[f] for f in order),
                    step,
                    total - lost[after],
                    removed,
                    lost[bit] - removed,
                    lost[_ALL] - lost[_ALL ^ bit],
                    good[after] - good[before],
                    toxic[after] - toxic[before],
                    values[at],
                )
            )
            before = after
    return pd.DataFrame(rows, columns=[field.split()[0] for field in _ROWS.split(", ")])


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row for each part, order of the five filters and step.

    A text fails A with under 100 words, B if under 80 % of its words are
    distinct, C if over 10 % of its characters are A-Z, D if it holds one of
    ``#$%&*|``, and E if a document with a smaller id has the same text. Null
    texts are empty, null parts the empty string. A null id is smaller and
    greater than none, so its row never fails E and has no label. Rows repeated as a
    whole count as often as they are there, and do not fail E for each other.
    Several labels of one document count as one: good or toxic if any says so.
    Other columns play no part; without documents there are no rows.

    ``columns`` names the columns, as in ``failure_counts``. A part's counts are
    at most 32 rows, which one task turns into the part's 600.
    """
    return failure_counts(docs, labels, **columns).groupBy("part").applyInPandas(_orders, _ROWS)
