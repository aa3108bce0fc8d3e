"""Quality rules under weak supervision.

Each rule votes good or bad, or abstains. Expectation-maximisation over the
votes of all documents estimates how often the rule votes right on good and on
bad documents, and how many documents are good; the posterior probability of
being good replaces a filter that all rules must pass. Votes are counted by
pattern where they lie, and there are at most three to the number of rules
patterns, so the estimation has the same size for any corpus.

A base filter stands before the verdict: texts of fewer than 20 words, or with
over 30 % of their words in 8-word windows found twice or more, are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import ID, REST, TEXT, TEXT_HASH, identified, other_columns, same_row, stored
from tidemark.llm.words import Block, blocks, mix, shingle_hashes

LEAST_WORDS = 20
MOST_REPEATED = 30
REPEAT_WINDOW = 8
ROUNDS = 100
KEPT = 0.5

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "a an and are as at be by for from has have he her his i in is it not of on or she that the their they this "
    "to was we were what which who will with you "
    "auch auf aus bei das dass dem den der des die ein eine einen einer er es für hat ich im ist mit nicht noch "
    "sich sie sind so über um und von vor war wie wird zu zum zur "
    "au aux avec ce cette dans de des du elle en est et être il ils je la le les leur mais ne nous on ou par pas "
    "plus pour que qui sa se ses son sont sur un une vous "
    "al como con cuando del el ella en entre era es esta está este fue ha hay la las lo los más me mi muy no para "
    "pero por que se si sin sobre su sus también te un una y ya"
)

_COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_letters long, n_common long"
)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LETTER = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))


def repeated_words(block: Block, window: int) -> np.ndarray:
    """For each text, its words in windows that occur twice or more in it."""
    values, owner = shingle_hashes(block, window)
    counts = np.diff(block.first)
    whole = (counts >= window)[owner]
    values, owner = values[whole], owner[whole]
    if not len(values):
        return np.zeros(len(counts), dtype=np.int64)
    windows = np.where(counts >= window, counts - window + 1, 0)
    starts = block.first[owner] + np.arange(len(owner)) - (np.cumsum(windows) - windows)[owner]
    keyed = mix(values ^ mix(owner.astype(np.uint64)))
    order = np.argsort(keyed)
    same = keyed[order][1:] == keyed[order][:-1]
    twice = np.zeros(len(values), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(block.hashes) + 1, dtype=np.int64)
    edge[starts[twice]] += 1
    edge[starts[twice] + window] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[block.first[1:]] - covered[block.first[:-1]]


def _line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines), len(lines) - len(set(lines))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from tidemark.llm.words import _utf8

    common = np.concatenate([block.hashes for block in blocks(pa.array([COMMON_WORDS]))])
    for batch in batches:
        for block in blocks(batch.column(TEXT)):
            rows = slice(block.rows.start, block.rows.stop)
            data, offsets = _utf8(batch.column(TEXT).slice(block.rows.start, len(block.rows)))
            data, bounds = data[offsets[0] : offsets[-1]], offsets - offsets[0]

            def summed(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(flags)])
                return total[bounds[1:]] - total[bounds[:-1]]

            lines = [_line_counts(data[a:b].tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
            counts = [
                np.diff(block.first),
                summed(~_SPACE[data] & ((data & 0xC0) != 0x80), bounds),
                summed(_SYMBOL[data], bounds),
                np.array([twice for _, twice in lines], dtype=np.int64),
                repeated_words(block, REPEAT_WINDOW),
                np.array([all_ for all_, _ in lines], dtype=np.int64),
                summed(_UPPER[data], bounds),
                summed(_LETTER[data], bounds),
                summed(np.isin(block.hashes, common), block.first),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(ID)[rows],
                    batch.column(TEXT_HASH)[rows],
                    *(pa.array(np.asarray(count).astype(np.int64)) for count in counts),
                ],
                names=[ID, TEXT_HASH, *(part.split()[0] for part in _COUNTS.split(", "))],
            )


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """-1 for bad, 1 for good, 0 to abstain, from the counts of a document."""
    words = F.greatest("n_words", F.lit(1))
    mean = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    doubled = F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))
    repeated = F.col("n_repeat_words") / words
    upper = F.col("n_upper") / F.greatest("n_letters", F.lit(1))
    common = F.col("n_common") / words
    enough = F.col("n_words") >= 50
    return {
        "length": _vote(F.col("n_words") < LEAST_WORDS, F.col("n_words") >= 40),
        "word_length": _vote((mean < 2) | (mean > 16), (mean >= 3) & (mean <= 12)),
        "symbols": _vote(symbols > 0.1, symbols <= 0.02),
        "lines": _vote(doubled > 0.3, doubled <= 0.05),
        "repeats": _vote(repeated > MOST_REPEATED / 100, repeated <= 0.05),
        "capitals": _vote(upper > 0.4, upper <= 0.15),
        "function_words": _vote(enough & (common < 0.01), common >= 0.05),
    }


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior probability of being good for each pattern of votes.

    The model: a share of documents is good; each rule that votes does so
    independently, right with one probability on good documents and another on
    bad ones. It starts from one bad vote being a likely sign of a bad document,
    and pseudo-counts keep rules that seldom vote from certainty.
    """
    if not len(votes):
        return np.zeros(0)
    good, bad = votes == 1, votes == -1
    posterior = np.where(bad.any(axis=1), 0.2, 0.98)
    for _ in range(rounds):
        weight = counts * posterior
        other = counts * (1 - posterior)
        prior = (weight.sum() + 9) / (counts.sum() + 10)
        right = (weight @ good + 19) / (weight @ (good | bad) + 20)
        found = (other @ bad + 1) / (other @ (good | bad) + 4)
        right, found = np.clip(right, 0.6, 1 - 1e-4), np.clip(found, 0.02, 1 - 1e-4)
        odds = (
            np.log(prior / (1 - prior))
            + good @ (np.log(right) - np.log(1 - found))
            + bad @ (np.log(1 - right) - np.log(found))
        )
        posterior = 1 / (1 + np.exp(-odds))
    return posterior


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: float = KEPT) -> DataFrame:
    """All columns, with the counts, ``base_failed``, ``quality`` and ``kept``.

    Null texts have no words and fail the base filter, as empty ones do. Rows
    equal in id and text get equal verdicts. Columns of the names above are
    replaced.
    """
    return _judged(docs, id_col, text_col, kept, with_row=True)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: float = KEPT) -> DataFrame:
    """As ``judge``, with the id in place of all other columns; no text is moved."""
    return _judged(docs, id_col, text_col, kept, with_row=False)


def _judged(docs: DataFrame, id_col: str, text_col: str, kept: float, with_row: bool) -> DataFrame:
    rows = identified(docs, id_col, text_col)
    counted = stored(
        rows.select(ID, TEXT_HASH, TEXT).mapInArrow(
            _count, f"{ID} {rows.schema[ID].dataType.simpleString()}, {TEXT_HASH} long, {_COUNTS}"
        ),
        "counts",
    )
    names = list(rules())
    voted = counted.withColumns(rules())
    patterns = voted.groupBy(*names).count().collect()
    votes = np.array([[row[name] for name in names] for row in patterns], dtype=np.int64).reshape(-1, len(names))
    posterior = estimate(votes, np.array([row["count"] for row in patterns], dtype=np.float64))
    code = sum((F.col(name) + 1) * 3**at for at, name in enumerate(names))
    codes = ((votes + 1) * 3 ** np.arange(len(names))).sum(axis=1)
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, posterior, strict=True)], "code int, quality double"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    # at most 3 ** rules rows, 2,187 of 12 bytes
    found = (
        voted.withColumn("code", code)
        .join(F.broadcast(table), "code")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= kept))
        .drop("code", *names)
    )
    own = [name for name in found.columns if name not in (ID, TEXT_HASH)]
    if not with_row:
        return found.select(F.col(ID).alias(id_col), *own)
    found = found.dropDuplicates([ID, TEXT_HASH])
    joined = rows.join(found, same_row(rows, found)).drop(found[ID]).drop(found[TEXT_HASH])
    return joined.select(
        F.col(ID).alias(id_col),
        F.col(TEXT).alias(text_col),
        *own,
        *other_columns(joined, {id_col, text_col, *own}),
    )
