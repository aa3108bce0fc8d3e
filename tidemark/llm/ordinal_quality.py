"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document has one latent score, a weighted sum of its features, and its grade
depends on where the score lies among ascending thresholds:
``P(grade <= k) = sigmoid(threshold_k - score)``. All grades share the weights.
Features are the hashed words of the text, in lower case and without marks, each
counted once, and a few shares of its characters and words. The model gives the expected grade and the
probability of each upper tail, by which documents are selected.

It is fitted by stochastic gradient descent with per-weight rates in numpy, on a
bounded sample of different rated texts. A word keeps weight zero unless it is in
``LEAST_DOCS`` of them and their mean grade is ``LEAST_SIGNS`` standard errors from
that of all, so that names and chance add no noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import ID, REST, TEXT, identified, other_columns, quoted
from tidemark.llm.words import Block, _utf8, blocks

BUCKETS = 1 << 18
SAMPLE_ROWS = 30_000
TEXTS_AN_ID = 4
LEAST_DOCS = 8
LEAST_SIGNS = 6.0
EPOCHS = 16
RATE = 1.5
SHRINK = 1e-5
SELECTED = 0.4

#: named shares take the buckets after those of words
SHARES = ("bias", "symbols", "marks", "capitals", "digits", "bars", "distinct", "long", "short")
_BYTES = np.arange(256)
_WITHOUT_MARKS = _BYTES.astype(np.uint8)
_WITHOUT_MARKS[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
_CLASSES = {
    "symbols": np.isin(_BYTES, list(b"#*$%&<>@^~=+_\\/")),
    "marks": np.isin(_BYTES, list(b"!?")),
    "capitals": (_BYTES >= 0x41) & (_BYTES <= 0x5A),
    "digits": (_BYTES >= 0x30) & (_BYTES <= 0x39),
    "bars": np.isin(_BYTES, list(b"|[]{}")),
}


@dataclass(frozen=True)
class Model:
    """Weights by bucket and ascending thresholds, one less than there are grades."""

    grades: tuple[int, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade or better, from the second grade on."""
        return 1 / (1 + np.exp(self.thresholds[None, :] - scores[:, None]))


def _plain(texts: pa.Array) -> pa.Array:
    """Texts in lower case, every mark a space."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    data, offsets = _utf8(lowered)
    return pa.LargeStringArray.from_buffers(
        len(lowered), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_WITHOUT_MARKS[data])
    )


def _features(texts: pa.Array, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket of each different word; and the shares of each text."""
    owner = block.text_of
    bucket = (block.hashes >> np.uint64(46)).astype(np.int64) % BUCKETS
    keyed = np.unique(owner * BUCKETS + bucket)
    owner, bucket = keyed // BUCKETS, keyed % BUCKETS
    data, offsets = _utf8(texts)
    data, bounds = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    words = np.diff(block.first)
    size = np.maximum(np.diff(bounds), 1)
    shares = np.zeros((len(words), len(SHARES)))
    shares[:, 0] = 1
    for at, name in enumerate(SHARES):
        if name in _CLASSES:
            total = np.concatenate([[0], np.cumsum(_CLASSES[name][data])])
            shares[:, at] = np.minimum(10 * (total[bounds[1:]] - total[bounds[:-1]]) / size, 3)
    different = np.bincount(owner, minlength=len(words))
    shares[:, SHARES.index("distinct")] = different / np.sqrt(np.maximum(words, 1)) / 10
    shares[:, SHARES.index("long")] = np.log1p(words) / 10
    shares[:, SHARES.index("short")] = words < 20
    return owner, bucket, shares


def fit(
    samples: list[tuple[int, np.ndarray, np.ndarray]],
    least_docs: int = LEAST_DOCS,
    epochs: int = EPOCHS,
    seed: int = 3,
) -> Model:
    """Fit on (grade, buckets, values) of documents."""
    grades = tuple(sorted({grade for grade, _, _ in samples}))
    weights = np.zeros(BUCKETS + len(SHARES))
    if len(grades) < 2:
        return Model(grades, weights.astype(np.float32), np.zeros(max(len(grades) - 1, 0)))
    random = np.random.Generator(np.random.PCG64(seed))
    seen = np.bincount(np.concatenate([index for _, index, _ in samples]), minlength=len(weights))
    level = np.array([grades.index(grade) for grade, _, _ in samples], dtype=np.float64)
    total = np.zeros(len(weights))
    for (_, index, _), value in zip(samples, level - level.mean(), strict=True):
        total[index] += value
    signs = np.abs(total) / (level.std() * np.sqrt(np.maximum(seen, 1)))
    known = (seen >= least_docs) & (signs >= LEAST_SIGNS)
    known[BUCKETS:] = True
    rows = [(grades.index(grade), index[known[index]], value[known[index]]) for grade, index, value in samples]
    counts = np.bincount([grade for grade, _, _ in rows], minlength=len(grades))
    below = np.cumsum(counts)[:-1] / counts.sum()
    thresholds = np.log(below / (1 - below))
    past, past_thresholds = np.full(len(weights), 1e-6), np.full(len(thresholds), 1.0)
    for _ in range(epochs):
        for at in random.permutation(len(rows)):
            grade, index, value = rows[at]
            cumulative = 1 / (1 + np.exp(weights[index] @ value - thresholds))
            edges = np.concatenate([[0.0], cumulative, [1.0]])
            slope = edges * (1 - edges)
            chance = max(edges[grade + 1] - edges[grade], 1e-9)
            # gradients of minus the log likelihood
            back = (slope[grade + 1] - slope[grade]) / chance
            step = np.zeros(len(thresholds))
            if grade < len(thresholds):
                step[grade] -= slope[grade + 1] / chance
            if grade:
                step[grade - 1] += slope[grade] / chance
            down = back * value + SHRINK * weights[index]
            past[index] += down * down
            weights[index] -= RATE * down / np.sqrt(past[index])
            past_thresholds += step * step
            thresholds = np.maximum.accumulate(thresholds - RATE * step / np.sqrt(past_thresholds))
    return Model(grades, weights.astype(np.float32), thresholds)


def _collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(_plain(batch.column("text"))):
            rows = slice(block.rows.start, block.rows.stop)
            owner, bucket, shares = _features(batch.column("text")[rows], block)
            cuts = np.searchsorted(owner, np.arange(len(block.rows) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("grade")[rows],
                    batch.column("order")[rows],
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(bucket.astype(np.int32))),
                    pa.array(list(shares), pa.list_(pa.float64())),
                ],
                names=["grade", "order", "buckets", "shares"],
            )


def train(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on the ``sample_rows`` rated ids with the least hashes, and ``TEXTS_AN_ID`` texts of each at most.

    Rows without a grade or text are left out; of several grades of one id the
    least counts. The sampled ratings, of that bounded number, are sent to the
    documents; features of the sample alone reach the driver. Texts with the same
    words and grade count once.
    """
    rated = ratings.select(quoted(id_col).alias("id"), quoted(grade_col).cast("int").alias("grade")).where(
        "id is not null and grade is not null"
    )
    order = F.xxhash64("id", F.lit("rated"))
    once = rated.groupBy("id").agg(F.min("grade").alias("grade")).withColumn("order", order)
    # sample_rows rows of 24 bytes
    chosen = F.broadcast(once.orderBy("order", "id").limit(sample_rows))
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).where("text is not null")
    of_id = Window.partitionBy("id").orderBy(F.xxhash64("text"))
    sample = (
        rows.join(chosen, "id")
        .withColumn("place", F.row_number().over(of_id))
        .where(F.col("place") <= TEXTS_AN_ID)
        .select("grade", "order", "text")
    )
    found = sample.mapInArrow(
        _collect_features, "grade int, order long, buckets array<int>, shares array<double>"
    ).toArrow()
    named = np.arange(BUCKETS, BUCKETS + len(SHARES), dtype=np.int32)
    samples = []
    columns = (found.column(name) for name in ("order", "grade", "buckets", "shares"))
    for order, grade, buckets, shares in zip(*columns, strict=True):
        buckets, shares = np.asarray(buckets.values), np.asarray(shares.values)
        index, value = np.concatenate([buckets, named]), np.concatenate([np.ones(len(buckets)), shares])
        samples.append((order.as_py(), buckets.tobytes(), (grade.as_py(), index, value)))
    # the same order on every run, whatever the order of arrival
    samples.sort(key=lambda sample: (*sample[:2], sample[2][0]))
    # copies of a text would make all its words look telling
    unique = {(words, sample[0]): sample for _, words, sample in samples}
    return fit(list(unique.values()))


def _rate(model: Model, selected: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.diff(np.array(model.grades, dtype=np.float64))
        for batch in batches:
            for block in blocks(_plain(batch.column(TEXT))):
                rows = slice(block.rows.start, block.rows.stop)
                owner, bucket, shares = _features(batch.column(TEXT)[rows], block)
                scores = np.bincount(owner, model.weights[bucket], minlength=len(block.rows))
                tails = model.tails(scores + shares @ model.weights[BUCKETS:])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(ID)[rows],
                        batch.column(TEXT)[rows],
                        batch.column(REST)[rows],
                        pa.array(model.grades[0] + tails @ steps),
                        pa.array(tails[:, -1]),
                        pa.array(tails[:, -1] >= selected),
                    ],
                    names=[ID, TEXT, REST, "expected_grade", "top_probability", "selected"],
                )

    return run


def rate(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", selected: float = SELECTED
) -> DataFrame:
    """All columns, with ``expected_grade``, ``top_probability`` and ``selected``.

    ``top_probability`` is that of the best grade; ``selected`` says whether it
    reaches the limit. Null texts are empty. With fewer than two grades there is
    nothing to tell apart: the three are null. Columns of those names are replaced.
    """
    rows = identified(docs, id_col, text_col)
    if len(model.grades) < 2:
        found = rows.select(
            ID,
            TEXT,
            REST,
            F.lit(None).cast("double").alias("expected_grade"),
            F.lit(None).cast("double").alias("top_probability"),
            F.lit(None).cast("boolean").alias("selected"),
        )
    else:
        schema = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in (ID, TEXT, REST))
        found = rows.select(ID, TEXT, REST).mapInArrow(
            _rate(model, selected), f"{schema}, expected_grade double, top_probability double, selected boolean"
        )
    own = {id_col, text_col, "expected_grade", "top_probability", "selected"}
    return found.select(
        F.col(ID).alias(id_col),
        F.col(TEXT).alias(text_col),
        "expected_grade",
        "top_probability",
        "selected",
        *other_columns(found, own),
    )
