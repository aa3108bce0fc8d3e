"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its hashed subwords (byte n-grams of
lower-cased letters that cross no word border), put through a linear softmax.
Both are trained by stochastic gradient descent in numpy on a bounded sample of
labelled rows: snippets of about ``SAMPLE_DOCS`` documents for each language,
chosen by a hash of the id. As the model is linear in the mean, embeddings and
softmax weights fold into one table of scores by subword, which is what tasks
use; every subword of the whole text counts in a prediction.

Scores are calibrated on snippets, short and long, of documents that the model did
not learn from. A temperature makes them probabilities. Rejection is calibrated on
languages that a model does not know: the languages are left out in turn, in
``FOLDS`` folds at most, and a model of the others scores what was left out. For
texts of each of ``LENGTHS`` subwords or more, a score is rejected that
``FOREIGN`` of the left-out texts do not reach, but never more than ``REJECTED`` of
the known ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import ID, TEXT, identified, other_columns, quoted

SAMPLE_DOCS = 1500
SNIPPETS = 3
SNIPPET_CHARS = (20, 300)
BUCKETS = 1 << 16
DIMENSIONS = 16
EPOCHS = 3
RATE = 0.5
REJECTED = 0.003
FOREIGN = 0.95
FOLDS = 4
HELD = 5  # one document in so many is for calibration
LONG_CHARS = 3000
LENGTHS = (0, 60, 200, 800)
UNKNOWN = "und"
_SLICE = 1 << 18  # bytes; the arrays of a slice take some 70 times that
_GRAMS = (2, 3, 4)

# letters of ASCII in lower case, bytes of other characters as they are, all else a border
_LETTER = np.arange(256, dtype=np.uint32)
_LETTER[0x41:0x5B] += 0x20
_LETTER[[b for b in range(128) if not chr(b).isalpha()]] = 0


@dataclass(frozen=True)
class Model:
    """Languages, calibrated scores by subword, and the least accepted score of texts of each of ``LENGTHS``."""

    languages: tuple[str, ...]
    scores: np.ndarray
    thresholds: tuple[float, ...]

    def least(self, subwords: np.ndarray) -> np.ndarray:
        """The score below which a text of so many subwords is rejected."""
        return np.array(self.thresholds)[np.searchsorted(LENGTHS, subwords, side="right") - 1]


def _subwords(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram and whether it crosses no border but at its ends."""
    count = max(len(codes) - size + 1, 0)
    value = np.full(count, size, dtype=np.uint32)
    inside = np.ones(count, dtype=bool)
    for at in range(size):
        part = codes[at : at + count]
        value = (value ^ part) * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        if 0 < at < size - 1:
            inside &= part != 0
    if size == 2:
        inside &= (codes[:count] != 0) | (codes[1 : count + 1] != 0)
    return value % np.uint32(BUCKETS), inside


def subword_buckets(text: str) -> np.ndarray:
    codes = _LETTER[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    found = [_subwords(codes, size) for size in _GRAMS]
    return np.concatenate([buckets[inside] for buckets, inside in found])


def _portions(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of ``_SLICE`` bytes together, with a border on both sides of each, or of one longer text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets + 2 * np.arange(len(texts) + 1)
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(offsets, offsets[at] + _SLICE, side="right")) - 1
        upto = min(max(upto, at + 1), len(texts))
        yield texts.slice(at, upto - at)
        at = upto


def _score_texts(texts: pa.Array, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean subword scores of each text and the number of its subwords, a slice of bytes at a time."""
    by_language = np.ascontiguousarray(scores.T)
    found = [_score_portion(portion, by_language) for portion in _portions(texts)]
    if not found:
        return np.zeros((0, scores.shape[1])), np.zeros(0)
    return np.concatenate([mean for mean, _ in found]), np.concatenate([counted for _, counted in found])


def _score_portion(texts: pa.Array, by_language: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores are gathered for one language at a time: memory does not grow with their number."""
    edge, joint = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    spaced = pc.binary_join_element_wise(edge, pc.utf8_lower(texts), edge, joint)
    offsets = np.frombuffer(spaced.buffers()[1], dtype=np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
    data = np.frombuffer(spaced.buffers()[2], dtype=np.uint8)
    total = np.zeros((len(texts), len(by_language)))
    counted = np.zeros(len(texts))
    widest = max(_GRAMS)
    for low in range(int(offsets[0]), int(offsets[-1]), _SLICE):
        high = min(low + _SLICE, int(offsets[-1]))
        codes = _LETTER[data[low : min(high + widest - 1, int(offsets[-1]))]]
        first = int(np.searchsorted(offsets, low, side="right")) - 1
        last = int(np.searchsorted(offsets, high, side="left"))
        cuts = np.clip(offsets[first : last + 1], low, high) - low
        owner = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(cuts))
        # to the text's end, as far as it matters
        ends = np.minimum(offsets[first + 1 : last + 1] - low, high - low + widest).astype(np.int32)
        left = ends[owner] - np.arange(high - low, dtype=np.int32)
        for size in _GRAMS:
            buckets, inside = _subwords(codes, size)
            count = min(len(buckets), high - low)
            use = np.flatnonzero(inside[:count] & (left[:count] >= size))
            who, which = owner[use], buckets[use]
            counted[first:last] += np.bincount(who, minlength=last - first)
            for column, of in enumerate(by_language):
                total[first:last, column] += np.bincount(who, of[which], minlength=last - first)
    return total / np.maximum(counted, 1)[:, None], counted


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def _learn(grams: list, target: np.ndarray, used: np.ndarray, languages: int, epochs: int, seed: int) -> np.ndarray:
    """Scores by subword and language, by stochastic gradient descent over the snippets in ``used``."""
    random = np.random.Generator(np.random.PCG64(seed))
    used = used.copy()
    embedding = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weights = random.normal(0, 0.1, (DIMENSIONS, languages))
    steps, step = epochs * len(used), 0
    for _ in range(epochs):
        random.shuffle(used)
        for at in used:
            index, count = grams[at]
            share = count / count.sum()
            mean = share @ embedding[index]
            error = _softmax(mean @ weights)
            error[target[at]] -= 1
            rate = RATE * (1 - step / steps)
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            # each subword's own rate: shares are small, as there are many
            embedding[index] -= rate * np.sqrt(share)[:, None] * back
            step += 1
    return embedding @ weights


def _means(grams: list, scores: np.ndarray, which: np.ndarray) -> np.ndarray:
    rows = [grams[at][1] @ scores[grams[at][0]] / grams[at][1].sum() for at in which]
    return np.array(rows).reshape(len(which), scores.shape[1])


def _sharpness(means: np.ndarray, target: np.ndarray) -> float:
    """The temperature that makes the scores probabilities."""
    if not len(means):
        return 1.0
    truth = np.arange(len(means)), target
    return min(np.geomspace(0.1, 30, 60), key=lambda s: -np.log(_softmax(s * means)[truth] + 1e-12).sum())


def _foreign(grams: list, target: np.ndarray, used: np.ndarray, held: np.ndarray, languages: int, seed: int):
    """Held-out texts in languages that a model was not given, and its scores of them."""
    found, scored = [], []
    for fold in range(min(FOLDS, languages)):
        out = np.arange(languages) % FOLDS == fold
        if out.sum() == languages:
            continue
        kept = np.cumsum(~out) - 1
        known, strange = held[~out[target[held]]], held[out[target[held]]]
        scores = _learn(grams, kept[target], used[~out[target[used]]], int((~out).sum()), 1, seed)
        sharpness = _sharpness(_means(grams, scores, known), kept[target[known]])
        found.append(strange)
        scored.append(_softmax(sharpness * _means(grams, scores, strange)).max(axis=1))
    return (np.concatenate(found), np.concatenate(scored)) if found else (held[:0], np.zeros(0))


def _thresholds(known: tuple, foreign: tuple, rejected: float) -> tuple[float, ...]:
    """By length: what ``FOREIGN`` of the foreign texts do not reach, but all but ``rejected`` of the known ones do."""
    found, last = [], 0.0
    for at, low in enumerate(LENGTHS):
        high = LENGTHS[at + 1] if at + 1 < len(LENGTHS) else np.inf
        (mine, others) = (scores[(sizes >= low) & (sizes < high)] for sizes, scores in (known, foreign))
        if len(mine):
            last = float(np.quantile(mine, rejected))
            if len(others):
                last = min(last, float(np.quantile(others, FOREIGN)))
        found.append(last)
    return tuple(found)


def fit(
    snippets: list[str], labels: list[str], held_out: list[bool] | None = None, rejected: float = REJECTED, seed: int = 7
) -> Model:
    """Train on snippets and calibrate on those held out, by default one in ``HELD``."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), (1.0,) * len(LENGTHS))
    target = np.searchsorted(languages, labels)
    grams = [np.unique(subword_buckets(text), return_counts=True) for text in snippets]
    apart = np.arange(len(grams)) % HELD == 0 if held_out is None else np.array(held_out)
    useful = np.array([len(index) > 0 for index, _ in grams])
    held, used = np.flatnonzero(useful & apart), np.flatnonzero(useful & ~apart)
    scores = _learn(grams, target, used, len(languages), EPOCHS, seed)
    means = _means(grams, scores, held)
    sharpness = _sharpness(means, target[held])
    sizes = np.array([count.sum() for _, count in grams])
    strange, doubts = _foreign(grams, target, used, held, len(languages), seed)
    known = sizes[held], _softmax(sharpness * means).max(axis=1) if len(held) else np.zeros(0)
    thresholds = _thresholds(known, (sizes[strange], doubts), rejected)
    return Model(languages, (scores * sharpness).astype(np.float32), thresholds)


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    rejected: float = REJECTED,
) -> Model:
    """Fit on ``sample_docs`` texts for each language; rows without a text, language or letter are left out.

    The texts with the least hashes of id and text are taken, each once, by a
    distributed top-N, so the bound holds however often an id is there. Only
    snippets of them reach the driver.
    """
    rows = labelled.select(
        quoted(id_col).alias("id"), quoted(text_col).alias("text"), quoted(lang_col).alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not counts:
        return fit([], [])
    span = 1 << 40
    # three times as many by their hash, of which the least are taken
    limits = F.create_map(
        *(F.lit(x) for lang, n in counts.items() for x in (lang, min(span, int(span * 3 * sample_docs / n))))
    )
    pick = F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(span))
    rows = rows.where((pick < F.element_at(limits, F.col("lang"))) & F.col("text").rlike(r"\p{L}"))
    low, high = SNIPPET_CHARS
    pieces = []
    for number in range(SNIPPETS + 1):
        spread = F.xxhash64("id", "text", F.lit(number))
        size = low + F.pmod(spread, F.lit(high - low + 1)) if number < SNIPPETS else F.lit(LONG_CHARS)
        start = F.pmod(F.shiftright(spread, 20), F.greatest(F.length("text") - size, F.lit(1)))
        pieces.append(F.substring("text", start.cast("int") + 1, size.cast("int")))
    held = F.pmod(F.shiftright(pick, 8), F.lit(HELD)) == 0
    # the long snippet is for calibration alone
    chosen = rows.select("lang", pick.alias("pick"), held.alias("held"), F.array(*pieces[:-1], F.when(held, pieces[-1])).alias("snippets"))
    first = chosen.groupBy("lang", "pick").agg(F.first("held").alias("held"), F.first("snippets").alias("snippets"))
    order = Window.partitionBy("lang").orderBy("pick")
    sample = first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_docs)
    found = [
        (row["lang"], row["held"], snippet)
        for row in sorted(sample.collect(), key=lambda row: (row["lang"], row["pick"]))
        for snippet in row["snippets"]
        if snippet
    ]
    langs, apart, snippets = zip(*found, strict=True) if found else ((), (), ())
    return fit(list(snippets), list(langs), list(apart), rejected)


def _predict(model: Model):
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    @F.arrow_udf("lang_pred string, score double, accepted boolean")
    def predicted(texts: pa.Array) -> pa.Array:
        means, counted = _score_texts(texts, model.scores)
        odds = _softmax(means)
        letters = np.asarray(pc.match_substring_regex(texts, r"\p{L}").fill_null(False))
        best = np.where(letters, odds.argmax(axis=1), len(names) - 1)
        score = np.where(letters, odds.max(axis=1), 0.0)
        accepted = letters & (score >= model.least(counted))
        columns = [pa.array(names[best], pa.string()), pa.array(score), pa.array(accepted)]
        return pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "accepted"])

    return predicted


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns, with ``lang_pred``, ``score`` (0 to 1) and ``accepted``.

    A null text, or one without a letter, is ``und`` with score 0 and not
    accepted; so is every text if the model knows no language. Only the text is
    looked at, and it alone goes to Python. Columns of those names are replaced. No
    row is moved.
    """
    rows = identified(docs, id_col, text_col)
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    found = rows.withColumn("found", _predict(model)(TEXT) if model.languages else unknown)
    own = {id_col, text_col, "lang_pred", "score", "accepted"}
    return found.select(
        F.col(ID).alias(id_col),
        F.col(TEXT).alias(text_col),
        "found.lang_pred",
        "found.score",
        "found.accepted",
        *other_columns(found, own),
    )
