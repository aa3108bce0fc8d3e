"""Spelling variants by an index of variable-length grams.

Words are near if one inserted, deleted or replaced character turns one into the
other. Li, Wang and Yang, "VGRAM" (2007), with lists merged across the cluster:

1. *Dictionary.* Grams of ``low`` to ``high`` characters of all words, between
   markers, are counted. Those more frequent than a threshold are the ones worth
   extending; the threshold rises with the number of grams, so that at most
   ``DICTIONARY`` of them, however many words there are, go to the tasks.
2. *Decomposition.* From each position of a word its gram runs on while it is in
   the dictionary, up to ``high`` characters. A gram that ends no later than an
   earlier one is left out. So a gram's end depends on its own characters alone.
3. *Affected grams.* An edit of the character at i can change a gram only if the
   gram ends in i .. i + high - 1: it holds the character, or an earlier gram that
   does may swallow it. The most ends in such a window bound the grams that one
   edit takes from the word (``affected``). The markers on either side are as many
   as it takes for words of ``LEAST_CHARS`` to keep one gram at least.
4. *Lists.* Near words share all but ``affected`` of the grams of either. Hence
   they share one of the ``affected + 1`` rarest of both, and only those are
   indexed, rarest first by the counts of the dictionary. A list too long for a
   task is dealt out as pairs of blocks.
5. *Verification.* Words of a list are compared character by character, and a pair
   counts in the list of the rarest gram they share. Each list gives one row for a
   word with its number of near words there and the best of them; pairs are never
   listed.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import quoted, spread_join, stored
from tidemark.llm.words import grouped

LEAST_CHARS, LEAST_COUNT = 5, 3
LOW, HIGH = 2, 4
DICTIONARY = 200_000
LIST_WORDS = 4096
#: One deletion in so many runs, for texts without known misspellings.
CHANGED_IN = 97
_PAIRS = 500_000
_LETTERS = "A-Za-zÀ-ÿ"


def runs(text: Column) -> Column:
    """Maximal runs of letters of a text, as an array."""
    return F.regexp_extract_all(text, F.lit(f"[{_LETTERS}]+"), F.lit(0))


def lowered(run: Column) -> Column:
    """A run of letters with A-Z in lower case and all else unchanged."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(run.rlike("[À-Þ]"), F.translate(run, upper, lower)).otherwise(F.lower(run))


def misspelt(doc_id: Column, run: Column, one_in: int = CHANGED_IN) -> Column:
    """The run, without one of its characters where the crc32 of ``<doc_id>:<run>`` is divisible by ``one_in``."""
    pick = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (pick % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(pick % one_in == 0, shorter).otherwise(run)


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for words of the least length and count."""
    found = docs.select(quoted(id_col).alias("id"), F.explode(runs(quoted(text_col))).alias("run"))
    words = found.select("id", lowered(F.col("run")).alias("run")).select(misspelt(F.col("id"), F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def markers(high: int) -> int:
    return max(high - 2, 0)


def dictionary(words: DataFrame, low: int, high: int, most: int = DICTIONARY) -> dict[str, int]:
    """The frequent grams and their counts, ``most`` at most."""
    extra = 2 * markers(high)
    windows = sum(F.greatest(F.length("word") + extra - size + 1, F.lit(0)) for size in range(low, high + 1))
    total = words.agg(F.sum(windows)).first()[0] or 0
    threshold = max(total // most, 1)
    text = F.concat(F.lit("^" * markers(high)), F.col("word"), F.lit("$" * markers(high)))
    size = F.explode(F.sequence(F.lit(low), F.lit(high)))
    starts = F.explode(F.sequence(F.lit(1), F.length("marked") - F.col("size") + 1))
    grams = (
        words.select(text.alias("marked"), size.alias("size"))
        .where(F.length("marked") >= F.col("size"))
        .select("marked", "size", starts.alias("start"))
        .groupBy(F.substring("marked", F.col("start"), F.col("size")).alias("gram"))
        .count()
        .where(F.col("count") > threshold)
    )
    return {row["gram"]: row["count"] for row in grams.collect()}


def decompose(word: str, frequent: dict[str, int], low: int, high: int) -> tuple[list[str], list[int]]:
    """The grams of a word between markers, and the positions of their last characters."""
    marked = "^" * markers(high) + word + "$" * markers(high)
    grams, ends = [], []
    for start in range(len(marked) - low + 1):
        end = start + low
        while end < len(marked) and end - start < high and marked[start:end] in frequent:
            end += 1
        if not ends or end - 1 > ends[-1]:
            grams.append(marked[start:end])
            ends.append(end - 1)
    return grams, ends


def affected(ends: list[int], length: int, high: int) -> int:
    """The most grams with these ends that one edit in a word of ``length`` characters can take away."""
    first = markers(high)
    return max(
        bisect_left(ends, begin + high) - bisect_left(ends, begin) for begin in range(first, first + length)
    )


def tokens(word: str, frequent: dict[str, int], low: int, high: int) -> list[int]:
    """The indexed grams of a word as numbers, rarest first."""
    grams, ends = decompose(word, frequent, low, high)
    numbers = sorted({frequent.get(gram, 0) << 32 | zlib.crc32(gram.encode()) for gram in grams})
    shared = max(len(numbers) - affected(ends, len(word), high), 1)
    return numbers[: len(numbers) - shared + 1]


def _index(frequent, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            found = [tokens(word, known, low, high) for word in batch.column("word").to_pylist()]
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([token for one in found for token in one], pa.int64()),
                    batch.column("word").take(pa.array(np.repeat(np.arange(len(found)), sizes))),
                    batch.column("n").take(pa.array(np.repeat(np.arange(len(found)), sizes))),
                    pa.array([packed for one in found for packed in [np.array(one).tobytes()] * len(one)], pa.binary()),
                ],
                names=["token", "word", "n", "tokens"],
            )

    return run


def _ragged(counts: np.ndarray, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index and running number within it, for each index as often as its count, in portions."""
    stops = np.cumsum(counts)
    low = 0
    while low < len(counts):
        before = int(stops[low] - counts[low])
        high = max(int(np.searchsorted(stops, before + at_once, side="right")), low + 1)
        part = counts[low:high]
        index = np.repeat(np.arange(low, high), part)
        yield index, np.arange(len(index)) - np.repeat(stops[low:high] - part - before, part)
        low = high


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``b``, one character longer, is that of ``a`` with one more."""
    width = a.shape[1]
    same = np.ones((len(a), 1), dtype=bool)
    head = np.logical_and.accumulate(a == b[:, :width], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate(np.hstack([same, (a == b[:, 1:])[:, ::-1]]), axis=1).sum(axis=1) - 1
    return head + tail >= width


def near_pairs(
    words: list[bytes], lists: np.ndarray, part: np.ndarray, across: np.ndarray, at_once: int = _PAIRS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of near words of one list; where ``across`` is set, of two different parts."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.lexsort((lists, sizes))
    keys = np.stack([sizes[order], lists[order]])
    new = np.flatnonzero((np.diff(keys, prepend=-1) != 0).any(axis=0))
    group_of = np.repeat(np.arange(len(new)), np.diff([*new, len(order)]))
    rank = np.arange(len(order)) - new[group_of]
    letters = {}  # by length: the rows in order, and their characters
    for size in np.unique(sizes):
        low, high = np.searchsorted(keys[0], [size, size + 1])
        text = b"".join(words[at] for at in order[low:high])
        letters[int(size)] = low, np.frombuffer(text, dtype=np.uint8).reshape(high - low, size)
    named = {(int(keys[0][at]), int(keys[1][at])): group for group, at in enumerate(new)}
    members = np.diff([*new, len(order)])
    longer = np.array([named.get((int(keys[0][at]) + 1, int(keys[1][at])), -1) for at in new], dtype=np.int64)

    def chosen(x, y, test, size, other):
        use = ~across[order[x]] | (part[order[x]] != part[order[y]])
        x, y = x[use], y[use]
        if not len(x):
            return x, y
        (low, a), (base, b) = letters[size], letters[other]
        width = max(1, 16_000_000 // (2 * size + 1))
        hit = [test(a[x[i : i + width] - low], b[y[i : i + width] - base]) for i in range(0, len(x), width)]
        hit = np.concatenate(hit)
        return order[x[hit]], order[y[hit]]

    for size, (low, rows) in letters.items():
        span = slice(low, low + len(rows))
        for index, number in _ragged(rank[span], at_once):
            yield chosen(low + index, new[group_of[low + index]] + number, _replaced, size, size)
        if size + 1 not in letters:
            continue
        target = longer[group_of[span]]
        for index, number in _ragged(np.where(target >= 0, members[target], 0), at_once):
            yield chosen(low + index, new[target[index]] + number, _inserted, size, size + 1)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each word of a list that has near words there: their number and the best."""
    for table in grouped(batches, "task"):
        words = [word.encode("latin-1") for word in table.column("word").to_pylist()]
        n = table.column("n").to_numpy()
        token = table.column("token").to_numpy()
        packed = table.column("tokens").to_pylist()
        lists = np.unique(table.column("task").to_numpy(), return_inverse=True)[1]
        part, across = table.column("part").to_numpy(), table.column("across").to_numpy()
        left, right = [], []
        for x, y in near_pairs(words, lists, part, across):
            width = max((len(packed[at]) // 8 for at in (*x, *y)), default=0)
            if not width:
                continue
            # the list of the rarest gram that both have is the one where a pair counts
            x_tokens, y_tokens = (
                np.frombuffer(b"".join(packed[at].ljust(8 * width, fill) for at in side), np.int64).reshape(-1, width)
                for side, fill in ((x, b"\xff"), (y, b"\xfe"))
            )
            both = (x_tokens[:, :, None] == y_tokens[:, None, :]).any(axis=2)
            first = np.where(both, x_tokens, np.iinfo(np.int64).max).min(axis=1)
            here = first == token[x]
            left += [x[here], y[here]]
            right += [y[here], x[here]]
        if not left:
            continue
        left, right = np.concatenate(left), np.concatenate(right)
        # words sort as their code points do
        place = np.empty(len(words), dtype=np.int64)
        place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((place[right], -n[right], left))
        left, right = left[order], right[order]
        first = np.flatnonzero(np.diff(left, prepend=-1))
        found = table.column("word").combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [
                found.take(pa.array(left[first])),
                pa.array(np.diff([*first, len(left)])),
                pa.array(-n[right[first]]),
                found.take(pa.array(right[first])),
            ],
            names=["word", "n_near", "less", "best"],
        )


def near_words(
    words: DataFrame,
    low: int = LOW,
    high: int = HIGH,
    list_words: int = LIST_WORDS,
    most_grams: int = DICTIONARY,
) -> DataFrame:
    """``word``, ``n_near`` and ``best``, a struct of the near word of largest ``n`` and that ``n``, for words that have one.

    ``words`` has ``word``, all different, of ``LEAST_CHARS`` characters or more below
    U+0100, and ``n``. It is read three times.
    """
    spark = words.sparkSession
    frequent = spark.sparkContext.broadcast(dictionary(words, low, high, most_grams))
    index = stored(
        words.mapInArrow(_index(frequent, low, high), "token long, word string, n long, tokens binary"), "grams"
    )
    lists = index.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    parts = F.ceil(F.col("members") / list_words).cast("int")
    listed = spread_join(index, lists.select("token", parts.alias("parts")), ["token"])
    dealt = listed.withColumn("part", F.pmod(F.xxhash64("word", F.lit(11)), "parts").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    task = F.xxhash64("token", F.least("part", "other"), F.greatest("part", "other"))
    merged = (
        dealt.select("token", "word", "n", "tokens", "part", (F.col("part") != F.col("other")).alias("across"), task.alias("task"))
        .repartition("task")
        .sortWithinPartitions("task")
        .mapInArrow(_merge, "word string, n_near long, less long, best string")
    )
    best = F.min(F.struct("less", "best"))
    found = merged.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("found"))
    return found.select(
        "word", "n_near", F.struct((-F.col("found.less")).alias("n"), F.col("found.best").alias("word")).alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, where following the forms from the word ends; by doubling the steps."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        on = F.struct(F.col("l.root")) == F.struct(F.col("r.root"))
        now = stored(
            now.alias("l")
            .join(next_.alias("r"), on, "left")
            .select("l.word", F.coalesce("r.further", "l.root").alias("root"), F.col("r.further").isNotNull().alias("moved")),
            "roots",
        )
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each word of the texts: its count, near words, form and root.

    Columns: ``word``, ``form`` (the near word of largest count, the first in
    code-point order of several, if its count is twice the word's or more; else
    null), ``root`` (where following the forms ends; the word itself without a
    form), ``n``, ``n_near`` (0 if none) and ``form_n`` (null without a form).
    Counts at least double from form to form, so the way to the root is short and
    has no circle. Null and empty texts have no words; a null id counts as an empty one in
    the choice of misspelt runs; repeated rows count as often as they are there.
    Without words there are no rows. Other columns play no part.
    """
    words = stored(vocabulary(docs, id_col, text_col), "words")
    near = near_words(words, **options)
    form = F.when(F.col("best.n") >= 2 * F.col("n"), F.col("best"))
    known = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            form["word"].alias("form"),
            form["n"].alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
