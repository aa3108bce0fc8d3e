"""Substring dedup by prefix-partitioned suffix trees.

A *window* is a run of ``window`` words of one document. Every word covered by a
window whose word sequence also starts anywhere else, in the same document or
another, is removed. Windows are judged on the input.

Suffixes are split into groups by a prefix that all suffixes of equal windows
share. The prefix has variable length: it ends with the window's *anchor*, the
run of ``anchor`` words with the smallest hash in it (the last of equals), so it
takes between ``anchor`` and ``window`` words. Equal windows have equal anchors
at equal places, so no repeat is split between groups, and neighbouring windows
mostly have the same anchor: they form a *stretch*, which is moved as one row.

1. Every document gives one row per stretch: the anchor's hash and a hash of the
   whole stretch. An anchor that occurs once has no repeats; most end here.
2. Equal stretches are counted with a map-side sum. All windows of a stretch
   that occurs twice repeat; thousands of copies are one row from here on.
3. The different stretches of one anchor meet in one task, as words. Its
   suffixes are put into a tree level by level; nodes with one suffix are
   leaves and go; nodes left at depth ``window`` are the repeats.
4. An anchor with more than ``group_rows`` different stretches would not fit a
   task. Its suffixes are split by their longest prefix, the window itself, and
   counted by a grouped sum.

Words are compared by 64-bit hashes, ``window`` of them for a window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import ID, REST, TEXT, TEXT_HASH, identified, other_columns, spread_join, stored
from tidemark.llm.words import Ranges, blocks, grouped, sliding

WINDOW = 35
ANCHOR = 12
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
GROUP_ROWS = 20_000
_FLUSH_BYTES = 1 << 20


def _stretches(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """Stretches of a block: text position, first window, window count, both hashes."""
    span = window - anchor + 1
    count = len(hashes) - window + 1
    if count < 1:
        return None
    ranges = Ranges(hashes)
    at = np.arange(len(hashes) - anchor + 1)
    grams = ranges.of(at, at + anchor)
    lowest = sliding(grams, span, np.minimum)
    place = np.zeros(count, dtype=np.int64)
    for offset in range(span):
        hit = grams[offset : offset + count] == lowest
        place[hit] = np.flatnonzero(hit) + offset
    owner = np.searchsorted(first, np.arange(count), side="right") - 1
    valid = np.arange(count) + window <= first[owner + 1]
    new = np.ones(count, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new & valid)
    if not len(begins):
        return None
    stops = np.flatnonzero(np.append(new[1:] | ~valid[1:], True) & valid) + 1
    return owner[begins], begins, stops - begins, grams[place[begins]], ranges.of(begins, stops + window - 1)


def _find_stretches(window: int, anchor: int):
    names = [ID, TEXT_HASH, "prefix", "stretch", "start", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                found = _stretches(block.hashes, block.first, window, anchor)
                if found is None:
                    continue
                owner, begins, windows, prefix, stretch = found
                row = pa.array(owner + block.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array(prefix.view(np.int64)),
                        pa.array(stretch.view(np.int64)),
                        pa.array((begins - block.first[owner]).astype(np.int32)),
                        pa.array(windows.astype(np.int32)),
                    ],
                    names=names,
                )

    return run


def _spell(window: int):
    """The words of the stretches listed for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for block in blocks(batch.column(TEXT)):
                listed = wanted.slice(block.rows.start, len(block.rows))
                items = listed.flatten()
                if not len(items):
                    continue
                owner = np.repeat(np.arange(len(listed)), np.asarray(listed.value_lengths().fill_null(0)))
                windows = np.asarray(items.field("windows")).astype(np.int64)
                starts = block.first[owner] + np.asarray(items.field("start"))
                lengths = windows + window - 1
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                take = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths)
                words = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(block.hashes[take].view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [items.field("prefix"), items.field("stretch"), items.field("variants"), words],
                    names=["prefix", "stretch", "variants", "words"],
                )

    return run


def repeated_suffixes(group: np.ndarray, words: np.ndarray, first: np.ndarray, window: int):
    """Stretch and offset of every suffix below an inner tree node of depth ``window``.

    ``words[first[i]:first[i + 1]]`` are the words of stretch ``i`` and
    ``group[i]`` its prefix group. The tree is built from the root down; at each
    level a node's suffixes are told apart by their next word.
    """
    windows = np.diff(first) - window + 1
    owner = np.repeat(np.arange(len(windows)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = first[owner] + offset
    node = np.unique(group, return_inverse=True)[1][owner]
    for depth in range(window):
        if not len(at):
            break
        word = words[at + depth]
        order = np.lexsort((word, node))
        node, word, at, owner, offset = node[order], word[order], at[order], owner[order], offset[order]
        edge = np.ones(len(at), dtype=bool)
        edge[1:] = (node[1:] != node[:-1]) | (word[1:] != word[:-1])
        node = np.cumsum(edge) - 1
        inner = np.bincount(node)[node] > 1
        node, at, owner, offset = node[inner], at[inner], owner[inner], offset[inner]
    return owner, offset


def _grow_trees(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "prefix"):
            table = table.combine_chunks()
            lists = table.column("words").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            first = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
            owner, offset = repeated_suffixes(
                table.column("prefix").to_numpy(), np.asarray(lists.flatten()), first, window
            )
            marks = np.zeros(len(lists), dtype=np.int64)
            np.bitwise_or.at(marks, owner, np.int64(1) << offset)
            hit = np.flatnonzero(marks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(table.column("prefix").to_numpy()[hit]),
                    pa.array(table.column("stretch").to_numpy()[hit]),
                    pa.array(marks[hit]),
                ],
                names=["prefix", "stretch", "marks"],
            )

    return run


def _with_spaces(text: bytes, keep: np.ndarray) -> bytes:
    """The kept words with the white space before each; that of the text's ends stays with its outer words."""
    spans = [word.span() for word in _WORD.finditer(text)]
    if not len(keep):
        return b""
    left = b"".join(text[spans[at - 1][1] if at else 0 : spans[at][1]] for at in keep)
    left = left if keep[0] == 0 else left.lstrip()
    return left + text[spans[-1][1] :] if keep[-1] == len(spans) - 1 else left


def _cut(window: int, spaces: bool):
    """Keep the words that no marked window covers."""
    offsets = np.arange(window)

    def kept(text: bytes, starts, marks) -> tuple[str, int, int]:
        words = text.split()
        if starts is None or not len(starts):
            return (text if spaces else b" ".join(words)).decode(), len(words), 0
        starts, marks = np.asarray(starts), np.asarray(marks)
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for bit in offsets:
            begin = starts[(marks >> bit) & 1 == 1] + bit
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + window, -1)
        keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        left = _with_spaces(text, keep) if spaces else b" ".join([words[at] for at in keep])
        return left.decode(), len(words), len(words) - len(keep)

    def made(batch: pa.RecordBatch, rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                batch.column(ID),
                batch.column(REST),
                pa.array([row[0] for row in rows], pa.string()),
                pa.array([row[1] for row in rows], pa.int64()),
                pa.array([row[2] for row in rows], pa.int64()),
            ],
            names=[ID, REST, "kept_text", "n_words", "n_removed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(TEXT).cast(pa.binary()).fill_null(b"")
            starts, marks = batch.column("starts"), batch.column("marks")
            rows, done, size = [], 0, 0
            for at in range(batch.num_rows):
                text = texts[at].as_py()
                rows.append(kept(text, starts[at].values, marks[at].values))
                size += len(text)
                if size >= _FLUSH_BYTES:  # a worker holds few texts, whatever its batches hold
                    yield made(batch.slice(done, len(rows)), rows)
                    rows, done, size = [], at + 1, 0
            if rows:
                yield made(batch.slice(done), rows)

    return run


def _row() -> Column:
    """Names a row in joins and grouping, also where its id is null."""
    return F.struct(ID, TEXT_HASH).alias("row")


def _verdicts(docs: DataFrame, shared: DataFrame, window: int, group_rows: int) -> DataFrame:
    """Prefix, stretch and a bit for each of its windows that repeats."""
    variants = shared.groupBy("prefix", "stretch", "windows").agg(
        F.count("*").alias("copies"), F.min(F.struct(ID, TEXT_HASH, "start")).alias("place")
    )
    settled = variants.where("copies > 1").select(
        "prefix", "stretch", F.expr("shiftleft(1L, windows) - 1").alias("marks")
    )
    branching = variants.groupBy("prefix").agg(F.count("*").alias("variants")).where("variants > 1")
    wanted = (
        spread_join(variants, branching, ["prefix"])
        .select("place.*", "prefix", "stretch", "windows", "variants")
        .groupBy(_row())
        .agg(F.collect_list(F.struct("prefix", "stretch", "start", "windows", "variants")).alias("wanted"))
    )
    # one row for each text, also where whole rows are repeated: the grouping needs no exchange after the
    # join, and as all columns stay, the exchange of the texts is that of the last join in remove_repeats
    named = docs.withColumn("row", _row())
    spelled = (
        named.join(wanted, named["row"] == wanted["row"])
        .drop(named["row"])
        .dropDuplicates(["row"])
        .mapInArrow(_spell(window), "prefix long, stretch long, variants long, words array<long>")
    )
    trees = (
        spelled.where(F.col("variants") <= group_rows)
        .repartition("prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(_grow_trees(window), "prefix long, stretch long, marks long")
    )
    suffixes = spelled.where(F.col("variants") > group_rows).select(
        "prefix",
        "stretch",
        "words",
        F.explode(F.expr(f"sequence(0, size(words) - {window})")).alias("offset"),
    ).select("prefix", "stretch", "offset", F.expr(f"slice(words, offset + 1, {window})").alias("suffix"))
    deep = suffixes.groupBy("prefix", "suffix").count().where("count > 1").drop("count")
    split = (
        spread_join(suffixes, deep, ["prefix", "suffix"])
        .groupBy("prefix", "stretch")
        .agg(F.bit_or(F.expr("shiftleft(1L, offset)")).alias("marks"))
    )
    found = settled.unionByName(trees).unionByName(split)
    return found.groupBy("prefix", "stretch").agg(F.bit_or("marks").alias("marks"))


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    group_rows: int = GROUP_ROWS,
    spaces: bool = False,
) -> DataFrame:
    """All columns, with the text that is left and the numbers of words.

    Adds ``kept_text`` (kept words joined by one space, or with ``spaces`` the
    text as it was without the words that go and the space before them), ``n_words`` and
    ``n_removed`` before the input's other columns; those replace columns of
    the same names. Null texts have no words. Texts of fewer than ``window``
    words lose nothing. Rows repeated as a whole repeat each other's windows,
    also where ids repeat or are null. ``window - anchor`` must be below 62.
    """
    if not 0 < anchor <= window or window - anchor > 61:
        raise ValueError("anchor must be 1 to window words, and at most 61 shorter")
    rows = identified(docs, id_col, text_col)
    id_type = rows.schema[ID].dataType.simpleString()
    found = rows.select(ID, TEXT_HASH, TEXT).mapInArrow(
        _find_stretches(window, anchor),
        f"{ID} {id_type}, {TEXT_HASH} long, prefix long, stretch long, start int, windows int",
    )
    twice = found.groupBy("prefix").count().where("count > 1").select("prefix")
    shared = stored(spread_join(found, twice, ["prefix"]), "stretches")
    marked = (
        spread_join(shared, _verdicts(rows, shared, window, group_rows), ["prefix", "stretch"])
        .groupBy(ID, TEXT_HASH)
        # a set, kept in the map tasks too: rows repeated as a whole have the same marks
        .agg(F.collect_set(F.struct("start", "marks")).alias("found"))
        .select(_row(), F.col("found.start").alias("starts"), F.col("found.marks").alias("marks"))
    )
    left = rows.withColumn("row", _row()).join(marked, "row", "left")
    rest = rows.schema[REST].dataType.simpleString()
    result = left.mapInArrow(
        _cut(window, spaces),
        f"{ID} {id_type}, {REST} {rest}, "
        "kept_text string, n_words long, n_removed long",
    )
    own = {id_col, "kept_text", "n_words", "n_removed"}
    return result.select(
        F.col(ID).alias(id_col), "kept_text", "n_words", "n_removed", *other_columns(result, own)
    )
