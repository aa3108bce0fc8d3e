"""Edit-aware token counts.

A document's count is the root of a segment tree. Its leaves are stretches of
text of about ``LEAF_CHARS`` characters that end where the tokenizer's pre-token
pattern always splits: before a space between letters or digits, or after an
ideographic mark before a letter, as in texts without spaces. No token crosses such
a border, so the tokens of a leaf don't depend on its neighbours, and the count of a
text is the sum over its leaves.

An edit touches the leaves that overlap it, and a neighbour where the edit takes
the border away. Only these are cut and encoded anew; sums above them are
updated. Where they are cut into more leaves than there were, the tree is built
again over the sizes of all leaves, of which none is encoded for it. The leaves' sizes can be stored and later brought up to date with a new
batch of edits, without encoding the rest of the text again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.packing import encoder, vocabulary_path
from tidemark.llm.tables import quoted

LEAF_CHARS = 512
#: a pre-token begins here, whatever stands around: at a space with letters or digits on both sides, or
#: at a letter or digit after an ideographic mark
_BORDER = re.compile(r"(?<=[^\W_]) (?=[^\W_])|(?<=[。，、！？；：」』）])(?=[^\W_])")

Count = Callable[[str], int]


def cuts(text: str, leaf_chars: int = LEAF_CHARS) -> list[str]:
    """The text in stretches, of ``leaf_chars`` or up to the next border after it."""
    found, start = [], 0
    while len(text) - start > leaf_chars:
        border = _BORDER.search(text, start + leaf_chars)
        if border is None:
            break
        found.append(text[start : border.start()])
        start = border.start()
    found.append(text[start:])
    return found


class SegmentTree:
    """Sums of two sizes of each leaf, characters and tokens, in two binary heaps."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.width = 1 << max(len(chars) - 1, 0).bit_length()
        self.leaves = len(chars)
        self.chars = [0] * self.width + chars + [0] * (self.width - len(chars))
        self.tokens = [0] * self.width + tokens + [0] * (self.width - len(tokens))
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, the last one for the end; and the leaf's start."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node] and start + self.chars[node] < self.chars[1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2


class CountedText:
    """A text and the tree of its token counts."""

    def __init__(self, text: str, count: Count, leaf_chars: int = LEAF_CHARS, sizes=None) -> None:
        """``sizes``: the stored characters and tokens of the leaves; encoded anew without them."""
        self.text, self._count, self.encoded = text, count, 0
        if sizes is None:
            pieces = cuts(text, leaf_chars)
            sizes = [len(piece) for piece in pieces], [count(piece) for piece in pieces]
            self.encoded = len(text)
        self.tree = SegmentTree(*map(list, sizes))
        self._leaf_chars = leaf_chars

    def sizes(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the leaves that are not empty."""
        width = self.tree.width
        pairs = [(c, t) for c, t in zip(self.tree.chars[width:], self.tree.tokens[width:], strict=True) if c]
        return [c for c, _ in pairs], [t for _, t in pairs]

    def edit(self, start: int, removed: int, replacement: str) -> None:
        """Replace ``removed`` characters from ``start``; places outside the text are moved into it."""
        start = min(max(start, 0), len(self.text))
        end = min(start + max(removed, 0), len(self.text))
        tree = self.tree
        first, low = tree.at(start)
        last, at = tree.at(max(end - 1, start))
        high = at + tree.chars[tree.width + last]
        new = self.text[:start] + replacement + self.text[end:]
        shift = len(replacement) - (end - start)
        # context: the borders on both sides must still be borders
        while low > 0 and not _BORDER.match(new, low):
            first, low = tree.at(low - 1)
        while high < len(self.text) and not _BORDER.match(new, high + shift):
            last, at = tree.at(high)
            high = at + tree.chars[tree.width + last]
        self.text = new
        region = new[low : high + shift]
        self.encoded += len(region)
        pieces = cuts(region, self._leaf_chars)
        if len(pieces) > last - first + 1:
            chars, tokens = (heap[tree.width : tree.width + tree.leaves] for heap in (tree.chars, tree.tokens))
            chars[first : last + 1] = map(len, pieces)
            tokens[first : last + 1] = map(self._count, pieces)
            self.tree = SegmentTree(chars, tokens)
            return
        for leaf in range(first, last + 1):
            piece = pieces[leaf - first] if leaf - first < len(pieces) else ""
            tree.put(leaf, len(piece), self._count(piece))


def _recount(path: str, leaf_chars: int, stored_sizes: bool, details: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode

        def count(text: str) -> int:
            return len(encode(text, allowed_special="all"))

        names = ["id", "n_tokens", "n_edits", "n_tokens_edited", "chars_encoded"]
        names += ["edited", "leaf_chars", "leaf_tokens"] if details else []
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                sizes = (row["leaf_chars"], row["leaf_tokens"]) if stored_sizes and row["leaf_chars"] else None
                found = CountedText(row["text"] or "", count, leaf_chars, sizes)
                before, found.encoded = found.tree.total, 0
                edits = sorted(row["edits"] or [], key=lambda e: e["order"])
                for edit in edits:
                    found.edit(edit["start"], edit["removed"], edit["replacement"] or "")
                more = (found.text, *found.sizes()) if details else ()
                rows.append((row["id"], before, len(edits), found.tree.total, found.encoded, *more))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            types = [batch.schema.field("id").type, *[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int32())] * 2]
            types = types[: len(names)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names=names
            )

    return run


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits_col: str | None = None,
    sizes: tuple[str, str] | None = None,
    path: str | None = None,
    leaf_chars: int = LEAF_CHARS,
    details: bool = True,
) -> DataFrame:
    """Token counts of every row before and after its edits.

    ``edits_col`` is an array of structs ``order``, ``start``, ``removed`` and
    ``replacement``, applied by order; places outside the text are moved into it
    and null replacements are empty. ``sizes`` names the columns that hold the
    leaves of an earlier count of the same text (``leaf_chars``,
    ``leaf_tokens``); rows where they are null are counted from the start.

    Columns: the id, ``n_tokens``, ``n_edits``, ``n_tokens_edited``,
    ``chars_encoded`` (that the edits made necessary), and with ``details``
    ``edited`` (the text), ``leaf_chars`` and ``leaf_tokens`` of it. Null and empty texts have no
    tokens. Other columns play no part. No row is moved.
    """
    none = F.lit(None)
    edits = "array<struct<order:int,start:int,removed:int,replacement:string>>"
    rows = docs.select(
        quoted(id_col).alias("id"),
        quoted(text_col).alias("text"),
        (quoted(edits_col) if edits_col else none).cast(edits).alias("edits"),
        (quoted(sizes[0]) if sizes else none).cast("array<int>").alias("leaf_chars"),
        (quoted(sizes[1]) if sizes else none).cast("array<int>").alias("leaf_tokens"),
    )
    found = rows.mapInArrow(
        _recount(path or vocabulary_path(), leaf_chars, sizes is not None, details),
        f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, n_edits long, n_tokens_edited long, "
        "chars_encoded long" + (", edited string, leaf_chars array<int>, leaf_tokens array<int>" if details else ""),
    )
    return found.withColumnRenamed("id", id_col)
