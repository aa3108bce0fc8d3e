"""Best-fit packing of documents into sequences by exact-complement hashing.

Only longer documents are cut, into pieces of the capacity; the first may be
shorter. Which piece goes where depends on lengths alone, so the plan is made
over the number of pieces of each length, a table of at most ``capacity`` rows
whatever the size of the corpus:

1. From the longest length down, the gap that a piece leaves is looked up among
   the single lengths, the sums of two and the sums of three that are still
   available, and filled exactly, as often as all lengths involved last.
2. What is left is placed best-fit: each length, longest first, into the
   fullest open sequences it fits, else into new ones.

A plan is a list of slots: runs of ranks of one length and the sequences they
fill. Ranks are numbered in parallel: pieces of a length are dealt to chunks of
bounded size by a hash, numbered within them, and chunk counts are accumulated.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import identified, stored

CAPACITY = 2048
CHUNK_PIECES = 50_000
END = 0
VOCABULARY = "byte_bpe_50k"
#: Strings that the vocabulary's ``tokenizers`` file makes tokens of, wherever they stand.
SPECIAL = {"<|endoftext|>": 50256}
_FLUSH_TOKENS = 1 << 18


def vocabulary_path() -> str:
    """The public vocabulary as ranks; the same ids as its ``tokenizers`` file."""
    import public_tokenizers

    return public_tokenizers.path(f"{VOCABULARY}.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer in ``path``, with the special tokens of the vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of ``count`` tokens."""
    first = count % capacity or capacity
    return [(0, min(first, count)), *((start, capacity) for start in range(first, count, capacity))]


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_to_numpy
        tail = np.array([end], dtype="<u4")
        names = ["id", "text_hash", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

        def made(batch, rows, numbers, starts, lengths, sums, ids):
            at = pa.array(rows, pa.int64())
            columns = [
                batch.column(0).take(at),
                batch.column(1).take(at),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            if with_ids:
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32))))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            texts = batch.column(2)
            held, tokens = tuple([] for _ in range(6)), 0
            for row in range(batch.num_rows):
                text = texts[row].as_py() or ""
                found = np.concatenate([encode(text, allowed_special="all"), tail]).astype("<u4", copy=False)
                for number, (start, length) in enumerate(cut(len(found), capacity)):
                    piece = found[start : start + length]
                    for values, value in zip(held, (row, number, start, length, zlib.crc32(piece), piece), strict=True):
                        values.append(value)
                    tokens += length
                    if tokens >= _FLUSH_TOKENS:  # a task holds the ids of few pieces, whatever its batches hold
                        yield made(batch, *held)
                        held, tokens = tuple([] for _ in range(6)), 0
            if held[0]:
                yield made(batch, *held)

    return run


class Plan:
    """Slots of a packing: arrays over runs of ranks of one length, by length and rank."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self._left = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in counts.items():
            self._left[length] = count
        self._used = np.zeros(capacity + 1, dtype=np.int64)
        self._slots: list[tuple[int, int, int, int, int, int]] = []
        self._fill_gaps()
        self._best_fit()
        slots = np.array(sorted(self._slots), dtype=np.int64).reshape(-1, 6)
        self.length, self.rank, self.count, self.sequence, self.each, self.offset = slots.T

    def _take(self, length: int, sequences: int, each: int, base: int, offset: int) -> None:
        """The next pieces of a length, ``each`` to a sequence, one after another from ``offset``."""
        count = sequences * each
        self._slots.append((length, int(self._used[length]), count, base, each, offset))
        self._used[length] += count
        self._left[length] -= count

    def _complement(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to the gap, the longest first."""
        left = self._left
        if left[gap]:
            return (gap,)

        def pair(total: int, most: int) -> tuple[int, int] | None:
            longer = np.arange(min(total - 1, most), (total - 1) // 2, -1)
            if not len(longer):
                return None
            enough = (left[longer] > 0) & (left[total - longer] > np.where(longer * 2 == total, 1, 0))
            hit = np.flatnonzero(enough)
            return (int(longer[hit[0]]), int(total - longer[hit[0]])) if len(hit) else None

        if two := pair(gap, gap):
            return two
        for longest in range(gap - 2, (gap - 1) // 3, -1):
            if left[longest]:
                left[longest] -= 1
                rest = pair(gap - longest, longest)
                left[longest] += 1
                if rest:
                    return (longest, *rest)
        return None

    def _fill_gaps(self) -> None:
        for length in range(self.capacity, 0, -1):
            while self._left[length]:
                self._left[length] -= 1
                rest = self._complement(self.capacity - length) if length < self.capacity else ()
                self._left[length] += 1
                if rest is None:
                    break
                together = defaultdict(int)
                for part in (length, *rest):
                    together[part] += 1
                sequences = min(int(self._left[part]) // each for part, each in together.items())
                offset = 0
                for part, each in together.items():
                    self._take(part, sequences, each, self.sequences, offset)
                    offset += part * each
                self.sequences += sequences

    def _best_fit(self) -> None:
        rooms: list[int] = []  # heap of the rooms there are
        open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: first sequence, sequences

        def opened(room: int, base: int, sequences: int) -> None:
            if room and sequences:
                if not open_[room]:
                    heapq.heappush(rooms, room)
                open_[room].append((base, sequences))

        for length in range(self.capacity, 0, -1):
            small = []
            while self._left[length]:
                while rooms and rooms[0] < length:  # too small for this length, not for later ones
                    small.append(heapq.heappop(rooms))
                if not rooms:
                    each = self.capacity // length
                    sequences = int(self._left[length]) // each
                    if not sequences:
                        each, sequences = int(self._left[length]), 1
                    self._take(length, sequences, each, self.sequences, 0)
                    opened(self.capacity - length * each, self.sequences, sequences)
                    self.sequences += sequences
                    continue
                room = rooms[0]
                base, sequences = open_[room].pop()
                if not open_[room]:
                    heapq.heappop(rooms)
                each = min(room // length, int(self._left[length]))
                used = min(sequences, int(self._left[length]) // each)
                self._take(length, used, each, base, self.capacity - room)
                opened(room - length * each, base, used)
                opened(room, base + used, sequences - used)
            for room in small:
                heapq.heappush(rooms, room)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and ranks."""
        order = np.lexsort((rank, length))
        # slots and pieces in one order: the last slot that starts at or before each piece
        key = np.concatenate([self.length, length[order]])
        start = np.concatenate([self.rank, rank[order]])
        kind = np.concatenate([np.zeros(len(self.length), np.int8), np.ones(len(order), np.int8)])
        merged = np.lexsort((kind, start, key))
        slot = np.maximum.accumulate(np.where(merged < len(self.length), merged, -1))
        at = np.empty(len(order), dtype=np.int64)
        piece = merged >= len(self.length)
        at[order[merged[piece] - len(self.length)]] = slot[piece]
        index = rank - self.rank[at]
        return self.sequence[at] + index // self.each[at], self.offset[at] + index % self.each[at] * length


def _place(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.place(
                np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            )
            columns = {name: batch.column(name) for name in batch.schema.names if name != "rank"}
            columns |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, chunk_pieces: int = CHUNK_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, sequences gapless from 0.

    ``pieces`` has ``no`` (a number of its own), ``id``, ``text_hash``, ``piece``
    and ``length`` (1 to the capacity) and is read three times.
    """
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = Plan(counts, capacity)
    chunks = F.array(*(F.lit(counts.get(length, 0) // chunk_pieces + 1) for length in range(1, capacity + 1)))
    hashed = F.xxhash64("id", "text_hash", "piece")
    dealt = pieces.withColumn("chunk", F.pmod(hashed, F.element_at(chunks, F.col("length").cast("int"))))
    order = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "chunk").count().select(
        "length", "chunk", F.coalesce(F.sum("count").over(order), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("length", "chunk").orderBy("id", "text_hash", "piece", "no")
    ranked = (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(bases, ["length", "chunk"])
        .withColumn("rank", F.col("base") + F.col("inside"))
        .select(*pieces.columns, "rank")
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_place(plan), f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
    end: int = END,
    with_ids: bool = False,
    chunk_pieces: int = CHUNK_PIECES,
) -> DataFrame:
    """One row for each piece of each document, with its place in a sequence.

    Columns: the id, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``, and ``ids`` if asked for. Documents end with
    the token ``end``; null and empty texts are that token alone. Rows repeated
    as a whole are packed as often as they are there. Other columns play no part.
    ``path`` is a vocabulary of ranks that every worker can open.
    """
    rows = identified(docs, id_col, text_col).select(
        F.col("_id").alias("id"), F.col("_text_hash").alias("text_hash"), F.col("_text").alias("text")
    )
    schema = f"id {rows.schema['id'].dataType.simpleString()}, text_hash long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        schema += ", ids array<int>"
    pieces = rows.mapInArrow(_pieces(path or vocabulary_path(), capacity, end, with_ids), schema)
    # numbered as they are written, so that the numbers are the same whenever they are read
    pieces = stored(pieces.withColumn("no", F.monotonically_increasing_id()), "pieces")
    packed = pack(pieces.drop("ids"), capacity, chunk_pieces)
    if with_ids:  # the ids are attached when all places are known, and take no part in finding them
        packed = packed.join(pieces.select("no", "ids"), "no")
    return packed.withColumnRenamed("id", id_col).drop("text_hash", "no")
