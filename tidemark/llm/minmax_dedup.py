"""Near-duplicate groups by min-max hashing, with every link confirmed on full sets.

A document's set holds its three-word shingles, A-Z in lower case. Documents are
linked if their sets have a Jaccard similarity of ``percent`` or more, and a group
is what links connect. Equal sets are one class from the start.

1. *Min-max hashing* (Ji et al., 2013). Each permutation of the shingle hashes
   gives two values of a signature, the least and the greatest. Both agree for two
   sets with the probability of their similarity, so ``permutations`` evaluations
   do the work of twice as many, and as the two are negatively correlated the
   share of equal values varies less. ``rows`` values make a band. A pair at 85 %
   shares none of 24 bands of 5 values in one case of a million.
2. *Candidates.* Sets of a band are tied if their signatures agree in ``_TIED`` of
   the values. Only a spanning forest of the ties leaves a task, so no pairs are
   listed; bands too large for a task are dealt out as pairs of blocks.
3. *Confirmation.* Connected ties make candidate groups. First each block of a
   group is decided exactly, together with the same few sets of the whole group.
   In a large group of copies this connects nearly all, at a cost that grows with
   the group. Where the blocks of a group are still in several components, the sets
   outside the largest one are then compared with all others of the group, in pairs
   of blocks. Intersections come from products of incidence matrices, whose counts
   are exact; only spanning forests of the links leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import quoted, row_key, spread_join, stored
from tidemark.llm.words import Block, blocks, grouped, mix, powers, shingle_hashes
from tidemark.names import whole_key

SHINGLE = 3
PERCENT = 85
PERMUTATIONS, ROWS = 60, 5
BAND_SETS = 4096
BLOCK_SETS = 2000
BLOCK_SHINGLES = 1_500_000
SHARED_SETS = 64

_SKETCH = 64  # values of a signature that travel with a band, a byte each
_TIED = 0.6  # share of equal values of a pair at 85 % less five standard deviations


def shingle_sets(block: Block, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and the text's position; one of all words if there are fewer."""
    values, owner = shingle_hashes(block, shingle)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new]


def signatures(values: np.ndarray, begins: np.ndarray, permutations: int) -> np.ndarray:
    """Least and greatest value of each set under each permutation, side by side, 32 bits each."""
    values = (values >> np.uint64(32)).astype(np.uint32)
    factors = (powers(0x9E3779B97F4A7C15, permutations + 1)[1:] >> np.uint64(31)).astype(np.uint32) | np.uint32(1)
    shifts = (powers(0xC2B2AE3D27D4EB4F, permutations + 1)[1:] >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(begins), 2 * permutations), dtype=np.uint32)
    buffer = np.empty_like(values)
    for at in range(permutations):
        np.multiply(values, factors[at], out=buffer)
        np.add(buffer, shifts[at], out=buffer)
        np.minimum.reduceat(buffer, begins, out=out[:, 2 * at])
        np.maximum.reduceat(buffer, begins, out=out[:, 2 * at + 1])
    return out


def band_keys(signs: np.ndarray, rows: int) -> np.ndarray:
    bands = signs.shape[1] // rows
    parts = signs[:, : bands * rows].reshape(len(signs), bands, rows).astype(np.uint64)
    keys = (parts * powers(0xA0761D6478BD642F, rows)).sum(axis=2, dtype=np.uint64)
    return mix(keys ^ (np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def _sign(shingle: int, permutations: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = 2 * permutations // rows
        for batch in batches:
            for block in blocks(batch.column("text"), lower=True):
                values, owner = shingle_sets(block, shingle)
                count = len(block.rows)
                sizes = np.bincount(owner, minlength=count)
                names = np.zeros((2, count), dtype=np.uint64)
                keys = np.zeros((0, bands), dtype=np.uint64)
                sketch = []
                full = np.flatnonzero(sizes)
                if len(full):
                    begins = np.cumsum(sizes)[full] - sizes[full]
                    names[0, full] = mix(np.add.reduceat(mix(values), begins))
                    names[1, full] = mix(np.add.reduceat(mix(values ^ np.uint64(0x5DEECE66D)), begins))
                    signs = signatures(values, begins, permutations)
                    keys = band_keys(signs, rows)
                    sketch = [row.tobytes() for row in signs[:, :_SKETCH].astype(np.uint8)]
                sketches = np.full(count, None, dtype=object)
                sketches[full] = sketch
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                part = slice(block.rows.start, block.rows.stop)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id")[part],
                        batch.column("text_hash")[part],
                        pa.array(names[0].view(np.int64)),
                        pa.array(names[1].view(np.int64)),
                        pa.array(sizes.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel())),
                        pa.array(list(sketches), pa.binary()),
                    ],
                    names=["id", "text_hash", "h1", "h2", "shingles", "bands", "sketch"],
                )

    return run


def tied(sketches: np.ndarray, least: float = _TIED) -> np.ndarray:
    """For each set, the first that it is connected with over ties.

    Breadth first: a set is compared only with those that nothing has reached yet,
    so alike sets take one comparison each.
    """
    label = np.arange(len(sketches))
    rest = label.copy()
    while len(rest):
        first, rest = rest[0], rest[1:]
        front = [first]
        while front and len(rest):
            alike = (sketches[rest] == sketches[front.pop()]).mean(axis=1) >= least
            front += list(rest[alike])
            label[rest[alike]] = first
            rest = rest[~alike]
    return label


def _spans(table: pa.Table, name: str) -> Iterator[slice]:
    """The runs of rows with equal values of a sorted column that are longer than one row."""
    values = table.column(name).to_numpy()
    bounds = [0, *(np.flatnonzero(np.diff(values)) + 1), len(values)]
    for begin, end in zip(bounds, bounds[1:], strict=False):
        if end - begin > 1:
            yield slice(int(begin), int(end))


def _edges(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if left:
        columns = [pa.array(np.concatenate(side), pa.int64()) for side in (left, right)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in grouped(batches, "task"):
        numbers = table.column("no").to_numpy()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(numbers), -1)
        left, right = [], []
        for span in _spans(table, "task"):
            label = tied(sketches[span])
            later = np.flatnonzero(label != np.arange(len(label)))
            left.append(numbers[span][label[later]])
            right.append(numbers[span][later])
        yield from _edges(left, right)


def linked_pairs(
    values: np.ndarray, owner: np.ndarray, sizes: np.ndarray, side: np.ndarray, across: bool, percent: int, columns: int = 4096
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets with at least the similarity: all, or those of two different sides."""
    distinct, column, having = np.unique(values, return_inverse=True, return_counts=True)
    number = np.where(having > 1, np.cumsum(having > 1) - 1, -1)[column]
    first = np.flatnonzero(side == side.min()) if across else np.arange(len(sizes))
    second = np.flatnonzero(side != side.min()) if across else first
    common = np.zeros((len(first), len(second)), dtype=np.float32)
    for low in range(0, int((having > 1).sum()), columns):
        inside = (number >= low) & (number < low + columns)
        incidence = np.zeros((len(sizes), columns), dtype=np.float32)
        incidence[owner[inside], number[inside] - low] = 1
        common += incidence[first] @ (incidence if second is first else incidence[second]).T
    x, y = np.nonzero(common)
    shared = common[x, y].astype(np.int64)
    x, y = first[x], second[y]
    hit = 100 * shared >= percent * (sizes[x] + sizes[y] - shared)
    return (x[hit], y[hit]) if across else (x[hit & (x < y)], y[hit & (x < y)])


def forest(count: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least index reachable from each over the links."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _confirm(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "task"):
            left, right = [], []
            for span in _spans(table, "task"):
                part = table.slice(span.start, span.stop - span.start)
                numbers = part.column("no").to_numpy()
                texts = part.column("text").combine_chunks()
                texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
                values, owner = [], []
                for block in blocks(texts, lower=True):
                    found, whose = shingle_sets(block, shingle)
                    values.append(found)
                    owner.append(whose + block.rows.start)
                values, owner = np.concatenate(values), np.concatenate(owner)
                sizes = np.bincount(owner, minlength=len(numbers))
                across = part.column("across")[0].as_py()
                x, y = linked_pairs(values, owner, sizes, part.column("side").to_numpy(), across, percent)
                root = forest(len(numbers), x, y)
                later = np.flatnonzero(root != np.arange(len(root)))
                left.append(numbers[root[later]])
                right.append(numbers[later])
            yield from _edges(left, right)

    return run


def _dealt(df: DataFrame, parts: Column, key: str, salt: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt)), parts).cast("int")


def _decided(tasks: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links of the tasks, a spanning forest each."""
    found = (
        tasks.select("task", "no", "text", "side", "across")
        .repartition("task")
        .sortWithinPartitions("task")
        .mapInArrow(_confirm(shingle, percent), "a long, b long")
    )
    return stored(found, "links")


def _first_round(spelled: DataFrame, shared_sets: int) -> DataFrame:
    """Each block of a group, with the same few sets of the group in all of them."""
    everywhere = F.pmod(F.xxhash64("no", F.lit(5)), F.greatest(F.col("members") / shared_sets, F.lit(1)).cast("long")) == 0
    own = F.when(everywhere, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    dealt = spelled.select("root", "no", "text", F.explode(own).alias("part"))
    return dealt.select(
        F.xxhash64("root", "part").alias("task"), "no", "text", F.lit(0).alias("side"), F.lit(False).alias("across")
    )


def _second_round(spelled: DataFrame, links: DataFrame, block_sets: int) -> DataFrame:
    """Sets outside the largest component of their group, with all others of the group."""
    large = spelled.where("parts > 1").select("no", "root", "shingles")
    met = components(links.join(large.select(F.col("no").alias("a")), "a", "left_semi"))
    label = F.coalesce("component", "no")
    named = large.join(met.select(F.col("node").alias("no"), F.col("root").alias("component")), "no", "left")
    named = stored(named.select("no", "root", label.alias("component")), "components")
    sizes = named.groupBy("root", "component").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("root").agg(
        F.max(F.struct("members", "component"))["component"].alias("largest"),
        F.sum("members").alias("members"),
        F.max("members").alias("most"),
    )
    blocks_of = lambda members: F.ceil(members / block_sets).cast("int")
    largest = largest.where("members > most").select(
        "root",
        "largest",
        blocks_of(F.col("members") - F.col("most")).alias("outside"),
        blocks_of(F.col("most")).alias("inside"),
    )
    open_ = spread_join(named, largest, ["root"])
    apart = F.col("component") != F.col("largest")
    part = F.when(apart, _dealt(open_, F.col("outside"), "no", 13)).otherwise(
        F.col("outside") + _dealt(open_, F.col("inside"), "no", 17)
    )
    last = F.when(apart, F.col("outside") + F.col("inside")).otherwise(F.col("outside")) - 1
    dealt = open_.select("no", "root", part.alias("side"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    dealt = dealt.select(
        "no",
        "side",
        (F.col("side") != F.col("other")).alias("across"),
        F.xxhash64("root", F.least("side", "other"), F.greatest("side", "other")).alias("task"),
    )
    return spread_join(dealt, spelled.select("no", "text"), ["no"])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    permutations: int = PERMUTATIONS,
    rows: int = ROWS,
    band_sets: int = BAND_SETS,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
    shared_sets: int = SHARED_SETS,
) -> DataFrame:
    """One row for each row: the id, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the least id reachable over links, the row's own included;
    ``kept`` says whether it is the row's. Null, empty and blank texts have no
    shingles and are linked with nothing. Null ids come after all others: in a group
    without any other id ``component_id`` is null and all its rows are kept. Rows
    with one id are rows of their own; rows repeated as a whole are kept together.
    An empty table gives no rows. Other columns play no part.
    """
    text_rows = docs.select(
        quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("text_hash"), quoted(text_col).alias("text")
    )
    id_type = text_rows.schema["id"].dataType.simpleString()
    signed = stored(
        text_rows.mapInArrow(
            _sign(shingle, permutations, rows),
            f"id {id_type}, text_hash long, h1 long, h2 long, shingles long, bands array<long>, sketch binary",
        ),
        "signatures",
    )
    representative = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "text_hash"))
    classes = (
        signed.where("shingles > 0")
        .groupBy("h1", "h2")
        .agg(
            representative.alias("row"),
            F.first("shingles").alias("shingles"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        .select("h1", "h2", "row.id", "row.text_hash", "shingles", "bands", "sketch")
    )
    # numbered as it is written, so that the numbers are the same whenever they are read
    classes = stored(classes.withColumn("no", F.monotonically_increasing_id()), "classes")

    reached = classes.select("no", F.explode("bands").alias("band"))
    full = reached.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    parts = F.ceil(F.col("members") / band_sets).cast("int")
    met = spread_join(reached, full.select("band", parts.alias("parts")), ["band"])
    met = met.withColumn("part", _dealt(met, F.col("parts"), "no", 11)).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    task = F.xxhash64("band", F.least("part", "other"), F.greatest("part", "other"))
    ties = (
        met.select("no", task.alias("task"))
        .join(classes.select("no", "sketch"), "no")
        .repartition("task")
        .sortWithinPartitions("task")
        .mapInArrow(_tie, "a long, b long")
    )

    found = stored(components(ties).withColumnRenamed("node", "no"), "candidates")
    weighed = found.join(classes.select("no", "id", "text_hash", "shingles"), "no")
    size = F.greatest(F.ceil(F.sum("shingles") / block_shingles), F.ceil(F.count("*") / block_sets)).cast("int")
    groups = weighed.groupBy("root").agg(size.alias("parts"), F.count("*").alias("members"))
    named = ["k1", "k2", "text_hash"]
    wanted = spread_join(weighed, groups, ["root"])
    wanted = wanted.select(
        *row_key(F.col("id"), id_type),
        "text_hash",
        "no",
        "root",
        "shingles",
        "parts",
        "members",
        _dealt(wanted, F.col("parts"), "no", 7).alias("part"),
    )
    # copies are folded before the texts are shuffled, and the join needs no other exchange
    texts = (
        text_rows.select(*row_key(F.col("id"), id_type), "text_hash", "text")
        .groupBy(*named)
        .agg(F.first("text").alias("text"))
    )
    spelled = stored(texts.join(wanted, named).drop(*named), "texts")
    links = _decided(_first_round(spelled, shared_sets), shingle, percent)
    more = _decided(_second_round(spelled, links, block_sets), shingle, percent)

    joined = components(links.unionByName(more)).withColumnRenamed("node", "no")
    grouped_ids = joined.join(classes.select("no", "id"), "no")
    smallest = grouped_ids.groupBy("root").agg(F.min("id").alias("component"))
    least = spread_join(grouped_ids, smallest, ["root"]).select("no", "component")
    known = classes.join(least, "no", "left").select("h1", "h2", F.coalesce("component", "id").alias("component"))
    on = whole_key(["h1", "h2"], "l") == whole_key(["h1", "h2"], "r")
    component = F.when(F.col("shingles") > 0, F.col("component")).otherwise(F.col("id"))
    return (
        signed.select("id", "h1", "h2", "shingles")
        .alias("l")
        .join(known.alias("r"), on, "left")
        .select(F.col("id").alias(id_col), F.col("shingles").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", quoted(id_col).eqNullSafe(F.col("component_id")))
    )
