"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Two texts are linked if the sets of their five-word shingles have a Jaccard
similarity of ``threshold`` or more. Equal texts are one class from the start.

1. *Forest.* Each text gets a signature of MinHashes, ``trees`` labels of up to
   ``depth`` values each. Every tree is a prefix trie of the sorted labels; its
   nodes are prefixes. The matched prefix is shortened from ``depth`` until a
   pair at the threshold shares a node of some tree with probability
   ``recall`` (``matched_depth``).
2. *Candidates.* In a node, texts are compared by whole signatures with a few
   leaders: a text far from every leader becomes the next one. A leader is tied
   to all texts that could be linked to something near it (Jaccard distance is a
   metric), so pairs over the threshold are connected by ties. A task gives each
   text one tie at most, to the first text it is connected with; pairs are never
   listed. Nodes too large for a task are dealt out as pairs of blocks.
3. *Verification.* Connected components of the ties hold all texts that may be
   linked. Within each, the sizes of all intersections come from products of
   shingle incidence matrices: every pair of a component is decided exactly,
   not just those that met in a node. Components over a task's size are dealt
   out as pairs of blocks; only counts and roots leave a task.

Texts of one to four words have one shingle, all their words. Texts without
words have no links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import quoted, row_key, spread_join, stored
from tidemark.llm.words import Block, blocks, grouped, powers, shingle_hashes

SHINGLE = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
RECALL = 0.9999
NODE_TEXTS = 4096
BLOCK_TEXTS = 2000
BLOCK_SHINGLES = 1_500_000

_NEAR, _FAR = 0.7, 0.2  # estimated similarity to a leader: covered by it, not tied to it


def matched_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest matched prefix whose forest finds pairs at the threshold with the target recall."""
    for matched in range(depth, 1, -1):
        if 1 - (1 - threshold**matched) ** trees >= recall:
            return matched
    return 1


def _signatures(block: Block, shingle: int, count: int) -> np.ndarray:
    """MinHashes of each text, 32 bits each; texts without words have all ones."""
    values, owner = shingle_hashes(block, shingle)
    out = np.full((len(block.rows), count), 0xFFFFFFFF, dtype=np.uint32)
    if not len(values):
        return out
    values = (values >> np.uint64(32)).astype(np.uint32)
    begins = np.flatnonzero(np.diff(owner, prepend=-1))
    factors = (powers(0x9E3779B97F4A7C15, count + 1)[1:] >> np.uint64(31)).astype(np.uint32) | np.uint32(1)
    shifts = (powers(0xC2B2AE3D27D4EB4F, count + 1)[1:] >> np.uint64(32)).astype(np.uint32)
    buffer = np.empty_like(values)
    for at in range(count):
        np.multiply(values, factors[at], out=buffer)
        np.add(buffer, shifts[at], out=buffer)
        out[owner[begins], at] = np.minimum.reduceat(buffer, begins)
    return out


def _sign(shingle: int, trees: int, matched: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        steps = powers(0xA0761D6478BD642F, matched)
        for batch in batches:
            for block in blocks(batch.column("text")):
                signs = _signatures(block, shingle, trees * matched)
                labels = signs.reshape(len(signs), trees, matched).astype(np.uint64)
                nodes = (labels * steps).sum(axis=2, dtype=np.uint64) ^ salt
                nodes = (nodes ^ (nodes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                words = np.diff(block.first)
                sizes = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
                rows = slice(block.rows.start, block.rows.stop)
                keep = [batch.column(name)[rows] for name in ("id", "h1", "h2")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *keep,
                        pa.array(sizes.astype(np.int64)),
                        pa.FixedSizeListArray.from_arrays(pa.array(nodes.view(np.int64).ravel()), trees).cast(
                            pa.list_(pa.int64())
                        ),
                        pa.array([row.tobytes() for row in signs.astype(np.uint8)], pa.binary()),
                    ],
                    names=["id", "h1", "h2", "shingles", "nodes", "signature"],
                )

    return run


def leaders(signs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each leader and the texts tied to it, by rows of the signature matrix."""
    open_ = np.ones(len(signs), dtype=bool)
    while True:
        rest = np.flatnonzero(open_)
        if not len(rest):
            return
        leader = rest[0]
        alike = (signs == signs[leader]).mean(axis=1)
        open_ &= alike < _NEAR
        open_[leader] = False
        tied = alike >= _FAR
        tied[leader] = False
        yield leader, np.flatnonzero(tied)


def connected(signs: np.ndarray) -> np.ndarray:
    """For each text, the first one that it is connected with over ties."""
    label = np.arange(len(signs))
    for leader, tied in leaders(signs):
        met = np.unique(label[np.append(tied, leader)])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    return label


def _tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in grouped(batches, "node"):
        node = table.column("node").to_numpy()
        keys = table.column("key").to_numpy()
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8)
        signs = signs.reshape(len(node), -1)
        bounds = np.flatnonzero(np.diff(node)) + 1
        left, right = [], []
        for begin, end in zip([0, *bounds], [*bounds, len(node)], strict=True):
            label = connected(signs[begin:end])
            tied = np.flatnonzero(label != np.arange(end - begin))
            left.append(keys[begin + label[tied]])
            right.append(keys[begin + tied])
        if left:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left), pa.string()), pa.array(np.concatenate(right), pa.string())],
                names=["a", "b"],
            )


def similar_pairs(
    sets: list[np.ndarray], blocks_of: np.ndarray, across: bool, threshold: float, columns: int = 4096
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets with at least the Jaccard similarity: all, or those across two blocks."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, shared = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.where(shared > 1, np.cumsum(shared > 1) - 1, -1)[column]
    first = np.flatnonzero(blocks_of == blocks_of.min()) if across else np.arange(len(sets))
    second = np.flatnonzero(blocks_of != blocks_of.min()) if across else first
    common = np.zeros((len(first), len(second)), dtype=np.float32)
    for low in range(0, int((shared > 1).sum()), columns):
        inside = (number >= low) & (number < low + columns)
        incidence = np.zeros((len(sets), columns), dtype=np.float32)
        incidence[owner[inside], number[inside] - low] = 1
        common += incidence[first] @ incidence[second].T
    together = sizes[first][:, None] + sizes[second][None, :]
    x, y = np.nonzero((common * (1 + threshold) >= threshold * together - 1e-3) & (common > 0))
    x, y = first[x], second[y]
    keep = slice(None) if across else x < y
    return x[keep], y[keep]


def _roots(count: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least index reachable from each, by repeated minima."""
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


def _verify(shingle: int, threshold: float):
    def decided(table: pa.Table) -> pa.RecordBatch:
        keys, at = np.unique(table.column("key").to_numpy(), return_index=True)
        texts = table.column("text").combine_chunks().take(pa.array(at))
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        sets: list[np.ndarray] = []
        for block in blocks(texts):
            values, owner = shingle_hashes(block, shingle)
            cuts = np.searchsorted(owner, np.arange(1, len(block.rows)))
            sets += [np.unique(part) for part in np.split(values, cuts)]
        x, y = similar_pairs(sets, table.column("part").to_numpy()[at], table.column("across")[0].as_py(), threshold)
        links = np.bincount(np.concatenate([x, y]), minlength=len(keys))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(links), pa.array(keys[_roots(len(keys), x, y)], pa.string())],
            names=["key", "links", "root"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "task"):
            task = table.column("task").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(task)) + 1), len(task)]
            for begin, end in zip(bounds, bounds[1:], strict=False):
                if end - begin > 1:
                    yield decided(table.slice(begin, end - begin))

    return run


def _block_pairs(df: DataFrame, parts: Column, group: Column, name: str) -> DataFrame:
    """Deals rows out to every pair of blocks of their group; ``name`` tells the pairs apart."""
    own = F.pmod(F.xxhash64("key", F.lit(11)), parts).cast("int")
    dealt = df.withColumn("part", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)))
    pair = F.xxhash64(group, F.least("part", "other"), F.greatest("part", "other"))
    return dealt.withColumn("across", F.col("part") != F.col("other")).withColumn(name, pair).drop("other")


def _class_key(h1: str, h2: str) -> Column:
    """The two hashes of a text as one name of its class."""
    return F.concat(F.hex(h1), F.lit("-"), F.hex(h2))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    node_texts: int = NODE_TEXTS,
    block_texts: int = BLOCK_TEXTS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row for each row: its text class, its group and its links.

    Columns: the id, ``class_id`` (least id of the rows with an equal text),
    ``n_copies`` (rows with an equal text), ``n_links`` (different texts linked
    to it), ``group_id`` (least id among the texts reachable over links),
    ``group_key`` (the text that has this id, the one with the least hashes if
    several do; it alone names the group where ids repeat or are null), and
    ``_h1``, ``_h2``, the two hashes of the text that name its class. Null texts
    are equal to each other. Other columns play no part.
    """
    matched = matched_depth(threshold, trees, depth, recall)
    h1, h2 = F.xxhash64(quoted(text_col)), F.xxhash64(F.lit(7), quoted(text_col))
    rows = docs.select(quoted(id_col).alias("id"), h1.alias("h1"), h2.alias("h2"), quoted(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = stored(
        rows.mapInArrow(
            _sign(shingle, trees, matched),
            f"id {id_type}, h1 long, h2 long, shingles long, nodes array<long>, signature binary",
        ),
        "signatures",
    )
    key = _class_key("h1", "h2")
    classes = signed.groupBy("h1", "h2").agg(
        F.min("id").alias("class_id"), F.count("*").alias("n_copies"), F.max("shingles").alias("shingles")
    )
    classes = stored(classes.withColumn("key", key), "classes")

    # candidates: the nodes of the forest that more than one text reaches
    texts = signed.where("shingles > 0").groupBy("h1", "h2").agg(
        F.first("nodes").alias("nodes"), F.first("signature").alias("signature")
    )
    texts = stored(texts, "texts")
    reached = texts.select("h1", "h2", F.explode("nodes").alias("node"))
    full = reached.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
    members = spread_join(reached, full, ["node"]).join(texts.drop("nodes"), ["h1", "h2"])
    members = members.select("node", "members", "signature", key.alias("key"))
    dealt = _block_pairs(members, F.ceil(F.col("members") / node_texts), F.col("node"), "node")
    ties = (
        dealt.select("node", "key", "signature")
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(_tie, "a string, b string")
    )

    # verification: all pairs of each component of ties
    found = stored(components(ties).withColumnRenamed("node", "key"), "components")
    weighed = found.join(classes.select("key", "class_id", "h1", "h2", "shingles"), "key")
    size = F.greatest(F.ceil(F.sum("shingles") / block_shingles), F.ceil(F.count("*") / block_texts))
    parts = weighed.groupBy("root").agg(size.alias("parts"))
    wanted = spread_join(weighed, parts, ["root"]).select(
        *row_key(F.col("class_id"), id_type), "h1", "h2", "key", "root", "parts"
    )
    # one row for each text: rows repeated as a whole are folded in the map tasks, and the join needs no other exchange
    named = ["k1", "k2", "h1", "h2"]
    unique = rows.select(*row_key(F.col("id"), id_type), "h1", "h2", "text").groupBy(*named).agg(F.first("text").alias("text"))
    spelled = unique.join(wanted, named)
    tasks = _block_pairs(spelled, F.col("parts"), F.col("root"), "task")
    verified = stored(
        tasks.select("task", "part", "across", "key", "text")
        .repartition("task")
        .sortWithinPartitions("task")
        .mapInArrow(_verify(shingle, threshold), "key string, links long, root string"),
        "links",
    )
    links = verified.groupBy("key").agg(F.sum("links").alias("n_links"))
    joined = components(verified.select(F.col("key").alias("a"), F.col("root").alias("b")))

    groups = joined.withColumnRenamed("node", "key").join(classes.select("key", "class_id"), "key")
    # ids may repeat or be null: the hashes in the key tell the groups apart
    first = F.struct(F.col("class_id").isNull().alias("absent"), "class_id", "key")
    least = groups.groupBy("root").agg(F.min(first).alias("first"))
    labels = spread_join(groups, least, ["root"]).select(
        "key", F.col("first.class_id").alias("group_id"), F.col("first.key").alias("group_key")
    )
    known = (
        classes.join(labels, "key", "left")
        .join(links, "key", "left")
        .select(
            "h1",
            "h2",
            "class_id",
            "n_copies",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.when(F.col("group_key").isNull(), F.col("class_id")).otherwise(F.col("group_id")).alias("group_id"),
            F.coalesce("group_key", "key").alias("group_key"),
        )
    )
    return spread_join(signed.select("id", "h1", "h2"), known, ["h1", "h2"]).select(
        F.col("id").alias(id_col),
        "class_id",
        "n_copies",
        "n_links",
        "group_id",
        "group_key",
        F.col("h1").alias("_h1"),
        F.col("h2").alias("_h2"),
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the least id of every group; rows equal in id and text count as one.

    Of different texts that share this id, the one with the least hashes stays.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    dtype = dict(docs.dtypes)[id_col]
    chosen = quoted(id_col).eqNullSafe(F.col("group_id")) & (_class_key("_h1", "_h2") == F.col("group_key"))
    first = found.where(chosen).select(*row_key(F.col(id_col), dtype), F.col("_h1").alias("k3"), F.col("_h2").alias("k4"))
    named = docs.select(
        *row_key(quoted(id_col), dtype),
        F.xxhash64(quoted(text_col)).alias("k3"),
        F.xxhash64(F.lit(7), quoted(text_col)).alias("k4"),
        F.struct(*(quoted(name) for name in docs.columns)).alias("row"),
    )
    key = ["k1", "k2", "k3", "k4"]
    # repeated rows are folded in the map tasks, and the join finds them where the grouping has left them
    alone = named.groupBy(*key).agg(F.first("row").alias("row"))
    return alone.join(first, key, "left_semi").select("row.*")
