"""Document fingerprints by SpotSigs, in DataFrame functions only.

Common words are anchors. Each occurrence of one, with the chain of the next two
content words that follow it, is a spot signature; a document's fingerprint is
the set of its signatures (Theobald, Siddharth and Paepcke, 2008). Frames of
navigation and lists of names have few common words, so the natural text of a
page decides.

Fingerprints are compared by Jaccard similarity. As that is at most the ratio of
the set sizes, sets fall into classes by size and only neighbouring classes can
hold pairs over a threshold; within them, two such sets share one of their rarest
signatures (``near_pairs``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import quoted, row_key, spread_join, stored
from tidemark.names import whole_key

CHAIN = 2
REACH = 8

# Anchors, frequent function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he his i in is it not of on or she that the this to was were with "
    "auf das dem den der des die ein eine er es für ich im ist mit nicht sich sie und von war zu "
    "au aux avec ce dans de des du elle en est et il je la le les ne on ou par pas pour que qui se sur un une "
    "al como con del el en es la las lo los no para por que se su un una y"
)
_MARKS = ".,;:!?()[]{}\"'`#*$%&|<>-_/\\@+=~^"


def _words(text: Column) -> Column:
    bare = F.translate(F.lower(text), _MARKS, "")
    return F.array_remove(F.split(bare, r"[\x20\x09-\x0D]+"), "")


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the sorted array of the signatures of a text column as ``name``.

    A signature is a 32-bit hash of the anchor and its chain; the chain is made
    of the first ``CHAIN`` content words among the ``REACH`` words after the
    anchor. A text without any such spot has every two neighbouring words as
    signatures, one with a single word that word, and one without words but not
    empty itself. Null and empty texts have none.
    """
    words, content = f"_{name}_words", f"_{name}_content"
    anchor = F.col(words)
    df = df.withColumn(words, _words(F.coalesce(F.col(text), F.lit(""))))
    common = sorted(set(ANCHORS.split()))
    df = df.withColumn(content, F.transform(words, lambda word: F.when(~word.isin(common), word)))

    def spot(word: Column, at: Column) -> Column:
        chain = F.slice(F.array_compact(F.slice(F.col(content), at + 2, F.lit(REACH))), 1, CHAIN)
        found = F.when(F.size(chain) > 0, F.hash(F.get(anchor, at), chain))
        return F.when(word.isNull(), found)

    spots = F.array_compact(F.transform(content, spot))
    df = df.withColumn(name, F.array_sort(F.array_distinct(spots)))
    pairs = F.transform(anchor, lambda word, at: F.hash(word, F.get(anchor, at + 1)))
    plain = (
        F.when(F.size(anchor) > 1, F.slice(pairs, F.lit(1), F.size(anchor) - 1))
        .when(F.size(anchor) == 1, pairs)
        .when(F.length(text) > 0, F.array(F.hash(text)))
        .otherwise(F.array().cast("array<int>"))
    )
    filled = F.when(F.size(name) > 0, F.col(name)).otherwise(F.array_sort(F.array_distinct(plain)))
    return df.withColumn(name, filled).drop(words, content)


def likeness(one: str, other: str) -> Column:
    """Jaccard similarity of two signature arrays without repeats; 1 if both are empty."""
    common = F.size(F.array_intersect(one, other))
    together = F.size(one) + F.size(other) - common
    return F.when(together == 0, F.lit(1.0)).otherwise(common / together)


def as_text(signatures: str) -> Column:
    """A fingerprint as text: its signatures in order, eight hex digits each."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def followers(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each document and the one after it by descending id, the first after the last.

    Columns ``id``, ``text_hash``, ``n_chars``, ``next_id``, ``next_hash``. Rows
    equal in id and text stand as one; equal ids are in the order of the hashes.
    Ids are dealt out by ranges and ordered in each; the ranges, one row each,
    are joined up at their ends.
    """
    n_chars = F.coalesce(F.length(quoted(text_col)), F.lit(0)).cast("long")
    keys = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("text_hash"), n_chars.alias("n_chars"))
    order = [F.col("id").desc_nulls_last(), F.col("text_hash").desc()]
    ranged = stored(
        keys.distinct().repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "order"
    )
    key = F.struct("id", "text_hash")
    inside = Window.partitionBy("range").orderBy(*order)
    place = F.row_number().over(inside)
    rows = ranged.withColumn("place", place).withColumn("next", F.lead(key).over(inside))
    first = rows.where("place = 1").select("range", key.alias("first"))
    over = Window.orderBy("range")
    ends = first.withColumn("after", F.lead("first").over(over))
    start = F.min_by("first", "range").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.withColumn("after", F.coalesce("after", start)).drop("first")
    following = F.coalesce("next", "after")
    return rows.join(ends, "range").select(
        "id", "text_hash", "n_chars", following["id"].alias("next_id"), following["text_hash"].alias("next_hash")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of an edited text and of the next document.

    The edited text has the last half of the code points replaced by as many of
    the first ones of the next document. Columns: the id, ``n_chars``,
    ``edited``, ``signatures``, ``edited_signatures``, ``near_edited``,
    ``near_next``. Other columns play no part. Null texts are empty.
    """
    # both joins start from one and the same exchange of the texts
    id_type = dict(docs.dtypes)[id_col]

    def key(at: Column, hashed: Column) -> list[Column]:
        return [*row_key(at, id_type), hashed.alias("k3")]

    rows = docs.select(
        *key(quoted(id_col), F.xxhash64(quoted(text_col))), F.coalesce(quoted(text_col), F.lit("")).alias("text")
    )
    order = stored(followers(docs, id_col, text_col), "followers")
    asked = order.select(
        *key(F.col("next_id"), F.col("next_hash")), F.struct(*key(F.col("id"), F.col("text_hash"))).alias("by"), "n_chars"
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    sent = with_signatures(rows.join(asked, ["k1", "k2", "k3"]), "text", "next_signatures").select(
        "by.*",
        "n_chars",
        F.substring("text", F.lit(1), half).alias("head"),
        "next_signatures",
    )
    # a following row that is there several times has sent the same several times
    both = rows.join(sent.dropDuplicates(["k1", "k2", "k3"]), ["k1", "k2", "k3"])
    both = both.withColumn("id", F.when(~F.col("k2"), F.col("k1")))
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half)
    both = both.select("id", "text", "n_chars", F.concat(kept, "head").alias("edited"), "next_signatures")
    both = with_signatures(with_signatures(both, "text", "signatures"), "edited", "edited_signatures")
    return both.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited",
        "signatures",
        "edited_signatures",
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
    )


def near_pairs(sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs of different fingerprints with at least the likeness, from ``id`` and ``signatures``.

    Equal sets are one class, named by two hashes of the set, as ids may be null or
    equal; the result has ``a``, ``b`` (the least ids of the two classes), ``a_key``,
    ``b_key`` (their names, ``a_key`` the less) and ``likeness``. Sets are partitioned
    by size so that only a class of sizes and the next can hold a pair; there, each
    set is found by its rarest signatures only, as many as a pair over the threshold
    cannot all miss. Empty sets are in no pair.
    """
    named = sets.where(F.size("signatures") > 0).withColumn(
        "key", F.concat(F.hex(F.xxhash64("signatures")), F.lit("-"), F.hex(F.xxhash64(F.lit(7), "signatures")))
    )
    classes = named.groupBy("key").agg(F.min("id").alias("id"), F.first("signatures").alias("signatures"))
    classes = stored(classes.withColumn("count", F.size("signatures")), "sets")
    seen = classes.select(F.explode("signatures").alias("signature")).groupBy("signature").agg(F.count("*").alias("seen"))
    spread = spread_join(classes.select("key", "count", F.explode("signatures").alias("signature")), seen, ["signature"])
    rarest = Window.partitionBy("key").orderBy("seen", "signature")
    most = F.col("count") - F.ceil(F.lit(threshold) * F.col("count")) + 1
    step = math.log(1 / threshold) if threshold < 1 else 1.0
    indexed = (
        spread.withColumn("place", F.row_number().over(rarest))
        .where(F.col("place") <= most)
        .select("key", "count", "signature", F.floor(F.log("count") / step).alias("size_class"))
    )
    other = indexed.withColumn("size_class", F.explode(F.array(F.col("size_class"), F.col("size_class") + 1))).select(
        F.col("key").alias("other"), F.col("count").alias("other_count"), "signature", "size_class"
    )
    fits = (F.col("other_count") >= threshold * F.col("count")) & (F.col("count") >= threshold * F.col("other_count"))
    on = whole_key(["signature", "size_class"], "l") == whole_key(["signature", "size_class"], "r")
    pairs = (
        indexed.alias("l")
        .join(other.alias("r"), on)
        .where(fits & (F.col("key") != F.col("other")))
        .select(F.least("key", "other").alias("a_key"), F.greatest("key", "other").alias("b_key"))
        .distinct()
    )
    one, two = (
        classes.select(F.col("key").alias(f"{side}_key"), F.col("id").alias(side), F.col("signatures").alias(f"_{side}"))
        for side in "ab"
    )
    found = pairs.join(one, "a_key").join(two, "b_key").withColumn("likeness", likeness("_a", "_b"))
    return found.where(F.col("likeness") >= threshold).select("a", "b", "a_key", "b_key", "likeness")
