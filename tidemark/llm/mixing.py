"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source, documents stand in the
order of their keys; the mix takes as many whole epochs of the source as its
budget holds and then documents up to the key where the running number of words
meets the rest of the budget exactly.

The running sum is found in two steps. Keys are cut into ranges; the words of
each range are summed where they lie, and the sums are accumulated over the
ranges. Only the documents of the one range that holds the cut are sorted. The
result is a row per source, cut key and all, and every document compares its
own key with it: no document is moved by its source, so a source with a third
of all rows is no heavier than others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import quoted, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
RANGE_DOCS = 20_000
SEED = 1


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``target`` for each row of ``source`` and ``source_size``, one row a source.

    Sources by code point, null last, get the weights in turn. Shares are
    proportional to them, capped at ``most`` times the source's size, the excess
    reshared by weight. So a target is the cap or a common level times the
    weight: in ascending order of cap over weight, the level is found at the
    first source that its share doesn't fill. There is a row per source only.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    cap = F.col("source_size") * F.lit(float(most))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn("cap", cap)
    fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighed.withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(rest))
        .withColumn("place", F.row_number().over(fill))  # sources may be alike
        .withColumn("own", F.when(F.col("level") <= F.col("fill"), F.struct("place", "level")))
    )
    level = F.min("own").over(everything)["level"]
    return levels.withColumn("level", level).select(
        "source",
        "source_size",
        F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target"),
    )


def _cuts(sized: DataFrame, targets: DataFrame, range_docs: int) -> DataFrame:
    """By source: target, whole epochs, and the place and number of words of the cut."""
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    goals = targets.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    bits = max(1, (sized.count() // range_docs).bit_length())
    ranged = sized.withColumn("range", F.shiftright("key", 64 - bits))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = sums.withColumn("upto", F.sum("words").over(order)).withColumn("before", F.col("upto") - F.col("words"))
    goals = goals.withColumnRenamed("source", "_source")
    hit = upto.join(goals, F.col("source").eqNullSafe(F.col("_source"))).where(
        (F.col("rest") >= F.col("before")) & (F.col("rest") < F.col("upto"))
    )
    hit = hit.select("_source", F.col("range").alias("_range"), "before", "rest")
    near = (
        ranged.join(hit, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")))
        .groupBy("source", "before", "rest", "key", "text_hash")
        .agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    )
    running = Window.partitionBy("source").orderBy("key", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("words").over(running), F.lit(0))
    cut = (
        near.withColumn("start", start)
        .where((F.col("rest") >= F.col("start")) & (F.col("rest") < F.col("start") + F.col("words")))
        .select(
            F.col("source").alias("_cut_source"),
            F.struct("key", "text_hash").alias("cut"),
            F.floor((F.col("rest") - F.col("start")) / F.col("rows")).alias("cut_words"),
        )
    )
    return goals.join(cut, F.col("_source").eqNullSafe(F.col("_cut_source")), "left").drop("_cut_source", "rest")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    range_docs: int = RANGE_DOCS,
    seed: int = SEED,
) -> DataFrame:
    """All columns, with ``size``, ``source_size``, ``target`` and ``taken``.

    ``taken`` counts the words the mix takes of a row, repeats included: its
    size for each epoch it is in, and a part of it at the cut. Sums of a source
    meet its target to within a word for each row repeated at the cut. Null and
    wordless texts have size 0 and nothing is taken; null sources are a source.
    Rows with equal ids and texts take equal shares. The same input gives the
    same mix. Columns of those names are replaced.
    """
    size = F.coalesce(F.regexp_count(quoted(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    source = quoted(source_col)
    key = F.xxhash64(quoted(id_col), quoted(text_col), F.lit(seed))
    sized = stored(
        docs.select(
            source.alias("source"), key.alias("key"), F.xxhash64(quoted(text_col)).alias("text_hash"), size.alias("size")
        ),
        "sizes",
    )
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    # written, so that its size is known where it is joined: Spark sends a small one to the documents
    cuts = stored(_cuts(sized, stored(targets, "targets"), range_docs), "cuts")
    named = docs.select(
        F.struct(*(quoted(name) for name in docs.columns)).alias("_row"),
        source.alias("_of"),
        F.struct(key.alias("key"), F.xxhash64(quoted(text_col)).alias("text_hash")).alias("_place"),
        size.alias("_size"),
    )
    rest = F.when(F.col("cut").isNull() | (F.col("_place") > F.col("cut")), 0).when(
        F.col("_place") < F.col("cut"), F.col("_size")
    ).otherwise(F.col("cut_words"))
    own = {"size", "source_size", "target", "taken"}
    return named.join(cuts, F.col("_of").eqNullSafe(F.col("_source"))).select(
        *(F.col("_row")[name].alias(name) for name in docs.columns if name.lower() not in own),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("epochs") * F.col("_size") + rest).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, the row at a cut by the nearer whole number."""
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    found = mix(docs, **options).withColumn("_copies", copies).where("_copies > 0")
    repeated = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    return repeated.select(*(quoted(name) for name in docs.columns))
