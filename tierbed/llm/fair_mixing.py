"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, gone through up to ``max_epochs``
times. A document's virtual finish time is the running size of its queue divided by the
source's weight. Documents are taken in order of finish time until the budget is full: a
queue that runs dry leaves its share to the others, by weight.

Everything after one scan works on (id, source, size, shuffle key). A queue is cut into
slices of the shuffle key, so a source with a third of all rows is summed in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierbed.llm.storage import fan_out, free_name, saved

SLICES = 1024


def word_count(text: Column) -> Column:
    """Number of runs of bytes other than ``[\\x20\\x09-\\x0D]``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, max_epochs: int) -> DataFrame:
    """``sources(source, source_size, weight)`` with the target of each source.

    The water level is the virtual time at which the queues together have given the budget,
    the sum of all sizes: a source gives ``least(max_epochs * size, weight * level)``. One row
    per source passes through the windows here, never documents.
    """
    limit = F.col("source_size") * max_epochs
    dry = limit / F.col("weight")  # virtual time at which the source has nothing left
    by_dry = Window.orderBy("dry", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        sources.withColumn("dry", dry)
        .withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("given", F.coalesce(F.sum(limit).over(by_dry), F.lit(0)))
        .withColumn(
            "open_weight",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_dry), F.lit(0)),
        )
        .withColumn("level", (F.col("budget") - F.col("given")) / F.col("open_weight"))
        # The level is the one found when the first source that does not run dry comes up.
        .withColumn(
            "level",
            F.min(
                F.when(F.col("level") <= F.col("dry"), F.struct("dry", "rank", "level"))
            ).over(everything)["level"],
        )
    )
    target = F.least(limit.cast("double"), F.col("weight") * F.col("level"))
    return levels.withColumn("target", target).drop("dry", "budget", "given", "open_weight")


def _ranked_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources by code point, null last, with repeating weights; one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    choice = F.array(*[F.lit(w) for w in weights])
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", rank)
        .withColumn("weight", F.get(choice, F.col("rank") % len(weights)))
    )


def shuffle_key(id_col: str, source_col: str, text_col: str, seed: int) -> Column:
    """60 bits of a digest of the row."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, source_col, text_col)]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _timed(queue: DataFrame, sources: DataFrame) -> DataFrame:
    """The queue with ``finish``, the virtual time at which its first pass has each document."""
    sliced = queue.withColumn("slice", F.shiftright("shuffle", 61 - SLICES.bit_length()))
    earlier = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        sliced.groupBy(F.col("source").alias("of"), F.col("slice").alias("at"))
        .agg(F.sum("size").alias("slice_size"))
        .withColumn("ahead", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    )
    within = Window.partitionBy("source", "slice").orderBy("shuffle")
    named = sources.withColumnRenamed("source", "source_name")
    return (
        sliced.withColumn("in_slice", F.sum("size").over(within))
        .join(slices, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
        .join(named, F.col("source").eqNullSafe(F.col("source_name")))
        .withColumn("queued", F.col("ahead") + F.col("in_slice"))
    )


def _finish(epoch: Column) -> Column:
    return (F.col("source_size") * epoch + F.col("queued")) / F.col("weight")


def _cut(timed: DataFrame, max_epochs: int) -> tuple | None:
    """The last place in the global order that the budget still holds; None if it holds none."""
    place = F.struct("finish", "shuffle", "epoch")
    entries = timed.select(
        "shuffle", "size", F.explode(F.array(*[F.lit(k) for k in range(max_epochs)])).alias("epoch"),
        "source_size", "queued", "weight",
    ).select(_finish(F.col("epoch")).alias("finish"), "shuffle", "epoch", "size")
    order = ["finish", "shuffle", "epoch"]
    ranges = saved(
        entries.repartitionByRange(fan_out(timed.sparkSession), *order).withColumn(
            "part", F.spark_partition_id()
        ),
        "mix-ranges",
    )
    # One row per range partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ranges.groupBy("part")
        .agg(F.sum("size").alias("n"), F.max(place).alias("last"))
        .withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    budget = timed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    whole = parts.filter(F.col("ahead") + F.col("n") <= budget).agg(F.max("last")).first()[0]
    edge = parts.filter(F.col("ahead") + F.col("n") > budget).agg(
        F.min(F.struct("part", "ahead")).alias("edge")
    ).first()["edge"]
    if edge is None:
        return whole
    running = F.sum("size").over(Window.partitionBy("part").orderBy(*order))
    inside = (
        ranges.filter(F.col("part") == edge["part"])
        .withColumn("total", running + F.lit(edge["ahead"]))
        .filter(F.col("total") <= budget)
        .agg(F.max(place).alias("last"))
        .first()["last"]
    )
    return inside or whole


def fair_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 7,
) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, copies, shuffle``.

    ``size`` counts words; ``copies`` is how often the mix takes the document (0 to
    ``max_epochs``) and ``taken`` is that many times its size. Weights go to the sources by
    code point, null last, and repeat. The budget is the sum of all sizes.

    Null texts have size 0. A null id is a document like any other. Rows alike in id, source
    and text share one place in the queue, and are taken or left together. Documents of size 0
    cost nothing; they are taken as their neighbours in the queue are. Other columns are
    ignored; an empty table gives no rows. Reruns agree: the order depends on the rows only.
    """
    queue = saved(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
            shuffle_key(id_col, source_col, text_col, seed).alias("shuffle"),
        ),
        "mix-queue",
    )
    sources = source_targets(_ranked_sources(queue, weights), max_epochs)
    timed = saved(_timed(queue, sources), "mix-times")
    cut = _cut(timed, max_epochs)
    copies = F.lit(0)
    if cut is not None:
        last = F.struct(F.lit(cut["finish"]), F.lit(cut["shuffle"]), F.lit(cut["epoch"]))
        for k in range(max_epochs):
            here = F.struct(_finish(F.lit(k)), F.col("shuffle"), F.lit(k))
            copies = copies + F.when(here <= last, 1).otherwise(0)
    return timed.withColumn("copies", copies).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        "shuffle",
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as it is taken, columns as they are,
    whatever their names.

    Null and empty texts have no words and are taken at no cost or not at all, as ``fair_mix`` says;
    repeated rows share their turns, and a long text is taken whole. An empty table gives no rows.
    """
    id_col = options.get("id_col", "doc_id")
    source_col, text_col = options.get("source_col", "source"), options.get("text_col", "text")
    key = shuffle_key(id_col, source_col, text_col, options.get("seed", 7))
    own, theirs, copies, copy = (free_name(docs, x) for x in ("own_key", "mix_key", "n_copies", "nth_copy"))
    taken = (
        fair_mix(docs, **options)
        .filter(F.col("copies") > 0)
        .groupBy(F.col("shuffle").alias(theirs))
        .agg(F.max("copies").alias(copies))
    )
    repeated = docs.withColumn(own, key).join(taken, F.col(own) == F.col(theirs))
    each = F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy)
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns], each).drop(copy)
