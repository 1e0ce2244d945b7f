"""Mixing sources to target weights: capped water-filling and seeded repetitions.

DataFrame functions only. Each source's share of the budget is proportional to
its weight; a source that would be repeated more than ``max_epochs`` times is
clamped there and its excess goes to the others by weight, until none is
above. A source's target is then taken as whole repetitions of all its
documents and a fractional one: its documents in a seeded order, up to the
remaining words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import range_dealt, stored, with_running_sum, words_count


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, source_size) with the sum of ``size`` of each source."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def ranked_weights(sources: DataFrame, weights: list[float]) -> DataFrame:
    """Add ``weight``: ``weights`` in turn over the sources by code point, NULL last.

    The rank is a two-level one (place inside a range, ranges before it), so
    the number of sources is not bounded by a task. ``sources`` holds a source once
    (NULL is one of them) and no column called weight, _part, _rank or _offset; an
    empty table stays empty.
    """
    order = [F.col("source").isNull().asc(), F.col("source").asc()]
    dealt = range_dealt(sources, order, "mix-sources")
    counts = dealt.groupBy("_part").agg(F.count("*").alias("n"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = counts.select("_part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    placed = dealt.withColumn("_rank", rank).join(offsets, "_part")
    turn = F.pmod(F.col("_rank") + F.col("_offset"), F.lit(len(weights))).cast("int")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    return placed.withColumn("weight", F.element_at(listed, turn + 1)).drop("_part", "_rank", "_offset")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    Rounds of one aggregate each: with the sources clamped so far at
    ``max_epochs`` times their size, the rest share what is left of ``budget``
    by weight; those above their cap are clamped next. Ends when no further
    source is. Two totals a round reach the driver. Where the caps together
    stay below the budget, every source is clamped. A source of size 0 has target 0.
    A NULL size or weight is an error of the caller and gives a NULL target. An empty
    table stays empty.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        # Whether a source is clamped depends on the last level alone: levels only rise.
        free = F.col("weight") * F.lit(level) <= cap
        row = sources.agg(
            F.coalesce(F.sum(F.when(free, F.lit(0.0)).otherwise(cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(free, F.col("weight")).otherwise(F.lit(0.0))), F.lit(0.0)),
            F.count(F.when(~free, F.lit(1))),
        ).first()
        held, weight, now = row
        if now == clamped or not weight:
            break
        clamped, level = now, (budget - held) / weight
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(free, share).otherwise(cap))


def seeded_order(id_col: Column, text: Column, seed: int) -> Column:
    """The place of a document in its source's seeded order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def mix(
    docs: DataFrame,
    weights: list[float],
    budget_ratio: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, place, source, size, source_size, target, whole, taken) for each row.

    size: words of the text (NULL: 0); target: the source's share of
    ``budget_ratio`` times all words; whole: repetitions every document of the
    source gets; taken: the words the mix takes of this one, repetitions
    counted. The fractional repetition takes the source's documents in a seeded
    order (``place``) until the target's words are used up, the last in part,
    so a source's taken words are its target rounded down.

    Weights go round over the sources by code point; a NULL source is one source
    of its own, ranked last. Rows that repeat an id are documents of their own;
    fully equal rows may exchange their taken words. Empty texts take 0 words,
    and sources of size 0 have target 0. Other columns are ignored. An empty
    table gives no rows.
    """
    sized = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            words_count(F.col(text_col)).alias("size"),
            seeded_order(F.col(id_col), F.col(text_col), seed).alias("place"),
        ),
        "mix-sizes",
    )
    sources = stored(ranked_weights(source_sizes(sized), weights), "mix-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    targets = water_fill(sources, budget_ratio * total, max_epochs).select(
        F.col("source").alias("_source"), "source_size", "target"
    )
    run = with_running_sum(
        sized, ["source"], [F.col("place"), F.col("doc_id"), F.col("size")], F.col("size"), "upto", "mix-order"
    )
    rows = run.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("whole", whole)
    rest = F.floor(F.col("target")).cast("long") - F.col("whole") * F.col("source_size")
    start = F.col("upto") - F.col("size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - start))
    return rows.select(
        "doc_id", "place", "source", "size", "source_size", "target", "whole", (F.col("whole") * F.col("size") + part).alias("taken")
    )


def repeat_documents(docs: DataFrame, mixed: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as ``mixed`` takes them, whole documents
    only: one cut by the end of its source's target stays when at least half of
    it is taken. A document without words is taken as often as its source's
    documents are in whole. Columns are those of ``docs``.

    Rows are matched by (id, place), and rows equal in both share their copies
    out: as many in all as ``mixed`` takes of them. NULL ids and texts are matched
    like any other; empty tables give no rows; columns of any name are carried along.
    """
    whole_copies = F.when(
        F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + F.lit(0.5))
    ).otherwise(F.col("whole"))
    copies = mixed.select("doc_id", "place", whole_copies.cast("long").alias("n"))
    copies = copies.groupBy("doc_id", "place").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).filter(F.col("n") > 0)
    placed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), seeded_order(F.col(id_col), F.col(text_col), seed).alias("at")
    )
    joined = placed.join(copies, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("at") == F.col("place")))
    # Rows that repeat id and text share their copies out, the first n mod rows of them
    # one more; only they are numbered.
    single = joined.filter(F.col("rows") == 1).withColumn("k", F.col("n"))
    nth = F.row_number().over(Window.partitionBy("id", "at").orderBy("at"))
    several = joined.filter(F.col("rows") > 1).withColumn("nth", nth)
    several = several.withColumn("k", F.floor(F.col("n") / F.col("rows")) + (F.col("nth") <= F.col("n") % F.col("rows")).cast("long")).drop("nth")
    every = single.unionByName(several).filter(F.col("k") > 0)
    return every.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k")))).select("row.*")
