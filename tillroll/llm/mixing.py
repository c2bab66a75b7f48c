"""Mixing sources to target weights: capped water-filling.

Each source has a weight and a size.  Targets share a total by weight; a
source whose share is above ``max_epochs`` times its size is clamped there,
and what it can't take is shared again among the others by weight, until no
share is above its cap.  The clamped sources are exactly a prefix of the
sources in the order of cap / weight, so the fixed point is read off running
sums over the per-source table instead of a loop of jobs.

A target is then met by whole repetitions of every document (``target`` div
size of the source) and one fractional repetition: the source's documents in
a seeded order, as many as the rest of the target holds, the last of them in
part.  So the words taken from a source are its target rounded down.

Only DataFrame functions are used.  The one thing gathered in a task is the
table of sources (three numbers each; the sort of that window spills).  The
running sum over a source's documents is cut into buckets of the seeded
order, about :data:`BUCKET_DOCS` documents each, so a source with a third of
all rows spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BUCKET_DOCS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def water_fill(sources: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """``sources(source, source_size, ...)`` with ``number`` and ``target``.
    Sources in code point order, null last, are numbered from 1 and weigh
    ``weights`` in turn; they share the sum of all sizes."""
    every = Window.partitionBy()
    turn = F.pmod(F.col("number") - 1, F.lit(len(weights)))
    big = "decimal(38,0)"
    s = (sources.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
         .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("bigint"))
         .withColumn("cap", F.col("source_size") * max_epochs)
         .withColumn("total", F.sum("source_size").over(every)))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    s = (s.withColumn("cap_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("clamped", F.col("cap").cast(big) * F.col("weight_left").cast(big)
                     <= F.col("weight").cast(big) * (F.col("total") - F.col("cap_before")).cast(big)))
    free = ~F.col("clamped")
    s = (s.withColumn("rest", F.col("total") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(every), F.lit(0)))
         .withColumn("free_weight", F.sum(F.when(free, F.col("weight"))).over(every))
         .withColumn("target", F.when(F.col("clamped"), F.col("cap").cast("double"))
                     .otherwise(F.col("weight") * (F.col("rest").cast("double") / F.col("free_weight").cast("double")))))
    return s.select(*sources.columns, "number", "target")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 17,
        keep: Sequence[str] = ()) -> DataFrame:
    """One row for each row of ``docs(doc_id, text, source)``: ``doc_id, size,
    source_size, target, taken, whole, part`` and the ``keep`` columns.
    ``taken = whole * size + part`` words; ``part`` is the fractional
    repetition, its first ``part`` words.

    Null texts and texts without words have size 0 and take nothing; null is a
    source of its own, the last.  Repeated rows are documents of their own.
    An empty table gives no rows.  Other columns are not read.  The order of
    the fractional repetition depends on ``seed`` and ``doc_id`` alone, so
    reruns agree."""
    sized = docs.select(
        F.col("doc_id"), word_count("text").alias("size"), F.col("source"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("place"),
        *[F.col(c).alias(f"kept_{c}") for c in keep])
    sized = stored(sized, "mix-sizes")
    sources = (sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs")))
    sources = stored(water_fill(sources, weights, max_epochs), "mix-sources").withColumnRenamed("source", "its_source")
    spread = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rows = (sized.join(sources, F.col("source").eqNullSafe(F.col("its_source")))
            .withColumn("bucket", F.floor(spread * F.ceil(F.col("source_docs") / F.lit(BUCKET_DOCS))))
            .withColumn("whole", whole)
            .withColumn("quota", F.floor("target").cast("bigint") - F.col("whole") * F.col("source_size")))
    # The rows (with the kept columns) are dealt by (number, bucket) once, for the window; the join finds them so.
    ahead = (rows.groupBy("number", "bucket").agg(F.sum("size").alias("in_bucket"))
             .withColumn("before_bucket", F.coalesce(F.sum("in_bucket").over(
                 Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .select("number", "bucket", "before_bucket"))
    inside = Window.partitionBy("number", "bucket").orderBy("place", "size")
    rows = (rows.withColumn("before_here", F.coalesce(F.sum("size").over(
                inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .join(ahead, ["number", "bucket"])
            .withColumn("before", F.col("before_bucket") + F.col("before_here"))
            .withColumn("part", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("quota") - F.col("before"))))
            .withColumn("taken", F.col("whole") * F.col("size") + F.col("part")))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "whole", "part",
                       *[F.col(f"kept_{c}").alias(c) for c in keep])
