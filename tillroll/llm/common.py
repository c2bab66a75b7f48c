"""Helpers shared by the operators: tables written to the shared folder,
sizes, and connected components."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path, unique_name, work_path

#: White space of the word definition ``[^\x20\x09-\x0D]+``.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table, and no others."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


_WORK: list[tuple[str, str, str, str | None]] = []   #: application, owner, folder, and table name if it is in the catalog
_OWNER = ContextVar("work_owner", default="")


@contextmanager
def work_owner(name: str):
    """Work tables written inside belong to ``name``."""
    before = _OWNER.set(name)
    try:
        yield
    finally:
        _OWNER.reset(before)


def note_work(spark: SparkSession, path: str, name: str | None = None) -> None:
    """Note a work table for :func:`release_work`."""
    _WORK.append((spark.sparkContext.applicationId, _OWNER.get(), path, name))


def release_work(spark: SparkSession, owner: str = "") -> None:
    """Delete the work tables that this application's operators have written
    for ``owner`` so far (outside any owner: those of single queries).  Call it
    when all results that read them have been written elsewhere."""
    for entry in [w for w in _WORK if w[:2] == (spark.sparkContext.applicationId, owner)]:
        if entry[3]:
            spark.sql(f"DROP TABLE IF EXISTS {entry[3]}")
        remove_path(spark, entry[2])
        _WORK.remove(entry)


def stored(df: DataFrame, label: str, partition_by: str | None = None, work: bool = True) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses do
    not compute it again, and a lost executor re-reads files.  The schema is
    given on reading, so an empty table stays readable.  A ``work`` table goes
    with :func:`release_work`; others stay."""
    spark = df.sparkSession
    path = work_path(spark, "llm", unique_name(label))
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if work:
        note_work(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one number, from which partition counts follow."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0])


def with_columns(schema: T.StructType, **kinds: str) -> T.StructType:
    """The schema with more columns (the given one is left alone)."""
    out = T.StructType(list(schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


def pieces(total: int, each: int, least: int = 1) -> int:
    """How many partitions of about ``each`` hold ``total``."""
    return max(least, -(-total // each))


def lower_ascii(c: Column | str) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(*columns: str) -> Column:
    """64 bits of the named columns' values; equal rows have equal keys."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000null")) for c in columns])


def sampled(docs: DataFrame, chosen: DataFrame, value: str) -> DataFrame:
    """``doc_id, text, value``: one row for each row of ``chosen(doc_id,
    value)`` whose document is in ``docs``, whatever the repeats there (the
    smallest text of a repeated document)."""
    asked = chosen.groupBy(F.col("doc_id").alias("asked_id")).agg(F.sort_array(F.collect_list(value)).alias("__values"))
    return (docs.select("doc_id", "text").join(F.broadcast(asked), F.col("doc_id") == F.col("asked_id"))
            .groupBy("doc_id", "__values").agg(F.min("text").alias("text"))
            .select("doc_id", "text", F.explode("__values").alias(value)))


#: Keys that hold more than this share's inverse of all rows are at most as many as it.
HOT = 1000


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` joined to ``keyed`` (one row for each of their keys, none
    null), of which ``weight`` says how many of the rows have that key.

    Keys of more than a thousandth of all rows, under a thousand of them, are
    broadcast, so that their rows stay where they are; the others are shuffled,
    and none of them can fill a task.  Pass written tables: both are read twice."""
    total = keyed.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    hot = keyed.where(F.col(weight) * HOT > total)
    cold = keyed.where(F.col(weight) * HOT <= total).drop(weight)
    of_hot = rows.join(F.broadcast(hot.drop(weight)), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return of_hot.unionByName(others)


#: Edges of one task of :func:`components`, at least.
EDGES = 50_000


def components(edges: DataFrame, label: str = "components", hubs: bool = False) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, root)``, root being
    the component's smallest node.

    Large-star and small-star steps in turn (Kiveris et al., 2014): each node's
    neighbours are linked to the smallest one, first the larger neighbours,
    then the smaller ones.  Each step is one aggregate for the smallest
    neighbour (combined before the shuffle, so a hub costs one row a task) and
    one join, which Spark may split where a hub is hot; with ``hubs`` they stay
    where they are (:func:`join_hot`), for two more written tables a round.  Every
    round is written to the shared folder; rounds end when all edges lead from
    a node with no other edge to its root (about the logarithm of the longest
    path).  A step's tasks are as many as the edges counted so far ask for."""
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct(), label)
    while True:
        tasks = pieces(2 * e.count(), EDGES)
        ends = (e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
                .unionByName(e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
                .groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")))
        if not ends.coalesce(tasks).where("up > 1 or up = 1 and down = 1").count():
            break
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("links"))
        least = stored(least, label) if hubs else least.drop("links")
        met = join_hot(both, least, "a", "links") if hubs else both.join(least, "a")
        large = (met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).where("a <> b").coalesce(tasks).distinct())
        large = stored(large.coalesce(tasks), label)
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("links"))
        least = stored(least, label) if hubs else least.drop("links")
        met = join_hot(large, least, "a", "links") if hubs else large.join(least, "a")
        small = (met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").coalesce(tasks).distinct())
        e = stored(small.coalesce(tasks), label)
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
