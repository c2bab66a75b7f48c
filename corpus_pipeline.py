"""The corpus pipeline: five stages, each on all rows the one before kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next one's ``docs``.  All stages but the last return the columns of
``docs``, whatever they are, beside ``doc_id, text, source, n_chars``.  Nulls
and empty texts pass every stage; each stage leaves an empty table empty.

A stage begins by deleting the work tables of the stages before it, whose rows
have been written by then: write a stage's result before calling the next.  Work
tables of queries built outside the pipeline stay.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bwt, decontam, jaccard, mixing, ordinal
from tillroll.llm.common import release_work, row_key, stored, table, work_owner

#: A document goes when the probability of the top grade is below this.
QUALITY = 0.5
MIX_COLUMNS = ("text", "lang", "n_chars")


def _stage(work):
    """The stage with work tables of its own, after those of the stages before are gone."""
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_work(spark, "pipeline")
        with work_owner("pipeline"):
            return work(spark, docs, sf_dir)
    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the quality classifier rejects go.  Texts
    without a word carry no evidence and stay."""
    ratings = table(spark, sf_dir, "labels", "doc_id", "quality").withColumnRenamed("quality", "grade")
    model = ordinal.train(docs.select("doc_id", "text"), ratings)
    graded = ordinal.score(docs, model, names=("__grade", "__tail"))
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return graded.where((F.col("__tail") >= QUALITY) | empty).select(*docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each near-duplicate group stays."""
    return jaccard.one_of_each(docs)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: passages of 50 bytes or more that a smaller doc_id holds
    are cut out of the texts (whole characters).  Every document stays, some
    with an empty text; a null text becomes empty."""
    cut = bwt.remove_repeats(docs, characters=True, names=("__kept", "__bytes", "__removed", "__spans"))
    text = F.col("__kept").cast("string")
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark window of ten words go."""
    keyed = docs.withColumn("__key", row_key("doc_id", "text"))
    index = decontam.build_index(keyed.select("__key", "text"))
    found = decontam.search(index, table(spark, sf_dir, "benchmark", "item_id", "text"), size=10)
    hit = found.where(F.size("items") > 0).select(F.col("id").cast("long").alias("__key")).distinct()
    return keyed.join(hit, "__key", "left_anti").select(*docs.columns)


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: sources mixed to target weights.  Returns ``doc_id, source,
    text, lang, n_chars`` and ``size, source_size, target, taken, whole, part``."""
    mixed = mixing.mix(docs, keep=("source", *MIX_COLUMNS))
    return mixed.select("doc_id", "source", *MIX_COLUMNS, "size", "source_size", "target", "taken", "whole", "part")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("decontamination", decontamination), ("source_mix", source_mix)]

#: The classifier and the transform have no SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", work=False)
    return STAGES[-1][1](spark, docs, sf_dir)
