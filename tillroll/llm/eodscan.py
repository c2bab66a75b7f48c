"""Token counts of documents in flat, unindexed token files.

A token file is nothing but fixed-width identifiers; an end-of-document
identifier closes each document, and documents run across block borders.  A
vectorised search finds the identifiers inside each block; a prefix scan over
the blocks' summaries (tokens, documents closed, place of the last close)
stitches the borders: sums give each block's first token and first document, a
running maximum the last close before it.  The scan has two levels, over
blocks within a run of :data:`RUN` blocks and over the runs, so one file with
most of the blocks doesn't make one task.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import unique_name, work_path
from .common import note_work

BLOCK_TOKENS = 1 << 20
RUN = 1024
#: Fixed value: the split pattern that the byte-level vocabulary was made with.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Fixed value: the white space of the split pattern.
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LONG_SPACE = re.compile(f"{SPACE}{{1024,}}")


def encode_whole(encoding, text: str) -> list[int]:
    """The ids of a text with runs of white space of any length, over which the
    split pattern would overflow its stack.  The pattern makes one piece of
    such a run, but for its last character if a word follows (which goes with
    the word, or alone), so the run is encoded as that piece and the texts
    before and after by the pattern; the ids are the same."""
    out, at = [], 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encoding.encode_ordinary(text[at:run.start()])
        out += encoding._encode_single_piece(text[run.start():end].encode())
        at = end
    return out + encoding.encode_ordinary(text[at:])


def byte_pair_encoder(path: str) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """What makes a task's encoder from a vocabulary file (base64 token and
    rank a line).  The file is read here, once; the executors get its content."""
    with open(path, "rb") as f:
        content = f.read()

    def make():
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        encoding = tiktoken.Encoding("given", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [encode_whole(encoding, t) for t in texts]

    return make


def write_flat(docs: DataFrame, make_encoder: Callable, eod: int, width: int = 2,
               block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Token files of ``docs(doc_id, text)``: each task appends its documents
    to one stream, ``eod`` after each, cut into blocks of ``block_tokens``
    wherever that falls.  Returns the written ``(file, block, tokens)`` and
    ``(file, first, doc_ids)``, the order in which documents were appended.

    A null text is an empty document."""
    kind = np.dtype(f"<u{width}")

    def flat(batches):
        encode, file, block, first, rest = None, TaskContext.get().partitionId(), 0, 0, np.zeros(0, kind)
        for batch in batches:
            encode = encode or make_encoder()
            for low in range(0, batch.num_rows, 200):
                some = batch.slice(low, 200)
                parts = [rest]
                for ids in encode([t or "" for t in some.column(1).to_pylist()]):
                    parts += [np.array(ids, kind), np.array([eod], kind)]
                rest = np.concatenate(parts)
                n = len(rest) // block_tokens
                rows = [(file, block + i, rest[i * block_tokens:(i + 1) * block_tokens].tobytes()) for i in range(n)]
                block, rest = block + n, rest[n * block_tokens:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["ids"] + ["flat"] * n), pa.array([file] * (n + 1), pa.int64()),
                     pa.array([first] + [r[1] for r in rows], pa.int64()), pa.array([None] + [r[2] for r in rows], pa.binary()),
                     pa.array([some.column(0).to_pylist()] + [None] * n, pa.list_(pa.int64()))], names=names)
                first += some.num_rows
        if len(rest):
            yield pa.RecordBatch.from_arrays([pa.array(["flat"]), pa.array([file], pa.int64()), pa.array([block], pa.int64()),
                                              pa.array([rest.tobytes()], pa.binary()), pa.array([None], pa.list_(pa.int64()))], names=names)

    names = ["kind", "file", "number", "tokens", "doc_ids"]
    spark = docs.sparkSession
    schema = "kind string, file long, number long, tokens binary, doc_ids array<long>"
    path = work_path(spark, "llm", unique_name("token-files"))
    id_col, text = docs.columns
    (docs.select(F.col(id_col).cast("long"), text).mapInArrow(flat, schema)
     .write.partitionBy("kind").option("compression", "zstd").parquet(path))
    note_work(spark, path)
    written = spark.read.schema(schema).parquet(path)
    return (written.where("kind = 'flat'").select("file", F.col("number").alias("block"), "tokens"),
            written.where("kind = 'ids'").select("file", F.col("number").alias("first"), "doc_ids"))


def read_flat(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(file, block, tokens)`` of raw token files under ``path`` (each below
    2 GiB, which is what Spark's reader of whole files takes)."""
    step = width * block_tokens

    def cut(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                raw = memoryview(content.as_buffer())
                for i in range(-(-len(raw) // step)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()]), pa.array([i], pa.int64()), pa.array([bytes(raw[i * step:(i + 1) * step])], pa.binary())],
                        names=["file", "block", "tokens"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(cut, "file string, block long, tokens binary")


def count_tokens(blocks: DataFrame, eod: int, width: int = 2) -> DataFrame:
    """One row for each document of ``blocks(file, block, tokens)``: ``file,
    ordinal, start, n_tokens, closed``.  ``start`` is the first token's place
    in the file and ``n_tokens`` leaves the end identifier out; the last
    document of a file is not ``closed`` if tokens follow the last identifier.

    An empty document has 0 tokens; an empty or null block holds nothing; a
    file without an identifier is one open document; other columns are not
    read."""
    kind = np.dtype(f"<u{width}")

    def scan(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py() or b""
                ids = np.frombuffer(raw, kind, len(raw) // width)
                ends = np.flatnonzero(ids == eod).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([len(ids)], pa.int64()),
                     pa.array([ends], pa.list_(pa.int32()))], names=["file", "block", "n", "ends"])

    file_type = blocks.schema["file"].dataType.simpleString()
    found = blocks.select("file", F.col("block").cast("long").alias("block"), "tokens").mapInArrow(
        scan, f"file {file_type}, block long, n long, ends array<int>")
    found = found.withColumn("run", F.floor(F.col("block") / RUN)).withColumn("closes", F.size("ends").cast("long"))
    before = (Window.unboundedPreceding, -1)
    in_run = Window.partitionBy("file", "run").orderBy("block").rowsBetween(*before)
    zero = F.lit(0).cast("long")
    found = (found.withColumn("base0", F.coalesce(F.sum("n").over(in_run), zero))
             .withColumn("docs0", F.coalesce(F.sum("closes").over(in_run), zero))
             .withColumn("close0", F.when(F.col("closes") > 0, F.col("base0") + F.element_at("ends", -1)))
             .withColumn("prev0", F.max("close0").over(in_run)))
    runs = found.groupBy("file", "run").agg(F.sum("n").alias("run_n"), F.sum("closes").alias("run_docs"), F.max("close0").alias("run_close"))
    over = Window.partitionBy("file").orderBy("run").rowsBetween(*before)
    runs = (runs.withColumn("run_base", F.coalesce(F.sum("run_n").over(over), zero))
            .withColumn("run_first", F.coalesce(F.sum("run_docs").over(over), zero))
            .withColumn("run_prev", F.max(F.col("run_base") + F.col("run_close")).over(over)))
    at = found.join(runs.select("file", "run", "run_base", "run_first", "run_prev"), ["file", "run"])
    at = (at.withColumn("base", F.col("run_base") + F.col("base0")).withColumn("first", F.col("run_first") + F.col("docs0"))
          .withColumn("prev", F.coalesce(F.col("run_base") + F.col("prev0"), F.col("run_prev"), F.lit(-1).cast("long"))))
    closed = (at.select("file", "base", "first", "prev", "ends", F.posexplode("ends").alias("i", "end"))
              .withColumn("start", F.when(F.col("i") == 0, F.col("prev") + 1).otherwise(F.col("base") + F.element_at("ends", F.greatest(F.col("i"), F.lit(1))) + 1))
              .select("file", (F.col("first") + F.col("i")).alias("ordinal"), "start",
                      (F.col("base") + F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed")))
    rest = (runs.groupBy("file").agg(F.max(F.col("run_base") + F.col("run_n")).alias("size"), F.sum("run_docs").alias("ordinal"),
                                     F.coalesce(F.max(F.col("run_base") + F.col("run_close")) + 1, zero).alias("start"))
            .where("size > start").select("file", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")))
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, make_encoder: Callable, eod: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, file, ordinal, n_tokens`` for each row of ``docs(doc_id,
    text)``, by way of token files and the separator scan."""
    flat, order = write_flat(docs, make_encoder, eod, width, block_tokens)
    named = (order.select("file", "first", F.posexplode("doc_ids").alias("i", "doc_id"))
             .select(F.col("file").alias("in_file"), (F.col("first") + F.col("i")).alias("place"), "doc_id"))
    counted = count_tokens(flat, eod, width)
    return (counted.join(named, (F.col("file") == F.col("in_file")) & (F.col("ordinal") == F.col("place")))
            .select("doc_id", "file", "ordinal", "n_tokens"))
