"""Insert-or-ignore, set based.

The first row per key wins, "first" meaning the smallest value of the given
arrival order; keys already in the target are left alone.  Keys and order columns
alone decide, by a hash aggregate with partial minima (so a key repeated across a
third of a placed batch costs one row a task) and an anti join to the target's keys.  The
full rows meet what won in one join, and those read from Parquet files stay
where they are: they are marked by their places in the files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import materialize

ARRIVAL = "_arrival"
_FILE, _BLOCK, _PLACE = "_arrival_file", "_arrival_block", "_arrival_place"
ARRIVAL_COLUMNS = (_FILE, _BLOCK, _PLACE)
_PLACE_BITS = 33                # of monotonically_increasing_id: the row's place in its partition


def note_file(df: DataFrame) -> DataFrame:
    """Add the file and the block of it that each row was read from.  A stream
    must ask for them at its source."""
    return df.withColumns({_FILE: F.col("_metadata.file_path"), _BLOCK: F.col("_metadata.file_block_start")})


def note_arrivals(df: DataFrame) -> DataFrame:
    """Add where each row was read: its file, the block of the file and the
    place among the rows read with it.  (Spark deals the blocks of many files to
    partitions by size, so the partition says nothing about their order.)  Rows
    that come from no file have their partition for a block.  Call it before
    any shuffle, write the result, and number it with :func:`number_arrivals`."""
    at = F.monotonically_increasing_id()
    if _FILE not in df.columns:
        try:
            df = note_file(df)
        except AnalysisException:
            df = df.withColumns({_FILE: F.lit(""), _BLOCK: F.shiftright(at, _PLACE_BITS)})
    return df.withColumns({_FILE: F.coalesce(_FILE, F.lit("")), _PLACE: at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))})


def number_arrivals(noted: DataFrame) -> DataFrame:
    """``_arrival`` in place of what :func:`note_arrivals` added to a table
    written since: rows by file path, then by place in the file.  The blocks,
    a row for each split that was read, are numbered in one small window and
    broadcast, so that the rows stay where they are."""
    blocks = noted.select(F.col(_FILE).alias("_f"), F.col(_BLOCK).alias("_b")).distinct()
    blocks = blocks.withColumn("_nth", F.row_number().over(Window.orderBy("_f", "_b")).cast("long"))
    return (noted.join(F.broadcast(blocks), (F.col(_FILE) == F.col("_f")) & F.col(_BLOCK).eqNullSafe(F.col("_b")))
            .withColumn(ARRIVAL, F.shiftleft("_nth", _PLACE_BITS) + F.col(_PLACE)).drop("_f", "_b", "_nth", *ARRIVAL_COLUMNS))


PLACE = "_place"
_ROW_BITS = 40                  # of a place: the row's index in its file
_BLOCK_BITS, _WORD_BITS = 10, 6  # places of a block of bits, and of one word of it
BROADCAST_BLOCKS = 500_000      # blocks that are broadcast, at most: half a billion rows, 90 MB


def number_places(df: DataFrame) -> DataFrame:
    """Add ``_place``: the number of the file (by path) that each row is read from and the
    row's index in it, as one number, which is the same whenever the files are
    read.  For rows straight from Parquet files: columns may have been added and
    rows left out, but none joined."""
    at = df.withColumns({"_file": F.col("_metadata.file_path"), PLACE: F.col("_metadata.row_index")})
    files = at.select(F.col("_file").alias("_f")).distinct()
    files = files.withColumn("_nth", F.row_number().over(Window.orderBy("_f")).cast("long"))
    return (at.join(F.broadcast(files), F.col("_file") == F.col("_f"))
            .withColumn(PLACE, F.shiftleft("_nth", _ROW_BITS) + F.col(PLACE)).drop("_file", "_f", "_nth"))


def _one_number(df: DataFrame, order: Sequence[str]) -> bool:
    return len(order) == 1 and isinstance(df.schema[order[0]].dataType, T.NumericType)


def _firsts(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each key (``_k0`` ...) with the first order (``_o0`` ...) of its rows."""
    if not order:
        raise ValueError("first_per_key needs the order of arrival")
    if _one_number(df, order):
        firsts = df.groupBy(*keys).agg(F.min(order[0]).alias("_o0"))
    else:
        firsts = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_o")).select(
            *keys, *[F.col(f"_o.{c}").alias(f"_o{i}") for i, c in enumerate(order)])
    return firsts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[f"_o{i}" for i in range(len(order))])


def _rows_of(firsts: DataFrame, df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    same += [F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(order)]
    picked = df.join(firsts, reduce(lambda a, b: a & b, same), "left_semi")
    return picked if ARRIVAL in order else picked.dropDuplicates(keys)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is smallest in ``order``: an arrival number
    (see :func:`number_arrivals`), or columns before it such as a batch stamp.
    An order without an arrival number may leave ties, of which one stays."""
    keys, order = list(keys), list(order)
    return _rows_of(_firsts(df, keys, order), df, keys, order)


def insert_or_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` to append to ``target``: first per key, minus keys
    the target already holds.  Rows that have been through :func:`number_places` stay
    in their tasks (and the places that won are written while the plan is
    built); other rows are shuffled once, by key and order, unless they consist of
    these alone."""
    keys, order = list(keys), list(order)
    held = target.select(*keys)
    if PLACE not in batch.columns:
        new = batch.select(*dict.fromkeys([*keys, *order])).join(held, keys, "left_anti")
        firsts = _firsts(new, keys, order)
        found = {c: f"_o{i}" for i, c in enumerate(order)} | {c: f"_k{i}" for i, c in enumerate(keys)}
        if set(batch.columns) <= set(found):
            return firsts.select(*[F.col(found[c]).alias(c) for c in batch.columns])
        return _rows_of(firsts, batch, keys, order)
    if not order:
        raise ValueError("insert_or_ignore needs the order of arrival")
    first = F.min_by(PLACE, order[0] if _one_number(batch, order) else F.struct(*order))
    won = batch.groupBy(*keys).agg(F.coalesce(first, F.min(PLACE)).alias(PLACE))     # where no row of a key has a number, one of them
    return _rows_at(won.join(held, keys, "left_anti"), batch).drop(PLACE)


def _rows_at(won: DataFrame, df: DataFrame) -> DataFrame:
    """The rows of ``df`` at the places in ``won``, which become a bit a row in blocks that
    are broadcast to the rows, or joined by block if there are too many."""
    words = 1 << (_BLOCK_BITS - _WORD_BITS)
    word = f"cast(shiftright({PLACE}, {_WORD_BITS}) & {words - 1} as int)"
    bit = f"cast({PLACE} & {(1 << _WORD_BITS) - 1} as int)"
    block = F.shiftright(PLACE, _BLOCK_BITS)
    marks = [F.coalesce(F.bit_or(F.expr(f"case when {word} = {i} then shiftleft(1L, {bit}) end")), F.lit(0).cast("long")) for i in range(words)]
    blocks, n = materialize(won.select(PLACE, block.alias("_block")).repartition("_block").groupBy("_block").agg(F.array(*marks).alias("_bits")), "places")
    marked = F.expr(f"shiftright(_bits[{word}], {bit}) & 1L = 1L")
    return df.join(F.broadcast(blocks) if n <= BROADCAST_BLOCKS else blocks, (block == F.col("_block")) & marked, "left_semi")
