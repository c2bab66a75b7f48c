"""Spelling variants by a dictionary of trie-node pairs.

1. The vocabulary is sorted; its words' prefixes are the nodes of a trie.  A
   partition of the sorted words numbers its nodes in one pass (a word shares
   the nodes of its common prefix with the word before); the prefixes that
   cross from one partition to the next are matched on the partitions' first
   and last words.  The reversed words number the suffixes in the same way.
2. A word with prefix nodes P and suffix nodes S gives two kinds of integer
   pairs: (P[i], S[i]) where a letter may be inserted, and (P[i], S[i+1])
   where letter i is skipped.  A node stands for one prefix or one suffix, so
   equal pairs are equal texts and no candidate needs a check: two words that
   skip to one pair differ by a replaced letter; a word that skips to a pair at
   which another may be inserted differs by an inserted or deleted one.  Of a
   run of equal letters only the first is skipped to meet insertions, so each
   neighbour is met once.
3. Words are distinct, so a pair is held by one word at most for each letter of
   the alphabet and by one that is whole: groups are small however large
   the vocabulary, and within them only counts and the best word are formed.
4. A word's *form* is its neighbour of largest count, if that is ``ratio`` times
   its own; following forms ends after log(count) steps at its *root*.
"""

from __future__ import annotations

import os
from operator import eq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, pieces, stored

LETTERS = "[A-Za-zÀ-ÿ]+"
LENGTH = 6
COUNT = 5
RATIO = 5
PART_WORDS = 100_000            # words of a sorted partition, about
_PART = 40                      # bits of a node's number within its partition


def slipped(run: Column, doc_id: Column, each: int) -> Column:
    """The run without one of its code points, in one of ``each`` occurrences,
    by the CRC of the document's id and the run (null id: empty)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % each == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, length: int = LENGTH, count: int = COUNT, slip: int | None = None) -> DataFrame:
    """``word, n``: the runs of letters of ``docs(doc_id, text)``, A-Z
    lower-cased, of at least ``length`` code points and ``count`` occurrences;
    with ``slip``, after :func:`slipped`."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower_ascii("text"), F.lit(LETTERS), F.lit(0))).alias("run"))
    word = F.col("run") if slip is None else slipped(F.col("run"), F.col("doc_id"), slip)
    return (runs.select(word.alias("word")).where(F.length("word") >= length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count))


def common_prefix(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


def _numbered(words: DataFrame, key: Column, parts: int) -> DataFrame:
    """``words(word, n)`` with ``number`` (ascending with the key) and ``nodes``,
    the trie nodes of the key's prefixes by length, from 0; ``again`` tells which
    letters repeat the one before."""
    ranged = words.withColumn("key", key).repartitionByRange(parts, "key").sortWithinPartitions("key")

    def number(batches):
        last, chain, node, place = "", [0], 0, 0
        for batch in batches:
            out, numbers, again = [], [], []
            for key, part in zip(batch.column("key").to_pylist(), batch.column("part").to_pylist(), strict=True):
                base = part << _PART
                same = common_prefix(last, key)
                chain = chain[:same + 1] + [base + node + i + 1 for i in range(len(key) - same)]
                node += len(key) - same
                place += 1
                last = key
                out.append(chain)
                numbers.append(base + place)
                again.append([False, *map(eq, key, key[1:])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), batch.column("key"), batch.column("part"), pa.array(numbers, pa.int64()),
                 pa.array(out, pa.list_(pa.int64())), pa.array(again, pa.list_(pa.bool_()))],
                names=["word", "n", "key", "part", "number", "nodes", "again"])

    table = stored(ranged.withColumn("part", F.spark_partition_id().cast("long"))
                   .mapInArrow(number, "word string, n long, key string, part long, number long, nodes array<long>, again array<boolean>"), "trie")
    # Two words for each partition: the nodes that a partition's first word has in common with the word before it.
    edges = table.groupBy("part").agg(F.min_by(F.struct("key", "nodes"), "number").alias("first"),
                                      F.max_by(F.struct("key", "nodes"), "number").alias("last")).orderBy("part").collect()
    known, before = {}, ("", [0])
    for part, first, last in edges:
        base = part << _PART
        known[part] = before[1][1:common_prefix(before[0], first.key) + 1]
        before = (last.key, [known[part][x - base - 1] if 0 < x - base <= len(known[part]) else x for x in last.nodes])

    def settle(batches):
        for batch in batches:
            out = []
            for part, nodes in zip(batch.column("part").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
                base, old = part << _PART, known[part]
                i = 1                                   # nodes common with an earlier partition lead the chain
                while i < len(nodes) and i <= len(old) and nodes[i] == base + i:
                    nodes[i] = old[i - 1]
                    i += 1
                out.append(nodes)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), batch.column("number"), batch.column("again"), pa.array(out, pa.list_(pa.int64()))],
                                             names=["word", "n", "number", "again", "nodes"])

    return table.mapInArrow(settle, "word string, n long, number long, again array<boolean>, nodes array<long>")


def _pairs(words: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """``word, n, number`` and ``(p, s, kind, n, number)``, the pairs of all
    words: kind 0 where a letter may be inserted, 1 where one is skipped, 2 where
    the one skipped repeats the letter before."""
    ahead = _numbered(words, F.col("word"), parts).withColumnRenamed("nodes", "prefixes")
    back = _numbered(words, F.reverse("word"), parts).select("word", F.reverse("nodes").alias("suffixes"))
    both = stored(ahead.join(back, "word"), "trie-words")
    size = F.size("prefixes")
    spots = both.select("n", "number", F.explode(F.arrays_zip(
        F.col("prefixes").alias("p"), F.col("suffixes").alias("s"), F.slice("suffixes", F.lit(2), size).alias("t"), "again")).alias("x"))
    kinds = F.array(F.struct(F.col("x.s").alias("s"), F.lit(0).alias("kind")),
                    F.struct(F.col("x.t").alias("s"), F.when(F.col("x.again"), 2).otherwise(1).alias("kind")))
    entries = (spots.select("n", "number", F.col("x.p").alias("p"), F.explode(kinds).alias("y"))
               .select("p", "y.s", "y.kind", "n", "number").where("s is not null"))
    return both.select("word", "n", "number"), entries


def neighbours(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """``word, n, number, n_near, best`` of the distinct ``words(word, n)``: how
    many others differ by one code point inserted, deleted or replaced (0 if
    none), and the best of them (the largest n, then the first in code-point order) as
    ``(m, number)``, m being -n.  ``number`` ascends with the word."""
    words = stored(words, "vocabulary")
    numbered, entries = _pairs(words, pieces(words.count(), part_words, 2))
    met = (entries.groupBy("p", "s")
           .agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "number", "kind"))).alias("held"))
           .where(F.size("held") > 1))
    firsts = F.filter("held", lambda x: x["kind"] == 1)
    each = met.select(F.explode("held").alias("x"), F.filter("held", lambda x: x["kind"] > 0).alias("skips"),
                      F.get(firsts, F.lit(0)).alias("first"), F.size(firsts).alias("firsts"),
                      F.get(F.filter("held", lambda x: x["kind"] == 0), F.lit(0)).alias("whole"))
    skip = F.col("x.kind") > 0
    replaced = F.when(F.get("skips", F.lit(0))["number"] != F.col("x.number"), F.get("skips", F.lit(0))).otherwise(F.get("skips", F.lit(1)))
    inserted = F.when(F.col("x.kind") == 1, F.col("whole"))
    best = F.when(skip, F.least(replaced, inserted)).otherwise(F.col("first"))
    near = F.when(skip, F.size("skips") - 1 + inserted.isNotNull().cast("int")).otherwise(F.col("firsts"))
    found = (each.select(F.col("x.number").alias("number"), near.alias("near"), best.alias("best")).where("near > 0")
             .groupBy("number").agg(F.sum("near").alias("n_near"), F.min(F.struct("best.m", "best.number")).alias("best")))
    return numbered.join(found, "number", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("long"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the distinct ``words(word, n)``:
    ``form`` is the best neighbour (see :func:`neighbours`) if its n is at least
    ``ratio`` times the word's, else null, and ``form_n`` its n; ``root`` ends the
    chain of forms, the word itself without one.  Words of any length and any
    script will do; ties go to the first word; no words give no rows."""
    if ratio < 2:
        raise ValueError("forms end only if each is more frequent than the word before")
    near = stored(neighbours(words), "neighbours")
    chosen = near.withColumn("up", F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best.number")))
    of_form = chosen.select(F.col("number").alias("up"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    # A form has few variants (its neighbours), so these joins have no hot key.
    chosen = stored(chosen.drop("best").join(of_form, "up", "left"), "forms")
    settled = chosen.where("up is null").select("number", F.col("word").alias("root"))
    waiting, rounds = chosen.where("up is not null").select("number", "up"), [settled]
    while not waiting.isEmpty():
        settled = stored(waiting.join(settled.withColumnRenamed("number", "up"), "up").select("number", "root"), "roots")
        waiting = stored(waiting.join(settled, "number", "left_anti"), "waiting")
        rounds.append(settled)
    roots = rounds[0]
    for more in rounds[1:]:
        roots = roots.unionByName(more)
    return chosen.join(roots, "number").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, length: int = LENGTH, count: int = COUNT, ratio: int = RATIO, slip: int | None = None) -> DataFrame:
    """:func:`variants` of the :func:`vocabulary` of ``docs(doc_id, text)``.
    Null and empty texts have no words; texts and runs of any length are read
    whole; repeated rows count again; a null id is empty text; other
    columns are not read."""
    return variants(vocabulary(docs, length, count, slip), ratio)
