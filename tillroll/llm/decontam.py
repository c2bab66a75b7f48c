"""Benchmark decontamination with a distributed positional inverted index.

*Index.*  The training texts are cut into blocks of whole rows, about
:data:`BLOCK` bytes each.  A block's row holds its terms (64-bit hashes, in
order), where each term's postings begin, and the postings: every position of
every token, rising within a term.  The index is written to the shared folder
without a shuffle and serves any later benchmark.

*Search.*  A benchmark item gives windows of ``size`` consecutive words (an
item of fewer words gives one).  Posting counts, summed over all blocks, order
a window's terms from the rarest.  In each block the rarest term's postings,
less its offset in the window, are the candidate starts; the next rarest
term's offset-adjusted list is intersected with them, and so on.  What remains
are exact phrases.  A proximity match has all the window's terms within
``slack`` words of its rarest term, in one document.

Windows go to the blocks in chunks of at most :data:`CHUNK` (the stated query
set against all rows, in blocks); that is all that is ever sent along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import U64, column_bytes, slices, word_bytes, words
from .common import pieces, stored

BLOCK = 4 << 20
CHUNK = 200_000
_INDEX = "block long, ids array<string>, n_words array<int>, terms binary, starts binary, postings binary"


def build_index(docs: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """The stored index of ``docs(id, text)``: one row a block.  Positions
    count words within the block, with a gap between rows, so that no phrase
    crosses documents.  ``ids`` are the rows' ids as text."""
    def indexed(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, off = column_bytes(batch.column(1))
            for low, high, part, at in slices(data, off, block_bytes):
                h, edges = words(part, at, word_bytes("term"))
                place = (np.arange(len(h)) + np.repeat(np.arange(high - low), np.diff(edges))).astype(np.uint32)
                order = np.argsort(h, kind="stable")
                sorted_h = h[order]
                new = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), sorted_h[1:] != sorted_h[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([ids[low:high]], pa.list_(pa.string())),
                     pa.array([np.diff(edges).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([sorted_h[new].tobytes()], pa.binary()),
                     pa.array([np.append(new, len(h)).astype(np.uint32).tobytes()], pa.binary()),
                     pa.array([place[order].tobytes()], pa.binary())],
                    names=["block", "ids", "n_words", "terms", "starts", "postings"])
                number += 1

    first, text = docs.columns
    return stored(docs.select(F.col(first).cast("string"), text).mapInArrow(indexed, _INDEX), "positional-index")


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows of ``items(item_id, text)``: ``(terms, items)``."""
    def cut(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, off = column_bytes(batch.column(1))
            for low, high, part, at in slices(data, off):
                h, edges = words(part, at, word_bytes("term"))
                h = h.view(np.int64)
                for row in range(high - low):
                    own = h[edges[row]:edges[row + 1]]
                    if len(own):
                        n = min(size, len(own))
                        seen = np.unique(np.lib.stride_tricks.sliding_window_view(own, n), axis=0)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([ids[low + row]] * len(seen), pa.string()), pa.array(list(seen), pa.list_(pa.int64()))],
                            names=["item_id", "terms"])

    first, text = items.columns
    cut_rows = items.select(F.col(first).cast("string"), text).mapInArrow(cut, "item_id string, terms array<long>")
    return cut_rows.groupBy("terms").agg(F.collect_set("item_id").alias("items"))


class Queries:
    """A chunk of windows, grouped by length, with their terms ordered from
    the rarest by ``counts`` (hash -> postings in the whole index)."""

    def __init__(self, rows: list, counts: dict[int, int]):
        self.terms = np.unique(np.array([t for r in rows for t in r.terms], np.int64).view(U64))
        held = np.array([counts.get(int(t), 0) for t in self.terms.view(np.int64)])
        self.groups = []
        for n in sorted({len(r.terms) for r in rows}):
            own = sorted((r for r in rows if len(r.terms) == n), key=lambda r: tuple(r.terms))
            term = np.searchsorted(self.terms, np.array([r.terms for r in own], np.int64).view(U64))
            keep = np.flatnonzero((held[term] > 0).all(axis=1))
            order = np.argsort(held[term[keep]], axis=1, kind="stable")
            self.groups.append((n, np.take_along_axis(term[keep], order, 1), order, [sorted(own[i].items) for i in keep]))


def _intersect(block: dict, q: Queries, slack: int | None):
    """Exact matches ``(start, length, group, window)`` and proximity matches
    ``(position, group, window)`` of a block."""
    terms, starts = np.frombuffer(block["terms"], U64), np.frombuffer(block["starts"], np.uint32).astype(np.int64)
    postings = np.frombuffer(block["postings"], np.uint32)
    if not len(terms) or not len(q.terms):
        return
    local = np.minimum(np.searchsorted(terms, q.terms), len(terms) - 1)
    here = terms[local] == q.terms
    used = np.flatnonzero(here)
    count = np.zeros(len(q.terms), np.int64)
    count[used] = starts[local[used] + 1] - starts[local[used]]
    base = np.concatenate([[0], np.cumsum(count)])
    if not base[-1]:
        return
    flat = np.repeat(starts[local] - base[:-1], count) + np.arange(base[-1])
    places = postings[flat].astype(U64)
    keys = (np.repeat(np.arange(len(q.terms)), count).astype(U64) << U64(32)) | places   # rising: (term, position)
    for g, (n, term, offset, _) in enumerate(q.groups):
        alive = np.flatnonzero(here[term].all(axis=1)) if len(term) else np.zeros(0, np.int64)
        if not len(alive):
            continue
        rare = term[alive, 0]
        window = np.repeat(alive, count[rare])
        at = np.repeat(base[rare] - np.concatenate([[0], np.cumsum(count[rare])[:-1]]), count[rare]) + np.arange(len(window))
        place = places[at].astype(np.int64)
        start, who = place - offset[window, 0], window
        keep = start >= 0
        start, who = start[keep], who[keep]
        for k in range(1, n):
            want = (term[who, k].astype(U64) << U64(32)) | (start + offset[who, k]).astype(U64)
            keep = keys[np.minimum(np.searchsorted(keys, want), len(keys) - 1)] == want
            start, who = start[keep], who[keep]
        yield "phrase", g, who, start
        if slack is not None:
            first = np.asarray(block["first"])
            row = np.searchsorted(first, place, "right") - 1
            low, high = np.maximum(place - slack, first[row]), np.minimum(place + slack, first[row + 1] - 2)
            who = window
            for k in range(1, n):
                tag = term[who, k].astype(U64) << U64(32)
                got = keys[np.minimum(np.searchsorted(keys, tag | low.astype(U64)), len(keys) - 1)]
                keep = (got >= tag | low.astype(U64)) & (got <= tag | high.astype(U64))
                who, low, high, place = who[keep], low[keep], high[keep], place[keep]
            yield "near", g, who, place


def merged_runs(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that sorted spans cover; spans that touch are one run."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.append(np.flatnonzero(new)[1:], len(end)) - 1]


def _spans(start: np.ndarray, end: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Spans as a column; ``edges`` says where each row's begin."""
    fields = [pa.array(start, pa.int32()), pa.array(end, pa.int32())]
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(fields, ["s", "e"]))


def _merged(batches):
    """Rows whose sorted ``spans`` become runs, in time linear in their number."""
    for batch in batches:
        spans = batch.column("spans")
        flat = spans.flatten()
        start, end = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("s", "e"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        apart = row << 32                                # spans of different rows never touch
        start, end = merged_runs(start + apart, end + apart)
        edges = np.searchsorted(start, np.arange(batch.num_rows + 1) << 32)
        runs = _spans(start & 0xFFFFFFFF, end & 0xFFFFFFFF, edges)
        yield pa.RecordBatch.from_arrays([runs if c == "spans" else batch.column(c) for c in batch.schema.names], names=batch.schema.names)


def search(index: DataFrame, items: DataFrame, size: int = 10, slack: int | None = None) -> DataFrame:
    """One row for each indexed document: ``block, row, id, n_words, spans,
    items, near_items``: the merged runs of matched words (start, end), the
    items with exact matches and those with proximity matches.

    Null and empty texts have no words: such documents match nothing and such
    items have no windows.  Repeated rows and items count each for itself;
    empty tables give no matches or no rows; only the two columns given to
    :func:`build_index` and ``items`` are read."""
    windows = stored(windows_of(items, size), "benchmark-windows")
    chunks = pieces(windows.count(), CHUNK)
    found = None
    for chunk in range(chunks):
        rows = windows.where(F.pmod(F.xxhash64("terms"), F.lit(chunks)) == chunk).collect()   # about CHUNK windows
        terms = np.unique(np.array([t for r in rows for t in r.terms], np.int64).view(U64))

        def count(batches, terms=terms):
            for batch in batches:
                for own, starts in zip(batch.column("terms"), batch.column("starts"), strict=True):
                    own, starts = np.frombuffer(own.as_py(), U64), np.frombuffer(starts.as_py(), np.uint32)
                    at = np.searchsorted(own, terms)
                    held = np.flatnonzero(own[np.minimum(at, len(own) - 1)] == terms) if len(own) else at[:0]
                    n = starts[at[held] + 1].astype(np.int64) - starts[at[held]]
                    yield pa.RecordBatch.from_arrays([pa.array(terms[held].view(np.int64)), pa.array(n)], names=["term", "n"])

        counts = {r.term: r.n for r in index.select("terms", "starts").mapInArrow(count, "term long, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")).collect()}   # at most the chunk's terms
        queries = Queries(rows, counts)

        def match(batches, q=queries):
            for batch in batches:
                for one in range(batch.num_rows):
                    block = {c: batch.column(c)[one].as_py() for c in ("block", "n_words", "terms", "starts", "postings")}
                    block["first"] = np.concatenate([[0], np.cumsum(np.array(block["n_words"], np.int64) + 1)])
                    spans, exact, near = {}, {}, {}
                    for kind, g, who, place in _intersect(block, q, slack):
                        n, _, _, named = q.groups[g]
                        row = np.searchsorted(block["first"], place, "right") - 1
                        for r, w in np.unique(np.column_stack([row, who]), axis=0).tolist():
                            (exact if kind == "phrase" else near).setdefault(r, set()).update(named[w])
                        if kind == "phrase":
                            for r, s in np.unique(np.column_stack([row, place - block["first"][row]]), axis=0).tolist():
                                spans.setdefault(r, []).append((s, s + n))
                    out = sorted({*exact, *near})
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([block["block"]] * len(out), pa.int64()), pa.array(out, pa.int32()),
                             pa.array([[{"s": a, "e": b} for a, b in spans.get(r, [])] for r in out],
                                      pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                             pa.array([sorted(exact.get(r, ())) for r in out], pa.list_(pa.string())),
                             pa.array([sorted(near.get(r, ())) for r in out], pa.list_(pa.string()))],
                            names=["block", "row", "spans", "items", "near_items"])

        hits = (index.select("block", "n_words", "terms", "starts", "postings")
                .mapInArrow(match, "block long, row int, spans array<struct<s:int,e:int>>, items array<string>, near_items array<string>"))
        found = hits if found is None else found.unionByName(hits)
    gathered = (found.groupBy("block", "row")
                .agg(F.expr("array_sort(flatten(collect_list(spans)))").alias("spans"),
                     F.expr("array_sort(array_distinct(flatten(collect_list(items))))").alias("items"),
                     F.expr("array_sort(array_distinct(flatten(collect_list(near_items))))").alias("near_items")))
    gathered = gathered.mapInArrow(_merged, "block long, row int, spans array<struct<s:int,e:int>>, items array<string>, near_items array<string>")
    every = index.select("block", F.posexplode(F.arrays_zip("ids", "n_words")).alias("row", "doc"))
    none = F.expr("cast(array() as array<string>)")
    return (every.join(gathered, ["block", "row"], "left")
            .select("block", "row", F.col("doc.ids").alias("id"), F.col("doc.n_words").alias("n_words"),
                    F.coalesce("spans", F.expr("cast(array() as array<struct<s:int,e:int>>)")).alias("spans"),
                    F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items")))
