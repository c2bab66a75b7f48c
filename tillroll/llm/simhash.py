"""SimHash near-duplicates by meet-in-the-middle ball hashing.

1. A text's fingerprint is the bitwise majority over the XXH64 of its word
   shingles.  Equal fingerprints are one row from here on, whatever their copies.
2. Two fingerprints within an even ``radius`` have a word in the middle, within
   ``radius / 2`` of both; and two that have such a word in common are within
   ``radius``.  So every fingerprint emits all variants within half the radius
   (2,081 at radius 4), and those that meet on a variant are linked, exactly.
3. The shuffle is on the variants' leading bits: a fingerprint is sent once to
   each prefix that some of its variants have, and the task that holds a prefix
   forms the variants under it.  At 14 bits that is 106 rows of 16 bytes in place
   of 2,081.  The number of bits follows from the number of fingerprints; a
   prefix under which too many variants would meet (a large group of near copies)
   is dealt again by further bits, down to the whole variant if need be, under
   which at most 2,081 fingerprints can be.
4. A task sorts its variants, keeps those met twice, verifies the links and
   returns a spanning forest of them; pairs within a group are never rows.
   Components of all links follow.
"""

from __future__ import annotations

from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import U64, column_bytes, lowered, slices, word_bytes, word_spans
from .common import components, join_hot, stored

SHINGLE = 4
RADIUS = 4
BITS = 64
SEED = 42
MEETING = 1 << 21               # variants that meet in one task, about
STEP = 6                        # more leading bits for a prefix with too many
CHUNK = 1 << 18                 # shingles whose bits are counted at a time


def majority(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each row from its shingle hashes: ``h`` in row order,
    ``counts`` of them in each row; zero for a row of none."""
    owner = np.repeat(np.arange(len(counts)), counts)
    sums = np.zeros((len(counts), BITS), np.int64)
    for low in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[low:low + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = owner[low:low + CHUNK]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        sums[rows[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def row_hashes(part: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles of the rows, in order, and how many each row has:
    its runs of ``n`` words joined by a space, or all words if there are fewer."""
    starts, ends, edges = word_spans(part, at, word_bytes("text"))
    many = np.diff(edges)
    counts = np.where(many >= n, many - n + 1, (many > 0).astype(np.int64))
    if not len(starts):
        return np.zeros(0, U64), counts
    long = ends - starts
    fresh = np.concatenate([[0], np.cumsum(long + 1)])          # where each word begins once gaps are single spaces
    joined = np.full(fresh[-1], 0x20, np.uint8)
    held = np.flatnonzero(word_bytes("text")[part])
    joined[held + np.repeat(fresh[:-1] - starts, long)] = lowered()[part[held]]
    # the first word of each shingle: all but the last n-1 of a row
    first = np.repeat(edges[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    last = np.minimum(first + n, np.repeat(edges[1:], counts)) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(fresh[first].tolist(), (fresh[last] + long[last]).tolist(), strict=True)
    return np.fromiter((digest(text[s:e], SEED) for s, e in spans), U64, len(first)), counts


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (64 bits, signed) for each row of ``docs(doc_id, text)``."""
    def sign(batches):
        for batch in batches:
            data, off = column_bytes(batch.column("text"))
            for low, high, part, at in slices(data, off):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low),
                                                  pa.array(majority(*row_hashes(part, at, n)).view(np.int64))], names=["doc_id", "fingerprint"])
    return docs.select("doc_id", "text").mapInArrow(sign, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint long")


def masks(bits: int, flips: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``flips`` of them set."""
    out = [0]
    for f in range(1, min(flips, bits) + 1):
        out += [sum(1 << b for b in some) for some in combinations(range(bits), f)]
    return np.array(out, U64)


def volume(bits: int, flips: int) -> int:
    return sum(comb(bits, f) for f in range(min(flips, bits) + 1))


def _leading(value: np.ndarray, bits: int) -> np.ndarray:
    return value >> U64(BITS - bits) if bits else np.zeros_like(value)


def _deal(rows: DataFrame, bits: int, more: int, half: int) -> DataFrame:
    """``(bits, prefix, spent, fingerprint, weight)`` under prefixes of ``more``
    further bits, from rows of ``(prefix, spent, fingerprint)`` under prefixes of
    ``bits``: every prefix of variants, the flips spent on it, and the variants
    that remain under it."""
    now = bits + more
    weights = np.array([volume(BITS - now, half - s) for s in range(half + 1)])

    def deal(batches):
        for batch in batches:
            prefix, spent, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("prefix", "spent", "fingerprint"))
            fp, prefix = fp.view(U64), prefix.view(U64)
            for s in range(half + 1):
                own = np.flatnonzero(spent == s)
                if not len(own):
                    continue
                flips = masks(more, half - s)
                tail = _leading(fp[own], now) & U64((1 << more) - 1)
                out = ((prefix[own] << U64(more)) | tail)[:, None] ^ flips[None, :]
                used = np.tile(s + np.bitwise_count(flips).astype(np.int32), len(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(out.size, now, np.int32)), pa.array(out.ravel().view(np.int64)), pa.array(used),
                     pa.array(np.repeat(fp[own], len(flips)).view(np.int64)), pa.array(weights[used])],
                    names=["bits", "prefix", "spent", "fingerprint", "weight"])
    return rows.mapInArrow(deal, "bits int, prefix long, spent int, fingerprint long, weight long")


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest index that each of ``size`` nodes reaches over links a-b."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all() and (root[a] == root[b]).all():
            return root


def meet(fp: np.ndarray, spent: np.ndarray, bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints under one prefix of ``bits``: those of a
    variant in common, as a spanning forest of pairs."""
    rest = BITS - bits
    inside = U64((1 << rest) - 1)
    found, owner = [], []
    for s in range(half + 1):
        own = np.flatnonzero(spent == s)
        flips = masks(rest, half - s)
        found.append(((fp[own] & inside)[:, None] ^ flips[None, :]).ravel())
        owner.append(np.repeat(own, len(flips)))
    variant, owner = np.concatenate(found), np.concatenate(owner)
    ordered = np.sort(variant)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    none = np.zeros(0, U64)
    if not len(twice):
        return none, none
    place = np.minimum(np.searchsorted(twice, variant), len(twice) - 1)
    hit = twice[place] == variant
    place, owner = place[hit], owner[hit]
    head = np.full(len(twice), len(fp))
    np.minimum.at(head, place, owner)
    a, b = owner, head[place]
    a, b = np.divmod(np.unique(a * len(fp) + b), len(fp))
    near = (a != b) & (np.bitwise_count(fp[a] ^ fp[b]) <= 2 * half)
    root = _forest(a[near], b[near], len(fp))
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked], fp[root[linked]]


def links(prints: DataFrame, count: int, radius: int = RADIUS, meeting: int = MEETING) -> DataFrame:
    """``(a, b)``: links whose components are those of all pairs of the
    distinct ``prints(fingerprint)`` at ``radius`` differing bits or fewer.
    About ``meeting`` variants meet in a task, twice that at most."""
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even: half of it is the variants' ball")
    half = radius // 2
    bits = min(BITS, max(1, round(log2(max(1, count * volume(BITS, half) / meeting)))))
    start = prints.select(F.lit(0).cast("long").alias("prefix"), F.lit(0).alias("spent"), "fingerprint")
    rows = stored(_deal(start, 0, bits, half), "variant-prefixes")
    dealt = []
    while True:
        load = stored(rows.groupBy("prefix").agg(F.sum("weight").alias("load"), F.count(F.lit(1)).alias("rows")), "prefix-loads")
        full = load.where(F.col("load") > 2 * meeting) if bits < BITS else load.where("false")
        again = stored(full, "full-prefixes")
        if again.isEmpty():
            dealt.append(rows)
            break
        marked = join_hot(rows, load.select("prefix", (F.col("load") > 2 * meeting).alias("full"), "rows"), "prefix", "rows")
        dealt.append(marked.where("not full").select(*rows.columns))
        more = min(STEP, BITS - bits)
        rows = stored(_deal(marked.where("full").select("prefix", "spent", "fingerprint"), bits, more, half), "variant-prefixes")
        bits += more
    met = dealt[0]
    for part in dealt[1:]:
        met = met.unionByName(part)

    def pairs(table: pa.Table) -> pa.Table:
        fp = table["fingerprint"].to_numpy().view(U64)
        a, b = meet(fp, table["spent"].to_numpy(), table["bits"][0].as_py(), half)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return met.select("bits", "prefix", "spent", "fingerprint").groupBy("bits", "prefix").applyInArrow(pairs, "a long, b long")


def near_duplicates(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint`` (16 lowercase hex digits) and ``component_id``
    (the smallest doc_id among the rows reachable over fingerprints at
    ``radius`` differing bits or fewer, its own included), one row for each row
    of ``docs``.

    Null and empty texts, and texts without a word, have fingerprint zero and
    are linked like any other; repeated rows are each returned.  Null ids
    name no component: it is null if all of its ids are.  Texts are read whole;
    other columns are not read; no rows give no rows."""
    signed = stored(fingerprints(docs, n), "fingerprints")
    prints = stored(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "distinct-fingerprints")
    found = stored(links(prints.select("fingerprint"), prints.count(), radius), "fingerprint-links")
    groups = stored(components(found, "fingerprint-components", hubs=True), "components")
    rooted = (prints.join(groups, prints["fingerprint"] == groups["node"], "left")
              .select("fingerprint", "first", "copies", F.coalesce("root", "fingerprint").alias("root")))
    rooted = stored(rooted, "rooted-fingerprints")
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("prints")), "component-ids")
    named = stored(join_hot(rooted, least, "root", "prints").select("fingerprint", "copies", "component_id"), "named-fingerprints")
    out = join_hot(signed, named, "fingerprint", "copies")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
