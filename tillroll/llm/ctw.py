"""Language-model scoring by context-tree weighting.

A byte is eight binary decisions (the nodes of a binary tree over byte
values).  For every node a context tree over the bytes before it holds
Krichevsky-Trofimov counts at each depth from 0 to :data:`DEPTH`, and the
weighted probability of a context mixes its own estimate with the product of
its longer contexts', half and half.  Learned on the training texts and then
kept, the model gives each next byte a probability: from the deepest context
up, each depth's estimate and the deeper mixture are weighed by what the
training texts say of them.  A text's score is the log10 probability of its
bytes (A-Z lower-cased) and of its end.

How it is computed:

1. One pass over the texts.  A task takes up to :data:`BLOCK` bytes as a
   block, counts its distinct byte strings of ``DEPTH + 1`` bytes (and its
   distinct words, for the unigram base) and writes them, dealt into shards by
   the last two bytes of the context, with the compressed text beside them.
2. Each shard sums the counts of all blocks.  As a shard holds whole subtrees
   below depth 2, it computes them alone; depths 1 and 0 need only sums over
   the shards, at most 256 x 255 rows, whatever the data.
3. Each shard answers every block's strings with their log-probabilities.
4. Each block meets its answers and adds them up along its texts.

What moves is counted per block and distinct string, never per byte.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import U64, column_bytes, lowered, slices, word_bytes, words
from .common import pieces, stored
from .packing import Lookup, count_keys, pack, pack_bytes, pack_sorted, unpack, unpack_bytes, unpack_sorted

DEPTH = 5
BLOCK = 48 << 20
SHARDS = 24          #: at least; they grow with the square root of the data
EDGE = 0xFF          #: stands before a text and at its end; no UTF-8 byte
END_WORD = U64(0x5DEECE66D)
_MERGE = 6_000_000
_AT_ONCE = 2 << 20


def edged(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' strings of ``DEPTH + 1`` bytes, one for each byte of a row
    and one for its end, and where each row's begin."""
    rows = len(off) - 1
    stream = np.full(len(data) + DEPTH * (rows + 1), EDGE, np.uint8)
    for r in range(rows):
        at = off[r] + DEPTH * (r + 1)
        stream[at:at + off[r + 1] - off[r]] = data[off[r]:off[r + 1]]
    two = (stream[:-1].astype(U64) << U64(8)) | stream[1:]
    four = (two[:-2] << U64(16)) | two[2:]
    six = (four[:-2] << U64(16)) | two[4:]
    own = np.diff(off) + 1
    at = off[:-1] + DEPTH * np.arange(rows)              # the string whose last byte is the row's first
    starts = np.concatenate([[0], np.cumsum(own)])
    keep = np.zeros(len(six), bool)
    change = np.zeros(len(six) + 1, np.int32)
    change[at] += 1
    np.add.at(change, at + own, -1)
    keep = np.cumsum(change[:-1]) > 0
    return six[keep], starts


def shard_of(strings: np.ndarray, shards: int) -> np.ndarray:
    """By the last two bytes of the context."""
    two = (strings >> U64(8)) & U64(0xFFFF)
    return ((two * U64(0x9E3779B97F4A7C15)) >> U64(40)) % U64(shards)


class _Counts:
    """Distinct keys with training counts, merged now and then."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, learn: np.ndarray) -> None:
        """``learn``: 1 where a key counts for training, else 0."""
        both, n = np.unique((keys << U64(1)) | learn.astype(U64), return_counts=True)
        self.parts.append((both >> U64(1), n * (both & U64(1)).astype(np.int64)))
        self.held += len(both)
        if self.held > _MERGE:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        keys, n = count_keys(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))
        self.parts, self.held = [(keys, n)], len(keys)
        return keys, n


def word_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """63-bit word hashes with an end word after each row, and row starts."""
    h, edges = words(data, off, word_bytes("text"), lower=False)
    rows = len(off) - 1
    out = np.empty(len(h) + rows, U64)
    starts = edges + np.arange(rows + 1)
    end = np.zeros(len(out), bool)
    end[starts[1:] - 1] = True
    out[end], out[~end] = END_WORD, h >> U64(1)
    return out, starts


_PACKED = "kind string, block long, shard int, ids array<long>, learn array<boolean>, keys binary, counts binary"
_NAMES = ["kind", "block", "shard", "ids", "learn", "keys", "counts"]


def _row(kind: str, block: int, shard: int, ids=None, learn=None, keys=None, counts=None) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((kind, block, shard, ids, learn, keys, counts), types, strict=True)], names=_NAMES)


def _blocks(docs: DataFrame, shards: int) -> DataFrame:
    """Step 1: ``docs(doc_id, text, learn)`` as blocks of texts and counts."""
    def cut(batches):
        block, size, strings, spoken = TaskContext.get().partitionId() << 24, 0, _Counts(), _Counts()

        def flush():
            for kind, counts in (("string", strings), ("word", spoken)):
                keys, n = counts.merged()
                shard = shard_of(keys, shards) if kind == "string" else (keys >> U64(20)) % U64(shards)
                order = np.argsort(shard, kind="stable")
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in range(shards):
                    pick = order[edges[s]:edges[s + 1]]
                    if len(pick):
                        yield _row(kind, block, s, keys=pack_sorted(keys[pick]), counts=pack(n[pick].astype(np.uint32)))

        for batch in batches:
            data, off = column_bytes(batch.column("text"))
            ids, learn = batch.column("doc_id").to_pylist(), batch.column("learn").to_numpy(zero_copy_only=False)
            for low, high, part, at in slices(lowered()[data], off, _AT_ONCE):
                for keys, starts, into in (*[(*edged(part, at), strings)], *[(*word_keys(part, at), spoken)]):
                    into.add(keys, np.repeat(learn[low:high], np.diff(starts)))
                yield _row("text", block, 0, ids[low:high], learn[low:high].tolist(), pack_bytes(part), pack(np.diff(at)))
                size += len(part)
                if size >= BLOCK:
                    yield from flush()
                    block, size, strings, spoken = block + 1, 0, _Counts(), _Counts()
        if size or strings.parts:
            yield from flush()

    return stored(docs.mapInArrow(cut, _PACKED), "language-blocks", partition_by="kind")


@functools.cache
def _log_gamma_table() -> np.ndarray:
    return np.array([math.lgamma(0.5 * i) if i else 0.0 for i in range(4096)])


def _log_gamma(twice: np.ndarray) -> np.ndarray:
    """log gamma(twice / 2)."""
    x = 0.5 * np.maximum(twice, 4096).astype(np.float64)
    far = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return np.where(twice < 4096, _log_gamma_table()[np.minimum(twice, 4095)], far)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov log-probability of ``a`` zeros and ``b`` ones."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    return _log_gamma(2 * a + 1) + _log_gamma(2 * b + 1) - math.log(math.pi) - _log_gamma(2 * (a + b) + 2)


def _halves(own: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Log of the even mixture."""
    return np.logaddexp(own, deeper) - math.log(2)


def _share(own: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Weight of the own estimate in the mixture."""
    return 0.5 * (1 + np.tanh(0.5 * np.clip(own - deeper, -700, 700)))


class Subtrees:
    """All contexts of depth 2 to DEPTH in a shard.  Node keys of decision
    ``i`` at depth ``d``: the context's ``d`` bytes, then the byte's first
    ``i`` bits."""

    def __init__(self, strings: np.ndarray, n: np.ndarray):
        self.nodes = {}
        keys = strings
        for d in range(DEPTH, 1, -1):
            keys, n = count_keys(keys & U64((1 << 8 * (d + 1)) - 1), n) if d < DEPTH else (keys, n)
            for i in range(8):
                node = keys >> U64(8 - i)
                one = ((keys >> U64(7 - i)) & U64(1)).astype(bool)
                at = np.flatnonzero(np.concatenate([np.ones(min(1, len(node)), bool), node[1:] != node[:-1]]))
                a = np.add.reduceat(np.where(one, 0, n), at) if len(at) else n[:0]
                b = np.add.reduceat(np.where(one, n, 0), at) if len(at) else n[:0]
                own, key = log_kt(a, b), node[at]
                if d == DEPTH:
                    total, share = own, np.ones(len(own))
                else:
                    child_key, child_total = self.nodes[d + 1, i][0], self.nodes[d + 1, i][3]
                    parent = np.searchsorted(key, child_key & U64((1 << (8 * d + i)) - 1))
                    deeper = np.bincount(parent, child_total, len(key))
                    total, share = _halves(own, deeper), _share(own, deeper)
                self.nodes[d, i] = (key, (b + 0.5) / (a + b + 1.0), share, total, a, b)

    def roots(self) -> np.ndarray:
        """Sums over this shard's depth-2 contexts by their last byte: rows of
        (last byte, decision node, zeros, ones, log-probability)."""
        out = []
        for i in range(8):
            key, _, _, total, a, b = self.nodes[2, i]
            node = ((key >> U64(i)) & U64(0xFF)) * U64(256) + U64(1 << i) + (key & U64((1 << i) - 1))
            where, at = np.unique(node, return_inverse=True)
            out.append(np.column_stack([where // U64(256), where % U64(256), *[np.bincount(at, v, len(where)) for v in (a, b, total)]]))
        return np.concatenate(out) if out else np.zeros((0, 5))

    def log10_next(self, strings: np.ndarray, top: np.ndarray) -> np.ndarray:
        """log10 probability of each string's last byte after the others."""
        out = np.zeros(len(strings))
        last = ((strings >> U64(8)) & U64(0xFF)).astype(np.int64)
        for i in range(8):
            one = ((strings >> U64(7 - i)) & U64(1)).astype(bool)
            p = np.full(len(strings), 0.5)
            for d in range(DEPTH, 1, -1):
                key, ones, share = self.nodes[d, i][:3]
                want = (strings & U64((1 << 8 * (d + 1)) - 1)) >> U64(8 - i)
                if not len(key):
                    continue
                at = np.minimum(np.searchsorted(key, want), len(key) - 1)
                own = np.where(one, ones[at], 1 - ones[at])
                p = np.where(key[at] == want, share[at] * own + (1 - share[at]) * p, 0.5)
            node = (1 << i) + ((strings & U64(0xFF)) >> U64(8 - i)).astype(np.int64)
            for row in (last, np.full(len(last), 256)):          # depth 1, then depth 0
                ones, share = top[0, row, node], top[1, row, node]
                p = share * np.where(one, ones, 1 - ones) + (1 - share) * p
            out += np.log10(p)
        return out


def top_of_tree(rows: np.ndarray) -> np.ndarray:
    """Depths 1 (by the last byte) and 0 (row 256): the estimate of a one and
    the weight of that estimate, for each decision node."""
    a, b, deeper = (np.zeros((257, 256)) for _ in range(3))
    if len(rows):
        at = (rows[:, 0].astype(int), rows[:, 1].astype(int))
        for into, column in ((a, 2), (b, 3), (deeper, 4)):
            np.add.at(into, at, rows[:, column])
    own = log_kt(np.rint(a), np.rint(b))
    total = _halves(own, deeper)
    a[256], b[256], deeper[256] = a[:256].sum(0), b[:256].sum(0), total[:256].sum(0)
    own[256] = log_kt(np.rint(a[256]), np.rint(b[256]))
    return np.stack([(b + 0.5) / (a + b + 1.0), _share(own, deeper)])


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [unpack_sorted(k) for k in table["keys"].to_pylist()]
    counts = [unpack(c).astype(np.int64) for c in table["counts"].to_pylist()]
    return count_keys(np.concatenate(keys), np.concatenate(counts))


def score(docs: DataFrame, learn: str = "learn") -> DataFrame:
    """One row for each row of ``docs(doc_id, text, learn)``, trained on the
    rows whose ``learn`` is true: ``doc_id, learn, n_bytes, n_tokens, n_known,
    train_tokens, base_score, score``.  ``-score / n_bytes`` is the code
    length per byte in decimal digits.

    Null texts count as empty: they hold their end alone.  Repeated rows are
    scored and learned each; texts of any length are read whole; with no
    training rows every decision has probability 1/2; an empty table gives no
    rows; other columns are not read."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col(learn), F.lit(False)).alias("learn"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = SHARDS + 8 * math.isqrt(pieces(int(size), BLOCK))
    written = _blocks(own, shards)
    strings, spoken, texts = (written.where(F.col("kind") == k) for k in ("string", "word", "text"))

    def roots(table: pa.Table) -> pa.Table:
        keys, n = _summed(table)
        rows = Subtrees(keys[n > 0], n[n > 0]).roots()
        return pa.table({"last": rows[:, 0].astype(np.int32), "node": rows[:, 1].astype(np.int32), "a": rows[:, 2], "b": rows[:, 3], "total": rows[:, 4]})

    top_rows = (strings.select("shard", "keys", "counts").groupBy("shard")
                .applyInArrow(roots, "last int, node int, a double, b double, total double")
                .groupBy("last", "node").agg(F.sum("a"), F.sum("b"), F.sum("total")).orderBy("last", "node").collect())   # at most 256 x 255 rows
    top = top_of_tree(np.array(top_rows, float).reshape(-1, 5))

    def answer(table: pa.Table) -> pa.Table:
        keys, n = _summed(table)
        value = Subtrees(keys[n > 0], n[n > 0]).log10_next(keys, top).astype(np.float32)
        asked = [unpack_sorted(k) for k in table["keys"].to_pylist()]
        return pa.table({"block": table["block"], "kind": pa.array(["string"] * len(asked)), "keys": table["keys"],
                         "answers": pa.array([pack(value[np.searchsorted(keys, a)]) for a in asked], pa.binary())})

    def frequency(table: pa.Table) -> pa.Table:
        keys, n = _summed(table)
        asked = [unpack_sorted(k) for k in table["keys"].to_pylist()]
        return pa.table({"block": table["block"], "kind": pa.array(["word"] * len(asked)), "keys": table["keys"],
                         "answers": pa.array([pack(n[np.searchsorted(keys, a)]) for a in asked], pa.binary()),
                         "tokens": pa.array([int(n.sum())] + [0] * (len(asked) - 1), pa.int64()),
                         "kinds": pa.array([int((n > 0).sum())] + [0] * (len(asked) - 1), pa.int64())})

    answers = "block long, kind string, keys binary, answers binary"
    for_strings = strings.select("shard", "block", "keys", "counts").groupBy("shard").applyInArrow(answer, answers)
    for_words = stored(spoken.select("shard", "block", "keys", "counts").groupBy("shard")
                       .applyInArrow(frequency, answers + ", tokens long, kinds long"), "word-counts")
    tokens, kinds = for_words.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()

    def add_up(texts_of: pa.Table, answers_of: pa.Table) -> pa.Table:
        found = {}
        for kind in ("string", "word"):
            own = answers_of.filter(pa.compute.equal(answers_of["kind"], kind))
            keys = np.concatenate([np.zeros(0, U64), *[unpack_sorted(k) for k in own["keys"].to_pylist()]])
            found[kind] = Lookup(keys), np.concatenate([np.zeros(0), *[unpack(v).astype(np.float64) for v in own["answers"].to_pylist()]])
        out = {name: [] for name in ("doc_id", "learn", "n_bytes", "n_tokens", "n_known", "base_score", "score")}
        for row in texts_of.to_batches(max_chunksize=1):
            if not row.num_rows:
                continue
            ids, learned = row.column("ids")[0].as_py(), row.column("learn")[0].as_py()
            data, length = unpack_bytes(row.column("keys")[0].as_py()), unpack(row.column("counts")[0].as_py())
            off = np.concatenate([[0], np.cumsum(length)])
            keys, starts = edged(data, off)
            look, value = found["string"]
            out["score"].append(np.add.reduceat(value[look(keys)], starts[:-1]))
            keys, starts = word_keys(data, off)
            look, value = found["word"]
            c = value[look(keys)]
            out["base_score"].append(np.add.reduceat(np.log10((c + 1) / (tokens + kinds + 1)), starts[:-1]))
            out["n_known"].append(np.add.reduceat((c > 0).astype(np.int64), starts[:-1]))
            out["n_tokens"].append(np.diff(starts))
            out["n_bytes"].append(length)
            out["doc_id"] += ids
            out["learn"] += learned
        return pa.table({k: pa.array(v, pa.int64() if k == "doc_id" else pa.bool_()) if k in ("doc_id", "learn")
                         else pa.array(np.concatenate([np.zeros(0), *v]).astype(np.float64 if "score" in k else np.int64)) for k, v in out.items()})

    rows = (texts.select("block", "ids", "learn", "keys", "counts").groupBy("block")
            .cogroup(for_strings.unionByName(for_words.select("block", "kind", "keys", "answers")).groupBy("block"))
            .applyInArrow(add_up, "doc_id long, learn boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double"))
    return rows.withColumn("train_tokens", F.lit(int(tokens)).cast("long"))
