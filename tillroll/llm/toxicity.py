"""Toxicity: Levenshtein automata over a lexicon trie, and context windows.

1. *Lexicon.*  From a bounded, seeded sample of labelled rows: a term is taken
   when it stands in toxic texts far more often than chance allows.  Support
   is counted in distinct (word before, word after) pairs, so a passage copied
   a thousand times counts once.  Every word with enough of it is tested, of any
   length; scripts written without spaces give pairs of characters as words.
2. *Matching.*  Each distinct word of a batch runs through the trie of all
   terms with the banded Levenshtein automaton: a node keeps, for the words
   still within the allowed distance, one band of the edit matrix.  Terms of
   :data:`LONG` or more bytes allow distance 2, those of :data:`SHORT` or more
   1, so misspelled terms are found; shorter ones, and those of more than
   :data:`LONGEST` bytes, match as they are.
3. *Context.*  A match's strength is the log-odds of its spelling in the
   sample (a spelling seen only in clean texts counts against); a spelling not
   met there has that of the term's spellings at its distance.  Matches
   inside quotation marks are kept apart from the others, and the strongest
   window of :data:`WINDOW` words measures how dense the abuse is.  A logistic
   regression on these three numbers gives the score.

Every document is scored in one pass without a shuffle.  The model sent along
holds at most ``terms`` lexicon entries and the spellings met in the sample.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import column_bytes, lowered, prefix_hash, run_spans, slices, span_hash, word_bytes, word_spans
from .common import sampled, stored, with_columns

SAMPLE = 20_000       #: labelled rows, at most, that the model is fitted on
TERMS = 2048          #: entries of the lexicon, at most
SHORT, LONG = 4, 8    #: bytes of a term from which distance 1 and 2 are allowed
LONGEST = 64          #: longer terms are matched exactly
SUPPORT = 5           #: contexts of a term in toxic texts, at least
WINDOW = 16           #: words
QUOTE_BYTES = 80      #: a quoted match has marks this near on both sides
STRONGEST = 6.0
#: Share of toxic uses assumed of a term's spellings, by distance, as two spellings would show it.
ASSUMED = (0.95, 0.85, 0.7)


@dataclass
class Trie:
    """Terms of one allowed distance, as nested nodes."""

    distance: int
    children: dict = field(default_factory=dict)
    term: int = -1

    def add(self, term: bytes, number: int) -> None:
        node = self
        for b in term:
            node = node.children.setdefault(b, Trie(self.distance))
        node.term = number

    def match(self, letters: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words as rows of ``letters`` (0 beyond ``length``): the nearest
        term (lowest number on ties; -1 if none) and its distance."""
        d, n = self.distance, len(length)
        best, found = np.full(n, d + 1, np.int8), np.full(n, -1, np.int32)
        band = np.broadcast_to(np.concatenate([np.full(d, d + 1, np.int8), np.arange(d + 1, dtype=np.int8)]), (n, 2 * d + 1))
        padded = np.pad(letters, ((0, 0), (d, 2 * d + 1)))
        stack = [(self, 0, np.arange(n), band)]
        while stack:
            node, depth, who, old = stack.pop()
            if node.term >= 0:
                at = length[who] - depth + d
                fits = (at >= 0) & (at <= 2 * d)
                cost = np.full(len(who), d + 1, np.int8)
                cost[fits] = old[np.flatnonzero(fits), at[fits]]
                better = (cost < best[who]) | ((cost == best[who]) & (cost <= d) & (node.term < found[who]))
                best[who[better]], found[who[better]] = cost[better], node.term
            if not node.children:
                continue
            text = padded[who, depth:depth + 2 * d + 1]     # the letter before each cell of the next row
            for letter, child in node.children.items():
                new = old + (text != letter)
                new[:, :-1] = np.minimum(new[:, :-1], old[:, 1:] + 1)
                for b in range(1, 2 * d + 1):
                    np.minimum(new[:, b], new[:, b - 1] + 1, out=new[:, b])
                if depth < d:                               # cells before the word's start don't exist
                    new[:, :max(0, d - depth - 1)] = d + 1
                live = new.min(axis=1) <= d
                if live.any():
                    stack.append((child, depth + 1, who[live], new[live].astype(np.int8)))
        return found, best


@dataclass
class Lexicon:
    terms: list[bytes]
    short: Trie = field(init=False)
    near: Trie = field(init=False)
    far: Trie = field(init=False)
    whole: dict[bytes, int] = field(init=False)

    def __post_init__(self):
        self.short, self.near, self.far = Trie(0), Trie(1), Trie(2)
        self.whole = {t: i for i, t in enumerate(self.terms) if len(t) > LONGEST}
        for i, t in enumerate(self.terms):
            if len(t) <= LONGEST:
                (self.far if len(t) >= LONG else self.near if len(t) >= SHORT else self.short).add(t, i)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest term and distance of the words at the given spans of lower-cased bytes."""
        length = ends - starts
        found, dist = np.full(len(starts), -1, np.int32), np.full(len(starts), 9, np.int8)
        if self.whole:
            for i in np.flatnonzero(length > LONGEST):
                term = self.whole.get(data[starts[i]:ends[i]].tobytes(), -1)
                if term >= 0:
                    found[i], dist[i] = term, 0
        for trie, low, high in ((self.short, 1, SHORT - 1), (self.near, SHORT - 1, LONG), (self.far, LONG - 2, LONGEST + 2)):
            pick = np.flatnonzero((length >= low) & (length <= high))
            if not trie.children or not len(pick):
                continue
            width = int(length[pick].max())
            where = starts[pick, None] + np.arange(width)
            letters = np.where(np.arange(width) < length[pick, None], data[np.minimum(where, len(data) - 1)], 0).astype(np.uint8)
            f, c = trie.match(letters, length[pick])
            better = (f >= 0) & (c < dist[pick])
            found[pick[better]], dist[pick[better]] = f[better], c[better]
        return found, dist


@dataclass
class Hits:
    """Matches of a slice: row, word number, word hash, term, distance, quoted, span."""

    row: np.ndarray
    place: np.ndarray
    word: np.ndarray
    term: np.ndarray
    distance: np.ndarray
    quoted: np.ndarray
    start: np.ndarray
    end: np.ndarray
    context: np.ndarray


def _quoted(data: np.ndarray, off: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether a span stands between quotation marks: an odd number of marks
    before it in its row, and marks within QUOTE_BYTES on both sides."""
    mark = data == 0x22
    if len(data) > 2:
        guillemet = (data[:-1] == 0xC2) & ((data[1:] == 0xAB) | (data[1:] == 0xBB))
        curly = (data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] >= 0x9C) & (data[2:] <= 0x9F)
        mark[:-1] |= guillemet
        mark[:-2] |= curly
    at = np.flatnonzero(mark)
    if not len(at):
        return np.zeros(len(row), bool)
    before = np.searchsorted(at, start)
    odd = (before - np.searchsorted(at, off[row])) % 2 == 1
    left = at[np.maximum(before - 1, 0)]
    right = at[np.minimum(before, len(at) - 1)]
    return odd & (start - left <= QUOTE_BYTES) & (right >= end) & (right - end <= QUOTE_BYTES) & (right < off[row + 1])


def unspaced(data: np.ndarray) -> np.ndarray:
    """Where a character begins that is written without spaces between words:
    Thai, Lao, Burmese, Khmer, kana and the Han characters (three bytes each)."""
    out = np.zeros(len(data), bool)
    if len(data) < 3:
        return out
    a, b = data[:-2], data[1:-1]
    out[:-2] = (((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | ((a == 0xE1) & (((b >= 0x80) & (b <= 0x82)) | (b == 0x9E) | (b == 0x9F)))
                | ((a == 0xE3) & (b >= 0x81)) | ((a >= 0xE4) & (a <= 0xE9)))
    return out


def term_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as :func:`word_spans` gives them; a run of characters written
    without spaces is a word for each two neighbours in it (or its only one)."""
    at = unspaced(data)
    if not at.any():
        return word_spans(data, off, word_bytes("term"))
    held = at.copy()
    held[1:] |= at[:-1]
    held[2:] |= at[:-2]
    starts, ends, _ = run_spans(word_bytes("term")[data] & ~held, off)
    low, high, _ = run_spans(held, off)
    size = (high - low) // 3
    pairs = np.maximum(size - 1, 1)
    first = np.repeat(low, pairs) + 3 * (np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs))
    starts, ends = np.concatenate([starts, first]), np.concatenate([ends, first + np.repeat(np.where(size > 1, 6, 3), pairs)])
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], np.searchsorted(starts[order], off)


def find_hits(data: np.ndarray, off: np.ndarray, lexicon: Lexicon) -> Hits:
    """All matches in a slice of rows, in order."""
    starts, ends, edges = term_spans(data, off)
    low = lowered()[data]
    prefix = prefix_hash(data, lower=True)
    h = span_hash(prefix, starts, ends)
    unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    found, dist = lexicon.lookup(low, starts[first], ends[first])
    at = np.flatnonzero(found[inverse] >= 0)
    row = np.searchsorted(edges, at, "right") - 1
    before = np.where(at > edges[row], h[np.maximum(at - 1, 0)], np.uint64(0))
    after = np.where(at + 1 < edges[row + 1], h[np.minimum(at + 1, len(h) - 1)], np.uint64(0)) if len(h) else h[:0]
    return Hits(row, at - edges[row], h[at], found[inverse[at]], dist[inverse[at]], _quoted(data, off, row, starts[at], ends[at]),
                starts[at], ends[at], before * np.uint64(3) + after)


@dataclass
class Model:
    lexicon: Lexicon
    words: np.ndarray          # sorted hashes of spellings met in the sample
    strength: np.ndarray       # their log-odds
    unseen: np.ndarray         # log-odds of a spelling not met, by term and distance
    coefficients: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.5, 0.1, 0.2]))

    def of_words(self, word: np.ndarray, term: np.ndarray, distance: np.ndarray) -> np.ndarray:
        out = self.unseen[term, distance]
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            out = np.where(self.words[at] == word, self.strength[at], out)
        return out

    def features(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Three numbers a row: matches in plain text, quoted matches, and the
        strongest window.  A spelling counts once a row in the first two."""
        rows = len(off) - 1
        out = np.zeros((rows, 3))
        hits = find_hits(data, off, self.lexicon)
        if not len(hits.row):
            return out
        s = self.of_words(hits.word, hits.term, hits.distance)
        key = np.lexsort((hits.quoted, hits.word, hits.row))
        new = np.ones(len(key), bool)
        new[1:] = (hits.row[key][1:] != hits.row[key][:-1]) | (hits.word[key][1:] != hits.word[key][:-1])
        once = key[new]                                    # an unquoted use goes before a quoted one
        for column, pick in ((0, ~hits.quoted[once]), (1, hits.quoted[once])):
            out[:, column] = np.bincount(hits.row[once][pick], s[once][pick], rows)
        plain = np.flatnonzero(~hits.quoted & (s > 0))
        if len(plain):
            at = hits.row[plain].astype(np.int64) * (1 << 40) + hits.place[plain]
            total = np.concatenate([[0.0], np.cumsum(s[plain])])
            window = total[1:] - total[np.searchsorted(at, at - WINDOW)]
            np.maximum.at(out[:, 2], hits.row[plain], window)
        return np.clip(out, -12.0, 18.0)

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        z = self.coefficients[0] + self.features(data, off) @ self.coefficients[1:]
        return 0.5 * (1.0 + np.tanh(0.5 * z))


def logistic(x: np.ndarray, y: np.ndarray, base: float, penalty: float = 10.0) -> np.ndarray:
    """Intercept and slopes by Newton steps.  An L2 penalty draws them to the
    sum of log-odds (the prior's, and the matches' in plain text; quoted ones
    at 0.4), from which few or separable rows don't lead far away; slopes never
    turn negative (more abuse is not less toxic)."""
    a = np.column_stack([np.ones(len(x)), x])
    usual = np.array([np.log(base / (1 - base)), 1.0, 0.4, 0.0])
    ridge, w = penalty * np.eye(4), usual.copy()
    for _ in range(30):
        p = 0.5 * (1.0 + np.tanh(0.5 * (a @ w)))
        g = a.T @ (y - p) - ridge @ (w - usual)
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge, g)
        w += np.clip(step, -1, 1)
    w[1:] = np.maximum(w[1:], 0.0)
    return w


def _support(docs: DataFrame) -> DataFrame:
    """Distinct contexts of words in ``docs(text)``: ``(word, contexts)``."""
    def pairs(batches):
        for batch in batches:
            data, off = column_bytes(batch.column(0))
            for _, _, part, at in slices(data, off):
                starts, ends, edges = term_spans(part, at)
                h = span_hash(prefix_hash(part, lower=True), starts, ends)
                row = np.repeat(np.arange(len(at) - 1), np.diff(edges))
                same = np.concatenate([[False], row[1:] == row[:-1]]) if len(row) else np.zeros(0, bool)
                before = np.where(same, np.roll(h, 1), np.uint64(0))
                after = np.where(np.roll(same, -1), np.roll(h, -1), np.uint64(0))
                context = before * np.uint64(3) + after
                _, keep = np.unique(h * np.uint64(31) + context, return_index=True)
                low = lowered()[part].tobytes()
                words = [low[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(context[keep].view(np.int64))],
                                                 names=["word", "context"])

    return (docs.select("text").mapInArrow(pairs, "word binary, context long").distinct()
            .groupBy("word").agg(F.count(F.lit(1)).alias("contexts")))


def learn_lexicon(toxic: DataFrame, clean: DataFrame, base: float, most: int = TERMS) -> list[bytes]:
    """Terms whose contexts are toxic more often than the share ``base`` of
    toxic texts explains: log-likelihood gain above that of the best of all
    the words by chance, with a margin of 1 in 100.  The gain is computed for
    every word of :data:`SUPPORT` toxic contexts; the best ``most`` are returned."""
    found = _support(toxic).where(F.col("contexts") >= SUPPORT).withColumnRenamed("contexts", "a")
    both = stored(found.join(_support(clean).withColumnRenamed("contexts", "b"), "word", "left").select("word", "a", F.coalesce("b", F.lit(0)).alias("b")),
                  "term-support")
    tested = both.count()
    rate = F.col("a") / (F.col("a") + F.col("b"))
    gain = F.col("a") * F.log(rate / F.lit(base)) + F.when(F.col("b") > 0, F.col("b") * F.log((1 - rate) / F.lit(1 - base))).otherwise(0.0)
    best = (both.withColumn("gain", gain).where((rate > max(0.5, 3 * base)) & (F.col("gain") > float(np.log(max(tested, 1) * 1e4))))
            .orderBy(F.desc("gain"), "word").limit(most))
    return [bytes(r.word) for r in best.select("word").collect()]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS, seed: int = 10) -> Model:
    """Fit on ``labels(doc_id, label)`` (0 or 1; others and nulls are left
    out) joined to ``docs(doc_id, text)``, on at most ``sample`` of them; a
    document that ``docs`` repeats counts once a label."""
    chosen = (labels.where("label in (0, 1) and doc_id is not null")
              .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "label").limit(sample)
              .select("doc_id", F.col("label").cast("int").alias("label")))
    rows = stored(sampled(docs, chosen, "label").select("text", "label"), "toxicity-sample")  # at most ``sample`` rows
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    base = (positive + 0.5) / (n + 1.0)
    lexicon = Lexicon(learn_lexicon(rows.where("label = 1"), rows.where("label = 0"), base, terms) if positive else [])

    def spellings(batches):
        for batch in batches:
            data, off = column_bytes(batch.column("text"))
            label = batch.column("label").to_numpy()
            for low, _, part, at in slices(data, off):
                hits = find_hits(part, at, lexicon)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hits.word.view(np.int64)), pa.array(hits.term), pa.array(hits.distance.astype(np.int32)),
                     pa.array(hits.context.view(np.int64)), pa.array(label[low + hits.row].astype(np.int32))],
                    names=["word", "term", "distance", "context", "label"])

    seen = (rows.mapInArrow(spellings, "word long, term int, distance int, context long, label int").distinct()
            .groupBy("word", "term", "distance").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).collect()
            if lexicon.terms else [])
    prior = np.log(base / (1 - base))
    shown, spellings_of = np.tile(2.0 * np.array(ASSUMED), (max(1, len(lexicon.terms)), 1)), np.full((max(1, len(lexicon.terms)), 3), 2.0)
    for r in seen:
        shown[r.term, r.distance] += r.a / (r.a + r.b)
        spellings_of[r.term, r.distance] += 1
    share = shown / spellings_of
    seen.sort(key=lambda r: np.int64(r.word).view(np.uint64))
    mean = np.array([share[r.term, r.distance] for r in seen])
    a, b = np.array([r.a for r in seen], float), np.array([r.b for r in seen], float)
    strength = np.log((a + mean) / (b + 1 - mean)) - prior if seen else np.zeros(0)
    unseen = np.log(share / (1 - share)) - prior
    model = Model(lexicon, np.array([r.word for r in seen], np.int64).view(np.uint64),
                  np.clip(strength, -STRONGEST, STRONGEST), np.clip(unseen, -STRONGEST, STRONGEST))

    def features(batches):
        for batch in batches:
            data, off = column_bytes(batch.column("text"))
            for low, high, part, at in slices(data, off):
                f = model.features(part, at)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(f[:, i]) for i in range(3)], batch.column("label").slice(low, high - low)], names=["x0", "x1", "x2", "y"])

    got = np.array(rows.mapInArrow(features, "x0 double, x1 double, x2 double, y int").collect(), float).reshape(-1, 4)
    got = got[np.lexsort(got.T)]
    if len(got):
        model.coefficients = logistic(got[:, :3], got[:, 3], base)
        model.coefficients[2] = min(model.coefficients[2], model.coefficients[1])  # a quoted match never weighs more
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for each row of ``docs(doc_id, text)``.

    Null and empty texts, and texts without a match, get the score of the
    intercept; texts of any length are read whole; repeated rows get equal
    scores; an empty table gives no rows; other columns are not read."""
    def scored(batches):
        for batch in batches:
            data, off = column_bytes(batch.column("text"))
            out = np.zeros(batch.num_rows)
            for low, high, part, at in slices(data, off):
                out[low:high] = model.score(part, at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(scored, with_columns(docs.select("doc_id").schema, score="double"))
