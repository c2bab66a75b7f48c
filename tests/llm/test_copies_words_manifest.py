"""SimHash groups, spelling variants and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.llm import merkle, simhash, spelling

from .conftest import LOWER, SCHEMA, words

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 11 ------------------------------------------------------------------ SimHash
def slow_fingerprint(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(given):
    prints = [slow_fingerprint(t) for _, t in given]
    distinct = sorted(set(prints))
    group = {f: f for f in distinct}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                group[find(a)] = find(b)
    least = {}
    for (doc, _), f in zip(given, prints, strict=True):
        root = find(f)
        least[root] = min((x for x in (least.get(root), doc) if x is not None), default=None)
    return sorted(((doc, f"{f:016x}", least[find(f)]) for (doc, _), f in zip(given, prints, strict=True)), key=repr)


def test_simhash_groups(spark, docs, awkward, no_docs):
    assert rows(simhash.near_duplicates(docs)) == slow_groups([(r[0], r[1]) for r in awkward])
    assert rows(simhash.near_duplicates(no_docs)) == []


def test_simhash_query_matches_brute_force(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op11_simhash"](spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert rows(got) == slow_groups(given)


def test_shingles_of_odd_texts():
    texts = ["", " \n", "One", "a  b\tc", "A b c d", "é ü  b c d e  ", "x " * 5000 + "y", "x\x00y z " * 4, "p" * 100_000]
    data = "".join(texts).encode()
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    h, counts = simhash.row_hashes(np.frombuffer(data, np.uint8), off, 4)
    assert simhash.majority(h, counts).tolist() == [slow_fingerprint(t) for t in texts]


@pytest.mark.parametrize("meeting", [1 << 21, 1 << 12, 300])
def test_links_of_crowded_fingerprints(spark, meeting):
    """A third of all fingerprints lie in one ball: prefixes are dealt again, links stay exact."""
    r = random.Random(4)
    centre = r.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(60)}
    prints |= {r.getrandbits(64) for _ in range(100)}
    far = r.getrandbits(64)
    prints |= {far, far ^ 0b1111, far ^ 0b1111 ^ (0b1111 << 60), far ^ (0b11111 << 30)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), len(signed), meeting=meeting)
    root = {p: p for p in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    def groups(pairs):
        for p in signed:
            root[p] = p
        for a, b in pairs:
            root[find(a)] = find(b)
        held = defaultdict(set)
        for p in signed:
            held[find(p)].add(p)
        return sorted(map(sorted, held.values()))
    mask = (1 << 64) - 1
    exact = groups([(a, b) for a in signed for b in signed if ((a ^ b) & mask).bit_count() <= 4])
    got = [tuple(x) for x in found.collect()]
    assert all(((a ^ b) & mask).bit_count() <= 4 or find(a) == find(b) for a, b in got)
    assert groups(got) == exact and len(exact) < len(signed) - 20


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint long"), 1, radius=3)


# 12 ------------------------------------------------------------------ spelling variants
def slow_vocabulary(given, length=6, count=5, slip=199):
    n = Counter()
    for doc, text in given:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= length and c >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_variants(n, ratio=5):
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    best = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: b if b is not None and n[b] >= ratio * n[w] else None for w, b in best.items()}
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=repr)


def letter_words(seed, size):
    r = random.Random(seed)
    n = {}
    for _ in range(size):
        w = "".join(r.choice("abé") for _ in range(r.randint(1, 6)))
        n[w] = r.choice([1, 1, 2, 5, 25, 125, 700])
    return n | {"": 4, "a" * 300: 5, "a" * 299: 50, "zzzz": 5, "zzz": 25, "zz": 125, "z": 625, "ÿÿÿ": 3}


@pytest.mark.parametrize("part_words", [100_000, 9])
def test_variants_of_all_words(spark, part_words, monkeypatch):
    monkeypatch.setattr(spelling.neighbours, "__defaults__", (part_words,))
    n = letter_words(part_words, 250)
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows(spelling.variants(df)) == slow_variants(n)
    with pytest.raises(ValueError):
        spelling.variants(df, ratio=1)


def test_spelling_of_awkward_texts(spark, docs, awkward, no_docs):
    given = [(r[0], r[1]) for r in awkward]
    for slip in (None, 3):
        n = slow_vocabulary(given, 3, 2, slip)
        assert n and rows(spelling.spelling_groups(docs, 3, 2, slip=slip)) == slow_variants(n)
    assert rows(spelling.spelling_groups(no_docs)) == []


# 13 ------------------------------------------------------------------ manifest
def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def slow_climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def slow_manifest(given):
    """From rows of (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for row in given:
        doc, source, lang, n_chars, text = row
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        other = slow_leaf((doc, source, lang, n_chars, None if text is None else text.translate(LOWER))) if hit else None
        trees[lang].append((doc is not None, doc or 0, slow_leaf(row), doc, other))
    names = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    levels = {g: slow_climb([leaf for _, _, leaf, _, _ in sorted(trees[g], key=lambda x: x[:3])]) for g in names}
    upper = slow_climb([levels[g][-1][0] for g in names])
    root, out = upper[-1][0], []
    for place, g in enumerate(names):
        for at, (_, _, leaf, doc, other) in enumerate(sorted(trees[g], key=lambda x: x[:3])):
            node, beside = other or leaf, []
            for ladder, i in ((levels[g], at), (upper, place)):
                for level in ladder[:-1]:
                    run = level[i // 8 * 8:i // 8 * 8 + 8]
                    beside += run[:i % 8] + run[i % 8 + 1:]
                    node = digest(*run[:i % 8], node, *run[i % 8 + 1:])
                    i //= 8
            out.append((doc, leaf, levels[g][-1][0], root, digest(*beside), node, node == root))
    return sorted(out, key=repr)


def manifest(df, **how):
    tampered = merkle.tampered_leaf(when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return merkle.build(df, changed=tampered, **how)


@pytest.mark.parametrize("depth", [5, 1, 2])
def test_manifest_of_awkward_rows(spark, docs, awkward, no_docs, depth):
    expected = slow_manifest([(d, s, g, n, t) for d, t, g, s, n in awkward])
    assert rows(merkle.prove(manifest(docs, depth=depth))) == expected
    assert {v for *_, v in expected} == {True, False}
    nothing = manifest(no_docs, depth=depth)
    assert rows(merkle.prove(nothing)) == [] and nothing.root is None


@pytest.mark.parametrize("depth", [5, 1])
def test_proofs_of_some_leaves_and_many_groups(spark, depth):
    """One group of most rows, one id that repeats, 70 small groups: proofs of
    a few leaves fetch what they lack and are those of the whole."""
    given = [(i % 90 if i % 3 else 7, "s", "hot", i, f"Text {i}") for i in range(700)] + [(i, None, f"g{i:02d}", None, "x") for i in range(70)]
    given += [(7, "s", "hot", 1, "Same")] * 40
    df = spark.createDataFrame([(d, t, g, s, n) for d, s, g, n, t in given], SCHEMA).repartition(5)
    m = manifest(df, depth=depth)
    expected = slow_manifest(given)
    assert rows(merkle.prove(m)) == expected
    some = merkle.prove(m, m.leaves.where("at % 37 = 5 or n = 1"))
    want = {(tree, at) for tree, at in m.leaves.where("at % 37 = 5 or n = 1").select("tree", "at").collect()}
    got = rows(some)
    assert len(got) == len(want) and not Counter(got) - Counter(expected)


def test_missing_nodes_are_the_smallest_union():
    for n, at in ((1, [0]), (9, [8]), (64, [0, 1, 63]), (700, [5, 6, 300, 699])):
        known, asked = {(0, a) for a in at}, merkle.missing_nodes(np.array(at), n)
        fetched = {(level, x) for level, places in asked for x in places.tolist()}
        assert not known & fetched
        used = set()
        for level, wide in enumerate(merkle.heights(n)[:-1]):
            for a in {x for k, x in known if k == level}:
                run = {(level, x) for x in range(a // 8 * 8, min(wide, a // 8 * 8 + 8))}
                assert run <= known | fetched
                used |= run - known
                known.add((level + 1, a // 8))
        assert used == fetched
