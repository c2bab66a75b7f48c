"""The LSH forest of operator 6: tries, shortening, and clusters taken node by node."""

from __future__ import annotations

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from tillroll.llm import jaccard
from tillroll.llm.common import components

from .conftest import prose, terms


def links_by_force(texts):
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in map(terms, texts)]
    count = defaultdict(int)
    for i, j in combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= .8 * len(sets[i] | sets[j]):
            count[i] += 1
            count[j] += 1
    return [count[i] for i in range(len(texts))]


def found_links(spark, texts, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.n_links for r in jaccard.near_duplicates(docs, **kw).orderBy("doc_id").collect()]


@pytest.fixture
def narrow(spark):
    """Many partitions, so that runs of equal prefixes cross borders."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_tries_join_all_equal_prefixes(spark, narrow):
    r = np.random.default_rng(5)
    values = r.integers(0, 2, (60, jaccard.TREES, jaccard.DEEPEST)).astype(">u2")
    values[:40, 3] = 7                                                # a node with two thirds of all classes
    names = [i.to_bytes(16, "big") for i in range(60)]
    classes = spark.createDataFrame([(bytearray(n), bytearray(v.tobytes())) for n, v in zip(names, values, strict=True)],
                                    "class binary, signature binary")
    links = jaccard.sorted_tries(classes, 4).cache()
    for depth in (4, 5, 6):
        got = {bytes(n): bytes(m) for n, m in components(links.where(f"depth = {depth}").selectExpr("class as a", "head as b")).collect()}
        root = list(range(60))
        fresh = set()
        for _ in range(60):
            for i, j in combinations(range(60), 2):
                same = [(values[i, t, :depth] == values[j, t, :depth]).all() for t in range(jaccard.TREES)]
                if any(same):
                    root[i] = root[j] = min(root[i], root[j])
                    if depth < 6 and not any((values[i, t, :depth + 1] == values[j, t, :depth + 1]).all() for t in range(jaccard.TREES)):
                        fresh |= {names[i], names[j]}
            if depth < 6 or root == [root[x] for x in root]:
                break
        want = {}
        for i in range(60):
            x = i
            while root[x] != x:
                x = root[x]
            want[names[i]] = names[x]
        assert got == {n: m for n, m in want.items() if n in got} and all(m == n for n, m in want.items() if n not in got)
        opened = {got[bytes(c)] for (c,) in links.where(f"depth = {depth} and fresh").select("class").collect()}
        assert {got[n] for n in fresh} <= opened                     # a cluster with new pairs is marked


def test_every_link_of_a_chained_cluster_is_found_once(spark, narrow, monkeypatch):
    """Texts that share half or more of their shingles with their neighbours: one long cluster, cut by blocks or by nodes."""
    text = prose(8, 700).split()
    texts = [" ".join(text[i * 3:i * 3 + 120]) for i in range(60)] + [" ".join(text[i * 3:i * 3 + 119]) for i in range(60)]
    want = links_by_force(texts)
    assert max(want) > 3
    for block in (1000, 7):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        assert found_links(spark, texts) == want


def test_prefixes_shorten_while_links_are_missed(spark, monkeypatch):
    """Links of nearly equal texts end at the full depth; links at the threshold ask for shorter prefixes."""
    depths = []
    real = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda m, t, depth, *rest: depths.append(depth) or real(m, t, depth, *rest))
    base = prose(4, 1500).split()
    near = [" ".join([*base[:9 * i], f"w{i}", *base[9 * i + 1:]]) for i in range(60)]
    assert found_links(spark, near) == [59] * 60 and depths == [6]
    depths.clear()
    pair = prose(5, 104).split()
    edge = [" ".join(pair), " ".join([*pair[:50], "changed", *pair[51:70], "again", *pair[71:]])]
    assert found_links(spark, edge) == [1, 1] and depths == [6, 4]
    depths.clear()
    assert found_links(spark, edge, recall=.5) == [1, 1] and depths == [6]


def test_the_estimate_is_the_chance_to_meet():
    assert jaccard.meeting_chance(.8, 4) == pytest.approx(1 - (1 - .8 ** 4) ** 16)
    assert jaccard.prefix_length(jaccard.THRESHOLD, jaccard.RECALL) == 4
    r = np.random.default_rng(3)
    met = 0
    for _ in range(300):
        own = r.integers(0, 1 << 63, 90, dtype=np.uint64)
        both = [np.concatenate([own[:80], own[80:85]]), np.concatenate([own[:80], own[85:]])]    # 80 of 90 shared
        s = jaccard.signatures(np.concatenate(both), np.array([0, 85, 170]))
        nodes = jaccard.prefixes(s, 6)
        met += (nodes[0] == nodes[1]).any()
    assert met >= 300 * jaccard.meeting_chance(80 / 90, 6) - 3
