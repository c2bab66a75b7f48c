"""The pipeline against a brute-force version on a small corpus with planted
junk, copies, near copies, shared passages and benchmark passages; its queries
on the given tables; and its stages on empty tables."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from itertools import combinations

import pytest

import __spark_entry__ as entry
import corpus_pipeline

from .conftest import SCHEMA, prose, words
from .test_operators import fill, shingles, slow_cut, slow_hits


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(9)
    folder = tmp_path_factory.mktemp("corpus")
    passage, item = prose(900, 70).replace("é", "e"), prose(901, 25).replace("é", "e")
    texts = {i: prose(i, r.randint(40, 160)).replace("é", "e") for i in range(120)}
    junk = {i: r.choice(["$$$ ", "### *** ", "SPAM!! SPAM!! "]) * 60 for i in range(120, 160)}
    for i in range(160, 168):
        texts[i] = texts[i - 160]
    for i in range(168, 174):
        w = texts[i - 160].split()
        w[3] = "edited"
        texts[i] = " ".join(w)
    for i in (30, 31, 32, 33):
        texts[i] += "\n" + passage
    for i in (40, 41):
        texts[i] = item + " " + texts[i]
    texts |= {180: None, 181: "", 182: "short text"}
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}", len(t or "")) for i, t in {**texts, **junk}.items()]
    labels = [(i, 0 if i in junk else 1, 0) for i in [*range(100), *range(120, 150)]]
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as docs").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, set(junk), [(1, item)]


def brute_force(rows, junk, items):
    rows = [r for r in rows if r[0] not in junk]
    sets = {r[0]: shingles(r[1]) for r in rows}
    linked = defaultdict(set)
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and both >= .8 * len(sets[a] | sets[b]):
            linked[a].add(b)
            linked[b].add(a)
    gone = set()
    for a in sorted(sets):
        group, todo = {a}, [a]
        while todo:
            new = linked[todo.pop()] - group
            group |= new
            todo += new
        gone |= group - {min(group)}
    rows = [r for r in rows if r[0] not in gone]
    cut = {c[0]: c[4].decode() for c in slow_cut([(r[0], r[1]) for r in rows])}
    rows = [(r[0], cut[r[0]], r[2], r[3], len(cut[r[0]])) for r in rows]
    return [r for r in rows if not slow_hits(r[1], items)[1]]


def test_pipeline_matches_brute_force(spark, corpus):
    folder, rows, junk, items = corpus
    left = brute_force(rows, junk, items)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.text, r.lang, str(r.source), r.n_chars) for r in got) == sorted((r[0], r[1], r[2], str(r[3]), r[4]) for r in left)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert {s: round(t, 6) for s, t in fill(sizes).items()} == {s: round(t, 6) for s, t in target.items()}
    assert all(taken[s] == math.floor(t) for s, t in target.items())
    assert len(left) < len(rows) - len(junk)


def test_stages_keep_the_columns(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.names == docs.columns, name
        assert stage(spark, docs.where("doc_id < 0"), folder).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("doc_id < 0"), folder).count() == 0


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_with_sql_match_it(spark):
    duckdb = pytest.importorskip("duckdb")
    from tillroll.llm.oracles import oracle_sql
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    for name, sql in oracle_sql().items():
        df = entry.queries()[name](spark, folder)
        want = con.execute(sql)
        assert [d[0] for d in want.description] == df.columns, name
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want.fetchall())), name


def test_fit_makes_no_copy_of_its_sample():
    """The sample is the driver's largest array: its peak above it stays under a fifth of it."""
    import tracemalloc

    import numpy as np

    from tillroll.llm import ordinal

    random = np.random.default_rng(3)
    x = random.poisson(0.4, (1500, ordinal.BUCKETS + 1)).astype(np.float32)
    grade = random.integers(0, 2, 1500).astype(float)
    tracemalloc.start()
    try:
        ordinal.fit(x, grade, steps=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < x.nbytes / 5
