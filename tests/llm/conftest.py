from __future__ import annotations

import random
import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, n=120):
    r = random.Random(seed)
    parts = ["ka", "lo", "mi", "ne", "ru", "sa", "té", "vo", "zu", "pri", "tan"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="session")
def awkward():
    """Rows with nulls, empty and very long texts, copies and repeated rows."""
    base = [prose(i) for i in range(12)]
    shared = prose(99, 40)
    near = base[0].split()
    near[7] = "changed"
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(20, base[0], "en", "s0", 1), (21, " ".join(near), "en", None, 1), (22, None, "en", "s1", 0), (23, "", "en", "s1", 0),
             (24, "   \n\t", None, "s2", 5), (25, "one", "en", "s2", 3), (26, "one", "en", None, 3), (27, base[3] + " " + shared, "en", "s1", 9),
             (28, shared + " " + base[4][:200], "en", "s0", 9), (29, prose(7, 30_000), "en", "s0", 9), (29, base[5], "en", "s0", 9),
             (30, base[6], "en", "s0", 9), (30, base[6], "en", "s0", 9), (None, base[7], "en", None, 9), (None, prose(55), None, None, None),
             (31, "a" * 400, "en", "s0", 400), (32, "b" + "a" * 300 + "é" * 60, "en", "s0", 360), (33, "x" * 49, "en", "s0", 49),
             (34, "Ünïcode “quotes” — dashes " * 8, "de", "s1", 9), (35, "THE Same Words the same words", "en", "s1", 9)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, awkward):
    """The awkward rows, with extra columns under names the operators use."""
    df = spark.createDataFrame(awkward, SCHEMA).repartition(3)
    for name in ("key", "class", "nodes", "size", "block", "row", "chunk", "target", "taken", "kept", "score", "id", "winner_key", "n_words", "v", "a", "b"):
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
