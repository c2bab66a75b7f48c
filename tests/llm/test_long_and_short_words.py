"""Texts of long white space through the tokenizer, toxic terms of any length
and script, and work tables that belong to their owner."""

from __future__ import annotations

import base64
import random

import numpy as np
import pytest
import tiktoken

from tillroll.llm import eodscan, toxicity
from tillroll.llm.common import release_work, stored, work_owner

from .conftest import prose

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def encoding():
    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines()) if a}
    return tiktoken.Encoding("given", pat_str=eodscan.SPLIT, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("space", [" ", "\n", "\t ", "　", "  \r\n"])
def test_long_white_space_gives_the_same_ids(encoding, space):
    run = space * 3000
    for text in (run, f"a{run}", f"{run}b", f"a b{run}c d{run}", f"x{run}'s{run}!{run}7", f"é{run}​z\x1c{run}é"):
        assert eodscan.encode_whole(encoding, text) == encoding.encode_ordinary(text)


def test_a_megabyte_of_spaces_is_counted(spark, encoding):
    texts = [" " * 1_000_000 + "x", "one two", None, "\n" * 1_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in eodscan.token_counts(df, eodscan.byte_pair_encoder(VOCABULARY), 50256).collect()}
    spaces, lines = (len(encoding._encode_single_piece(t.encode())) for t in (" " * 999_999, "\n" * 1_000_000))
    assert got == {0: spaces + 1 + (len(encoding.encode_ordinary(" x")) - 1), 1: 2, 2: 0, 3: lines}


@pytest.mark.parametrize("insult", ["wq", "zug", "zugzu", "q" * 30, "z" * 90, "バカ", "ไอ้"])
def test_terms_of_any_length_and_script_are_learned(spark, insult):
    r = random.Random(len(insult))
    dense = insult[0] in "バไ"

    def text(i, bad):
        w = prose(i, 50).lower().split()
        for _ in range(2 if bad else 0):
            at = r.randrange(len(w))
            w[at] = f"漢字{chr(0x4e00 + r.randrange(900))}{insult}{chr(0x4e00 + r.randrange(900))}文" if dense else insult
        return " ".join(w)
    rows = [(i, text(i, i < 40), int(i < 40)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "label"))
    spelled = insult.encode()
    assert any(t == spelled or (dense and t in spelled) for t in model.lexicon.terms)
    test = [(i, text(1000 + i, i < 20)) for i in range(60)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(test, "doc_id long, text string"), model).collect()}
    assert min(got[i] for i in range(20)) > 0.5 > max(got[i] for i in range(20, 60))


def test_spans_of_scripts_without_spaces():
    texts = ["ab 漢字文 c", "字", "x漢字y", "ไทย", "é ü"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts, ends, edges = toxicity.term_spans(data, off)
    words = [bytes(data[s:e]).decode() for s, e in zip(starts, ends, strict=True)]
    assert [words[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)] == [
        ["ab", "漢字", "字文", "c"], ["字"], ["x", "漢字", "y"], ["ไท", "ทย"], ["é", "ü"]]


def test_no_word_is_cut_before_its_gain_is_known(spark):
    """A wide vocabulary of words commoner than the toxic one."""
    rows = [(" ".join(f"w{j:05d}" for j in range(400)) + f" a{i} slur b{i}",) for i in range(12)]
    toxic = spark.createDataFrame(rows, "text string")
    clean = spark.createDataFrame([(" ".join(f"c{i}x{j} w{j:05d}" for j in range(400)),) for i in range(60)], "text string")
    found = toxicity.learn_lexicon(toxic, clean, 0.16, most=2)
    assert found == [b"slur"]


def test_owners_release_their_own_tables(spark):
    with work_owner("one"):
        first = stored(spark.range(3).toDF("x"), "first")
    with work_owner("two"):
        second = stored(spark.range(4).toDF("x"), "second")
    release_work(spark, "one")
    assert second.count() == 4
    with pytest.raises(Exception):  # noqa: B017
        first.count()
