import os
import random

import numpy as np
import pytest
import regex
from telarium.llm import tokens as K

VOCAB = f"{K.TOKENIZERS}/{K.VOCABULARY}"
pytestmark = pytest.mark.skipif(not os.path.exists(VOCAB), reason="no vocabulary files")


@pytest.fixture(scope="module")
def truth():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks=K.ranks(VOCAB), special_tokens={}).encode_ordinary


TEXTS = [None, "", " ", "\n\n", "Los estudiantes miden el agua.", "<|endoftext|> y más", "日月水火 👩‍🏫 naïve​", "a" * 3000, "=" * 5000, "it's we'll I'D", "x\t\ty  z   ", "é" * 400, "�\x00\x7f", "palabra " * 4000]


def test_ids(spark, truth):
    rows = [(i, t, "b", [1]) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "c", None)]
    got = K.encode(spark.createDataFrame(rows, "doc_id long, text string, ids string, word array<int>")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == (truth(TEXTS[r.doc_id]) if TEXTS[r.doc_id] else [])


def test_empty_table(spark):
    assert K.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_merge_is_exact(truth):
    r = random.Random(4)
    rank = K.ranks(VOCAB)
    for _ in range(500):
        w = "".join(r.choice("aeiourstnl ñéß水") for _ in range(r.randint(1, 40)))
        assert [i for x in regex.findall(K.PATTERN, w) for i in K.merge(x.encode(), rank)] == truth(w)


def test_automaton_numbers_words_and_shares_suffixes(tmp_path):
    words = sorted({w.encode() for w in "casa casas cosa cosas caso mesa mesas m a".split()})
    parts = K.minimal_automaton(words)
    assert len(parts["final"]) < sum(map(len, words))
    lex = object.__new__(K.Lexicon)
    lex.keys, lex.target, lex.skip, lex.final = (parts[k].astype(np.int64) for k in ("keys", "target", "skip", "final"))
    asked = [*words, b"cas", b"cosax", b"", b"z", b"mes"]
    assert lex.numbers(asked).tolist() == [*range(len(words)), -1, -1, -1, -1, -1]


def test_round_trip(spark):
    back = {i: b for b, i in K.ranks(VOCAB).items()}
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in K.encode(df).collect():
        assert b"".join(back[i] for i in r.ids).decode() == (TEXTS[r.doc_id] or "")


def test_a_small_lexicon_gives_the_same(spark, truth):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    path = K.fit_lexicon(df, size=2, min_count=1)
    assert all(r.ids == (truth(TEXTS[r.doc_id]) if TEXTS[r.doc_id] else []) for r in K.encode(df, lexicon=path).collect())
