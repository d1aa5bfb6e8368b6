"""Token ids equal the plain tokenizer's on awkward texts and on every document of the small table."""

import random

import duckdb
import pyarrow as pa
import pytest

from strata.llm import tokens

AWKWARD = ["", " ", "\n\t", "a", "Hello, World!", "don't 's 'tis it's. dogs' 'same ('same x's) ''s", "abc123.45, 3.14! 1,000", "foo—bar—, naïve. É́cole, straße; ΣΑΣ. İstanbul!", "a b c　.",
           "word\x0bword\x0cword\rword\x1cword", "<|endoftext|> x<|startoftext|>y, <| |>", "x<|", "日本語、テスト。 😀! 👍🏽,", "é. e ́ .́", "...a...b... a... ..a", "[a](b)_c_ __d__ `e`", "A_B-C.D", "q" * 3000,
           "!" * 500, "a." * 500, "​. ﻿, ﬁ. ǆ! ŉ?", "x\x00y. \x7f!", "🇩🇪.,", "ａｂ．", "½. ²! Ⅷ?", "'", "'.", "a'.", "a'. b", "1'.", "word. \nword .\tword"]


def plain(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def own(texts, tok=None):
    ids, ends = (tok or tokens.WordTokenizer()).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist())]


def test_awkward_texts_alone_and_together():
    assert own(AWKWARD + [None]) == plain(AWKWARD + [None])
    assert [own([t])[0] for t in AWKWARD] == plain(AWKWARD)
    assert own([]) == [] and own([None, ""]) == [[], []]
    assert own(pa.array(AWKWARD).slice(3, 9).to_pylist()) == plain(AWKWARD[3:12])


@pytest.mark.parametrize("seed", range(4))
def test_random_mixtures(seed):
    rng = random.Random(seed)
    parts = ["a", "B", "é", "É", "ß", "Σ", "1", "9", ".", ",", "!", "'", "s", "t", "-", "_", "<", "|", ">", " ", "\n", "\t", " ", "—", "…", "́", "日", "😀", "\x0b", "re", "'ll"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(600)]
    tok = tokens.WordTokenizer(cache_pieces=200)  # so small that both halves turn over
    assert [x for a in range(0, 600, 50) for x in own(texts[a:a + 50], tok)] == plain(texts)


def test_every_document_of_the_small_table():
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' ORDER BY doc_id").fetchall()]
    assert own(texts) == plain(texts)
