import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltgauge.llm import tokens

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(PATH)
PROVEN = tokens.whole_tokens(PATH)
COUNT = tokens.token_counter(PATH, PROVEN)

TEXTS = ["", " ", "a", "don't  stop\n\n\tnow ", "é中文😀 x", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "x" * 50_000, "ࢦ ੾ 𐥀"]


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_proven_strings_are_one_token_alone():
    assert len(PROVEN) > 40_000
    for text in sorted(PROVEN)[::97]:
        assert library(text) == 1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert COUNT(text) == library(text)


def test_rows(spark):
    rows = [(n, t, 1) for n, t in enumerate(TEXTS)] + [(100, None, 2), (None, "two words", 3), (1, " ", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = tokens.count_tokens(docs, PATH).collect()
    want = sorted(((i, len((t or "").encode()), library(t)) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in out), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in out)
    assert tokens.count_tokens(docs.limit(0), PATH).collect() == []
