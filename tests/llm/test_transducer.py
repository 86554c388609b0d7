import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltgauge.llm import transducer

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
LIBRARY = Tokenizer.from_file(PATH)
MERGES = transducer.Merges(PATH)
LOOKAHEAD = MERGES.lookahead()
ODD = transducer.strange(PATH)
CODER = transducer.Coder(PATH, LOOKAHEAD, ODD)

TEXTS = [
    "",
    " ",
    "Don't  stop\n\n\tnow, it'S over'd'",
    "ΑΣ ΣΊΣΥΦΟΣ İstanbul ǅ ﬁ é é 한 각 á̧",
    "a᠎b c\u0085d e​f x\x1cy",
    "<|endoftext|>a<|startoftext|> <|END",
    "emoji 😀 new \U0001f9ff \U0001fae8 end",
    "1234 ½ Ⅷ ٣٤",
    "''' 'r 're 'l 'll ...'s",
]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ours(text):
    return [i for part in CODER.pieces(text) for i in part]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(text):
    assert ours(text) == library(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert ours(text) == library(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"aehnst'rS. 1", "the", "ing", "é", "́", "̧", "각", "ᅡ", "\n", "é", "Σ"]), max_size=80), st.integers(1, 7))
def test_pieces_of_any_size(parts, size):
    text = "".join(parts)
    encoder = transducer.Encoder(MERGES, LOOKAHEAD)
    got = [i for k in range(0, len(text), size) for i in encoder.feed(text[k : k + size])] + encoder.finish()
    assert got == library(text)


@pytest.mark.parametrize("letters", ["a", "ab", "abcdehinorst", "é", "!", ".-=", "!'s", "漢字", "́a"])
def test_very_long_words(letters):
    draw = random.Random(letters)
    text = "".join(draw.choice(letters) for _ in range(40_000))
    assert ours(f"x {text} y{text}1") == library(f"x {text} y{text}1")


def test_long_words_of_words():
    draw = random.Random(1)
    tokens = [t.removesuffix("</w>") for t in MERGES.ids if t.isascii() and t.removesuffix("</w>").isalpha()]
    for _ in range(20):
        text = "".join(draw.choice(tokens) for _ in range(3_000))
        assert ours(text) == library(text)


def test_an_open_word_waits_no_longer_than_the_lookahead():
    assert LOOKAHEAD < 5_000
    word = transducer.OpenWord(MERGES, LOOKAHEAD)
    for _ in range(30):
        word.feed("tokenization" * 100)
        assert len(word.waiting) <= LOOKAHEAD + 2 * transducer.STEP


def test_the_lookahead_holds():
    """Borders farther back than the lookahead are the same whatever follows."""
    draw = random.Random(2)
    tokens = [t for t in MERGES.ids if t.isascii() and t.isalpha()]
    farthest = 0
    for _ in range(300):
        text = "".join(draw.choice(tokens) for _ in range(40))
        cut = draw.randrange(1, len(text))

        def borders(symbols):
            ends = np.cumsum([len(t.removesuffix("</w>")) for t in MERGES.tokens(symbols)])
            return {int(e) for e in ends}

        one = borders(MERGES.symbols(text[:cut], last=False))
        two = {b for b in borders(MERGES.symbols(text)) if b < cut}
        differ = (one ^ two) - {cut}
        farthest = max([farthest, *(cut - b for b in differ)])
    assert 0 < farthest <= LOOKAHEAD


def test_a_list_without_order_has_no_bound():
    merges = transducer.Merges(PATH)
    merges.rules = [("th", "e"), ("t", "h")]
    with pytest.raises(ValueError):
        merges.lookahead()


def digest(data):
    return hashlib.sha256(data).hexdigest()


def test_rows(spark):
    long_text = "a very long text, é " * 30_000 + "z" * 50_000
    rows = [(n, t, "k") for n, t in enumerate([*TEXTS, long_text])] + [(100, None, "l"), (None, "two words", "m"), (1, " ", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r)[:4] for r in transducer.transcode(docs, PATH).collect()), key=str)
    want = []
    for i, text, _ in rows:
        ids = library(text or "")
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), digest(np.array(ids, dtype="<u4").tobytes()), digest(decoded.encode())))
    assert got == sorted(want, key=str)
    assert transducer.transcode(docs.limit(0), PATH).collect() == []


def test_there_and_back(spark):
    rows = [(n, t) for n, t in enumerate(TEXTS) if "<|" not in t] + [(50, None)]
    encoded = transducer.encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    for r in transducer.decode(encoded, PATH).collect():
        assert list(r.ids) == library(r.text or "")
        plain = LIBRARY.normalizer.normalize_str(r.text or "")
        assert "".join(r.decoded.split(" ")) == "".join(plain.split(" "))
    joined = transducer.decode(encoded, PATH, readable=False).select("ids", "decoded").collect()
    assert all(r.decoded == LIBRARY.decode(list(r.ids), skip_special_tokens=False) for r in joined)


def test_bytes_wait_for_their_character():
    decoder = transducer.Decoder(MERGES)
    ids = MERGES.ids
    parts = [ids[letter] for letter in MERGES.symbols("漢é", last=False)]
    assert "".join(decoder.readable([i]) for i in parts) == "漢é"
    assert decoder.readable(parts[:1]) == "" and decoder.readable([], last=True) == "�"


def test_no_character_of_old_unicode_is_left_to_the_library():
    odd = transducer.re.compile(ODD)
    old = [c for c in map(chr, range(0x10000)) if unicodedata.ucd_3_2_0.category(c) not in ("Cn", "Cs")]
    assert sum(bool(odd.match(c)) for c in old) < 100
