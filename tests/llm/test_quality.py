import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltgauge.llm import quality, words


def brute(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dups = sum(line in lines[:n] for n, line in enumerate(lines))
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeated), len(lines)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab é\n\t#\x0b\x1c ", max_size=80))
def test_features(text):
    assert quality.features(text) == brute(text)


@given(st.text(max_size=60))
def test_equal_words_have_equal_hashes(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = words.word_hashes(text).tolist()
    assert len(hashes) == len(found)
    assert len(set(hashes)) == len(set(found))
    assert hashes == words.word_hashes("x" * 999 + " \n" + text).tolist()[1:]


GOOD = "Yesterday several people walked through the ancient harbour town, looking at little boats."
ROWS = (
    [(n, GOOD + f" No {n}.", "good", 1) for n in range(40)]
    + [(100 + n, "# $ % " * 4 + GOOD, "bad", 1) for n in range(40)]
    + [(140, GOOD, "bad", 1), (150, None, "good", 2), (151, "", None, 3), (None, GOOD, None, 4), (3, GOOD + " No 3.", "good", 1)]
    + [(160, "a b c d e f " * 30, "good", 5), (161, "word " * 100_000, "good", 5)]
)


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string, kept int")


def test_verdicts(docs):
    out = quality.rate_documents(docs).collect()
    assert len(out) == len(ROWS)
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[n] for n in range(40)) and kept[140] and kept[None]
    assert not any(kept[n] for n in (*range(100, 140), 150, 151, 160, 161))
    by_id = {i: t for i, t, *_ in ROWS}
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) == brute(by_id[r.doc_id] or "")


def test_hosts_are_shrunk_to_the_mean(spark):
    rows = [("a", ["symbols"])] + [("b", [])] * 50 + [("c", ["symbols"])] * 45 + [("c", [])] * 5
    scored = spark.createDataFrame(rows, "host string, failed_rules array<string>")
    hosts = {r.host: r for r in quality.host_verdicts(scored).collect()}
    rates = [1.0, 0.0, 0.9]
    mean = sum(rates) / 3
    var = sum((r - mean) ** 2 for r in rates) / 2
    weight = max(mean * (1 - mean) / var - 1, 1)
    for host, n, k in (("a", 1, 1), ("b", 50, 0), ("c", 50, 45)):
        assert hosts[host].shrunk_rate == pytest.approx((k + mean * weight) / (n + weight))
    assert hosts["c"].rejected and hosts["c"].n_symbols == 45 and not hosts["b"].rejected


def test_stage_keeps_columns(docs):
    out = quality.keep_good(docs)
    assert out.columns == docs.columns
    assert out.where("doc_id = 3").count() == 2
    assert quality.keep_good(docs.limit(0)).collect() == []
    assert quality.rate_documents(docs.limit(0)).collect() == []
