import hashlib
import random
import string

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from siltgauge.llm import secrets

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


def corpus(draw):
    """Texts with secrets and look-alikes, and where the secrets are."""
    words = "the of and to in river house window letter morning garden remember yesterday between".split()
    rows, truth = [], set()
    for n in range(400):
        parts = [draw.choice(words) for _ in range(30)]
        place, kind = draw.randrange(5, 25), n % 5
        hexes = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        mixed = "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(draw.randrange(20, 45)))
        if kind == 0:
            parts[place] = f'token = "{hexes}"'
        elif kind == 1:
            parts[place] = f"api_key: {mixed}"
        elif kind == 2:
            parts[place] = "".join(draw.choice("0123456789") for _ in range(20))
        elif kind == 3:
            parts[place] = draw.choice(["internationalization", "unquestionablyremember", "gardenwindowhousemorning"])
        text = " ".join(parts)
        if kind < 2:
            secret = hexes if kind == 0 else mixed
            truth.add((n, text.index(secret), text.index(secret) + len(secret), hashlib.sha256(secret.encode()).hexdigest()))
        rows.append((n, text, f"src{n % 3}", "x"))
    return rows, truth


def test_held_out_findings(spark):
    train_rows, _ = corpus(random.Random(1))
    test_rows, truth = corpus(random.Random(2))
    frame = "doc_id long, text string, source string, label string"
    train_docs, test_docs = spark.createDataFrame(train_rows, frame), spark.createDataFrame(test_rows, frame)
    costs = secrets.transition_costs(train_docs)
    labelled = secrets.find_candidates(train_docs, VOCABULARY, costs)
    found = {tuple(r)[:4] for r in secrets.find_secrets(test_docs, VOCABULARY, labelled=labelled).collect()}
    assert len(found & truth) >= 0.97 * len(truth)
    assert len(found - truth) <= 0.03 * len(truth)
    again = secrets.find_secrets(test_docs.repartition(5), VOCABULARY).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in secrets.find_secrets(test_docs, VOCABULARY).collect()}


def test_transitions_count_all_texts(spark):
    docs = spark.createDataFrame([("abab",), (None,), ("",), ("a",), ("é1",)], "text string")
    costs = secrets.transition_costs(docs).reshape(secrets.N_SYMBOLS, -1)
    table = np.ones_like(costs)
    table[0, 1] += 2
    table[1, 0] += 1
    table[28, 28] += 1
    table[28, 26] += 1
    assert np.allclose(costs, -np.log(table / table.sum(axis=1, keepdims=True)))


def test_coverage():
    entries = frozenset(["house", "garden", "ouse"])
    assert secrets.covered("gardenXhouse", entries) == 11 / 12
    assert secrets.covered("x9x9", entries) == 0


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (None, 'token = "0a1b2c3d4e5f6a7b8c9d"', None), (3, "A" * 300_000, "b"), (4, "1" * 20 + " x", "b")]
    docs = spark.createDataFrame(rows + rows[2:3], "doc_id long, text string, source string").withColumn("score", F.lit(1))
    out = secrets.find_secrets(docs, VOCABULARY).collect()
    assert [(r.doc_id, r.start, r.end) for r in out] == [(None, 9, 29)]
    only = docs.where("doc_id is null")
    assert len(secrets.find_secrets(only, VOCABULARY).collect()) == 1
    assert secrets.find_secrets(docs.limit(0), VOCABULARY).collect() == []


def test_values_after_key_words_are_candidates():
    text = 'password = "Tr0ub4dor&3" key="sk.live!abc" api_key="sk.live!abc$9Z", token: abc12; \'secret\': \'é!xyz9\' auth=' + "Z" * 30
    found = [text[a:b] for a, b in secrets.candidates_in(text)]
    assert found == ["Tr0ub4dor&3", "sk.live!abc$9Z", "é!xyz9", "Z" * 30]
    assert list(secrets.candidates_in("password = short")) == []
    assert [a for a, _ in secrets.candidates_in("x" * 16 + " token=" + "y" * 40)] == [0, 23]


def plain_features(candidate, before, after, path, costs, entries):
    """The same numbers one character at a time."""
    n = len(candidate)
    probabilities = [candidate.count(c) / n for c in sorted(set(candidate))]
    kind = lambda c: "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s"
    out = [n, -sum(p * np.log2(p) for p in probabilities)]
    out.append(sum(kind(a) != kind(b) for a, b in zip(candidate, candidate[1:])) / n)

    def symbol(b):
        c = chr(b)
        return 28 if b > 127 else 26 if c.isdigit() else ord(c.lower()) - 97 if c.isalpha() else 27

    codes = [symbol(b) for b in candidate.encode()]
    steps = [costs[a * secrets.N_SYMBOLS + b] for a, b in zip(codes, codes[1:])]
    out += [sum(steps) / len(steps), max(steps)]
    out += [sum(kind(c) == k for c in candidate) / n for k in "duls"]
    out.append(secrets.covered(candidate, entries))
    for word in (before, after, path):
        bucket = [0.0] * secrets.BUCKETS
        bucket[secrets._bucket(word)] = 1.0
        out += bucket
    return out


def test_features_against_plain_ones():
    draw = random.Random(9)
    costs = np.array([draw.random() * 9 for _ in range(secrets.N_SYMBOLS**2)])
    entries = frozenset(["house", "token", "live"])
    for _ in range(200):
        candidate = "".join(draw.choice(string.printable[:94] + "éß") for _ in range(draw.randrange(6, 40)))
        got = secrets.features(candidate, 'the river token = "', " then more", "src1", costs, entries)
        assert np.allclose(got, plain_features(candidate, "river", "then", "src1", costs, entries))


def test_digests_that_are_called_so_are_no_secrets():
    hexes = "0123456789abcdef" * 2 + "01234567"
    assert secrets.sure_label(hexes, "see commit ") == 0 == secrets.sure_label("123e4567-e89b-12d3-a456-426614174000", "uuid: ")
    assert secrets.sure_label(hexes, "token = ") == 1 and secrets.sure_label(hexes, "see ") is None
    # neither the key word nor the assignment is among the features
    costs, entries = np.ones(secrets.N_SYMBOLS**2), frozenset()
    assert secrets.features(hexes, "river token = ", "", "", costs, entries) == secrets.features(hexes, "river commit ", "", "", costs, entries)
