import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from siltgauge.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def buckets(text):
    words = WORD.findall((text or "").translate(UPPER))
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [crc32(f.encode()) % 10000 for f in features]


def brute(docs, targets):
    held = [(i, *buckets(t)) for i, t in docs]
    source, target = Counter(b for *_, f in held for b in f), Counter(b for t in targets for b in buckets(t)[1])
    s_all, t_all = sum(source.values()), sum(target.values())

    def gain(b):
        return math.floor(1000 * math.log((target[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000))))

    rows = []
    for i, n_words, found in held:
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, n_words])
    drawable = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(drawable[: 25 * len(drawable) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def made_up():
    draw = random.Random(8)
    vocabulary = [f"w{n}" for n in range(300)] + ["Straße", "É", "漢字", "x1"]

    def text(n, low):
        return draw.choice([" ", ". ", "_"]).join(draw.choice(vocabulary[low:]) for _ in range(n))

    docs = [(n * 37 % 1009, text(draw.randrange(0, 80), draw.choice([0, 150]))) for n in range(300)]
    docs += [(None, text(40, 0)), (None, None), (2000, None), (2001, ""), (2002, "- \n"), (2003, "One"), (7, docs[7][1]), (7, docs[7][1])]
    docs += [(3000 + n, "the same text " * 9) for n in range(60)]
    return docs, [text(30, 200) for _ in range(20)] + [None, "", "one"]


def test_against_plain_sums(spark, made_up):
    docs, targets = made_up
    frame = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id long, text string, rank int")
    wanted = spark.createDataFrame([(t, "z") for t in targets], "text string, doc_id string")
    out = resample.resample(frame, wanted)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in out.dtypes} == {"bigint"}
    assert rows(out) == brute(docs, targets)


def test_empty_tables(spark, made_up):
    docs = spark.createDataFrame(made_up[0][:60], "doc_id long, text string")
    targets = spark.createDataFrame([(t,) for t in made_up[1]], "text string")
    assert resample.resample(docs.limit(0), targets).collect() == []
    assert rows(resample.resample(docs, targets.limit(0))) == brute(made_up[0][:60], [])


@pytest.mark.parametrize("seed", range(30))
def test_planes_add_up_exactly(seed):
    draw = np.random.default_rng(seed)
    values = draw.integers(-(2 ** draw.integers(1, 20)), 2 ** draw.integers(0, 20), resample.BUCKETS)
    counts = draw.integers(0, 2 ** draw.integers(1, 40), resample.BUCKETS) * draw.integers(0, 2, resample.BUCKETS)
    assert resample.GainPlanes(values).total(counts) == sum(a * b for a, b in zip(counts.tolist(), values.tolist(), strict=True))


def test_long_texts_come_in_parts():
    text = "Some words, to and fro; " * 200_000 + "x" * 3_000_000 + " end"
    n_words, found = buckets(text)
    parts = list(resample.feature_buckets(text))
    assert len(parts) > 3
    assert sum(n for n, _ in parts) == n_words
    assert Counter(b for _, f in parts for b in f.tolist()) == Counter(found)
