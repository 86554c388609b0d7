import math
import random
import re

import pytest

from siltgauge.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top=20):
    """item place -> the best (score, doc_id), by scoring every document by itself."""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, ws) for i, ws in held if ws]
    n_docs, n_terms = len(held), sum(len(ws) for _, ws in held)
    out = []
    for item_id, text in items:
        scores = []
        for i, ws in held:
            m = 100 - 25 + 25 * len(ws) * n_docs // n_terms
            score = 0
            for term in terms(text):
                df = sum(term in other for _, other in held)
                tf = ws.count(term)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1000000000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        scores.sort()
        out += [(item_id, r, None if none else i, -s) for r, (s, none, i) in enumerate(scores[:top], 1)]
    return out


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, term string"),
        spark.createDataFrame([(k, t, 2) for k, t in items], "item_id long, text string, score int"),
    )


def rows(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def made_up():
    draw = random.Random(3)
    vocabulary = [f"w{n}" for n in range(60)] + ["É", "über", "漢字", "A1"]

    def text(n):
        return draw.choice([" ", ", ", "_"]).join(draw.choice(vocabulary) for _ in range(n))

    docs = [(n * 7 % 211, text(draw.randrange(0, 30))) for n in range(150)]
    docs += [(1000 - n, "W1 w2 w2, w3") for n in range(70)] + [(2000 + n, f"w1 w2-w2 w3 other{n}") for n in range(40)]
    docs += [(None, "w1 w2 w2 w3"), (None, "w5"), (3000, None), (3001, ""), (3002, "\n ,"), (5, "w1 w1"), (5, "w1 w1")]
    items = [(n, text(draw.randrange(1, 15))) for n in range(12)]
    items += [(50, "w2 w2 w3"), (51, None), (52, "!"), (53, "nowhere"), (50, "w2 w2 w3"), (54, "w5 É é")]
    return docs, items


def test_against_every_document(spark, made_up):
    docs, items = made_up
    assert rows(lexical.search(*frames(spark, docs, items))) == sorted(brute(docs, items), key=str)


def test_blocks_of_items_change_nothing(spark, made_up, monkeypatch):
    docs, items = made_up
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 20)
    docs_frame, items_frame = frames(spark, docs, items)
    assert rows(lexical.search(docs_frame, items_frame, top=7)) == sorted(brute(docs, items, 7), key=str)


def test_a_class_is_kept_once_with_its_smallest_ids(spark):
    copies = [(n, [1, 2], [3, 1], 80) for n in range(500, 0, -1)] + [(0, [1, 2], [3, 1], 81), (9, [1], [3], 80)]
    bags = spark.createDataFrame(copies, "doc_id long, terms array<int>, tfs array<long>, m long").repartition(7)
    got = {(tuple(r.members), r.m, tuple(r.terms)) for r in lexical.bag_classes(bags, 4).collect()}
    assert got == {((1, 2, 3, 4), 80, (1, 2)), ((0,), 81, (1, 2)), ((9,), 80, (1,))}


def test_empty_tables_and_long_texts(spark, made_up):
    docs, items = frames(spark, *made_up)
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.where("doc_id = 3000"), items).collect() == []
    long_text = "filler " * 400_000 + "needle"
    pair = spark.createDataFrame([(1, long_text), (2, "Needle")], "doc_id long, text string")
    asked = [(1, "needle")]
    assert rows(lexical.search(pair, spark.createDataFrame(asked, "item_id long, text string"))) == brute([(1, long_text), (2, "Needle")], asked)
