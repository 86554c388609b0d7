import random
import re

import numpy as np
import pytest

from siltgauge.llm import decontaminate as dc


def brute_tiles(item, doc, least):
    """Greedy string tiling by comparing every pair of places."""
    in_item, in_doc, found = set(), set(), []
    while True:
        best, hits = least - 1, []
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and p + n not in in_item and t + n not in in_doc:
                    n += 1
                if n > best:
                    best, hits = n, [(p, t)]
                elif n == best >= least:
                    hits.append((p, t))
        if best < least:
            return found
        for p, t in hits:
            if not in_item & set(range(p, p + best)) and not in_doc & set(range(t, t + best)):
                in_item |= set(range(p, p + best))
                in_doc |= set(range(t, t + best))
                found.append((p, t, best))


@pytest.mark.parametrize("seed", range(60))
def test_tiles(seed):
    draw = random.Random(seed)
    item = [draw.randrange(4 + seed % 20) + 1 for _ in range(draw.randrange(1, 40))]
    doc = [draw.randrange(4 + seed % 20) + 1 for _ in range(draw.randrange(1, 30))]
    for _ in range(2):
        a = draw.randrange(len(item))
        doc[draw.randrange(len(doc)) :][:0] = item[a : a + 12]
        doc += item[a : a + draw.randrange(12)]
    least = draw.choice([2, 3, 5])
    got = dc.tiles(np.array(item, dtype=np.uint64), np.array(doc, dtype=np.uint64), least=least)
    assert got == brute_tiles(item, doc, least)


def split(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def brute(docs, items, threshold=0.5):
    out = set()
    for i, text in docs:
        for k, passage in items:
            want = split(passage)
            if len(want) >= 5:
                n = sum(t[2] for t in brute_tiles(want, split(text), 5))
                if n >= threshold * len(want):
                    out.add((i, k, len(want), n))
    return out


def test_leaks(spark):
    draw = random.Random(4)
    vocabulary = [f"w{n}" for n in range(120)]
    items = [(k, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(3, 40)))) for k in range(25)]
    items += [(100, None), (101, ""), (102, "Only four words here"), (103, items[0][1]), (None, "an item that has no id of its own at all")]
    docs = []
    for n in range(80):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(0, 60))]
        passage = draw.choice(items[:25])[1].split(" ")
        parts = [passage[i : i + 8] for i in range(0, len(passage), 8)]
        draw.shuffle(parts)
        for part in parts[: draw.randrange(0, 6)]:
            words[draw.randrange(len(words) + 1) :][:0] = part
            words += [p.upper() + draw.choice(["", ",", "."]) for p in part]
        docs.append((n, " ".join(words)))
    docs += [(500, None), (501, ""), (None, "x. " + items[3][1]), (None, "clean"), (502, "An item that has - no id! of its own, at all"), docs[0], (0, items[1][1])]
    frame = spark.createDataFrame([(i, t, 7, "z") for i, t in docs], "doc_id long, text string, item_id int, ref string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.find_leaks(frame, bench).collect()
    assert len({(r.doc_id, r.ref, r.item_id) for r in got}) == len(got)
    assert {(r.doc_id, r.item_id, r.n_tokens, r.n_covered) for r in got} == brute(docs, items)
    kept = dc.drop_leaks(frame, bench)
    assert kept.columns == frame.columns
    leaky = {(i, t) for i, t in docs if brute([(i, t)], items)}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((d for d in docs if d not in leaky), key=str)
    assert dc.find_leaks(frame.limit(0), bench).collect() == [] == dc.find_leaks(frame, bench.limit(0)).collect()


def test_very_long_text(spark):
    passage = " ".join(f"p{n}" for n in range(30))
    text = "filler words " * 100_000 + passage + " more" * 50_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.n_covered for r in dc.find_leaks(docs, spark.createDataFrame([(1, passage)], "item_id long, text string")).collect()] == [30]
