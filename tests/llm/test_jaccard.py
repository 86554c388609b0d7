import random
import re

import numpy as np
import pytest

from siltgauge.llm import jaccard
from siltgauge.llm.components import components


def brute(rows, length, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(length, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    first = list(range(len(rows)))

    def root(x):
        while first[x] != x:
            x = first[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            same_id = rows[x][0] is not None and rows[x][0] == rows[y][0] and sets[x] and sets[y]
            if same_id or (sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])):
                first[root(x)] = root(y)
    out = set()
    for x, (i, _) in enumerate(rows):
        ids = [rows[y][0] for y in range(len(rows)) if root(y) == root(x) and rows[y][0] is not None]
        out.add((i, len(sets[x]), i if not sets[x] else min(ids, default=None)))
    return out


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    out, n = [], 0
    for _ in range(60):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.choice([1, 2, 3, 9, 10, 12, 20, 40, 150]))]
        for _ in range(draw.choice([1, 2, 6])):
            text = " ".join(edited(draw, base, draw.choice([0, 0, 1, 2, 3])))
            out.append((n * 7 % 1009, text))
            n += 1
    base = [f"z{draw.randrange(900)}" for _ in range(200)]
    out += [(2000 + k, " ".join(edited(draw, base, k % 6))) for k in range(120)]
    out += [(5000, None), (5001, ""), (5002, " \n"), (None, "a b c d"), (None, "q q q"), (5003, "A B C D"), (5004, out[0][1]), (5004, "x y z v w"), (5005, "X Y Z V W")]
    return out + [out[3], (6000, "v " * 30_000), (6001, "v " * 20_000)]


@pytest.mark.parametrize(("length", "percent"), [(3, 90), (5, 80)])
def test_components_equal_all_pairs(spark, rows, length, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 25)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, size int, key string")
    out = jaccard.link_documents(docs, length=length, percent=percent).collect()
    assert len(out) == len({tuple(r) for r in out})
    assert {tuple(r) for r in out} == brute(rows, length, percent)


def test_block_product_with_small_stripes(monkeypatch):
    monkeypatch.setattr(jaccard, "STRIPE", 16)
    draw = random.Random(3)
    base = np.array([draw.getrandbits(63) for _ in range(100)], dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[k % 9 :], np.arange(k % 7, dtype=np.uint64)))) for k in range(40)]
    side = np.arange(40) % 2
    for cross in (False, True):
        first = jaccard.linked(sets, side, cross, 90)
        want = list(range(40))
        links = [(x, y) for x in range(40) for y in range(x) if not (cross and side[x] == side[y])]
        for _ in range(40):
            for x, y in links:
                inter = len(np.intersect1d(sets[x], sets[y]))
                if 100 * inter >= 90 * (len(sets[x]) + len(sets[y]) - inter):
                    want[x] = want[y] = min(want[x], want[y])
        assert first.tolist() == want


def test_stage_keeps_one_of_each_group(spark, rows):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, size int")
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in brute(rows, 5, 80) if i == c}
    assert {r.doc_id for r in kept.collect()} == want
    assert jaccard.keep_first(docs.limit(0)).collect() == []
    assert jaccard.link_documents(docs.limit(0)).collect() == []


def test_chains_and_stars(spark):
    draw = random.Random(9)
    edges = [(n, n + 1) for n in range(300)] + [(1000, n) for n in range(1001, 1400)] + [(5, 5), (None, 3), (2001, 2000)]
    draw.shuffle(edges)
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {n: 0 for n in range(301)} | {n: 1000 for n in range(1000, 1400)} | {2000: 2000, 2001: 2000}


def test_sketches_lose_no_link():
    draw = np.random.default_rng(1)
    for percent in (80, 90):
        sets = []
        for _ in range(150):
            n = int(draw.choice([1, 3, 20, 63, 64, 65, 130, 500, 1030]))
            base = draw.integers(0, 1 << 63, n, dtype=np.uint64)
            gone = int(n * draw.choice([0, 0.05, 0.1, 0.2, 0.25]))
            more = draw.integers(0, 1 << 63, int(draw.integers(0, gone + 1)), dtype=np.uint64)
            sets += [np.unique(base), np.unique(np.concatenate([base[gone:], more]))]
        sizes, chunk = np.array([len(s) for s in sets]), draw.integers(0, 40, len(sets))
        for cross in (False, True):
            want = set()
            for x, one in enumerate(sets):
                for y, two in enumerate(sets):
                    both = len(np.intersect1d(one, two))
                    apart = not cross or chunk[x] // 16 != chunk[y] // 16
                    if x != y and apart and 100 * both >= percent * (len(one) + len(two) - both):
                        want.add((x, int(chunk[y])))
            open_rows = jaccard.open_rows([jaccard.sketch(s) for s in sets], sizes, chunk, chunk // 16, cross, percent)
            found = {(int(r), int(c)) for r, c in open_rows}
            assert want and want <= found
            assert len(found) < 1.6 * len(want) + 20


def test_only_texts_asked_for_are_hashed(spark, rows):
    named = spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id long, text string")
    ids = spark.createDataFrame([(rows[0][0],), (rows[9][0],), (None,)], "_id long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard.hashed_texts(named, ids, 3)
        met = found.join(spark.createDataFrame([(b"k", 1)], "key binary, chunk int"), "key")
        assert met._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
        want = [jaccard._key(jaccard._set(t or "", 3)) for i, t in rows if i in (rows[0][0], rows[9][0], None)]
        assert sorted(bytes(r.key) for r in found.select("key").collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_that_stay_are_not_shuffled(spark, monkeypatch):
    sides = []

    def seen(rows, key, words, real=jaccard.parted):
        sides.append(real(rows, key, words))
        return sides[-1]

    monkeypatch.setattr(jaccard, "parted", seen)
    draw = random.Random(13)
    docs = [(n, " ".join(f"w{draw.randrange(10**6)}" for _ in range(30)), "k", 1) for n in range(200)]
    docs += [(500, docs[3][1], "k", 2), (501, "the same row", "k", 3), (501, "the same row", "k", 3), (None, "a row without id", None, 4)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, word string, bits int")
    kept = jaccard.keep_first(frame)
    assert kept.columns == frame.columns
    want = [*docs[:200], (501, "the same row", "k", 3), (None, "a row without id", None, 4)]
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))
    ((some, others),) = sides
    assert some.count() < 10 and some.count() + others.count() == len(docs)


def test_sets_that_share_parts_by_chance_are_no_cluster(spark, monkeypatch):
    wanted = []

    def seen(df, purpose, real=jaccard.landed):
        out = real(df, purpose)
        if purpose == "wanted":
            wanted.append({r.rep for r in out.select("rep").collect()})
        return out

    monkeypatch.setattr(jaccard, "landed", seen)
    monkeypatch.setattr(jaccard, "CELL_ROWS", 7, raising=False)
    draw = random.Random(21)
    # Every text has half of its words from the one before, and a tenth from a passage of all.
    half = [[f"w{draw.randrange(10**9)}" for _ in range(60)] for _ in range(121)]
    common = [f"c{k}" for k in range(20)]
    rows = [(n, " ".join(half[n] + half[n + 1] + common)) for n in range(120)]
    rows += [(200 + n, " ".join(edited(draw, rows[n][1].split(" "), 2))) for n in (3, 50, 51)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard.link_documents(docs, length=5, percent=80).collect()
    assert {tuple(r) for r in out} == brute(rows, 5, 80)
    assert {3, 50, 51} <= wanted[0] and len(wanted[0]) < 40


def test_bridges_join_what_links():
    draw = np.random.default_rng(4)
    sets = []
    for _ in range(30):
        base = np.unique(draw.integers(0, 1 << 63, int(draw.choice([6, 30, 60, 70, 300])), dtype=np.uint64))
        sets += [base[int(len(base) * draw.choice([0, 0.05, 0.1, 0.19, 0.5])) :] for _ in range(4)]
    sizes, component, side = np.array([len(s) for s in sets]), draw.integers(0, 100, len(sets)), draw.integers(0, 2, len(sets))
    words = [np.frombuffer(jaccard.sketch(s, jaccard.NARROW), dtype=np.int64) for s in sets]
    for cross in (False, True):
        found = jaccard.bridges(component, sizes, words, side, cross, 80)
        assert len(found) < len(set(component.tolist()))
        assert not cross or all(side[x] != side[y] for x, y in found)
        joined = component.copy()
        for x, y in found:
            assert joined[x] != joined[y]
            joined[joined == joined[x]] = joined[y]
        links = [(x, y) for x in range(len(sets)) for y in range(x) if not (cross and side[x] == side[y])]
        for x, y in links:
            both = len(np.intersect1d(sets[x], sets[y]))
            assert joined[x] == joined[y] or 100 * both < 80 * (len(sets[x]) + len(sets[y]) - both)
