import random

import pytest
from pyspark.sql import functions as F

from siltgauge.llm import lines


def shingles(line):
    units = line.encode("utf-16-be")
    n = len(units) // 2
    return {units[2 * i : 2 * i + 10] for i in range(max(n - 4, 1))}


def brute(docs):
    """Lines to remove per (id, text): all but the first of each component of similar lines."""
    places = [
        ((i is None, i or 0), text, number, line)
        for i, text in dict.fromkeys((i, t or "") for i, t in docs)
        for number, line in enumerate(text.split("\n"), 1)
        if line.strip(" \t\n\x0b\x0c\r")
    ]
    distinct = list(dict.fromkeys(p[3] for p in places))
    sets = [shingles(line) for line in distinct]
    first = list(range(len(distinct)))

    def root(x):
        while first[x] != x:
            x = first[x]
        return x

    for x in range(len(distinct)):
        for y in range(x):
            if min(len(sets[x]), len(sets[y])) * 5 >= max(len(sets[x]), len(sets[y])) * 4:
                if 10 * len(sets[x] & sets[y]) >= 8 * len(sets[x] | sets[y]):
                    first[root(x)] = root(y)
    groups = {}
    for p in places:
        groups.setdefault(root(distinct.index(p[3])), []).append(p)
    gone = set()
    for group in groups.values():
        group.sort(key=lambda p: (p[0], p[2]))
        gone |= {(p[0], p[1], p[2]) for p in group[1:]}
    return gone


def removed(spark, docs):
    frame = spark.createDataFrame([(i, t or "") for i, t in docs], "doc_id long, text string").withColumn("ref", F.xxhash64("text"))
    texts = {(r.doc_id, r.ref): r.text for r in frame.collect()}
    out = lines.repeated_lines(frame).collect()
    return {((r.doc_id is None, r.doc_id or 0), texts[r.doc_id, r.ref], n) for r in out for n in r.removed}


@pytest.fixture(scope="module")
def made_up():
    draw = random.Random(11)
    vocabulary = ["".join(draw.choice("abcdeilnorstu") for _ in range(draw.randrange(2, 9))) for _ in range(500)]
    base = [" ".join(draw.choice(vocabulary) for _ in range(draw.choice([1, 3, 8, 20, 60]))) for _ in range(150)]
    base += ["".join(draw.choice("漢字仮名交文章例") for _ in range(60)), "x" * 3000, "0123456789abcdef" * 40, "ab"]

    def near(line):
        words = line.split(" ")
        for _ in range(draw.choice([0, 0, 1, 2])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        return " ".join(words)

    docs = []
    for n in range(160):
        kept = [near(draw.choice(base)) for _ in range(draw.randrange(1, 6))] + ["", "a line that all have"]
        draw.shuffle(kept)
        docs.append((n * 31 % 997, "\n".join(kept)))
    return docs


def test_against_all_pairs(spark, made_up):
    want, found = brute(made_up), removed(spark, made_up)
    assert found <= want
    assert len(found) >= 0.97 * len(want)


def test_rows(spark):
    same = "this line is in every one of them, word for word"
    docs = [
        (5, f"first of all\n{same}\n\n  \nend", "a"),
        (3, f"{same}\nother text here", "b"),
        (9, f"{same}\n{same}.", "c"),
        (9, f"{same}\n{same}.", "c"),
        (None, f"no id\n{same}", None),
        (1, None, "d"),
        (2, "", "d"),
        (7, "\n\n", "d"),
        (8, "x\r\nY" + "z" * 40_000, "d"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, key string").withColumn("n_chars", F.length("text").cast("long"))
    out = {(r.doc_id, r.key): (r.text, r.n_lines, r.n_removed) for r in lines.deduplicate_lines(frame).collect()}
    assert out == {
        (5, "a"): ("first of all\n\n  \nend", 5, 1),
        (3, "b"): (docs[1][1], 2, 0),
        (9, "c"): ("", 2, 2),
        (None, None): ("no id", 2, 1),
        (1, "d"): (None, 0, 0),
        (2, "d"): ("", 1, 0),
        (7, "d"): ("\n\n", 3, 0),
        (8, "d"): (docs[-1][1], 2, 0),
    }
    kept = lines.drop_repeated_lines(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or -1, r.n_chars) for r in kept.collect()) == [(-1, 5), (1, None), (2, 0), (3, len(docs[1][1])), (5, 20), (7, 2), (8, len(docs[-1][1]))]
    assert lines.drop_repeated_lines(frame.limit(0)).collect() == []


def test_main_path_is_native(spark, made_up):
    frame = spark.createDataFrame(made_up[:20], "doc_id long, text string")
    plan = lines.deduplicate_lines(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_twins_in_a_large_family_are_found(spark):
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word(size):
        return "".join(draw.choice(letters) for _ in range(size))

    # Lines of 46 shingles, 0.67 alike in the family and 0.9 alike in pairs.
    template = word(40)
    docs = []
    for n in range(600):
        own = word(7)
        docs += [(2 * n, f"{template} {own}x{word(1)}"), (2 * n + 1, f"{template} {own}y{word(1)}")]
    want, found = brute_twins(docs), removed(spark, docs)
    assert len(want) == 600
    assert found <= want
    assert len(found) >= 0.98 * len(want)


def brute_twins(docs):
    """What goes of pairs of documents of one line each, of which only the two of a pair are similar."""
    gone = set()
    for (_, one), (i, two) in zip(docs[::2], docs[1::2], strict=True):
        a, b = shingles(one), shingles(two)
        if 10 * len(a & b) >= 8 * len(a | b):
            gone.add(((False, i), two, 1))
    return gone


def test_long_lines_at_the_threshold_are_found(spark):
    draw = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word(size):
        return "".join(draw.choice(letters) for _ in range(size))

    docs = []
    for n in range(400):
        words = [word(20) for _ in range(12)]
        # Every third word differs in its first letter.
        other = [word(1) + w[1:] if k % 3 == 0 else w for k, w in enumerate(words)]
        docs += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(other))]
    want, found = brute_twins(docs), removed(spark, docs)
    assert len(want) >= 300
    assert found <= want
    assert len(found) >= 0.97 * len(want)


def test_sketches_lose_no_similar_pair(spark):
    draw = random.Random(8)
    pairs = []
    for n in range(300):
        words = ["".join(draw.choice("abcdefgh ") for _ in range(6)) for _ in range(draw.choice([1, 4, 20, 80]))]
        other = [draw.choice(["", w, w[::-1]]) if draw.random() < 0.12 else w for w in words]
        pairs.append((n, "".join(words), "".join(other)))
    texts = [(k * 1000 + n, t) for n, *both in pairs for k, t in enumerate(both)]
    frame = spark.createDataFrame(texts, "node long, line string").withColumn("key", F.col("node").cast("string"))
    sketches = lines.with_sketch(frame)
    asked = spark.createDataFrame([(n, 1000 + n) for n, *_ in pairs], "x long, y long")
    kept = {int(r.a) for r in lines.likely_pairs(asked, sketches, 80).collect()}

    def jaccard(a, b):
        return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))

    similar = {n for n, a, b in pairs if 10 * len(shingles(a) & shingles(b)) >= 8 * len(shingles(a) | shingles(b))}
    assert similar and similar <= kept
    assert len(kept) < len(pairs) - sum(jaccard(a, b) < 0.6 for _, a, b in pairs if len(a) > 40) / 2


def test_unlike_lines_that_repeat_themselves_are_no_candidates(spark):
    draw = random.Random(9)

    def word(size):
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size))

    texts = []
    for n in range(60):
        common = word(30)
        texts += [(n, (common + word(30)) * 20), (1000 + n, (common + word(30)) * 20)]
    frame = spark.createDataFrame(texts, "node long, line string").withColumn("key", F.col("node").cast("string"))
    bands = {r.node: set(r.bands) for r in lines.with_bands(frame.select("node", "line")).collect()}
    assert sum(bool(bands[n] & bands[1000 + n]) for n in range(60)) < 20
    asked = spark.createDataFrame([(n, 1000 + n) for n in range(60)], "x long, y long")
    assert lines.likely_pairs(asked, lines.with_sketch(frame), 80).isEmpty()


def test_long_lines_of_a_family_that_are_not_similar_are_no_candidates(spark):
    draw = random.Random(10)

    def word(size):
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size))

    # Lines of 100 to 1,200 shingles, some 0.70 to 0.76 alike in a family and 0.85 and more in pairs.
    texts = []
    for size in (10, 26, 60, 120):
        base = [word(9) for _ in range(size)]
        for n in range(24):
            words = [word(9) if draw.random() < 0.08 else w for w in base]
            other = [word(9) if draw.random() < 0.04 else w for w in words]
            texts += [" ".join(words), " ".join(other)]
    rows = [(n, str(n).encode(), t) for n, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "node long, key binary, line string")
    members = frame.select(F.lit(1).alias("band"), "node", "key", F.col("key").alias("component"))
    found = {(int(r.a), int(r.b)) for r in lines.block_pairs(members, lines.with_sketch(frame), frame, 80).collect()}
    found = {(min(p), max(p)) for p in found}
    sets = [shingles(t) for t in texts]
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(len(sets)) for b in range(a + 1, len(sets))}
    assert {p for p, s in alike.items() if s >= 0.8} <= found
    below = {p for p, s in alike.items() if 0.6 < s < 0.76}
    assert len(below) > 1000 and len(found & below) < 0.05 * len(below)


def test_keys_of_several_rows_are_found_without_their_rows(spark):
    keys = spark.range(50_000).select("id", F.xxhash64("id").alias("key"))
    twice = keys.where("id % 100 = 0").select((F.col("id") + 50_000).alias("id"), "key")
    found = {r.id for r in lines.held_twice(keys.unionByName(twice), "key").collect()}
    assert {100 * n for n in range(500)} | {100 * n + 50_000 for n in range(500)} <= found
    assert len(found) < 1_100


def test_only_documents_that_lose_lines_are_shuffled(spark, monkeypatch):
    sides = []

    def seen(rows, key, words, real=lines.parted):
        sides.append(real(rows, key, words))
        return sides[-1]

    monkeypatch.setattr(lines, "parted", seen)
    docs = [(n, f"this is what only document {n} says, {n * n} times\nand {n ** 3} other words: {n * 'ab'} {n}") for n in range(100, 300)]
    docs += [(n, "one line that two documents have in common") for n in (1, 2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    losing = {i for (_, i), *_ in brute(docs)}
    out = {r.doc_id: r.n_removed for r in lines.deduplicate_lines(frame).collect()}
    assert {n for n, gone in out.items() if gone} == losing == {2}
    ((some, others),) = sides
    moved, stay = {r.row.doc_id for r in some.collect()}, {r.row.doc_id for r in others.collect()}
    assert losing <= moved and len(moved) < 5
    assert not moved & stay and moved | stay == set(out)


def test_only_lines_of_pairs_are_read_to_verify(spark, monkeypatch):
    read = []

    def seen(rows, key, words, real=lines.passing):
        near = real(rows, key, words)
        read.append(near.count())
        return near

    monkeypatch.setattr(lines, "passing", seen)
    line = "these words are the same in both lines of a pair, all but the last"
    rows = {f"k{n}": f"{line[n % 7:]} {n // 7}" for n in range(300)}
    texts = spark.createDataFrame([(k.encode(), t) for k, t in rows.items()], "key binary, line string")
    asked = [("k0", "k7"), ("k1", "k8"), ("k2", "k299")]
    pairs = spark.createDataFrame([(a.encode(), b.encode()) for a, b in asked], "a binary, b binary")
    found = {(r.a.decode(), r.b.decode()) for r in lines.verified_links(pairs, texts, 80).collect()}
    sets = {k: shingles(rows[k]) for pair in asked for k in pair}
    assert found == {(a, b) for a, b in asked if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])} != set()
    assert 6 <= read[0] < 12
