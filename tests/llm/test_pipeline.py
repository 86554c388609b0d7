import random

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as leaks_of
from test_jaccard import brute as components_of
from test_lines import brute as repeated_of
from test_mixing import targets
from test_quality import brute as features_of

import corpus_pipeline

BENCHMARK = [(1, " ".join(f"bench{n}" for n in range(24))), (2, None)]


def documents():
    draw = random.Random(21)
    words = ["".join(draw.choice("abcdefghilmnoprstu") for _ in range(draw.randrange(3, 9))) for _ in range(900)]

    def sentence(n=None):
        return " ".join(draw.choice(words) for _ in range(n or draw.randrange(8, 20)))

    rows = []
    for n in range(120):
        rows.append((n, "\n".join(sentence() for _ in range(draw.randrange(2, 6))), f"s{n % 4}"))
    rows += [(200 + n, rows[n][1], "s1") for n in range(10)]  # exact copies
    base = sentence(120).split(" ")
    for n in range(12):  # near copies whose lines differ: other line ends
        copy = list(base)
        copy[draw.randrange(120)] = "changed"
        cut = draw.randrange(30, 90)
        rows.append((300 + n, " ".join(copy[:cut]) + "\n" + " ".join(copy[cut:]), "s2"))
    passage = BENCHMARK[0][1].split(" ")
    for n in range(6):
        rows.append((400 + n, sentence(15) + "\n" + " ".join(passage[12:] + [draw.choice(words)] + passage[:12]) + f"\n{sentence(15)}", "s3"))
    rows += [(500, None, "s0"), (501, "", None), (502, "too short", "s0"), (503, "again and again " * 40, "s0"), (504, sentence(40), None)]
    shared = "this very line stands in a great many of all the documents here"
    rows = [(i, t + "\n" + shared if t and i % 3 == 0 else t, s) for i, t, s in rows]
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{n}")
        out = spark.read.parquet(f"{tmp_path}/{n}")
        rows = {r.doc_id: r for r in out.collect()}
        if n < 4:
            assert out.columns == docs.columns
        if n == 0:
            bad = {i for i, t, _ in before for f in [features_of(t or "")] if f[0] < 10 or 100 * f[4] > 20 * f[0]}
            assert set(rows) == {i for i, *_ in before} - bad and {500, 501, 502, 503} <= bad
        if n == 1:
            gone = repeated_of([(i, t) for i, t, _ in before])
            texts = {i: [x for k, x in enumerate(t.split("\n"), 1) if ((False, i), t, k) not in gone] for i, t, _ in before}
            assert {i: r.text for i, r in rows.items()} == {i: "\n".join(x) for i, x in texts.items() if "".join(x).strip()}
            assert all(r.n_chars == len(r.text) for r in rows.values())
        if n == 2:
            want = components_of([(i, t) for i, t, _ in before], 5, 80)
            assert set(rows) == {i for i, _, c in want if i == c}
            assert len(rows) < len(before)
        if n == 3:
            leaky = {i for i, *_ in leaks_of([(i, t) for i, t, _ in before], BENCHMARK)}
            assert leaky and set(rows) == {i for i, *_ in before} - leaky
        if n == 4:
            sizes = {}
            for _, t, s in before:
                sizes[s] = sizes.get(s, 0) + len(t.split())
            want = targets(sizes)
            assert set(rows) == {i for i, *_ in before}
            assert all(r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r.size for r in rows.values())
        docs, before = out, [(r.doc_id, r.text, r.source) for r in rows.values()]
    whole = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "text", "source", "size", "target", "taken"]
    assert sorted(whole.select(columns).collect(), key=str) == sorted(docs.select(columns).collect(), key=str)


def test_empty_corpus(spark, sf_dir, tmp_path):
    path = tmp_path / "none"
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").where(F.lit(False)).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(path)).collect() == []
