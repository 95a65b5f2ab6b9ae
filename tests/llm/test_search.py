"""LM scoring, nearest neighbours and archives against brute force; the pipeline as a whole."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrace.llm import forest, language, scoring, toxicity, warc
from terrace.workspace import scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_scores(texts):
    words = [WORD.findall((t or "").lower()) for t in texts]
    counts = [[Counter(tuple(w[i - n + 1:i + 1]) for i in range(n - 1, len(w))) for n in (1, 2, 3)] for w in words]
    every = [sum((c[n] for c in counts), Counter()) for n in range(3)]
    total = sum(map(len, words))
    out = []
    for w, own in zip(words, counts, strict=True):
        logs = []
        for i in range(len(w)):
            longest = min(3, i + 1)
            score = 0.4 ** longest / max(1, total - len(w))
            for n in range(longest, 0, -1):
                gram = tuple(w[i - n + 1:i + 1])
                seen = every[n - 1][gram] - own[n - 1][gram]
                if seen:
                    context = max(1, total - len(w)) if n == 1 else every[n - 2][gram[:-1]] - own[n - 2][gram[:-1]]
                    score = 0.4 ** (longest - n) * seen / context
                    break
            logs.append(math.log(score))
        out.append((len(w), sum(logs) / len(logs) if logs else None))
    return out


@pytest.mark.parametrize("size", [scoring.BLOCK_BYTES, 300])
def test_scores_agree_with_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", size)
    monkeypatch.setattr(scoring, "RANGE_NGRAMS", 64)
    rng = random.Random(1)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(25)], k=rng.randrange(0, 40))) for _ in range(60)]
    texts += [None, "", "  \n", "alone", texts[0], texts[1].upper(), "x " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in scoring.score_documents(docs).collect()}
    for k, (n, mean) in enumerate(brute_scores(texts)):
        assert rows[k].n_words == n
        assert rows[k].log_score is None if mean is None else rows[k].log_score == pytest.approx(mean, abs=1e-8)


def test_scores_long_and_empty_texts(spark, monkeypatch):
    """A text longer than a block is a block of its own, also between empty ones."""
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 100)
    rng = random.Random(2)
    texts = ["", " ".join(rng.choices([f"w{k}" for k in range(40)], k=3000)), "", None, "w1 w2 w3", " ".join(rng.choices(["w1", "w2"], k=900)), ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    rows = {r.doc_id: r for r in scoring.score_documents(docs).collect()}
    for k, (n, mean) in enumerate(brute_scores(texts)):
        assert rows[k].n_words == n
        assert rows[k].log_score is None if mean is None else rows[k].log_score == pytest.approx(mean, abs=1e-8)


def test_scores_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c", "x"), (1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x")], "doc_id long, text string, block string")
    rows = scoring.score_documents(docs).collect()
    assert sorted((r.n_words, r.log_score is None) for r in rows) == [(0, True), (3, False), (3, False), (3, False)]
    assert scoring.score_documents(docs.where("false")).count() == 0


def neighbours(rows, queries, k):
    good = {i: np.array(v, "f8") for i, v in rows}
    return {q: sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))[:k] for q in queries}


def test_forest_recall_and_order(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.normal(size=16) * rng.uniform(0.2, 3)).tolist()) for k in range(3000)]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    found = forest.search(frame, frame.where("id % 20 = 0"), k=10).collect()
    true = neighbours(rows, range(0, 3000, 20), 10)
    mine = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        mine.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert mine.keys() == true.keys() and all(len(v) == 10 and v == sorted(v) for v in mine.values())
    hit = sum(len({i for _, i in mine[q]} & {i for _, i in v}) for q, v in true.items())
    assert hit / sum(map(len, true.values())) >= 0.9
    vectors = dict(rows)
    for q, v in mine.items():
        assert all(-s == pytest.approx(float(np.dot(vectors[q], vectors[i])), rel=1e-12) for s, i in v)


def test_forest_copies_in_one_leaf(spark, monkeypatch):
    monkeypatch.setattr(forest, "ROWS", 50)
    monkeypatch.setattr(forest, "QUERIES", 3)
    rows = [(k, [1.0, 2.0, 0.5]) for k in range(400)] + [(1000 + k, [float(k % 7), -1.0, 0.1 * k]) for k in range(50)]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    found = forest.search(frame, frame.where("id % 40 = 0 AND id < 400"), k=5, visits=10_000).collect()
    true = neighbours(rows, range(0, 400, 40), 5)
    assert {(r.query_id, r.rank): r.vec_id for r in found} == {(q, n + 1): i for q, v in true.items() for n, (_, i) in enumerate(v)}


def test_forest_serves_vectors_of_every_length(spark, monkeypatch):
    monkeypatch.setattr(forest, "ROWS", 7)
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=5 if k % 4 else 3).tolist()) for k in range(200)]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    found = forest.search(frame, frame.where("id % 10 = 0"), k=4, visits=10_000).collect()
    true = {}
    for n in (3, 5):
        some = [r for r in rows if len(r[1]) == n]
        true |= neighbours(some, [i for i, _ in some if i % 10 == 0], 4)
    assert {(r.query_id, r.rank): r.vec_id for r in found} == {(q, n + 1): i for q, v in true.items() for n, (_, i) in enumerate(v)}


def test_forest_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (3, [2.0, 0.0], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [float("nan"), 0.0], 1),
            (8, [float("inf"), 0.0], 1), (None, [1.0, 1.0], 1), (0, [1.0, 0.0], 1), (9, [], 1), (2, [2.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    good = forest.usable(frame, "vec_id", "embedding")
    found = forest.search(good, good.where("id % 20 = 0"), k=20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [
        (0, 1, 2, 2.0), (0, 2, 3, 2.0), (0, 3, 20, 0.5), (20, 1, 2, 1.0), (20, 2, 3, 1.0), (20, 3, 0, 0.5)]
    empty = good.where("false")
    assert forest.search(empty, empty).count() == 0 and forest.search(good, empty).count() == 0


PAGES = [(1, "http://www.b.com/x?q=1", "<p>" + "a" * 200), (2, "https://b.com:80/y z", "<p>" + "a" * 200), (3, "http://c.org/", "short"),
         (4, "http://c.org/", "short"), (5, None, None), (6, "not a url", ""), (None, "http://b.com/", "<p>" + "a" * 200), (7, "http://a.net/é", "é" * 60),
         (8, "http://a.net/é", "é" * 60), (9, "http://c.org/", "long " * 40_000), (2, "https://b.com:80/y z", "<p>" + "a" * 200)]


def test_archive_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, key string")
    folder = scratch(spark, "warc")
    archive = warc.write_archive(pages, folder)
    key = warc.url_key(F.col("url"))
    rows = warc.lookup(archive, folder, pages.select(key.alias("key"))).collect()
    assert len(rows) == len(PAGES)
    first = {1: None, 2: 1, 3: None, 4: None, 5: None, 6: None, None: 1, 7: None, 8: 7, 9: None}
    html = {p[0]: p[2] for p in PAGES}
    for r in rows:
        assert r.refers_to == first[r.page_id] and r.record_type == ("response" if first[r.page_id] is None else "revisit")
        assert r.payload_bytes == len((html[r.page_id] or "").encode())
        assert r.payload is None if r.record_type == "revisit" else r.payload == (html[r.page_id] or "").encode()
    some = warc.lookup(archive, folder, spark.createDataFrame([("org,c)/",), ("org,c)/none",), (None,), ("org,c)/",)], "key string")).collect()
    assert sorted(r.page_id for r in some) == [3, 4, 9]


def test_archive_of_one_url(spark, monkeypatch):
    """All captures under one key: they lie in many blocks, and all are found."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 8)
    monkeypatch.setattr(warc, "FILE_BYTES", 1000)
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://one.com/").alias("url"), F.col("id").cast("string").alias("html"))
    folder = scratch(spark, "warc")
    archive = warc.write_archive(pages, folder)
    assert archive.count() > 1
    found = warc.lookup(archive, folder, spark.createDataFrame([("com,one)/",)], "key string")).collect()
    assert sorted(r.page_id for r in found) == list(range(300)) and all(r.payload == str(r.page_id).encode() for r in found)


def test_archive_of_many_files(spark, monkeypatch):
    """The first level has many rows in several sorted parts; keys before, between and after all files are looked up too."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    monkeypatch.setattr(warc, "FILE_BYTES", 60)
    monkeypatch.setattr(warc, "BLOCKS_READ", 4)
    rng = random.Random(3)
    urls = [f"http://h{rng.randrange(30)}.org/" if k % 3 else "http://hot.org/" for k in range(120)]
    pages = spark.createDataFrame([(k, u, str(k) * 5) for k, u in enumerate(urls)], "page_id long, url string, html string")
    folder = scratch(spark, "warc")
    archive = warc.write_archive(pages, folder)
    assert archive.count() > 10
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        wanted = pages.select(warc.url_key(F.col("url")).alias("key")).union(
            spark.createDataFrame([("",), ("a",), ("org,h1)/x",), ("org,h2)/x",), ("org,hot)/0",), ("zzz",)], "key string"))
        rows = warc.lookup(archive, folder, wanted).collect()
        one = warc.lookup(archive, folder, spark.createDataFrame([("org,h7)/",)], "key string")).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted((r.page_id, r.url, r.payload) for r in rows) == [(k, u, (str(k) * 5).encode()) for k, u in enumerate(urls)]
    assert sorted(r.page_id for r in one) == [k for k, u in enumerate(urls) if u == "http://h7.org/"]


def test_archive_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch(spark, "warc")
    archive = warc.write_archive(pages, folder)
    assert archive.count() == 0 and warc.lookup(archive, folder, pages.select(F.col("url").alias("key"))).count() == 0


def test_url_keys(spark):
    urls = {"http://www.B.com/x?y#z": "com,b,www)/x?y", "https://u:p@b.com:8080": "com,b)", "//a.b/c": "b,a)/c", "mailto:x": "mailto:x", None: ""}
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", warc.url_key(F.col("url")).alias("key")).collect()
    assert {r.url: r.key for r in rows} == urls


def test_damaged_records_are_refused():
    data = warc.capture(1, "http://a.b/", b"x" * 10, "0" * 64, None)
    with pytest.raises(ValueError):
        warc.parse(data[:-1])
    with pytest.raises(ValueError):
        warc._read("k", data)


def test_pipeline_stages_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit("x")).withColumn("component_id", F.lit(1))
    extra = spark.createDataFrame([(10_000, None, "en", "s", 0, "x", 1), (10_001, "12 34", None, None, None, "x", 1),
                                   (None, "plain words without a number", None, None, None, "x", 1)], docs.schema)
    rows, seen = docs.union(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, sf)
        if name != "packing":
            assert out.columns == docs.columns
            out = out.cache()
        seen[name] = rows, out
        rows = out
    ids = {name: {r.doc_id for r in out.select("doc_id").collect()} for name, (_, out) in seen.items()}
    every = {r.doc_id for r in docs.union(extra).select("doc_id").collect()}
    assert every - ids["language_id"] == {10_000, 10_001}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = ids["language_id"] - ids["toxicity"]
    assert sum(labels.get(i) == 0 for i in gone) <= 2
    assert ids["ngram_jaccard"] <= ids["toxicity"] and ids["substring_dedup"] == ids["ngram_jaccard"] == ids["packing"]


def test_pipeline_on_no_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    spark.read.parquet(f"{sf}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/labels.parquet").where("false").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert language.op4_language_id(spark, str(tmp_path)).count() == toxicity.op2_toxicity(spark, str(tmp_path)).count() == 0
