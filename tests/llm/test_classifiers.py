"""Language ID and toxicity: gradients against differences, held-out accuracy, odd rows."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import language, toxicity
from terrace.llm.recurrent import batches, windows

SF = "/root/testdata/sf0.01"


def slopes(params, loss, size=1e-2):
    """Numeric slope of the largest gradient entry of each parameter, and that entry."""
    _, grads = loss()
    for name, value in params.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        before = value[at]
        value[at] = before + size
        high = loss()[0]
        value[at] = before - size
        low = loss()[0]
        value[at] = before
        yield name, (high - low) / (2 * size), grads[name][at]


def test_language_gradients():
    rng = np.random.default_rng(0)
    params = {"in_f": rng.normal(size=(256, 24)), "in_b": rng.normal(size=(256, 24)), "u_f": rng.normal(size=(24, 8)) * 0.5,
              "u_b": rng.normal(size=(24, 8)) * 0.5, "w": rng.normal(size=(3, 16)), "b": np.zeros(3)}
    params = {k: v.astype("f4") for k, v in params.items()}
    steps = rng.integers(97, 101, (6, 4))
    mask = (np.arange(6)[:, None] < [6, 6, 3, 5]).astype("f4")
    for name, numeric, exact in slopes(params, lambda: language.gradients(params, steps, mask, np.array([0, 1, 2, 1]))):
        assert numeric == pytest.approx(exact, rel=0.03, abs=1e-4), name


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    features = toxicity.Features()
    numbers = [features.add(t) for t in ("ab cd ef", "gh ab", "xx yy zz ab")]
    params = {"word_f": rng.normal(size=(toxicity.WORDS, 24)) * 0.3, "word_b": rng.normal(size=(toxicity.WORDS, 24)) * 0.3,
              "triple_f": rng.normal(size=(toxicity.TRIPLES, 24)) * 0.3, "triple_b": rng.normal(size=(toxicity.TRIPLES, 24)) * 0.3,
              "u_f": rng.normal(size=(24, 8)) * 0.5, "u_b": rng.normal(size=(24, 8)) * 0.5,
              "v": rng.normal(size=16), "w": rng.normal(size=16), "b": np.zeros(1)}
    params = {k: v.astype("f4") for k, v in params.items()}
    steps = np.full((4, 3), len(features.words))
    for i, n in enumerate(numbers):
        steps[:len(n), i] = n
    inside = steps < len(features.words)
    rows = features.rows()
    for name, numeric, exact in slopes(params, lambda: toxicity.gradients(params, rows, steps, inside, np.array([1, 0, 1]), np.ones(3))):
        assert numeric == pytest.approx(exact, rel=0.03, abs=1e-4), name


def test_windows_cover_every_position_once():
    lengths = [0, 1, 31, 32, 33, 100]
    found = windows(lengths, 32, 16)
    for i, n in enumerate(lengths):
        mine = found[:, found[0] == i]
        seen = np.zeros(n, int)
        for _, start, size, fresh in mine.T:
            assert start + size <= n and size == min(n, 32)
            seen[start + fresh:start + size] += 1
        assert (seen == 1).all()
    assert sum(len(chosen) for chosen, _, _ in batches(found, 32, 3)) == found.shape[1]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.op4_language_id(spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(docs, "doc_id").where("held_out AND length(text) >= 30").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 250 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == docs.count()


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog", "en", 0.5), (2, None, "en", 0.5), (3, "", "de", 0.5), (4, "12 !? 34", None, 0.5),
         (None, "le chat et le chien", "fr", 0.5), (1, "the cat and the dog", "en", 0.5), (6, "a" * 200_000, None, 0.5)],
        "doc_id long, text string, lang string, score double")
    model = language.learn(docs)
    rows = language.identify(docs, model).collect()
    assert len(rows) == 7
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and by_id[2].score == 0
    assert by_id[6].lang_pred in model["classes"]
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "6", "None"]
    empty = docs.where("false")
    assert language.learn(empty) is None and language.identify(empty, None).count() == 0
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_sample_takes_rows_of_every_class(spark):
    """The smallest hashes of each class: a rare class, repeated ids and classes of any size are all there."""
    docs = spark.range(3000).selectExpr("id", "concat('text ', id) AS text", "CASE WHEN id = 7 THEN 'rare' WHEN id % 5 = 0 THEN 'few' ELSE 'many' END AS label")
    copies = spark.range(500).selectExpr("-1L AS id", "'same' AS text", "'copies' AS label")
    docs = docs.union(copies).union(spark.createDataFrame([(None, None, "none"), (1, "text", None)], "id long, text string, label string"))
    rows = language.sample(docs, docs, per_class=40)
    found = {}
    for text, label in rows:
        found.setdefault(label, []).append(text)
    assert {k: len(v) for k, v in found.items()} == {"rare": 1, "few": 40, "many": 40, "copies": 40}
    mixed = docs.orderBy(F.rand())
    assert len(set(found["many"])) == 40 and sorted(rows) == sorted(language.sample(mixed, mixed, per_class=40))


def test_sample_cuts_long_texts(spark, monkeypatch):
    monkeypatch.setattr(language, "LEARNT", 10)
    docs = spark.createDataFrame([(k, "0123456789" * 50, "x") for k in range(20)] + [(99, "short", "x")], "id long, text string, label string")
    rows = language.sample(docs.drop("label"), docs.drop("text"))
    assert {len(t) for t, _ in rows} == {5, 10} and len({t for t, _ in rows}) > 3


def test_language_stage_decides_by_score(spark):
    two = [("the cat and the dog of the house", "en"), ("le chat et le chien de la maison", "fr")]
    docs = spark.createDataFrame([(k, *two[k % 2]) for k in range(40)], "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert model["classes"] == ["en", "fr"]
    assert language.keep_identified(docs, model).count() == 40
    assert language.keep_identified(docs, model, margin=3).count() == 0  # no probability is above 1


def test_language_labels_every_position():
    model = language.train([("der die das und", "de"), ("the and of that", "en")] * 5)
    text = "the cat " * 100 + "é"
    labels = language.position_probabilities(model, [text, "", None])
    assert [len(x) for x in labels] == [len(text.encode()), 0, 0]
    assert np.allclose(labels[0].sum(axis=1), 1, atol=1e-4)
    assert np.allclose(labels[0].mean(axis=0), language.document_probabilities(model, [text])[0], atol=1e-4)


def test_language_without_learnable_rows_keeps_documents(spark):
    docs = spark.createDataFrame([(1, "plain words", None), (2, "12 34", None), (3, None, None), (4, "été", None)], "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert model is None and sorted(r.doc_id for r in language.keep_identified(docs, model).collect()) == [1, 4]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marked = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    model = toxicity.learn(docs, labels)
    found = toxicity.score_documents(marked, model).join(labels, "doc_id").where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2").collect()
    score, toxic = np.array([r.score for r in found]), np.array([r.toxic for r in found]) == 1
    assert ((score >= 0) & (score <= 1)).all()
    assert (score[toxic] >= toxicity.THRESHOLD).mean() > 0.7 and (score[~toxic] >= toxicity.THRESHOLD).mean() < 0.05


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, f"calm words number {i} " * 5, "x") for i in range(40)] + [(100 + i, f"calm words vile{i % 2} number {i} " * 5, "x") for i in range(40)]
        + [(300, None, "x"), (301, "", "x"), (302, "   ", "x"), (None, "calm", "x"), (303, "z" * 100_000, "x"), (0, "calm words number 0 " * 5, "x")],
        "doc_id long, text string, label string")
    labels = docs.where("doc_id < 200").select("doc_id", (F.col("doc_id") >= 100).cast("int").alias("toxic"), F.lit(None).cast("int").alias("text"))
    labels = labels.union(labels.where("false")).union(spark.createDataFrame([(5, None, None)], "doc_id long, toxic int, text int"))
    model = toxicity.learn(docs, labels)
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    bad = [r.score for r in rows if r.doc_id is not None and 100 <= r.doc_id < 200]
    good = [r.score for r in rows if r.doc_id is not None and r.doc_id < 40]
    assert np.mean(bad) > np.mean(good) + 0.3
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert toxicity.learn(docs, labels.where("false")) is None
    assert {r.score for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    assert toxicity.score_documents(docs.where("false"), model).count() == 0


def test_toxicity_scores_all_windows():
    rows = [("good words here " * 3, 0), ("good vile here " * 3, 1)] * 30
    model = toxicity.train(rows)
    text = "good words here " * 60 + "vile " + "good words here " * 60
    found = toxicity.window_scores(model, text)
    assert len(found) == len(range(0, 361 - 32, 16)) + 1 and found[-1][0] + found[-1][1] == 361
    assert max(s for _, _, s in found) == pytest.approx(toxicity.scores(model, [text])[0], abs=1e-5)


def test_word_vectors_of_many_words_are_made_in_slices():
    rng = np.random.default_rng(3)
    features = toxicity.Features()
    features.add(" ".join(f"w{i}x{i * 7919 % 100_003}" for i in range(50_000)))
    params = {"word_f": rng.normal(size=(toxicity.WORDS, 24)).astype("f4"), "triple_f": rng.normal(size=(toxicity.TRIPLES, 24)).astype("f4")}
    tracemalloc.start()
    rows = features.rows()
    found = toxicity.inputs(params, "f", rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6  # 8 MB of this are the result
    word, triples, begin = rows
    for k in (0, toxicity.TOGETHER - 1, toxicity.TOGETHER, 49_999):
        own = triples[begin[k]:begin[k + 1] if k + 1 < len(begin) else None]
        assert len(own) == len(features.words[k]) + 2
        assert np.allclose(found[k], params["triple_f"][own].mean(axis=0) + params["word_f"][word[k]], atol=1e-5)
    assert not found[-1].any() and len(found) == 50_001
