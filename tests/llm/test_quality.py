import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barlake.llm import quality

SF = "/root/testdata/sf0.1"


def clean(rng, n):
    return " ".join(f"word{rng.randrange(200)}" for _ in range(n))


def made(rng, n):
    """A document is bad if one passage of it is, wherever that stands."""
    rows = []
    for i in range(n):
        parts = [clean(rng, quality.PASSAGE) for _ in range(rng.randrange(1, 6))]
        if i % 2:
            junk = " ".join(f"b{rng.randrange(50)}$$" for _ in range(quality.PASSAGE))
            parts[rng.randrange(len(parts))] = junk
        rows.append((i, " ".join(parts), 1 - i % 2))
    return rows


def test_attention_finds_the_passage_that_tells(spark):
    rows = made(random.Random(3), 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:600]], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scored = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert np.mean([(scored[i] >= 0.5) == bool(y) for i, _, y in rows[600:]]) >= 0.97
    bad = [r[1] for r in rows[600:] if not r[2] and len(r[1].split()) > 2 * quality.PASSAGE]
    _, shares = model.read(pa.array(bad))
    for text, share in zip(bad, shares):
        words = text.split()
        junk = [words[i].endswith("$$") for i in range(0, len(words), quality.PASSAGE)].index(True)
        assert share.argmax() == junk and abs(share.sum() - 1) < 1e-5


def test_gradient():
    """Against differences of the loss, in doubles."""
    rng = np.random.default_rng(2)
    text = pa.array([clean(random.Random(i), n) for i, n in enumerate((300, 1, 64, 65))])
    made_ = quality.passages(text)
    x, first = made_.dense().astype(float), made_.first
    label = np.array([1.0, 0.0, 0.0, 1.0])
    model = quality.new_bags(0.5, seed=5)
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}

    def loss():
        y = model.forward(model.encode(x), first)["y"]
        return -np.mean(label * np.log(y) + (1 - label) * np.log(1 - y))

    f = model.forward(model.encode(x), first)
    grads = model.gradient(x, first, (f["y"] - label) / len(label), f)
    used = np.flatnonzero(x.any(0))
    for name, grad in grads.items():
        weights = model.weights[name]
        for _ in range(6):
            at = tuple(rng.integers(s) for s in weights.shape)
            if name == "E":
                at = (rng.choice(used), at[1])
            old = weights[at]
            weights[at] = old + 1e-5
            above = loss()
            weights[at] = old - 1e-5
            slope = (above - loss()) / 2e-5
            weights[at] = old
            assert slope == pytest.approx(grad[at], rel=1e-3, abs=1e-7)


def test_passages_of_a_batch_are_those_of_each_text():
    texts = [None, "", " \n", "Two words", "A b\nc. " * 100, "é ü 7%", "same same\nother"]
    whole = quality.passages(pa.array(texts, pa.string()))
    assert list(np.diff(whole.first)) == [1, 1, 1, 1, 5, 1, 1]
    for i, text in enumerate(texts):
        alone = quality.passages(pa.array([text], pa.string())).dense()
        assert np.array_equal(alone, whole.dense(whole.first[i], whole.first[i + 1]))
    numbers = quality.passages(pa.array(["same same\nother"])).numbers[0]
    assert np.allclose(numbers[4:8], [1 / 3, 2 / 3, 13 / 30, 1 / 3])


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels.filter(quality.learnt_from(F.col("doc_id"))))
    held_out = labels.filter(~quality.learnt_from(F.col("doc_id")))
    rows = quality.score(docs, model).join(held_out, "doc_id").select("score", "quality").collect()
    assert np.mean([r.score >= 0.3 for r in rows if r.quality]) > 0.99
    assert np.mean([r.score >= 0.3 for r in rows if not r.quality]) < 0.05


def test_odd_rows(spark, documents, no_documents, texts):
    labels = [(i, i % 2) for i in range(20)] + [(2, None), (None, 1), (5, 7), (900_007, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(documents, labels)
    rows = quality.score(documents, model).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    scores = {}
    for r in rows:
        scores.setdefault(r.text, set()).add(round(r.score, 4))
    assert all(len(s) == 1 for s in scores.values())
    assert quality.score(no_documents, model).collect() == []


@pytest.mark.parametrize("given, score", [([], 0.5), ([0, 0], 0.5 / 3)])
def test_without_labels_of_both_kinds(spark, documents, given, score):
    labels = spark.createDataFrame(list(enumerate(given)), "doc_id long, quality int")
    model = quality.fit(documents, labels)
    assert {round(r.score, 9) for r in quality.score(documents, model).collect()} == {round(score, 9)}


def test_bounds_of_the_sample_and_reruns(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags, label: seen.append((bags, label)))
    quality.fit(docs, labels)
    quality.fit(docs.repartition(7), labels.repartition(3))
    quality.fit(docs, labels, sample=50)
    quality.fit(docs, labels, at_most=500)
    (all_, y), (again, y2), (few, _), (short, _) = seen
    assert len(all_) == 399 and np.array_equal(y, y2)
    assert all(np.array_equal(a.words, b.words) for a, b in zip(all_, again))
    assert len(few) <= 50 and 0 < sum(map(len, short)) <= 500
