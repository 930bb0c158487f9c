import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import language_model as lm
from barlake.llm.exchange import chunked

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def tokens(text):
    return [w for w in re.split("[ \t-\r]+", (text or "").translate(LOWER)) if w] + [None]


def part(doc_id):
    crc = 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7
    return {2: 2, 3: 1}.get(crc, 0)


def column():
    crc = F.crc32(F.col("doc_id").cast("string")) % 7
    return F.when(F.col("doc_id").isNull(), 0).when(crc == 2, 2).when(crc == 3, 1).otherwise(0)


@pytest.fixture
def small_chunks(monkeypatch):
    """Several chunks, so that counts are put together."""
    monkeypatch.setattr("barlake.llm.exchange.CHUNK_BYTES", 1 << 16)


def test_scores_against_a_plain_model(documents, texts, small_chunks):
    seen = {}
    learn = lm.learn_weights

    def spied(events, **how):
        seen["weights"] = learn(events, **how)
        return seen["weights"]

    lm.learn_weights = spied
    try:
        rows = lm.score_texts(documents, column()).collect()
    finally:
        lm.learn_weights = learn
    words, pairs = Counter(), Counter()
    contexts = Counter()
    for i, t in texts:
        if part(i) != 2:
            ts = tokens(t)
            words.update(ts)
            pairs.update(zip(["<start>", *ts], ts))
            contexts.update(["<start>", *ts[:-1]])
    n, v = sum(words.values()), len(words)
    want = Counter()
    for i, t in texts:
        ts = tokens(t)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in ts)
        score = 0.0
        for a, w in zip(["<start>", *ts], ts):
            level = min(math.frexp(contexts[a])[1], lm.LEVELS - 1)
            share = seen["weights"][level]
            chance = share[1] * words[w] / n + share[2] / (v + 1)
            chance += share[0] * pairs[a, w] / contexts[a] if contexts[a] else 0
            score += math.log10(chance)
        known = sum(words[w] > 0 for w in ts)
        want[i, part(i) == 2, len(ts), known, n, round(base, 6), round(score, 6)] += 1
    got = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in rows
    )
    assert got == want
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_weights_climb_to_the_better_estimate():
    events = np.array([[5, 80, 8, 1000], [5, lm._NEVER, 8, 10], [2, lm._NEVER, lm._NEVER, 50]])
    weights = lm.learn_weights(events)
    assert weights[5, 0] > 0.9 and weights[2, 2] > 0.99
    assert np.allclose(weights.sum(1), 1) and weights[0, 0] == 0


def test_nothing_to_train_on(spark, no_documents):
    assert lm.score_texts(no_documents, column()).collect() == []
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    rows = lm.score_texts(docs, F.lit(2)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 3, 0, 0), (2, 1, 0, 0)]


def test_chunks_keep_every_row(documents, small_chunks):
    chunks = chunked(documents, "text")
    assert chunks.count() > 5
    assert chunks.select("chunk").distinct().count() == chunks.count()


def test_long_words_whose_polynomials_are_equal(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(0, one, 0), (1, other, 2), (2, one, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    scored = lm.score_texts(docs, F.col("part")).collect()
    assert {r.doc_id: r.n_known for r in scored} == {0: 2, 1: 1, 2: 2}


def test_three_words_against_a_plain_model(documents, texts, small_chunks, monkeypatch):
    seen = {}
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda events: seen.setdefault("weights", learn(events)))
    rows = lm.score_texts(documents, column(), order=3).collect()
    words, pairs, triples, contexts = Counter(), Counter(), Counter(), Counter()
    start = "<start>"
    n_texts = 0
    for i, t in texts:
        if part(i) != 2:
            ts = tokens(t)
            n_texts += 1
            words.update(ts)
            pairs.update(zip([start, *ts], ts))
            contexts.update([start, *ts[:-1]])
            triples.update(zip([start, *ts], ts, ts[1:]))
    n, v = sum(words.values()), len(words)
    want = Counter()
    for i, t in texts:
        ts, score = tokens(t), 0.0
        for k, w in enumerate(ts):
            a = ts[k - 1] if k else start
            b = (ts[k - 2] if k > 1 else start) if k else None
            two = pairs[b, a] if k else n_texts
            three = triples[b, a, w] if k else pairs[a, w]
            level = min(math.frexp(contexts[a])[1], lm.LEVELS - 1)
            if two:
                level = lm.LEVELS + min(math.frexp(two)[1], lm.LEVELS - 1)
            share = seen["weights"][level]
            chance = share[2] * words[w] / n + share[3] / (v + 1)
            chance += share[1] * pairs[a, w] / contexts[a] if contexts[a] else 0
            chance += share[0] * three / two if two else 0
            score += math.log10(chance)
        want[i, round(score, 6)] += 1
    assert Counter((r.doc_id, round(r.score, 6)) for r in rows) == want
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert (seen["weights"][: lm.LEVELS, 0] == 0).all() and np.allclose(seen["weights"].sum(1), 1)


def test_bad_order(no_documents):
    with pytest.raises(ValueError):
        lm.score_texts(no_documents, column(), order=4)
