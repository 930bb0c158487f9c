import random
from collections import Counter

import pytest

from barlake.llm.substrings import remove_repeated_windows


def words(text):
    for blank in "\t\n\v\f\r":
        text = (text or "").replace(blank, " ")
    return [w for w in (text or "").split(" ") if w]


def plain(texts, window):
    key = lambda i: float("inf") if i is None else i
    smallest = {}
    for i, t in texts:
        w = words(t)
        for j in range(len(w) - window + 1):
            k = tuple(w[j : j + window])
            smallest[k] = min(key(i), smallest.get(k, key(i)))
    out = Counter()
    for i, t in texts:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if smallest[tuple(w[j : j + window])] < key(i):
                gone[j : j + window] = [True] * window
        runs = tuple(
            (a, next((b for b in range(a, len(w)) if not gone[b]), len(w)))
            for a in range(len(w))
            if gone[a] and (a == 0 or not gone[a - 1])
        )
        out[i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g), runs] += 1
    return out


def found(df):
    return Counter(
        (r.doc_id, r.n_words, r.n_removed, r.kept, tuple((s.start, s.end) for s in r.removed))
        for r in df.collect()
    )


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    monkeypatch.setattr("barlake.llm.exchange.CHUNK_BYTES", 1 << 16)


def test_against_all_windows(documents, texts):
    got = found(remove_repeated_windows(documents))
    assert got == plain(texts, 50)
    assert sum(k[2] for k in got)


@pytest.mark.parametrize("window", [2, 3, 8])
def test_few_different_words(spark, window):
    rng = random.Random(window)
    base = [rng.choice("abcd") for _ in range(60)]
    texts = []
    for i in range(60):
        a = rng.randrange(60)
        part = base[a : a + rng.randrange(30)]
        noise = [rng.choice("abcdefgh") for _ in range(rng.randrange(20))]
        texts.append((rng.choice([i, i, 5, None]), rng.choice([" ", "\n", " \t"]).join(noise + part + noise[:3])))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert found(remove_repeated_windows(df, window=window)) == plain(texts, window)


def test_empty_table(no_documents):
    assert remove_repeated_windows(no_documents).collect() == []


def test_long_words_whose_polynomials_are_equal(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    same = ["word"] * 49
    rows = [(1, " ".join([*same, one])), (2, " ".join([*same, other])), (3, " ".join([*same, other]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = remove_repeated_windows(docs).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, kept)) == [(1, 0), (2, 0), (3, 50)]
