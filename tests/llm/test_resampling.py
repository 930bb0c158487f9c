import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barlake.llm import resampling
from barlake.llm.resampling import importance_resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, n, buckets):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs], len(words)


def brute(rows, targets, n, buckets, percent=10, least=20, seed=2024):
    taken = [(i, *features(text, n, buckets)) for i, text in rows]
    s, t = Counter(), Counter()
    for _, fs, _ in taken:
        s.update(fs)
    for text in targets:
        t.update(features(text, n, buckets)[0])
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets))))
        for b in range(buckets)
    ]
    out = []
    for i, fs, n_words in taken:
        weight = sum(gain[b] for b in fs)
        id_ = "" if i is None else str(i)
        h = int(hashlib.sha256(f"{seed}:{id_}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        out.append((i, n_words, len(fs), weight, score))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = Counter()
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        drawn[(*row, rank)] += 1
    late = Counter(out) - Counter(r[:-1] for r in drawn.elements())
    return drawn + Counter((*r, None) for r in late.elements())


@pytest.fixture(scope="module")
def targets(spark):
    rows = [("word w5x5 and w6x6",), ("the last of\nthe words",), (None,), ("",)]
    return spark.createDataFrame(rows, "text string")


@pytest.mark.parametrize("n, buckets, percent", [(1, 10_000, 10), (3, 997, 50)])
def test_against_brute_force(spark, documents, texts, targets, n, buckets, percent):
    got = importance_resample(documents, targets, n=n, buckets=buckets, percent=percent)
    found = Counter(tuple(r) for r in got.collect())
    given = [r[0] for r in targets.collect()]
    assert found == brute(texts, given, n, buckets, percent)


def test_runs_across_lines(spark):
    """Short and empty lines between, and lines longer than both their ends."""
    texts = ["a b\n\nc\nd e f g h i\n!\nj", "a b\n\nc\nd e f g h i\n!\nj", "\n\n", "x\ny\nz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n in (2, 3, 4, 5):
        made = resampling.Segmented(docs, "text", n, 10_000, ["doc_id"])
        counts = {r["bucket"]: r["n"] for r in made.counts().collect()}
        want = Counter()
        for text in texts:
            want.update(features(text, n, 10_000)[0])
        assert counts == want
        assert made.lines.filter("occurs = 2").count() == 5  # of the pair of equal texts


def test_hot_lines_are_joined_apart(spark, targets, monkeypatch):
    """A line that most rows have, and the others: each gets its weight."""
    rows = [(i, "the same line\n" * 3 + f"own line {i % 40}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr("barlake.llm.hot.SHARE", 4)
    got = Counter(tuple(r) for r in importance_resample(docs, targets, least_words=1).collect())
    assert got == brute(rows, [r[0] for r in targets.collect()], 1, 10_000, least=1)


def test_carried_columns_and_no_rows(spark, documents, no_documents, targets):
    got = importance_resample(documents, targets, carry=["lang", "seg"])
    want = Counter(tuple(r) for r in documents.select("doc_id", "lang", "seg").collect())
    assert Counter(tuple(r) for r in got.select("doc_id", "lang", "seg").collect()) == want
    assert importance_resample(no_documents, targets).collect() == []
    none = importance_resample(documents, targets.limit(0)).filter(F.col("rank").isNotNull())
    assert none.count() > 0
