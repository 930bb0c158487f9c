import random
from collections import Counter

import pytest

from barlake.llm.suffixes import remove_repeated_substrings


def plain(texts, length):
    seen, data = Counter(), [(i, (t or "").encode()) for i, t in texts]
    for _, b in data:
        seen.update(b[j : j + length] for j in range(len(b) - length + 1))
    out = Counter()
    for i, b in data:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        starts = [a for a in range(len(b)) if gone[a] and (a == 0 or not gone[a - 1])]
        ends = [a + 1 for a in range(len(b)) if gone[a] and (a + 1 == len(b) or not gone[a + 1])]
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i, len(b), kept, tuple(zip(starts, ends))] += 1
    return out


def found(df):
    return Counter(
        (r.doc_id, r._bytes, bytes(r._kept), tuple((s.start, s.end) for s in r._removed))
        for r in df.collect()
    )


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    monkeypatch.setattr("barlake.llm.exchange.CHUNK_BYTES", 1 << 16)


def test_against_all_substrings(documents, texts):
    short = [(i, t[:20_000] if t else t) for i, t in texts]
    df = documents.withColumn("text", documents["text"].substr(1, 20_000))
    got = found(remove_repeated_substrings(df))
    assert got == plain(short, 200)
    assert sum(len(k[3]) for k in got)


@pytest.mark.parametrize("length", [2, 5, 12, 60])
def test_repeats_of_every_kind(spark, length):
    rng = random.Random(length)
    base = "".join(rng.choice("abé\n ") for _ in range(400))
    texts = [(0, "a" * 300), (1, "ab" * 200), (2, None), (3, ""), (4, base[:100]), (4, base[:100])]
    for i in range(40):
        a = rng.randrange(350)
        cut = base[a : a + rng.randrange(3 * length)]
        noise = "".join(rng.choice("xyzé") for _ in range(rng.randrange(2 * length)))
        texts.append((rng.choice([10 + i, None]), noise + cut + noise[: length // 2]))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert found(remove_repeated_substrings(df, length=length)) == plain(texts, length)


def test_other_columns_stay(documents, texts):
    df = remove_repeated_substrings(documents, as_text=True)
    names = [c for c in documents.columns if c not in ("_bytes", "_kept", "_removed")]
    assert df.columns == [*names, "_bytes", "_kept", "_removed"]
    rows = df.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(texts)
    assert all(isinstance(r._kept, str) for r in rows)


def test_split_code_points_go_from_texts(spark):
    texts = [(1, "é" * 30 + "x"), (2, "y" + "é" * 30)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    kept = {r.doc_id: r._kept for r in remove_repeated_substrings(df, length=5, as_text=True).collect()}
    assert kept == {1: "x", 2: "y"}


def test_empty_table_and_bad_length(no_documents):
    assert remove_repeated_substrings(no_documents).collect() == []
    with pytest.raises(ValueError):
        remove_repeated_substrings(no_documents, length=1)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
@pytest.mark.parametrize("last", [False, True])
def test_reranking_a_sorted_stream(size, last, monkeypatch):
    """Pairs may go on over any number of batches."""
    import pyarrow as pa

    from barlake.llm import suffixes

    class Task:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(suffixes.TaskContext, "get", staticmethod(lambda: Task))
    rng = random.Random(size)
    rows = sorted(
        (rng.randrange(6), rng.randrange(3), rng.randrange(2) if rng.random() < 0.4 else 0, i)
        for i in range(60)
    )
    rows = sorted(rows + [(9, 9, 0, 1000 + i) for i in range(20)] + [(10, 0, i % 2, i) for i in range(9)])
    groups = {}
    for r in rows:
        groups.setdefault(r[:2], []).append(r)
    batches = [
        pa.RecordBatch.from_pydict(
            {
                "rank": pa.array([r[0] for r in part], pa.int64()),
                "ahead": pa.array([0] * len(part), pa.int64()),
                "mark": pa.array([r[2] for r in part], pa.int64()),
                "chunk": pa.array([7] * len(part), pa.int64()),
                "number": pa.array([r[3] for r in part], pa.int32()),
                "key": pa.array([r[1] for r in part], pa.int64()),
            }
        )
        for part in (rows[k : k + size] for k in range(0, len(rows), size))
    ]
    got = Counter()
    ranks = {}
    for batch in suffixes._reranked(last)(iter(batches)):
        assert batch.schema.names == ["rank", "ahead", "mark", "chunk", "number"]
        for r in batch.to_pylist():
            got[r["mark"], r["number"]] += 1
            ranks.setdefault(r["rank"], set()).add(r["number"])
    want, at, starts = Counter(), 0, set()
    for group in groups.values():
        several = len({r[2] for r in group}) > 1 if last else len(group) > 1
        if several:
            want.update((r[2], r[3]) for r in group)
            starts.add((3 << 40) + at)
        at += len(group)
    assert got == want and set(ranks) == starts
