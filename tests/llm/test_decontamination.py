import random
import re

import pytest

from barlake.llm import decontamination as d

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(texts, items, window):
    """Words, hits and items of each text."""
    places = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            places.setdefault(tuple(w[j : j + n]), set()).add(i)
    sizes = {len(k) for k in places}
    out = []
    for i, t in texts:
        w = words(t)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                at = places.get(tuple(w[j : j + n]))
                if at:
                    hit[j : j + n] = [True] * n
                    found |= at
        left = [x for x, h in zip(w, hit) if not h]
        out.append((i, len(w), sum(hit), sorted(found, key=lambda x: (x is None, x)), left))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r._words, r._hits, r._items, words(r._kept)) for r in df.collect()), key=repr)


def test_against_all_windows(spark, documents, texts):
    given = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    odd = [
        (None, "without an id and rather short"),
        (None, "one"),
        (900, "One"),
        (901, None),
        (902, " -- "),
        (903, texts[0][1][:400] if texts[0][1] else "x"),
        (904, "under the same"),
        (904, "under the same"),
    ]
    items = given.unionByName(spark.createDataFrame(odd, ITEMS))
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    for window in (10, 3, 1):
        got = found(d.decontaminate(documents, items, window=window))
        assert got == plain(texts, rows, window)
    assert any(r[2] for r in got)


def test_blocks_of_items_add_up(spark, documents, texts, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    monkeypatch.setattr(d, "BLOCK_BYTES", 3000)
    assert found(d.decontaminate(documents, items)) == plain(texts, rows, 10)


def test_empty_tables(spark, documents, texts, no_documents):
    none = spark.createDataFrame([], ITEMS)
    assert found(d.decontaminate(documents, none)) == plain(texts, [], 10)
    assert d.decontaminate(no_documents, none).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_automaton_finds_the_longest_matches(seed):
    """Few different words, so that items overlap in every way."""
    import numpy as np

    rng = random.Random(seed)
    alphabet = range(1, rng.choice([3, 4, 7]))
    items = [[rng.choice(alphabet) for _ in range(rng.randrange(0, 14))] for _ in range(6)]
    automaton = d.Automaton([(i, np.array(w, np.uint64)) for i, w in enumerate(items)], window=4)
    text = [rng.choice(alphabet) for _ in range(200)]
    parts = {tuple(w[i:j]) for w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    for i, _, matched in automaton.walk(text):
        longest = max((n for n in range(1, 15) if n <= i + 1 and tuple(text[i + 1 - n : i + 1]) in parts), default=0)
        assert matched == longest


def test_what_is_left_of_a_text(spark):
    items = spark.createDataFrame([(1, "b c d")], ITEMS)
    docs = spark.createDataFrame([(1, "A (b, C d). e"), (2, "b c"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r._kept for r in d.decontaminate(docs, items).collect()}
    assert got == {1: "A (). e", 2: "b c", 3: None}


def test_a_pass_for_each_block_writes_no_texts(spark, documents, texts, monkeypatch):
    """A benchmark too large for one pass: chunks are written once, passes write marks alone."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    odd = spark.createDataFrame([(None, "without an id and rather short"), (7, "one"), (8, "one")], ITEMS)
    items = items.unionByName(odd)
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    monkeypatch.setattr(d, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(d, "AT_ONCE", 1)
    monkeypatch.setattr("barlake.llm.exchange.CHUNK_BYTES", 1 << 16)
    wrote = []
    real = d.written
    monkeypatch.setattr(d, "written", lambda df, label: wrote.append(df.columns) or real(df, label))
    got = d.decontaminate(documents, items)
    assert found(got) == plain(texts, rows, 10)
    assert len(wrote) >= 3 and all(w == ["chunk", "row", "marks", "found"] for w in wrote)
    assert set(got.columns) == set(documents.columns) | {"_words", "_hits", "_items", "_kept"}


def test_equal_items_are_read_once(spark):
    items = spark.createDataFrame([(i, "a b c d") for i in range(50)] + [(None, "a b c d")], ITEMS)
    packed = d._packed(items, "item_id", "text", 0, 1, 10)
    assert len(packed.ids) == 1 and len(packed.ids[0]) == 51
    docs = spark.createDataFrame([(1, "x a b c d y")], "doc_id long, text string")
    (row,) = d.decontaminate(docs, items).collect()
    assert row._items == [*range(50), None] and row._hits == 4


@pytest.mark.parametrize("seed", range(4))
def test_packed_walks_as_the_automaton_does(seed):
    import numpy as np

    rng = random.Random(seed)
    items = [[rng.randrange(1, 5) for _ in range(rng.randrange(0, 14))] for _ in range(6)]
    automaton = d.Automaton([(i, np.array(w, np.uint64)) for i, w in enumerate(items)], window=4)
    packed = d.Packed(automaton, [[i] for i in range(6)])
    text = [rng.randrange(1, 7) for _ in range(200)]
    numbers = {int(w): k for k, w in enumerate(packed.words)}
    plainly = [(i, m) for i, _, m in automaton.walk(text)]
    assert plainly == [(i, m) for i, _, m in packed.walk([numbers.get(w, -1) for w in text])]
