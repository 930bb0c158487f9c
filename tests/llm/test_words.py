"""The byte arithmetic under the operators, against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.llm import words as w
from barlake.llm.exchange import Keys, pack, unpack

texts = st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab Zé\n\t x"), max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_of_rows(rows):
    column = pa.array(rows, pa.string())
    data, at = w.utf8(column)
    words = w.split_words(data, at)
    got = [bytes(data[a:b]).decode() for a, b in zip(words.start, words.end)]
    want = [re.findall("[^ \t-\r]+", r or "") for r in rows]
    assert got == [x for row in want for x in row]
    assert words.per_row.tolist() == [len(row) for row in want]
    hashes, row_at = w.hashed(column)
    named = {}
    for text, h in zip(got, hashes.tolist()):
        assert named.setdefault(text, h) == h
    assert len(set(named.values())) == len(named)
    assert row_at.tolist() == words.row_at.tolist()


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(0, 2**32))
def test_kept_words_and_spans(rows, seed):
    column = pa.array(rows, pa.string())
    words = w.split_words(*w.utf8(column))
    keep = np.random.default_rng(seed).random(len(words.start)) < 0.5
    want, spans, i = [], [], 0
    for r in rows:
        mine = re.findall("[^ \t-\r]+", r or "")
        flags = keep[i : i + len(mine)]
        i += len(mine)
        want.append(" ".join(x for x, k in zip(mine, flags) if k).encode())
        spans.append([(a, a + len(m.group())) for m in re.finditer("0+", "".join("01"[int(k)] for k in flags)) for a in [m.start()]])
    assert w.kept_texts(words, keep) == want
    lists = w.span_lists(~keep, words.row_at).to_pylist()
    assert [[(s["start"], s["end"]) for s in row] for row in lists] == spans


@pytest.mark.parametrize("length", [1, 3, 7])
def test_windows_have_equal_hashes_where_they_are_equal(length):
    rng = np.random.default_rng(length)
    values = rng.integers(0, 3, 500).astype(np.uint64)
    hashes = w.window_hashes(w.scramble(values), length)
    named = {}
    for i, h in enumerate(hashes.tolist()):
        assert named.setdefault(tuple(values[i : i + length].tolist()), h) == h
    assert len(set(named.values())) == len(named)
    rolling = w.Rolling(values)
    starts = rng.integers(0, 400, 50)
    assert (rolling(starts, starts + 5) == rolling(starts, starts + 5)).all()


def test_covered_and_fits():
    assert w.covered(np.array([0, 2, 6]), 3, 10).tolist() == [True] * 5 + [False] + [True] * 3 + [False]
    assert w.covered(np.zeros(0, int), 3, 2).tolist() == [False, False]
    assert w.fits(np.array([0, 2, 2, 5]), 2).tolist() == [0, 2, 3]


@pytest.mark.parametrize("dtype", [np.uint8, np.uint32, np.uint64])
@pytest.mark.parametrize("n", [0, 1, 1000])
def test_pack_round_trip(dtype, n):
    values = np.sort(np.random.default_rng(n).integers(0, np.iinfo(dtype).max, n, dtype=dtype))
    assert (unpack(pack(values, delta=True), dtype, delta=True) == values).all()
    assert (unpack(pack(values), dtype) == values).all()


@pytest.mark.parametrize("bits", [32, 64])
@pytest.mark.parametrize("buckets", [1, 16, 1024])
def test_keys_meet_their_answers(bits, buckets):
    rng = np.random.default_rng(buckets)
    hashes = rng.integers(0, 2**64, 400, dtype=np.uint64)[rng.integers(0, 400, 3000)]
    keys = Keys(hashes, buckets, bits)
    assert keys.counts.sum() == 3000
    dtype = np.uint32 if bits == 32 else np.uint64
    seen, got = 0, {}
    for bucket, part in keys.parts():
        sent = unpack(keys.sent(part), dtype, delta=True)
        assert len(sent) == part.stop - part.start
        seen += len(sent)
        got[bucket] = pack(keys.counts[part].astype(np.uint32))
    assert seen == len(np.unique(hashes))
    answers = keys.answers(got, np.uint32)
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    assert (answers[keys.inverse] == counts[inverse]).all()


def thue_morse(n, symbols):
    return "".join(symbols[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 8192, 1 << 17])
@pytest.mark.parametrize("symbols", ["ab", "xyzzy é".split()])
def test_texts_whose_polynomials_are_equal(n, symbols):
    """Whatever the base, a plain polynomial modulo 2**64 cannot tell these apart."""
    one, other = thue_morse(n, symbols), thue_morse(n, symbols[::-1])
    hashes, _ = w.hashed(pa.array([one, f"{other} {one}", "x" * 100 + " " + one]))
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2] == hashes[4]
    data = np.frombuffer((one + other).encode(), np.uint8)
    half = np.array([0, len(one.encode())])
    if n >= 1024 and len(one) == len(other) == n:
        plain = w.Rolling(w.byte_values(data))(half, half + n)
        assert plain[0] == plain[1]


def test_tree_hashes_depend_on_the_range_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 20_000).astype(np.uint8)
    values = w.byte_values(np.concatenate([data, data[:1], data]))
    start = rng.integers(0, 9_000, 300)
    end = start + rng.integers(0, 11_000, 300)
    first = w.tree_hashes(values, start, end)
    assert np.array_equal(first, w.tree_hashes(values, start + 20_001, end + 20_001))
    texts_ = {data[a:b].tobytes() for a, b in zip(start, end)}
    assert len(set(first.tolist())) == len(texts_)
