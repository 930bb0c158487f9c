"""Fingerprints against a plain implementation, and the search against all pairs."""

import hashlib
import random
import re

import xxhash

from barlake.llm.simhash import edited_fingerprints, find_within, fingerprints, with_near_rows


def plain(text):
    """The 128 bits as two signed longs."""
    seeds = (42, xxhash.xxh64_intdigest(b"\1\0\0\0", seed=42))
    votes = [[0] * 64, [0] * 64]
    for word in re.split("[ \t-\r]+", (text or "").lower()):
        length = min(len(word), 16)
        weight = (length * length + 15) // 16
        for half, seed in enumerate(seeds):
            h = xxhash.xxh64_intdigest(word.encode(), seed=seed)
            for i in range(64):
                votes[half][i] += weight if h >> i & 1 else -weight
    bits = [sum(1 << i for i, v in enumerate(vs) if v > 0) for vs in votes]
    return tuple(b - (1 << 64) if b >> 63 else b for b in bits)


def as_text(halves):
    return "".join(f"{h & (1 << 64) - 1:016x}" for h in halves)


def likeness(a, b):
    return 1 - sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a, b)) / 128


def test_every_row_has_its_fingerprints(documents, texts):
    rows = edited_fingerprints(documents).collect()
    assert len(rows) == len(texts)
    # Descending ids, null last; the texts of an id in an order of their own.
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.fingerprint, r.n_chars), []).append(r)
    by_id = {}
    for i, t in texts:
        by_id.setdefault(i, []).append(t or "")
    order = sorted(by_id, key=lambda i: (i is None, -(i or 0)))
    checked = 0
    for a, b in zip(order, order[1:] + order[:1]):
        if len(set(by_id[a])) > 1 or len(set(by_id[b])) > 1:
            continue
        text, other = by_id[a][0], by_id[b][0]
        take = len(text) // 3
        edited = text[: len(text) - take] + other[:take]
        prints = [plain(t) for t in (text, edited, other)]
        found = got[a, as_text(prints[0]), len(text)]
        assert len(found) == len(by_id[a])
        for r in found:
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.edited_fingerprint == as_text(prints[1])
            assert abs(r.near_edited - likeness(prints[0], prints[1])) < 1e-12
            assert abs(r.near_next - likeness(prints[0], prints[2])) < 1e-12
        checked += 1
    assert checked > 200


def test_one_document_is_its_own_next(spark):
    (row,) = edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert row.near_next == 1.0


def test_empty_table(no_documents):
    assert edited_fingerprints(no_documents).collect() == []


def test_search_finds_all_within_the_radius(spark):
    rng = random.Random(0)
    base = [rng.getrandbits(128) for _ in range(60)]
    values = set(base)
    for b in base:
        for flips in range(1, 8):
            values.add(b ^ sum(1 << i for i in rng.sample(range(128), flips)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(v & (1 << 64) - 1), signed(v >> 64)) for v in values]
    prints = spark.createDataFrame(rows, "f0 long, f1 long")
    queries = spark.createDataFrame(rows[::3], "f0 long, f1 long")
    for radius, spare in ((0, 1), (3, 1), (3, 2), (6, 2)):
        rs = find_within(queries, prints, radius, spare).collect()
        got = {((r.q0, r.q1), (r.f0, r.f1)): r.bits for r in rs}
        assert len(got) == len(rs)
        want = {}
        for q in rows[::3]:
            for p in rows:
                bits = round(128 * (1 - likeness(q, p)))
                if bits <= radius:
                    want[q, p] = bits
        assert got == want


def test_near_rows_count_copies(spark):
    rows = [(i, f, 0) for i, f in enumerate([5, 5, 5, 4, 7, 127, 5, -1])]
    prints = spark.createDataFrame(rows, "doc_id long, f0 long, f1 long")
    got = {r.doc_id: r.near_rows for r in with_near_rows(prints, prints["doc_id"] % 2 == 0).collect()}
    assert got == {0: 5, 1: None, 2: 5, 3: None, 4: 5, 5: None, 6: 5, 7: None}


def test_copies_of_a_key_change_nothing(spark):
    rows = [(1, "some words and some more"), (1, "some words and some more"), (2, None)]
    df = spark.createDataFrame(rows, "k long, t string")
    got = {r.k: (r.f0, r.f1) for r in fingerprints(df, ["k"], "t").collect()}
    assert got == {1: plain(rows[0][1]), 2: (0, 0)}
