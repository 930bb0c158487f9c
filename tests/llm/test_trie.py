import hashlib
import random
import zlib

import pytest

from barlake.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, seg string, path int, n long"


def rebuilt(rows):
    """Conversations as lists of ``(role, text)``, by the plain rule."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        size = f"{len(text.encode()):08X}"
        order = (turn is not None, turn or 0, digest + size)
        own.setdefault(conv, []).append((order, (role, text)))
    own = {c: [said for _, said in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        giver = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(giver, [])[:h] + turns[h:]
    return out


def brute(conversations):
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, convs in members.items():
        subtree = [v for v in members if v[: len(node)] == node]
        kids = {v for v in members if len(v) == len(node) + 1 and v[:-1] == node}
        leaves = [v for v in subtree if not any(len(w) == len(v) + 1 and w[:-1] == v for w in subtree)]
        saved = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in subtree if v)
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add(
            (min(convs), len(node), parent, len(convs), len(kids), len(leaves), saved,
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


def made(rng, n, turns, words):
    rows = []
    for _ in range(n):
        conv = rng.randrange(-30, 10 * n)
        for turn in range(rng.randrange(turns)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(words)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def found(spark, rows, **how):
    turns, convs = trie.rebuilt(*trie.ordered_turns(frame(spark, rows)))
    got = [tuple(r) for r in trie.prefix_trie(turns, convs, **how).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("segment, least", [(64, 4096), (2, 1), (3, 4), (1, 2), (64, 1)])
def test_against_brute_force(spark, segment, least):
    """Cut into segments and with containers burst, or neither: the same nodes."""
    rng = random.Random(segment)
    rows = made(rng, 40, 14, ["a", "é", "", "hello there"])
    rows += [(200 + i, t, "user", "same") for i in range(8) for t in range(9)]
    rows += [(300, t, "user", "long " * (t % 3)) for t in range(40)]
    rows += [(None, 1, "user", "nobody's"), (5, None, None, None), (5, None, "user", None)]
    rows += [(6, 2, "user", "x"), (6, 2, "user", "x"), (6, 2, "assistant", "tie")]
    rng.shuffle(rows)
    assert found(spark, rows, segment=segment, least=least, shares=1 << 16) == brute(rebuilt(rows))


def test_one_conversation_has_nearly_all_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    rows = [(10, t, "user", f"turn {t}") for t in range(90)] + [(11, 0, "user", "turn 0")]
    rows += [(12, t, "user", f"turn {t}") for t in range(30)]
    assert found(spark, rows, segment=3, least=1) == brute(rebuilt(rows))


def test_many_copies_are_one_entry(spark):
    """Copies do not make a container burst, however many."""
    rows = [(5 * i, t, "user", f"t{t}") for i in range(300) for t in range(3)]
    turns, convs = trie.rebuilt(*trie.ordered_turns(frame(spark, rows)))
    segments = trie._segments(turns, convs, 64)
    assert segments.count() == 300 and segments.select("path").distinct().count() == 1
    got = trie.prefix_trie(turns, convs, least=1).collect()
    assert sorted((r.conv_id, r.depth, r.n_convs, r.n_children) for r in got) == [
        (0, 0, 300, 1), (0, 1, 300, 1), (0, 2, 300, 1), (0, 3, 300, 0)
    ]


def test_turnless_conversations_and_none_at_all(spark):
    rows = [(c, 0, "user", f"only {c}") for c in range(1, 5)]  # without the first of their group
    got = found(spark, rows)
    assert got == brute(rebuilt(rows)) and any(r[1] == 0 and r[3] == 4 for r in got)
    assert found(spark, []) == set()


def test_long_texts(spark):
    text = "word " * 200_000
    rows = [(0, 0, "user", text), (0, 1, "user", text + "!"), (5, 0, "user", text), (5, 1, "a", "b")]
    assert found(spark, rows) == brute(rebuilt(rows))
