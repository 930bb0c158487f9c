import itertools
import random

import pytest

from barlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, seg string, position int"


def cheapest(roles):
    """Least cost over all ways to take each turn and to put messages in, by brute force."""
    best = {chat.START: 0}
    for role in roles:
        code = chat.ROLES.index(role) + 1 if role in chat.ROLES else 0
        ahead = {}
        for state, cost in best.items():
            for n in range(4):
                for way in itertools.product((1, 2, 3), repeat=n):
                    at, legal = state, True
                    for step in way:
                        legal = legal and step in chat.NEXT[at]
                        at = step
                    if not legal:
                        continue
                    for new in (1, 2, 3):
                        relabel = chat.RELABEL * (new != code)
                        if new in chat.NEXT[at]:
                            c = cost + n * chat.INSERT + relabel
                            ahead[new] = min(c, ahead.get(new, c))
                        if new == at and not way:
                            c = cost + chat.MERGE + relabel
                            ahead[new] = min(c, ahead.get(new, c))
        best = ahead
    return min(c + chat.INSERT * len(chat.END[s]) for s, c in best.items())


def messages(text):
    """``(role, content)`` of a rendered conversation, which must be legal."""
    out, at = [], chat.START
    for piece in text.split(chat.CLOSE)[:-1]:
        assert piece.startswith(chat.OPEN)
        role, _, content = piece[len(chat.OPEN) :].partition("\n")
        assert chat.ROLES.index(role) + 1 in chat.NEXT[at]
        at = chat.ROLES.index(role) + 1
        out.append((role, content))
    assert at == chat.ASSISTANT and text.endswith(chat.CLOSE)
    return out


def repaired(spark, rows, partitions=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(partitions)
    found = {}
    for r in chat.format_chats(df).collect():
        found.setdefault(r.conv_id, []).append(r)
    return {c: sorted(rs, key=lambda r: r.position) for c, rs in found.items()}


def test_repairs_cost_as_little_as_any(spark):
    rng = random.Random(3)
    conversations = {
        c: [rng.choice([*chat.ROLES, "tool", None]) for _ in range(rng.randrange(1, 9))]
        for c in range(120)
    }
    rows = [(c, t, role, f"t{c}-{t}") for c, roles in conversations.items() for t, role in enumerate(roles)]
    found = repaired(spark, rows)
    assert set(found) == set(conversations)
    for c, rs in found.items():
        assert [r.role for r in rs] == conversations[c]
        assert sum(r.cost for r in rs) == cheapest(conversations[c]), conversations[c]
        said = messages("".join(r.fragment for r in rs))
        texts = [t for _, m in said for t in m.split("\n") if t]
        assert texts == [f"t{c}-{t}" for t in range(len(rs))]
        empty = sum(not m for _, m in said)
        assert empty == sum(r.inserted for r in rs)
        merged = sum(r.action.endswith("merge") for r in rs)
        assert len(said) == len(rs) - merged + empty


@pytest.mark.parametrize("bits", [2, 10])
def test_segments_do_not_change_the_repair(spark, monkeypatch, bits):
    """One conversation much longer than a segment, over several levels of them."""
    rng = random.Random(5)
    roles = [rng.choice(["user", "assistant", "user", "system"]) for _ in range(40)]
    monkeypatch.setattr(chat, "SEGMENT_BITS", bits)
    (rs,) = repaired(spark, [(1, t, r, f"x{t}") for t, r in enumerate(roles)]).values()
    assert sum(r.cost for r in rs) == cheapest(roles)
    messages("".join(r.fragment for r in rs))


def test_odd_rows(spark):
    rows = [
        (None, None, "user", None),
        (None, 2, None, "<|im_end|> inside"),
        (7, 1, "user", ""),
        (7, 1, "user", ""),
        (8, 0, "assistant", "x " * 50_000),
        (9, 0, "user", "hello"),
    ]
    found = repaired(spark, rows)
    assert sorted(map(len, found.values())) == [1, 1, 2, 2]
    for rs in found.values():
        messages("".join(r.fragment for r in rs))
    assert [r.action for r in found[7]] == ["keep", "merge"]
    assert found[8][0].inserted == 1 and found[8][0].cost == chat.INSERT
    assert found[9][0].inserted == 1
    assert found[None][1].new_role == "assistant"
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_conversations_are_legal_already(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = chat.format_chats(turns).collect()
    assert len(rows) == turns.count()
    kept = [r for r in rows if r.action == "keep"]
    assert len(kept) > 0.5 * len(rows)


def test_long_turns(spark):
    """Texts of a megabyte, whole, alone and in equal pairs that differ at the end."""
    long = "word " * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "a"), (1, 1, "assistant", long + "b")]
    rows += [(2, t, "user" if t % 2 == 0 else "assistant", long[: 50_000 + t]) for t in range(40)]
    found = repaired(spark, rows)
    assert [r.action for r in found[1]] == ["keep", "keep", "merge"]
    texts = [text for _, text in messages("".join(r.fragment for r in found[2]))]
    assert texts == [r[3] for r in rows[3:]]
    joined = messages("".join(r.fragment for r in found[1]))[1][1]
    assert sorted(joined.split("\n")) == [long + "a", long + "b"]
