"""The prefix trie against nested dictionaries."""

import hashlib
import random
import zlib

import pytest

from typerank.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, name string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c / 5) * 5
        out[c] = own.get(c - base, [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = lambda p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)
        ends = sorted(c for c in ids if len(convs[c]) == len(path))
        out.append((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), children(path),
            sum(children(p) == 0 for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(table, rows, band):
    turns = trie.staged(trie.ordered_turns(table([(*r, 5, "clash") for r in rows], SCHEMA)), "turns")
    made = trie.prefix_trie(*trie.shared_histories(turns), band=band)
    return sorted((tuple(r) for r in trie.described(made).collect()), key=repr), made, turns


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(40), 101, 102, 1003, -7, -5, 1 << 40]:
        for t in range(rng.choice([0, 1, 2, 3, 8, 12, 20])):
            rows.append((c, t, rng.choice(["user", "é"]), rng.choice(["a", "b", "ü" * 5])))
    rows += [(3, None, None, None), (3, None, "user", "x"), (4, 2, "user", "twice"), (4, 2, "user", "twice")]
    rows += [(None, 0, "user", "lost"), (200, None, None, None), (6, 1 << 40, "far", "away"), (7, -(1 << 40), "before", "all")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("band", [2, 4])
def test_trie_against_plain_python(table, band):
    rows = conversations(band)
    got, made, turns = found(table, rows, band)
    assert got == plain(rows)
    texts = {(r.depth, r.conv_id): (r.role, r.text) for r in trie.node_texts(made, turns).collect()}
    convs = rebuilt(rows)
    assert texts == {(d, c): convs[c][d - 1] for c, d, *_ in plain(rows) if d}


def test_long_conversations_take_few_levels(table, spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_BITS", 3)
    rows = [(c, t, "user", "x" if t < 60 + c else f"{c}") for c in (5, 6) for t in range(90)]
    assert found(table, rows, 3)[0] == plain(rows)


def test_copies_end_at_one_node_in_several_packed_rows(table, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 3)
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(9)] + [(5 * c + 1000, 0, "user", "one") for c in range(40)]
    assert found(table, rows, 4)[0] == plain(rows)


def test_one_turnless_conversation_and_none(table):
    for rows in ([(11, 0, "user", "x")], [(None, 1, "user", "x")], []):
        assert found(table, rows, 4)[0] == plain(rows)
