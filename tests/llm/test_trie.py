"""The prefix trie against a plain one, over any cut into pieces and partitions."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from parcelflow.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, depth string, ctx string, n string, ends_sha256 string"


def plain(rows):
    """All nodes by walking every prefix."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [v[2:] for v in sorted(turns)] for c, turns in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = (*own.get(c - (abs(c) % 100) * (1 if c > 0 else -1), [])[:h], *turns[h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for v in members:
        if v:
            kids[v[:-1]].append(v)
    leaves, saved, out = {}, {}, []
    for v in sorted(members, key=len, reverse=True):
        leaves[v] = sum(leaves[k] for k in kids[v]) if kids[v] else 1
        saved[v] = (len(members[v]) - 1) * (len(v[-1][1]) if v else 0) + sum(saved[k] for k in kids[v])
        ends = ",".join(str(c) for c in sorted(members[v]) if len(convs[c]) == len(v))
        out.append((min(members[v]), len(v), min(members[v[:-1]]) if v else None, len(members[v]), len(kids[v]), leaves[v], saved[v],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **limits):
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in trie.rebuilt_trie(df, **limits).select(*trie.NODE_COLUMNS).collect()), key=str)


def some_rows(seed):
    """Few words, so that prefixes are shared; null turns, roles and texts, repeated rows, negative and far ids."""
    rng, rows = random.Random(seed), [(None, 1, "u", "nobody's")]
    for c in [*range(40), 100, 200, 201, 205, 305, -3, -100]:
        if rng.random() < 0.9:
            for t in range(rng.choice([1, 2, 5, 9, 14])):
                rows.append((c, rng.choice([None, t, t]), rng.choice([None, "u", "a", "u", "u"]), rng.choice(["x", "x", "yy", None, ""])))
    return rows + rows[:30]


@pytest.mark.parametrize(("seed", "limits"), [
    (1, {}), (2, {"piece": 3, "part_rows": 4, "fan": 2}), (3, {"piece": 1, "part_rows": 3, "fan": 2}), (4, {"piece": 2, "part_rows": 1, "fan": 3}),
])
def test_equals_the_plain_trie(llm, seed, limits):
    rows = some_rows(seed)
    assert found(llm, rows, **limits) == plain(rows)


def test_empty_table(llm):
    assert found(llm, []) == [] and found(llm, [(None, 1, "u", "x")]) == []


def test_long_conversations_that_part_late(llm):
    """Copies of a conversation of 300 turns, some with another last turn: shared pieces, tails and a hot sequence."""
    rows = [(c, t, "u", "same" if t < 299 or c % 7 else f"end {c}") for c in range(1000, 7000, 100) for t in range(300 - (c == 1300))]
    assert found(llm, rows, piece=64, part_rows=5) == plain(rows)


def test_one_conversation_without_a_turn_of_its_own(llm):
    rows = [(201, 0, "u", "x")]
    assert zlib.crc32(b"201") % 6 >= 1 and plain(rows) == [(201, 0, None, 1, 0, 1, 0, hashlib.sha256(b"201").hexdigest())]
    assert found(llm, rows) == plain(rows)


@pytest.mark.parametrize("cut", [1, 2, 3, 7])
def test_contracted_forests_stay_small(cut):
    """Whatever the cut into runs, joined forests give the same nodes, and rims hold at most two parts for each depth."""
    rng = random.Random(cut)
    keys = sorted({bytes(rng.choice([0, 1]) for _ in range(rng.randint(0, 8))) for _ in range(200)})
    wide = [b"".join(bytes([x]) * trie.TURN_BYTES for x in k) for k in keys]

    def parts():
        return [trie.Part("c", k, trie.np.arange(len(k) // trie.TURN_BYTES + 1), 1, i, 0, 0, 0, str(i)) for i, k in enumerate(wide)]

    def nodes(rows):
        ref = {r[3]: r[4] for r in rows if r[3]}
        return sorted(((r[4], r[5], r[6] if r[7] is None else ref[r[7]], *r[8:]) for r in rows), key=str)

    whole = trie.Forest(0)
    every = parts()
    assert whole.merge(every, [trie.shared_turns(a, b) for a, b in zip(every, every[1:])], False, False) == ([], [])
    path, forest, most = ([], []), trie.Forest(0), 0
    for at in range(0, len(wide), 200 // cut):
        run = path[0] + parts()[at : at + 200 // cut]
        edges = path[1] + [trie.shared_turns(a, b) for a, b in zip(run[len(path[1]) :], run[len(path[1]) + 1 :])]
        path = forest.merge(run, edges, True, True)
        most = max(most, len(path[0]))
    forest.merge(*path, False, False)
    assert nodes(forest.rows) == nodes(whole.rows) and most <= 2 * 9 + 2
