import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgertalk.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, depth int"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows):
    """The trie by its definition: every conversation whole, every subtree walked."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved, found = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, ())
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        last = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * last + sum(saved[x] for x in below)
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        found.append(
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                len(below),
                leaves[node],
                saved[node],
                hashlib.sha256(listed.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*row, 7) for row in rows], SCHEMA)
    found = ct.trie(df)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_equals_plain_on_random_families(spark, monkeypatch):
    monkeypatch.setattr(ct, "BLOCK", 4)
    monkeypatch.setattr(ct, "ENDS", 8)
    rnd = random.Random(11)
    rows = []
    for conv in range(-20, 120):
        if rnd.random() < 0.2:
            continue
        for turn in range(rnd.choice([1, 1, 2, 3, 5, 8, 12, 19])):
            text = rnd.choice(["a", "a", "ß", "long text", "", None])
            rows.append((conv, turn, rnd.choice(["user", "user", "assistant", None]), text))
    rnd.shuffle(rows)
    assert run(spark, rows) == plain(rows)


def test_equals_plain_on_copies_and_prefixes(spark, monkeypatch):
    """One conversation that most are, and others that stop early or go on."""
    monkeypatch.setattr(ct, "ENDS", 16)
    base = [("user", "one"), ("assistant", "two"), ("user", "three é"), ("assistant", "four")]
    rows = []
    for conv in range(300):
        n = 4 if conv % 3 else conv % 5
        rows += [(conv, turn, *base[turn]) for turn in range(n)]
        if conv % 50 == 7:
            rows += [(conv, 4 + turn, "user", f"more {turn % 9}") for turn in range(40)]
    assert run(spark, rows) == plain(rows)


def test_defined_results(spark):
    rows = [
        (5, None, "user", "first of all"),
        (5, 3, "user", None),
        (5, 3, "user", None),
        (5, -2, None, "x" * 100_000),
        (5, 3, "assistant", ""),
        (6, 0, "user", "short"),
        (None, 0, "user", "of nobody"),
        (8, 1, "us", "er"),
        (9, 1, "use", "r"),
        (13, 10_000, "user", "far"),
        (13, 9_999, "user", "nearly"),
    ]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "x")]) == []


def test_one_long_conversation(spark):
    rows = [(10, turn, "user", f"t{turn % 3}") for turn in range(1500)]
    rows += [(11, turn, "user", f"t{turn % 3}") for turn in range(700)]
    found = {r[:2]: r for r in run(spark, rows)}
    # Every node of the shorter one is one of the longer one's.
    assert len(found) == 1501
    assert found[10, 700][3] == 2 and found[10, 701][3] == 1
    assert found[10, 0][6] == 700 * 2


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in ct.trie(df).collect()), key=str) == plain(rows)
