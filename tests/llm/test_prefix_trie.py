"""The prefix trie against brute force, in one range and in many."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from galegrid.llm import prefix_trie as pt
from galegrid.llm.radix_tree import Full, Indexed, RadixTree, Sorted

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    found = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        found.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(m) == len(node) + 1 for m in below), sum(not any(x[: len(m)] == m and len(x) > len(m) for x in below) for m in below),
            sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m),
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def trie(spark, rows):
    return sorted(map(tuple, pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def conversations(seed, n=60, most=7):
    """Few texts, so that beginnings are shared; ids in groups of a hundred, with and without a first."""
    chance = random.Random(seed)
    ids = chance.sample([*range(0, 40), *range(100, 140), *range(250, 290), 300, 1000], n)
    return [
        (c, turn, chance.choice(["user", "assistant"]) if chance.random() < 0.2 else "user", chance.choice(["a", "b", "é🙂"]))
        for c in ids for turn in range(chance.choice([1, 2, 3, most]))
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("rows_of_a_task", [1, 5, 2000])
def test_as_brute_force(spark, monkeypatch, seed, rows_of_a_task):
    monkeypatch.setattr(pt, "TASK_ROWS", rows_of_a_task)
    rows = conversations(seed)
    assert trie(spark, rows) == expected(rows)


@pytest.mark.parametrize("span", [2, 4096])
def test_copies_and_one_long_conversation(spark, monkeypatch, span):
    monkeypatch.setattr(pt, "SPAN", span)
    monkeypatch.setattr(pt, "TASK_ROWS", 3)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 60) for t in range(3)]
    rows += [(c, t, "user", f"turn {t}") for c in range(1000, 1005) for t in range(60)]
    assert trie(spark, rows) == expected(rows)


def test_nulls_ties_and_conversations_that_end_before_they_begin(spark, monkeypatch):
    monkeypatch.setattr(pt, "TASK_ROWS", 2)
    rows = [(7, 0, "user", "x"), (7, 0, "user", "x"), (7, 0, "assistant", "x"), (7, None, None, None), (None, 1, "user", "lost")]
    rows += [(c, 0, "user", "only") for c in range(201, 230)]  # no first conversation: some lose their only turn
    rows += [(c, 0, "r", "") for c in range(300, 306)]
    want = expected(rows)
    assert any(depth == 0 and ends != pt.NO_ENDS for _, depth, *_, ends in want)
    assert {r[1:] for r in trie(spark, rows) if r[0] != 7} == {r[1:] for r in want if r[0] != 7}
    # equal turns go in one order of their own; without ties both agree throughout
    rows = [r for r in rows if r[0] != 7]
    assert trie(spark, rows) == expected(rows)


def test_empty_table_long_text_and_other_columns(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "x")]) == []
    df = spark.createDataFrame([(3, 0, "user", "é" * 200_000, 1, b"z")], SCHEMA + ", n int, key binary")
    found = pt.prefix_trie(df.withColumnsRenamed({"conv_id": "c", "n": "conv_id"}), key="c").collect()
    assert found[0]["n_convs"] == 1 and len(found) == 1 + (zlib.crc32(b"3") % 6 < 1)


def test_layouts_grow():
    chance, tree, kinds = random.Random(2), RadixTree(), set()
    keys = {bytes([chance.randrange(256)]) + chance.randbytes(chance.choice([0, 1, 3])) for _ in range(900)}
    for k, key in enumerate(sorted(keys, key=lambda _: chance.random())):
        tree.insert(key, k)
        kinds.add((type(tree.root.children), getattr(tree.root.children, "size", 0)))
    assert kinds == {(Sorted, 4), (Sorted, 16), (Indexed, 0), (Full, 0)}
    found, stack = [], [(tree.root, b"")]
    while stack:
        node, prefix = stack.pop()
        prefix += node.path
        if node.value is not None:
            found.append(prefix)
        stack.extend((n, prefix) for n in reversed(node.below()))
    assert found == sorted(keys)
