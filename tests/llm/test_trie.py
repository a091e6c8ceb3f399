import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from ledgerlens.llm import prefix_trie, registry

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The contract over (conv_id, turn, role, text) tuples, in plain Python."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(x, key=lambda t: t[:4])] for c, x in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return sorted((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children.get(node, 0), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()) for node, convs in members.items())


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[:2], r[3:]))


def found(spark, rows, component):
    table = spark.createDataFrame([(*r, 1, 2, "n") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, len int, x1 string")
    return key(prefix_trie.report(table.repartition(5), component).select(*COLUMNS).collect())


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert key(registry.op13_prefix_trie(spark, sf_dir).select(*COLUMNS).collect()) == key(brute(rows))


def _forest(n_convs, seed):
    """Few words, so that many conversations share turns; one of them is a third of all rows."""
    rnd = random.Random(seed)
    rows = [(c, t, rnd.choice(["user", "bot"]), rnd.choice(["a", "bb", "ccc é"])) for c in range(-120, n_convs) for t in range(rnd.randint(1, 7))]
    return rows + [(107, t, "user", "long" * (t % 5)) for t in range(10, 10 + len(rows) // 2)]


def test_rounds_and_tasks_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 16)
    rows = _forest(130, 1)
    want = key(brute(rows))
    # components of 40 nodes or fewer go to tasks; the others are split by joins first
    assert found(spark, rows, 40) == want


def test_defined_cases(spark):
    rows = [(0, None, "user", "x"), (0, 1, None, "y"), (0, 1, None, None), (0, 1, "a", "y"), (0, 1, "a", "y"), (1, 5, "user", "x"), (1, None, "", ""), (2, 1, "user", "x" * 300_000),
            (None, 1, "user", "x"), (101, 1, "user", "only"), (103, 1, "user", "only"), (201, 0, "q", ""), (-5, 0, "user", "x"), (-105, 0, "user", "x")]
    assert found(spark, rows, 1 << 14) == key(brute(rows))
    assert found(spark, [], 4) == []
    assert found(spark, [(None, 1, "a", "b")], 4) == []


@pytest.mark.parametrize("shape", ["path", "star", "random", "comb", "forest"])
def test_centroid_totals(shape):
    rnd = random.Random(shape)
    n = 700
    parent = {"path": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: rnd.randrange(i), "comb": lambda i: i - 1 if i % 2 else max(i - 2, 0),
              "forest": lambda i: -1 if i % 50 == 0 else rnd.randrange(i - i % 50, i)}[shape]
    up = [-1, *(parent(i) for i in range(1, n))]
    weights = np.array([[rnd.randint(0, 9), 1] for _ in range(n)], np.int64)
    want = weights.copy()
    for i in reversed(range(1, n)):
        if up[i] >= 0:
            want[up[i]] += want[i]
    assert (prefix_trie.centroid_totals(np.array(up), weights) == want).all()
