"""The trie against plain prefixes in Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from palimpsest.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, words int, id string"


def brute(rows, rebuild=True):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [s[2:] for s in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        a = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        full[c] = convs.get(a, [])[:h] + own[h:]
    nodes = {}
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    own = {p: (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p, m in nodes.items()}
    leaves, saved, children = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p in nodes:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own[p]
    for p, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(full[c]) == len(p))))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, limit=prefix_trie.LIMIT, rebuild=True):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    convs = prefix_trie.conversations(df)
    out = prefix_trie.trie(prefix_trie.rebuilt(convs) if rebuild else convs, limit)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {k for _, k in out.dtypes[:-1]} == {"bigint"}
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("limit", [20, 300, prefix_trie.LIMIT])
def test_conversations(spark, limit):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(spark, df, limit) == brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_odd_rows(spark):
    big = 2**60
    rows = [
        (0, None, None, None), (0, None, "", ""), (0, 0, "user", "a b"), (0, 0, "user", "a a"), (0, 1, "user", ""), (None, 0, "user", "nobody"), (1, 5, "user", " \t\n "), (1, 5, "user", " \t\n "), (2, 0, "us", "era"),
        (2, 0, "user", "a"), (-7, 0, "user", "x"), (-7, -1, "user", "y"), (-20, 0, "u", "one  two"), (big + 1, 0, "user", "z"), (big + 2, 0, "user", "z"), (big + 3, 0, "user", "z"), (45, 0, "user", "w " * 50_000), (46, 1, "user", "w " * 50_000),
    ]
    for limit in (1, 3, 100):
        assert got(spark, rows, limit) == brute(rows) and got(spark, rows, limit, False) == brute(rows, False)
    assert got(spark, []) == []


@pytest.mark.parametrize("limit", [1, 15, 60])
def test_random_tries(spark, limit):
    """Few different turns: deep sharing, ends inside heads, many copies."""
    rnd = random.Random(limit)
    rows = [(c, t, "u", rnd.choice(["a", "b b", "c c c"][: rnd.randint(1, 3)])) for c in range(120) for t in range(rnd.choice([0, 1, 2, 3, 4, 9]))]
    assert got(spark, rows, limit) == brute(rows) and got(spark, rows, limit, False) == brute(rows, False)


def test_long_shared_beginning(spark):
    """A beginning of 100 turns that 30 conversations share bursts in a few rounds."""
    rows = [(c, t, "u", f"t{t}" if t < 100 else f"own {c}") for c in range(30) for t in range(102)]
    assert got(spark, rows, 50, False) == brute(rows, False)


def test_many_copies(spark):
    """Ids of a node come from many tasks, in numeric order."""
    df = spark.range(0, 50_000, 1, 7).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("u").alias("role"), F.lit("same").alias("text"))
    (root, node) = got(spark, df, 10, False)
    want = hashlib.sha256(",".join(map(str, range(50_000))).encode()).hexdigest()
    assert node == (0, 1, 0, 50_000, 0, 1, 49_999, want) and root[3] == 50_000
