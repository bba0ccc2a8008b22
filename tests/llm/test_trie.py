"""Operator 11 against a plain trie, over orders, odd rows, long conversations and shared prefixes."""
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackscene.llm import trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain(rows):
    """The contract, one conversation after another in plain Python."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    tie = lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(f"{len(x[1])}:{x[1]}{x[2]}".encode()).digest())
    own = {c: [x[1:] for x in sorted(t, key=tie)] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h, rest = zlib.crc32(str(c).encode()) % 9, abs(c) % 5 * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(c - rest, [])[:h] + t[h:])
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children = {}
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if built[c] == n))).encode()).hexdigest()) for n, m in members.items())


def got(spark, rows, add=lambda d: d):
    out = trie.prefix_trie(add(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert out.columns == trie.NODES
    return sorted(tuple(r) for r in out.collect())


def same(a, b):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(a, key=key) == sorted(b, key=key)


def test_shared_and_diverging_prefixes(spark):
    rng = random.Random(4)
    rows = []
    for c in range(120):
        n = rng.choice([1, 2, 3, 4, 5, 8, 9, 13])
        seed = rng.randrange(6)
        for t in range(n):  # from some turn on, conversations of one seed go their own ways
            own = "" if t < rng.choice([2, 4, 6, 7, 20]) else f" of {c}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of seed {seed}{own} ü"))
    rng.shuffle(rows)
    same(got(spark, rows), plain(rows))


def test_copies_long_conversations_and_borders(spark):
    rows = [(c, t, "user", f"text {t}") for c in range(40, 60) for t in range(6)]
    rows += [(c, t, "user", f"long {t}" if t < 1500 else f"tail {t} {c}") for c in (5, 6, 7) for t in range(1530)]
    same(got(spark, rows), plain(rows))


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", "tie"), (1, 0, "user", "tie"), (None, 0, "user", "no conversation"), (-7, 1, "a", "x"),
            (-5, 0, "a", "y"), (-5, 1, "a", "z"), (0, 0, "user", "only turn"), (2, 5, "user:", "text"), (3, 5, "user", ":text"), (4, 0, "r", "w " * 50000), (4, None, "r", None)]
    rows += [(10, None, "user", "the same")] * 700
    clash = lambda d: d.select("*", *[F.lit(1).alias(c) for c in ("d", "n", "part", "at", "h", "k", "end", "digest", "a.b", "len", "_tie")])
    same(got(spark, rows, clash), plain(rows))


def test_empty_table_and_turnless(spark):
    assert got(spark, []) == []
    rows = [(c, 0, "user", "replaced by nothing") for c in (1, 2, 3, 4)]  # their base does not exist: h > 0 leaves no turn
    assert plain(rows)[0][1] == 0
    same(got(spark, rows), plain(rows))


@pytest.mark.parametrize("cut", [0, 1, 5, 9])
def test_sequence_hash_composes(cut):
    d = [hashlib.md5(bytes([i])).digest() for i in range(9)]
    assert trie.joined(trie.hash_of(d[:cut]), trie.hash_of(d[cut:]), 9 - cut) == trie.hash_of(d)


def test_many_ends_of_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "PACK_IDS", 7)
    ends = spark.createDataFrame([(b"x" * 16, c) for c in range(200, 0, -1)] + [(b"y" * 16, 5)], "digest binary, conv_id long")
    out = {bytes(r[0]): r[1] for r in trie.end_hashes(ends).collect()}
    assert out == {b"x" * 16: hashlib.sha256(",".join(map(str, range(1, 201))).encode()).hexdigest(), b"y" * 16: hashlib.sha256(b"5").hexdigest()}
