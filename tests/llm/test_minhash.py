"""Operator 12 against all pairs in plain Python; the multi-index join against plain distances."""
import random
import re
from itertools import combinations

import numpy as np
import pytest
from trackscene.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words=3):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}


def plain(rows):
    """(doc_id, n_shingles, component_id, kept) by all pairs."""
    sets = [shingles(t) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 85 * len(a | b):
            up[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(s), c := low.get(root(i)), r[0] == c) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def got(docs, **kw):
    out = minhash.near_copies(docs, **kw)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def family(rng, words, edits):
    """Copies of one text, each changed in its own places."""
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    for k in edits:
        t = list(base)
        for i in rng.sample(range(words), k):
            t[i] = f"x{rng.randrange(10**6)}"
        yield " ".join(t)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    texts = [t for n in (3, 5, 20, 60, 200, 400) for t in family(rng, n, [0, 0, 1, 1, 2, n // 40, n // 30, n // 20, n // 20, n // 15])]
    texts += list(family(rng, 100, [0] + [1, 2, 3] * 60))  # one large group
    texts += [None, "", " \t\n", "one", "one ", "two words", "Two Words", "two words more"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_against_all_pairs(make, corpus):
    assert got(make(corpus).repartition(5)) == plain(corpus)


def test_odd_rows(make, odd_rows, clashing):
    assert got(clashing(make(odd_rows))) == plain(odd_rows)
    assert got(make([])) == []


def random_pairs(rng, n, apart):
    a = rng.integers(0, 1 << 16, (n, minhash.POSITIONS)).astype(np.uint16)
    b = a.copy()
    for i in range(n):
        b[i, rng.choice(minhash.POSITIONS, apart, replace=False)] ^= rng.integers(1, 1 << 16, apart).astype(np.uint16)
    return a, b


@pytest.mark.parametrize("apart", [0, 1, 7, 14, 15])
@pytest.mark.parametrize("split", [0, 1, 2])
def test_every_pair_within_the_distance_shares_a_key(apart, split):
    a, b = random_pairs(np.random.default_rng(apart), 200, apart)
    errors, none = minhash.MOST_APART // (minhash.CHUNKS - split), np.zeros(200, np.uint64)
    for skip in (0, 1, 128) if split == 0 else ((1 << split) - 1, (1 << split) - 1 << 5):
        if split == 0 and skip:
            continue
        mask = np.full(200, skip)
        keys = [{(r, k) for r, k in zip(*map(list, minhash.chunk_keys(x, mask, none, errors)[:2]))} for x in (a, b)]
        met = {r for r, _ in keys[0] & keys[1]}
        outside = [c for c in range(minhash.POSITIONS) if not skip >> (c // minhash.PER_CHUNK) & 1]
        assert met >= {i for i in range(200) if (a[i, outside] != b[i, outside]).sum() <= minhash.MOST_APART}


@pytest.mark.parametrize("top", [1, 40])  # members of the largest component: none large, one large
def test_split_and_dealt_pairs_equal_direct_ones(spark, top):
    """Pairs of a hot key: the same whichever way they meet, and none farther apart or of one component."""
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 16, minhash.POSITIONS).astype(np.uint16)
    sig = np.tile(centre, (90, 1))
    for i in range(90):
        at = 4 + rng.choice(28, rng.integers(2, 14), replace=False)
        sig[i, at] = rng.integers(0, 1 << 16, len(at))
    name = lambda i: i.to_bytes(16, "big")
    longs = np.ascontiguousarray(sig).view(np.int64)
    fine = rng.integers(0, 256, (1, minhash.MORE)).astype(np.uint8).repeat(90, 0)
    fine[::3, :20] = rng.integers(0, 256, fine[::3, :20].shape)
    longs = np.concatenate([longs, np.ascontiguousarray(fine).view(np.int64)], 1)
    maps = np.zeros((90, len(minhash.MAP)), np.int64)
    maps[::7, 0] = -1  # 64 bits: more than two sets of 100 may differ in
    longs = np.concatenate([longs, maps], 1)
    classes = spark.createDataFrame([(name(i), 100, *map(int, x)) for i, x in enumerate(longs)], "id binary, n long, " + ", ".join(f"{s} long" for s in minhash.ALL))
    p = spark.createDataFrame([(5, 1, 0, name(i), name(i)) if i >= top else (5, 1, 0, name(i), name(0)) for i in range(90)],
                              "key long, used int, out int, id binary, component binary")
    want = {(i, j) for i, j in combinations(range(90), 2) if not (i < top and j < top) and (sig[i] != sig[j]).sum() <= minhash.MOST_APART
            and (i % 7 == 0) == (j % 7 == 0) and (sig[i] != sig[j]).sum() + (fine[i] != fine[j]).sum() <= minhash.ALL_APART}
    assert len(want) > 50
    for few, splits, run in ((200, 2, 4096), (200, 2, 5), (10, 1, 5), (10, 0, 5)):
        out = minhash.pairs_apart(p, classes, minhash.LEAST, few, splits, run).distinct().collect()
        assert {(int.from_bytes(r["a"], "big"), int.from_bytes(r["b"], "big")) for r in out} == want


def test_similar_sets_are_within_the_distance():
    """Sets of similarity 0.85 to 1: none beyond the distance in 4,000 pairs."""
    rng = np.random.default_rng(11)
    for n in (20, 100, 700):
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            pairs = []
            for _ in range(70):
                y = x.copy()
                k = int(rng.integers(0, max(1, int(n * 0.081))))  # k changed members of n: similarity (n - k) / (n + k)
                y[rng.choice(len(x), k, replace=False)] = rng.integers(0, 1 << 63, k).astype(np.uint64)
                pairs.append(np.unique(y))
            _, sig, fine = minhash.signatures([x, *pairs])
            apart = (sig[1:] != sig[0]).sum(axis=1)
            assert (apart <= minhash.MOST_APART).all() and (apart + (fine[1:] != fine[0]).sum(axis=1) <= minhash.ALL_APART).all()


def test_every_pair_leaves_one_key():
    rng = np.random.default_rng(2)
    for apart in (0, 1, 5, 12, 15):
        a, b = random_pairs(rng, 60, apart)
        shared = 0
        for c in range(minhash.CHUNKS):
            for out in range(minhash.PER_CHUNK):
                stay = [c * minhash.PER_CHUNK + i for i in range(minhash.PER_CHUNK) if i != out]
                shared = shared + (minhash._first_key(a != b, c, out) & (a[:, stay] == b[:, stay]).all(axis=1)).astype(int)
        assert (shared == 1).all()
