"""Operator 12 on keys of very many members: cells by size and tiles, hubs in the middle of a group."""
import random
from itertools import combinations

import numpy as np
import pytest
from trackscene.llm import minhash

from .test_minhash import family, got, plain

KINDS = "id binary, n long, " + ", ".join(f"{s} long" for s in minhash.ALL)
POSTED = "key long, used int, out int, id binary, component binary"


def name(i):
    return i.to_bytes(16, "big")


def number(x):
    return int.from_bytes(x, "big")


@pytest.mark.parametrize("least,run", [((85, 100), 1000), ((85, 100), 9), ((50, 100), 9), ((100, 100), 9)])
def test_pairs_of_like_size_meet_in_one_cell(spark, least, run):
    sizes = [1, 1, 2, 16, 17, 18, 19, 20, 20, 23, 24, 34, 40, 85, 86, 100, 100, 117, 118, 1000, 850, 849, 723, 722] + list(range(30, 70, 2))
    rows = [(k, 1, 0, name(i), name(i), n) for k in (5, 6) for i, n in enumerate(sizes)]
    cells = {}
    for r in minhash._cells(spark.createDataFrame(rows, POSTED + ", n long"), least, run).collect():
        cells.setdefault(r["cell"], []).append((number(r["id"]), r["side"], r["guest"]))
    met = {}
    for members in cells.values():
        for (x, s, g), (y, t, h) in combinations(members, 2):
            if not (g and h) and (s == t == 0 or {s, t} == {1, 2}):
                pair = min(x, y), max(x, y)
                met[pair] = met.get(pair, 0) + 1
    like = {(i, j) for i, j in combinations(range(len(sizes)), 2) if min(sizes[i], sizes[j]) * least[1] >= max(sizes[i], sizes[j]) * least[0]}
    assert like <= set(met)
    assert set(met.values()) == {2}  # once in each of the two keys
    assert run > 100 or max(map(len, cells.values())) <= 3 * run


def test_a_large_key_of_unlike_sets_is_not_joined_pair_by_pair(spark, monkeypatch):
    """Members that agree in half of the positions, as texts with one common passage do: Spark joins none of their pairs."""
    rng = np.random.default_rng(9)
    m = 120
    sig = np.tile(rng.integers(0, 1 << 16, minhash.POSITIONS).astype(np.uint16), (m, 1))
    at = [c * minhash.PER_CHUNK + i for c in range(1, minhash.CHUNKS) for i in (0, 1)]
    sig[:, at] = rng.integers(0, 1 << 16, (m, len(at)))
    fine, maps = np.zeros((m, minhash.MORE // 8), np.int64), rng.integers(-1 << 63, 1 << 63, (m, len(minhash.MAP)))
    maps[::10] = maps[0]  # like sets
    n = [100 if i % 10 == 0 else 100 + i % 16 for i in range(m)]
    longs = np.concatenate([np.ascontiguousarray(sig).view(np.int64), fine, maps], 1)
    classes = spark.createDataFrame([(name(i), n[i], *map(int, x)) for i, x in enumerate(longs)], KINDS)
    p = spark.createDataFrame([(5, 1, 0, name(i), name(i)) for i in range(m)], POSTED)
    joined, within = [], minhash.within

    def counted(pairs, least):
        joined.append(pairs.count())
        return within(pairs, least)

    monkeypatch.setattr(minhash, "within", counted)
    out = minhash.pairs_apart(p, classes, minhash.LEAST, few=10, run=30).collect()
    want = {(i, j) for i, j in combinations(range(0, m, 10), 2) if (sig[i] != sig[j]).sum() <= minhash.MOST_APART}
    assert len(want) > 50 and sorted((number(r["a"]), number(r["b"])) for r in out) == sorted(want)
    assert sum(joined) == 0


def test_a_group_meets_its_centre_first(make, spark, monkeypatch):
    """Copies near to one text and not to each other are linked by the first pairs that are verified."""
    rng = random.Random(4)
    rows = list(enumerate(family(rng, 200, [0] + [5] * 40)))
    rng.shuffle(rows)
    linked, verified = [], minhash.verified

    def counted(*args):
        out = verified(*args)
        linked.append(out.where("linked").count())
        return out

    monkeypatch.setattr(minhash, "verified", counted)
    assert got(make(rows)) == plain(rows)
    assert linked[0] >= 36
