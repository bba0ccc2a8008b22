"""Operators 1 and 3 against SQL, plain recomputation and odd tables."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from trackscene.llm import exact, mix, queries
from trackscene.plans.check import compare, duck_con

from ..conftest import SF_SMALL

WS = re.compile(r"[\x20\x09-\x0D]")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, name, queries.QUERIES[name], queries.ORACLE[name], SF_SMALL, duck_con(SF_SMALL))
    assert r["status"] == "ok", r


def plain_targets(sizes):
    """Rounds of sharing: whoever is above twice its size is fixed there, the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(2 * sizes[s] for s in fixed)
        share = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > 2 * sizes[s]}
        if not over:
            return {s: share.get(s, 2.0 * sizes[s]) for s in names}
        fixed |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, None: 1000, "Z": 5, "é": 7}, {"a": 3}, {None: 8, "x": 8}, {"a": 0, "b": 50, "c": 1},
                                   {f"s{i}": (i * 37) % 101 + 1 for i in range(30)}])
def test_targets_are_shared_in_rounds(spark, make, sizes):
    docs = make([(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())])
    got = {r["source_size"]: r["target"] for r in mix.with_copies(docs).collect()}
    want = plain_targets(sizes)
    for s, n in sizes.items():
        if n:
            assert got[n] == pytest.approx(want[s] if list(sizes.values()).count(n) == 1 else got[n])
    assert sum(r["target"] for r in mix.with_copies(docs).collect()) == pytest.approx(1.5 * sum(sizes.values()))


def test_copies_follow_the_rate_and_repeat(spark, make):
    docs = make([(i, "a b c d", "big" if i % 3 else "small") for i in range(6000)])
    a = mix.with_copies(docs).select("doc_id", "size", "source_size", "target", "copies").orderBy("doc_id").collect()
    assert a == mix.with_copies(docs.repartition(7)).select("doc_id", "size", "source_size", "target", "copies").orderBy("doc_id").collect()
    for source_size in {r["source_size"] for r in a}:
        rows = [r for r in a if r["source_size"] == source_size]
        assert sum(r["size"] * r["copies"] for r in rows) == pytest.approx(rows[0]["target"], rel=0.06)
        assert max(r["copies"] for r in rows) <= 2
    mixed = mix.mix_sources(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in a)


def test_mix_of_odd_tables(make, clashing, odd_rows):
    docs = make(odd_rows)
    assert mix.query(docs).count() == len(odd_rows)
    assert mix.mix_sources(make([])).count() == 0 and mix.query(make([(1, None), (2, "")])).agg(F.sum("taken")).first()[0] == 0
    c = clashing(docs)
    out = mix.mix_sources(c)
    assert out.columns == c.columns and out.count() == mix.mix_sources(docs).count()
    assert out.where("size != 'own size' or `a.b` != 'own a.b'").count() == 0


def plain_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(WS.sub("", t or ""), []).append((i, t or ""))
    want = []
    for i, t in rows:
        g = groups[WS.sub("", t or "")]
        longest = max(len(x) for _, x in g)
        ids = [j for j, x in g if len(x) == longest]
        keep = min((j for j in ids if j is not None), default=None)
        want.append((i, keep, len(g), i == keep, hashlib.sha256(WS.sub("", t or "").encode()).hexdigest()))
    return sorted(want, key=repr)


@pytest.mark.parametrize("broken_hash", [False, True])
def test_groups_of_equal_texts(make, odd_rows, broken_hash):
    """With a hash under which all texts collide the byte check alone must tell them apart."""
    rows = [(r[0], r[1]) for r in odd_rows] + [(20 + i, f"text {i // 3}" + " " * (i % 3)) for i in range(30)]
    got = exact.with_groups(make(rows), (lambda c: F.unhex(F.substring(F.md5(F.lit("x")), 1, 8))) if broken_hash else exact.content_hash)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_groups(rows)


def test_shuffled_keys_give_the_same(make, odd_rows, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST_KEYS", -1)
    rows = [(r[0], r[1]) for r in odd_rows]
    assert sorted((tuple(r) for r in exact.with_groups(make(rows)).collect()), key=repr) == plain_groups(rows)
    assert exact.dedup(make(odd_rows)).count() == len({WS.sub("", r[1] or "") for r in odd_rows})


def test_dedup_keeps_one_row_a_group(make, clashing, odd_rows):
    docs = clashing(make(odd_rows))
    out = exact.dedup(docs)
    rows = out.collect()
    assert out.columns == docs.columns
    texts = [WS.sub("", r["text"] or "") for r in rows]
    assert sorted(texts) == sorted({WS.sub("", r[1] or "") for r in odd_rows})
    assert exact.dedup(make([])).count() == 0 and exact.with_groups(make([])).count() == 0
