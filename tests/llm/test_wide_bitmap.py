"""Pairs of large sets are told apart by wide bitmaps before the sets themselves move."""
import random

import numpy as np
import pytest

from trackscene.llm import ngram
from trackscene.llm.common import mix64


def _set(r, n):
    return np.unique(mix64(np.array(r.sample(range(1, 1 << 40), n), np.uint64)))


@pytest.mark.parametrize("seed", range(3))
def test_similar_sets_always_pass(seed):
    r = random.Random(seed)
    for n in (513, 600, 1023, 1024, 1025, 1300, 2049, 5000):
        x = _set(r, n)
        for keep in (0.82, 0.9, 0.95, 1.0):
            kept = np.sort(r.sample(x.tolist(), int(len(x) * keep)))
            y = np.unique(np.concatenate([np.array(kept, np.uint64), _set(r, r.randrange(1, 80))]))
            if ngram.wide_parity(y) is not None and ngram.jaccard_links(x, y, (80, 100)):
                assert ngram.wide_allows(ngram.wide_parity(x), ngram.wide_parity(y), len(x) + len(y), (80, 100))
                assert ngram.wide_allows(ngram.wide_parity(y), ngram.wide_parity(x), len(x) + len(y), (80, 100))
        z = _set(r, n)
        assert not ngram.wide_allows(ngram.wide_parity(x), ngram.wide_parity(z), len(x) + len(z), (80, 100))
    assert ngram.wide_parity(x[:512]) is None


def test_sets_of_long_texts_far_enough_apart_do_not_move(spark, make, monkeypatch):
    """Pairs of long texts at a similarity of 0.69 met on their whole sets, as 512 bits cannot tell them apart."""
    r = random.Random(5)
    words = lambda n: " ".join(f"w{r.randrange(10 ** 9)}" for _ in range(n))
    texts = []
    for _ in range(10):
        base = words(1640)
        texts += [base + " " + words(360), base + " " + words(360)]
    texts.append(texts[0] + " " + words(100))
    moved = []
    table = ngram.set_table
    monkeypatch.setattr(ngram, "set_table", lambda *a: moved.append(table(*a)) or moved[-1])
    got = {x["doc_id"]: x["component_id"] for x in ngram.near_copies(make(list(enumerate(texts)))).collect()}
    assert got == {i: 0 if i == 20 else i for i in range(21)}
    assert sum(m.count() for m in moved) <= 8
