"""Operators 2 and 10 against brute force, and odd tables."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackscene.llm import components, ngram, substring

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(t):
    w = WORD.findall(lower(t or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def plain_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(s), low.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=repr)


def family(r, n, words, edits):
    """Texts each made from the one before or from the first by a few edits: stars and chains."""
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [r.choice(vocabulary) for _ in range(words)]
    out = [base]
    for _ in range(n - 1):
        t = list(out[0] if r.random() < 0.5 else out[-1])
        for _ in range(r.randint(0, edits)):
            k = r.randrange(len(t))
            t[k:k + r.randint(0, 1)] = [r.choice(vocabulary)]
        out.append(t)
    return [" ".join(t) for t in out]


def mixed_texts(seed):
    r = random.Random(seed)
    texts = [t for _ in range(6) for t in family(r, 25, r.choice([6, 30, 80, 200]), 4)]
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} {' '.join(f'x{k}y{i}' for i in range(r.randint(0, 30)))}" for k in range(30)]
    texts += ["a b c d", "A b C d", "a b c", "", " ", "a b c d e", "a b c d e f"] + texts[:10]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("frequent", [False, True])
def test_components_equal_brute_force(make, monkeypatch, seed, frequent):
    """Also with every posting taking the way of the very frequent ones."""
    if frequent:
        monkeypatch.setattr(ngram, "frequent_count", lambda slots: 0)
    rows = [(i * 3, t) for i, t in enumerate(mixed_texts(seed))]
    got = ngram.near_copies(make(rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_components(rows)


def test_similarity_at_the_threshold():
    x, y = np.arange(0, 90, dtype=np.uint64), np.arange(10, 100, dtype=np.uint64)
    assert ngram.jaccard_links(x, y, (80, 100)) and not ngram.jaccard_links(x[:-1], y, (80, 100))


def test_near_copies_of_odd_tables(make, clashing, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = ngram.near_copies(clashing(make(rows)))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_components(rows)
    assert ngram.near_copies(make([])).count() == 0
    assert ngram.near_copies(make([(1, None), (2, "")])).count() == 2


def test_one_of_each_component_stays(make, clashing, odd_rows, monkeypatch):
    rows = [(i, t) for i, t in enumerate(mixed_texts(5))]
    want = sorted(i for i, _, c in plain_components(rows) if i == c)
    docs = clashing(make(rows))
    out = ngram.keep_one(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == want
    monkeypatch.setattr(ngram, "BROADCAST_IDS", -1)
    assert sorted(r["doc_id"] for r in ngram.keep_one(make(rows)).collect()) == want
    # repeated and null ids: one row of each component, all rows without words
    odd = ngram.keep_one(clashing(make(odd_rows)))
    kept = odd.collect()
    assert sorted(len(shingles(r["text"])) for r in kept) == sorted([0, 0, 0, 0, *[len(s) for s in {frozenset(shingles(r[1])) for r in odd_rows} if s]])
    assert odd.columns == clashing(make(odd_rows)).columns


def test_connected_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 200 + i) for i in range(1, 40)] + [(r.randrange(300, 500), r.randrange(300, 500)) for _ in range(150)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == {x: find(x) for x in list(root) if any(a != b and x in (a, b) for a, b in edges)}


# ------------------------------------------------------------------ operator 2
def plain_chunks(raw):
    """Byte by byte: a gear hash of the last bytes, cut where it is low."""
    out, start = [], 0
    for i in range(len(raw)):
        h = 0
        for b in raw[max(0, i + 1 - substring.WINDOW):i + 1]:
            h = ((h << 1) + int(substring.GEAR[b])) & 0xFFFFFFFF
        if i + 1 >= substring.WINDOW and h < (1 << 32) // substring.MEAN or i + 1 == len(raw):
            for a in range(start, i + 1, substring.MOST):
                out.append((a, min(a + substring.MOST, i + 1)))
            start = i + 1
    return out


def plain_spans(rows, least):
    seen, spans = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw, run = (t or "").encode(), None
        for a, b in [*plain_chunks(raw), (None, None)]:
            known = a is not None and raw[a:b] in seen
            if a is not None:
                seen.add(raw[a:b])
            if known:
                run = (run[0] if run else a, b)
            elif run:
                if run[1] - run[0] >= least:
                    spans.append((i, run[0], run[1] - run[0]))
                run = None
    return sorted(spans)


def passages(seed):
    r = random.Random(seed)
    text = lambda n: " ".join("".join(r.choice("abcdefghéö") for _ in range(r.randint(2, 9))) for _ in range(n))
    shared = [text(60) for _ in range(4)]
    rows = [(i, " ".join([text(r.randint(0, 80)), *([r.choice(shared)] if r.random() < 0.5 else []), text(r.randint(0, 80))])) for i in range(60)]
    return rows + [(60, rows[3][1]), (61, None), (62, ""), (63, "aaaa" * 200), (64, "short")]


def test_chunks_follow_the_gear_hash():
    raw = [(t or "").encode() for _, t in passages(9)]
    off = np.cumsum([0, *map(len, raw)])
    s, e = substring.cuts(np.frombuffer(b"".join(raw), np.uint8), off)
    want = [(o + a, o + b) for x, o in zip(raw, off) for a, b in plain_chunks(x)]
    assert list(zip(s.tolist(), e.tolist())) == want


@pytest.mark.parametrize("batch", [1 << 23, 1])
def test_spans_equal_brute_force(make, monkeypatch, batch):
    monkeypatch.setattr(substring, "BATCH_BYTES", batch)
    rows = passages(1)
    got = substring.repeated_spans(make(rows).repartition(5))
    assert sorted((r["doc_id"], r["start"], r["size"]) for r in got.collect()) == plain_spans(rows, substring.LEAST_RUN)
    assert got.where("first_doc > doc_id").count() == 0


def test_passages_of_fifty_words_are_found(make):
    """A passage of 51 words in other surroundings is found in all places but the first, whatever lies around it."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8)))
    hits = 0
    for k in range(100):
        p = " ".join(word() for _ in range(51))
        hits += bool(plain_spans([(0, p), (1, f"{word()} {word()} {p} {word()}")], substring.LEAST_RUN))
    assert hits >= 99
    clean = [(i, " ".join(word() for _ in range(100))) for i in range(200)]
    assert substring.repeated_spans(make(clean)).count() == 0


def plain_anchors(raw):
    h = [int(substring.span_hashes(substring.BYTE_CODE[np.frombuffer(raw[i:i + substring.LEAST_RUN], np.uint8)], np.array([0]), np.array([substring.LEAST_RUN]))[0])
         for i in range(len(raw) - substring.LEAST_RUN + 1)]
    got = {0, len(h) - 1} if h else set()
    for i in range(len(h) - substring.REACH + 1):
        got |= {j for j in range(i, i + substring.REACH) if h[j] == min(h[i:i + substring.REACH])}
    return sorted(got)


def test_anchors_are_the_least_of_their_neighbours():
    with np.errstate(over="ignore"):
        raw = [(t or "").encode() for _, t in passages(9)[:20]] + [b"", b"y" * 111, b"z" * 112, b"ab" * 90, b"w" * 150, b"v" * 151, b"x"]
        off = np.cumsum([0, *map(len, raw)])
        s, e = substring.anchors(np.frombuffer(b"".join(raw), np.uint8), off)
        assert s.tolist() == [o + i for x, o in zip(raw, off) for i in plain_anchors(x)] and (e - s == substring.LEAST_RUN).all()
        assert not len(substring.anchors(np.zeros(0, np.uint8), np.array([0]))[0])


def test_every_passage_of_the_documents_is_found(spark, make):
    """Passages of 51 words of the given documents, each in two surroundings: all of LEAST_RUN + REACH - 1 bytes are reported."""
    texts = [r["text"].split() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("size(split(text, ' ')) > 200").orderBy("doc_id").collect()]
    r = random.Random(8)
    word = lambda: "".join(r.choice("0123456789") for _ in range(r.randint(3, 8)))
    rows, places = [], {}
    for k in range(600):
        w = r.choice(texts)
        at = r.randrange(len(w) - 51)
        p = f"<{k}> " + " ".join(w[at:at + 51])
        a, b, c, d = (" ".join(word() for _ in range(20)) for _ in range(4))
        rows += [(2 * k, f"{a} {p} {b}"), (2 * k + 1, f"{c} {p} {d}")]
        places[2 * k + 1] = (len(c) + 1, len(c) + 1 + len(p.encode()))
    got = {}
    for x in substring.query(make(rows)).collect():
        got.setdefault(x["doc_id"], []).append((x["start"], x["start"] + x["size"]))
    least = substring.LEAST_RUN + substring.REACH - 1
    wanted = {i: (a, b) for i, (a, b) in places.items() if b - a >= least}
    assert len(wanted) > 590
    for i, (a, b) in wanted.items():
        assert sum(max(0, min(y, b) - max(x, a)) for x, y in got.get(i, [])) >= b - a - 2 * (substring.REACH - 1)


def test_removed_text(make, clashing):
    rows = passages(2)
    docs = clashing(make(rows))
    out = substring.remove_repeats(docs)
    assert out.columns == docs.columns
    spans = plain_spans(rows, substring.LEAST_RUN)
    for r in out.collect():
        raw = (dict(rows)[r["doc_id"]] or "").encode()
        cut = sorted((a, n) for i, a, n in spans if i == r["doc_id"])
        at, parts = 0, []
        for a, n in cut:
            parts.append(raw[at:a].decode(errors="ignore"))
            at = a + n
        assert (r["text"] or "") == "".join([*parts, raw[at:].decode(errors="ignore")])
    assert substring.remove_repeats(make([])).count() == 0
    assert substring.repeated_spans(make([(None, "x" * 500), (None, "x" * 500), (1, None)])).select(F.min("doc_id")).first()[0] == -1


def test_rows_of_one_id_are_told_apart(make, clashing):
    """A copy stays of texts under null or repeated ids, and no row loses the bytes of another's spans."""
    r = random.Random(6)
    text = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    shared, clean, other = text(), text(), text()
    docs = clashing(make([(None, shared), (None, shared), (None, clean), (7, shared + " " + other), (7, other), (8, text()), (9, None), (9, None), (None, None)]))
    out = substring.remove_repeats(docs)
    assert out.columns == docs.columns
    got = [(x["doc_id"], x["text"]) for x in out.collect()]
    assert len(got) == 7 and (None, clean) in got and got.count((9, None)) == got.count((None, None)) == 1
    whole = "\n".join(t for _, t in got if t)
    assert shared in whole and other in whole and len(whole) < len(shared) + 3 * len(clean) + 260
