"""Operator 13 against the two libraries on whole texts, and the fragments' algebra."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from trackscene.llm import align, queries

A_PATH, B_PATH = (queries.vocabulary(n) for n in (queries.JSON_VOCABULARY, queries.PIECE_VOCABULARY))


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def groups_of(libraries, text):
    """[(ids of a, ids of b)] of a whole text by the libraries; None if a token's bytes do not give the text back."""
    a, b = libraries
    if not text:
        return None
    alphabet = align.byte_alphabet()
    x = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    raw = (" " + text).encode()
    if b"".join(t for _, t in x) != raw or b"".join(t for _, t in y) != raw:
        return None
    ends = [set(np.cumsum([len(t) for _, t in z]).tolist()) for z in (x, y)]
    common = ends[0] & ends[1]
    out = [[[], []] for _ in common]
    for side, z in enumerate((x, y)):
        at = k = 0
        for i, t in z:
            out[k][side].append(i)
            at += len(t)
            k += at in common
    return out


def plain(libraries, rows):
    made = [groups_of(libraries, t) for _, t in rows]
    links = [Counter((x, y) for xs, ys in g or [] for x in xs for y in ys) for g in made]
    count = Counter(p for c in links for p in c)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (doc, _), g, c in zip(rows, made, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out.append((doc, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(c.values()),
                    sum(k for p, k in c.items() if count[p] == top[p[0]]), sum(k * count[p] for p, k in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def got(docs, **kw):
    out = align.aligned(docs, A_PATH, B_PATH, **kw)
    assert out.columns == align.RESULT
    return sorted((tuple(r) for r in out.collect()), key=str)


ODD = ["a  b", " lead", "trail ", "ﬁ ½ ｆｕｌｌ", "x\ty\nz", "▁u", "a ▁ b", "é é", "　x", "a b c", "</s> <s> <unk> <|endoftext|> <|endoftext|>", " ", "\n", "<0x41> x",
       "it's we'll 'tis  don't", "12345 67,89", "\U0001F642 \U0001F469‍\U0001F469 x", "日本語 の テキスト", "tab\t end", "a" * 300, "  ", "  x", "x ​ y", "\x00 \x01"]


def test_tables_texts_equal_the_libraries(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == plain(libraries, rows)


def test_odd_texts_ranges_and_rows(make, clashing, libraries, odd_rows):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(r[0], r[1]) for r in odd_rows]
    rows += [(100 + i, " ".join(rng.choice(ODD) for _ in range(rng.randrange(1, 60)))) for i in range(20)]
    want = plain(libraries, rows)
    assert got(clashing(make(rows))) == want
    assert got(make(rows), long_chars=60, range_bytes=25) == want  # 60: many documents in ranges, several levels of composing


def test_empty_table(make):
    assert got(make([])) == [] and got(make([(1, None), (2, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def whole_fragment(pair, text, size):
    f = None
    links = Counter()
    parts = []
    for _, lo, hi, part in align.ranges(pair, " " + text, size):
        one, more = align.range_fragment(pair, part, lo, hi)
        links.update(more.tolist())
        parts.append(one)
    return parts, links


@pytest.mark.parametrize("size", [1, 2, 3, 7, 16, 100, 10**6])
def test_fragments_of_ranges_compose_to_the_whole(libraries, size):
    pair = align.Pair.load(A_PATH, B_PATH)
    rng = random.Random(size)
    for text in [*ODD, " ".join(rng.choice(ODD[8:]) for _ in range(40)), "Donaudampfschifffahrtsgesellschaftskapitän " * 9]:
        parts, links = whole_fragment(pair, text, size)
        g = groups_of(libraries, text)
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode() if g else b""
        for _ in range(3):  # any way of bracketing
            rest = list(parts)
            while len(rest) > 1:
                k = rng.randrange(len(rest) - 1)
                rest[k:k + 2] = [rest[k] + rest[k + 1]]
            w = (align.Fragment() + rest[0] + align.Fragment()).whole()
            assert w.closed[:-1] == want
            if g:
                assert links + Counter(w.pairs) == Counter(x << align.B_BITS | y for xs, ys in g for x in xs for y in ys)
                assert w.n == (sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(len(x) * len(y) for x, y in g))


def test_fragments_may_have_no_common_end():
    f = [align.Fragment(True, False, ((i,), ())) for i in range(3)] + [align.Fragment(True, True, ((9,), (4, 5)))]
    left, right = (f[0] + f[1]) + (f[2] + f[3]), f[0] + (f[1] + (f[2] + f[3]))
    assert left.whole().closed == right.whole().closed == b"0,1,2,9|4,5;"
    assert not align.Fragment(False).__add__(f[3]).whole().closed
