"""Operators 4 and 6 against the libraries, and round trips."""
import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from trackscene.llm import bpe, pretoken, tokenio

from ..conftest import SF_SMALL

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ALPHABET = "aabs tdrevlmTHE''' \n\t  .,!12½é你² 　\x1c\x85\x00Ⅷ́<|endoftext|>🙂"


def random_texts(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def tiktoken_model():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_matches_of_the_pattern():
    pattern = regex.compile(P.PATTERN)
    texts = random_texts(3000)
    cp = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    want = [o + m.start() for t, o in zip(texts, off) for m in pattern.finditer(t)]
    assert np.flatnonzero(pretoken.match_starts(cp, off[:-1])).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_replay_equals_the_library(text):
    import tiktoken  # noqa: F401
    m = bpe.MergeModel.load(RANKS)
    ids, _ = m.words.ids(text, np.array([len(text)]))
    assert m.decode(ids)[0].tobytes() == text.encode()


def test_ids_equal_the_library(tiktoken_model):
    texts = random_texts(2000, 1) + ["a" * 300, "ab" * 200, "= " * 100, "\n" * 50, "0" * 77]
    m = bpe.MergeModel.load(RANKS)
    ids, off = m.words.ids("".join(texts), np.array([len(t) for t in texts]))
    for t, a, b in zip(texts, off[:-1], off[1:]):
        assert ids[a:b].tolist() == tiktoken_model.encode_ordinary(t)


def test_a_full_store_changes_nothing(tiktoken_model):
    m = bpe.MergeModel.load(RANKS)
    small = pretoken.WordIds(m.words.encode, keep=3)
    for t in random_texts(50, 2):
        assert small.ids(t, np.array([len(t)]))[0].tolist() == tiktoken_model.encode_ordinary(t)


def test_op6_against_the_library(spark, tiktoken_model):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = bpe.query(docs, RANKS).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(tiktoken_model.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_encode_decode_columns(make, clashing, odd_rows):
    docs = clashing(make(odd_rows))
    out = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert out.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded"]
    for r in out.collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and r["size"] == "own size"
    assert bpe.encode(make([]), RANKS).count() == 0


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 24, 31])
def test_packing(width):
    r = random.Random(width)
    ids = np.array([r.getrandbits(width) for _ in range(1001)], np.uint64)
    raw = tokenio.pack(ids, width)
    assert len(raw) == -(-1001 * width // 8)
    assert (tokenio.unpack(raw, width, 0, 1001) == ids).all()
    for a, n in ((0, 0), (5, 1), (77, 300), (1000, 1)):
        assert (tokenio.unpack(raw, width, a, n) == ids[a:a + n]).all()


def plain_tokens(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    out, start = [], 0
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_op4_against_the_library(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = tokenio.query(docs.repartition(5), JSON)
    assert sorted(tuple(r) for r in got.collect()) == plain_tokens(rows)


def test_token_files(spark, make, clashing, odd_rows, scratch):
    texts = random_texts(400, 3)
    rows = [(r[0], r[1]) for r in odd_rows if r[0] is not None and r[0] != 7] + [(100 + 3 * i, t) for i, t in enumerate(texts)]
    tokenio.write_tokens(clashing(make(rows)).repartition(6), f"{scratch}/t", JSON, shards=4, block_ids=500)
    got = tokenio.document_sums(spark, f"{scratch}/t").collect()
    ordered = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    assert sorted(tuple(r) for r in got) == sorted(plain_tokens(ordered))
    assert tokenio.read_blocks(spark, f"{scratch}/t").count() > 4
    one = tokenio.read_document(spark, f"{scratch}/t", 100 + 3 * 77)
    assert [len(one)] == [p[2] for p in plain_tokens([(0, texts[77])])] and one[-1] == 2
    assert tokenio.read_document(spark, f"{scratch}/t", 101) is None
    ids = {r["doc_id"]: r["ids"] for r in tokenio.read_tokens(spark, f"{scratch}/t").collect()}
    assert ids[100 + 3 * 77] == one.tolist()


def test_added_tokens_as_the_library_sees_them(spark, make, scratch):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(JSON)
    texts = ["a <|endoftext|> b", "plain text", "<|endoftext|>", "x<|endoftext|><|endoftext|>y  <|endoftext|>\n", "cut <|endof", "text|> off", None,
             "it's  <|endoftext|>  z", "<|endoftext|"]
    want, start = [], 0
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    tokenio.write_tokens(make(list(enumerate(texts))), f"{scratch}/a", JSON, shards=2)
    assert sorted(tuple(r) for r in tokenio.document_sums(spark, f"{scratch}/a").collect()) == want
    assert tokenio.read_document(spark, f"{scratch}/a", 0).tolist() == [64, 220, 50256, 275, 2]


def test_tokens_of_an_empty_table(spark, make, scratch):
    tokenio.write_tokens(make([]), f"{scratch}/e", JSON, shards=2)
    assert tokenio.document_sums(spark, f"{scratch}/e").count() == 0
    tokenio.write_tokens(make([(None, "x"), (1, "y")]), f"{scratch}/n", JSON, shards=2)
    assert sorted((r["doc_id"] is not None, r["start"]) for r in tokenio.document_sums(spark, f"{scratch}/n").collect()) == [(False, 0), (True, 2)]
