"""Cross-tokenizer alignment (operator 13): an associative monoid of fragments.

Two tokenizers cut the same bytes differently.  Where tokens of both end, a
group closes; tokens of one group are linked.  A fragment is what a byte range
of a document knows alone: an open prefix (tokens up to the first common end),
closed groups, and an open suffix (tokens after the last common end).  Two
neighbouring fragments compose to one, the left suffix and the right prefix
closing a group; the composition is associative, so the fragments of a very
long document are made by many tasks and met in a tree.

Tokens come from the two libraries by units.  A text is cut before each single
space between characters that are no white space; no token of either
vocabulary reaches over such a place (``Pair`` checks this), so a worker
encodes each distinct unit once.  A range of a document takes the units it
touches and counts the tokens that end inside it.

The corpus-wide count of an id pair is taken from batches: a batch of
documents sends each of its distinct pairs once, with the number of its
documents that hold it, and gets the count of the whole corpus back.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, shuffle_partitions, span_hashes, stash
from .pretoken import SPACE, char_classes, char_codes

#: Characters read at once, characters of a batch; documents above this many are dealt out in ranges; UTF-8 bytes of a range.
PIECE_CHARS, BATCH_CHARS, LONG_CHARS, RANGE_BYTES = 1 << 19, 3 << 20, 1 << 15, 1 << 13
#: Bits of an id of b in a pair, and of a pair below a row's number: vocabularies of up to 2**20 ids.
B_BITS, ROW_BITS = 20, 40
#: Fragments composed by one task at a time, and distinct units kept by a worker (it only saves work).
FAN, KEEP_UNITS = 8, 500_000
#: Distinct units given to the libraries as one text.
JOINED_UNITS = 2000

_PAIRS: dict[tuple[str, str], Pair] = {}


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: visible bytes stand for themselves, the others follow in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """The two tokenizers of a worker: ids of units, and the bytes of ids."""

    def __init__(self, json_path: str, model_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(json_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: A unit border is safe only if no piece has a space behind another character.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        top = max(len(self.a_bytes), len(self.b_bytes))
        self.digits = np.array([len(str(i)) for i in range(top)])
        self.decimal = np.zeros((top, self.digits.max() + 1), np.uint8)
        for i in range(top):
            s = str(i).encode()
            self.decimal[i, :len(s)] = np.frombuffer(s, np.uint8)
        none = np.zeros(0, np.int64)
        self.known, self.good = np.zeros(0, np.uint64), np.zeros(0, bool)  # units met, by hash in order
        self.ids = [Lists(none.astype(np.uint32), none, none) for _ in range(2)]

    @classmethod
    def load(cls, json_path: str, model_path: str) -> Pair:
        if (json_path, model_path) not in _PAIRS:
            _PAIRS[json_path, model_path] = cls(json_path, model_path)
        return _PAIRS[json_path, model_path]

    def unit_starts(self, cp: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which code points begin a unit; ``first`` has the position of each text's first code point."""
        start = np.zeros(len(cp) + 1, bool)
        if self.cuts and len(cp) > 2:
            shown = char_classes()[cp] != SPACE
            start[1:-2] = (cp[1:-1] == 0x20) & shown[:-2] & shown[2:]
            start[first[1:] - 1] = False  # the last character of a text has nothing behind it
        start[first] = True
        return start[:-1]

    def _encode(self, units: list[str]) -> tuple[list[bytes], list[bytes], list[bool]]:
        """(ids of a, ids of b, whether both give the bytes back) of each unit."""
        a: list[bytes] = [b""] * len(units)
        b: list[bytes] = [b""] * len(units)
        ok = [False] * len(units)
        plain = [i for i, u in enumerate(units) if u[0] == " " and len(u) > 1 and not u[1].isspace() and not u[-1].isspace()]
        alone = sorted(set(range(len(units))) - set(plain))
        # units that may follow one another are encoded together: a border between them is a unit border there too
        for k in range(0, len(plain) if self.cuts else 0, JOINED_UNITS):
            some = plain[k:k + JOINED_UNITS]
            end = np.cumsum([len(units[i].encode()) for i in some])
            text = "".join([units[i] for i in some])
            both = (self.a.encode(text, add_special_tokens=False).ids, self.a_bytes, self.a_size, a), (self.b.encode(text[1:]), self.b_bytes, self.b_size, b)
            for ids, of, size, out in both:
                at = np.searchsorted(np.cumsum(size[ids]), end)
                if b"".join([of[i] for i in ids]) != text.encode() or not (np.cumsum(size[ids])[at] == end).all():
                    alone += some
                    break
                raw, cut = np.array(ids, "<u4").tobytes(), [0, *((at + 1) * 4).tolist()]
                for i, s, e in zip(some, cut[:-1], cut[1:]):
                    out[i] = raw[s:e]
            else:
                for i in some:
                    ok[i] = True
        alone = alone if self.cuts else range(len(units))
        for i in alone:
            x, y, raw = self.a.encode(units[i], add_special_tokens=False).ids, self.b.encode(units[i][1:]), units[i].encode()
            a[i], b[i] = np.array(x, "<u4").tobytes(), np.array(y, "<u4").tobytes()
            ok[i] = b"".join([self.a_bytes[t] for t in x]) == raw == b"".join([self.b_bytes[t] for t in y])
        return a, b, ok

    def units(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place among the known units of each unit in order, which of the known are good, first unit of each text and the total)."""
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        off = np.concatenate([[0], np.cumsum(sizes)])
        at = np.flatnonzero(self.unit_starts(cp, off[:-1]))
        end = np.append(at[1:], len(cp))
        with np.errstate(over="ignore"):
            h, where, unit = np.unique(span_hashes(char_codes()[cp], at, end), return_index=True, return_inverse=True)
        if len(self.known) > KEEP_UNITS:  # what this text holds is kept, the rest goes
            self._keep(np.isin(self.known, h, assume_unique=True))
        new = np.flatnonzero(~np.isin(h, self.known, assume_unique=True))
        if len(new):
            a, b, ok = self._encode([text[s:e] for s, e in zip(at[where[new]].tolist(), end[where[new]].tolist())])
            order = np.argsort(np.concatenate([self.known, h[new]]), kind="stable")
            self.known = np.concatenate([self.known, h[new]])[order]
            self.good = np.concatenate([self.good, ok])[order]
            self.ids = [x.added(raw, order) for x, raw in zip(self.ids, (a, b))]
        return np.searchsorted(self.known, h)[unit], self.good, np.searchsorted(at, off)

    def _keep(self, some: np.ndarray) -> None:
        self.known, self.good = self.known[some], self.good[some]
        self.ids = [x.picked(np.flatnonzero(some)) for x in self.ids]

    def tokens(self, text: str, sizes: np.ndarray) -> Tokens:
        """The tokens of texts lying one after another in ``text`` (each with its leading space), ``sizes`` code points each."""
        unit, is_good, first = self.units(text, sizes)
        n = len(sizes)
        row = np.repeat(np.arange(n), np.diff(first))
        good = np.ones(n, bool)
        good[row[~is_good[unit]]] = False
        keep = good[row]
        unit, row = unit[keep], row[keep]
        (a, at_a), (b, at_b) = (x.spread(unit) for x in self.ids)
        return Tokens(self, n, good, a, np.repeat(row, at_a), b, np.repeat(row, at_b))


class Lists:
    """Many short lists of ids, one after another."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, begin: np.ndarray):
        self.flat, self.size, self.begin = flat, size, begin

    def added(self, raw: list[bytes], order: np.ndarray) -> Lists:
        size = np.array([len(x) // 4 for x in raw], np.int64)
        begin = len(self.flat) + np.cumsum(size) - size
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(raw), "<u4")])
        return Lists(flat, np.concatenate([self.size, size])[order], np.concatenate([self.begin, begin])[order])

    def spread(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the picked lists one after another, number of ids of each pick)."""
        per = self.size[pick]
        run = np.cumsum(per) - per
        return self.flat[np.repeat(self.begin[pick] - run, per) + np.arange(per.sum())].astype(np.int64), per

    def picked(self, pick: np.ndarray) -> Lists:
        flat, size = self.spread(pick)
        return Lists(flat.astype(np.uint32), size, np.cumsum(size) - size)


class Tokens:
    """Tokens ``a`` and ``b`` of rows lying one after another, aligned: their groups, links and group strings."""

    def __init__(self, pair: Pair, n: int, good: np.ndarray, a: np.ndarray, row_a: np.ndarray, b: np.ndarray, row_b: np.ndarray):
        self.pair, self.n, self.good, self.a, self.b, self.row_a, self.row_b = pair, n, good, a, b, row_a, row_b
        self.end_a, self.end_b = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        self.cut_a, self.cut_b = np.isin(self.end_a, self.end_b, assume_unique=True), np.isin(self.end_b, self.end_a, assume_unique=True)

    def align(self) -> None:
        """For rows whose last tokens end together: the group of every token, and the tokens of every group."""
        self.group_a, self.group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        groups = int(self.cut_a.sum())
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        self.row_group = self.row_a[self.cut_a]

    def counts(self) -> dict[str, np.ndarray]:
        per = lambda rows, weights=None: np.bincount(rows, weights, self.n).astype(np.int64)
        return {"n_a": per(self.row_a), "n_b": per(self.row_b), "n_groups": per(self.row_group), "n_links": per(self.row_group, self.in_a * self.in_b)}

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, id pair) of every link: id of a, then B_BITS of the id of b."""
        per = self.in_b[self.group_a]
        first_b = (np.cumsum(self.in_b) - self.in_b)[self.group_a]
        at = np.repeat(first_b - (np.cumsum(per) - per), per) + np.arange(per.sum())
        return np.repeat(self.row_a, per), np.repeat(self.a << B_BITS, per) | self.b[at]

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """(the groups of all rows as text, each closed by a semicolon; where each row begins and the total)."""
        total = len(self.a) + len(self.b)
        ids, sep, row = np.empty(total, np.int64), np.full(total, ord(","), np.uint8), np.empty(total, np.int64)
        place_a = np.arange(len(self.a)) + (np.cumsum(self.in_b) - self.in_b)[self.group_a]
        place_b = np.arange(len(self.b)) + np.cumsum(self.in_a)[self.group_b]
        ids[place_a], ids[place_b], row[place_a], row[place_b] = self.a, self.b, self.row_a, self.row_b
        sep[place_a[self.cut_a]], sep[place_b[self.cut_b]] = ord("|"), ord(";")
        digits = self.pair.digits[ids]
        text = self.pair.decimal[ids]
        text[np.arange(total), digits] = sep
        text = text.ravel()
        off = np.concatenate([[0], np.cumsum(digits + 1)])
        return text[text != 0], off[np.searchsorted(row, np.arange(self.n + 1))]


# ------------------------------------------------------------------ fragments
class Fragment:
    """What a byte range knows of its document: ``prefix`` and ``suffix`` are (ids of a, ids of b), ``closed`` the groups between."""

    __slots__ = ("ok", "cut", "prefix", "suffix", "closed", "n", "pairs")

    def __init__(self, ok=True, cut=False, prefix=((), ()), suffix=((), ()), closed=b"", n=(0, 0, 0, 0), pairs=()):
        """``cut``: whether a common end lies in the range; n: tokens of a and b, groups and links in ``closed``; ``pairs``: links made by composing."""
        self.ok, self.cut, self.prefix, self.suffix, self.closed, self.n, self.pairs = ok, cut, prefix, suffix, closed, n, tuple(pairs)

    def __add__(self, right: Fragment) -> Fragment:
        ok, met = self.ok and right.ok, lambda x, y: (tuple(x[0]) + tuple(y[0]), tuple(x[1]) + tuple(y[1]))
        pairs = self.pairs + right.pairs
        if not self.cut:  # the right one's first common end is the first of both
            return Fragment(ok, right.cut, met(self.prefix, right.prefix), right.suffix, right.closed, right.n, pairs)
        if not right.cut:
            return Fragment(ok, True, self.prefix, met(self.suffix, right.prefix), self.closed, self.n, pairs)
        text, n, more = closed_group(*met(self.suffix, right.prefix))
        return Fragment(ok, True, self.prefix, right.suffix, self.closed + text + right.closed, tuple(map(sum, zip(self.n, n, right.n))), pairs + more)

    def whole(self) -> Fragment:
        """Of a whole document: the prefix is a group, as nothing lies before it; its end is a common end."""
        if not self.ok or not self.cut:
            return Fragment(self.ok)
        text, n, more = closed_group(*self.prefix)
        return Fragment(True, True, ((), ()), ((), ()), text + self.closed, tuple(map(sum, zip(n, self.n))), self.pairs + more)


def closed_group(a, b) -> tuple[bytes, tuple[int, int, int, int], tuple[int, ...]]:
    text = f"{','.join(map(str, a))}|{','.join(map(str, b))};".encode()
    return text, (len(a), len(b), 1, len(a) * len(b)), tuple(int(x) << B_BITS | int(y) for x in a for y in b)


def range_fragment(pair: Pair, text: str, lo: int, hi: int) -> tuple[Fragment, np.ndarray]:
    """The fragment of the tokens of ``text`` that end in its bytes (lo, hi], and the links of its closed groups."""
    t = pair.tokens(text, np.array([len(text)]))
    none = np.zeros(0, np.int64)
    if not t.good[0]:
        return Fragment(False), none
    in_a, in_b = (t.end_a > lo) & (t.end_a <= hi), (t.end_b > lo) & (t.end_b <= hi)
    a, b, cut_a, cut_b = t.a[in_a], t.b[in_b], t.cut_a[in_a], t.cut_b[in_b]
    at_a, at_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
    if not len(at_a):
        return Fragment(True, False, (a.tolist(), b.tolist())), none
    fa, fb, la, lb = at_a[0] + 1, at_b[0] + 1, at_a[-1] + 1, at_b[-1] + 1
    mid_a, mid_b = a[fa:la], b[fb:lb]
    inner = Tokens(pair, 1, np.ones(1, bool), mid_a, np.zeros(len(mid_a), np.int64), mid_b, np.zeros(len(mid_b), np.int64))
    inner.align()
    c = inner.counts()
    closed = Fragment(True, True, (a[:fa].tolist(), b[:fb].tolist()), (a[la:].tolist(), b[lb:].tolist()), inner.strings()[0].tobytes(),
                      tuple(int(c[k][0]) for k in ("n_a", "n_b", "n_groups", "n_links")))
    return closed, inner.links()[1]


def ranges(pair: Pair, text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """(number, lo, hi, text of the units touched) of the byte ranges of ``text``; lo and hi count from that text's first byte.

    Borders lie every ``size`` bytes wherever that falls, but at most one in a
    unit, so a unit is read twice at most.
    """
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = np.flatnonzero(pair.unit_starts(cp, np.array([0])))
    width = 1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF)
    byte = np.concatenate([[0], np.cumsum(width)])
    begin = byte[at]
    border = np.arange(size, byte[-1], size)
    unit = np.searchsorted(begin, border, "right") - 1
    border = border[np.concatenate([[True], unit[1:] != unit[:-1]])] if len(border) else border
    cut = [0, *border.tolist(), int(byte[-1])]
    stop = np.append(at[1:], len(cp))
    for k, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):
        u, v = np.searchsorted(begin, lo, "right") - 1, np.searchsorted(begin, hi, "left") - 1
        yield k, int(lo - begin[u]), int(hi - begin[u]), text[at[u]:stop[v]]


# ------------------------------------------------------------------ Spark
DOCS = "doc_id long, batch long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int, steps binary, times binary"
TABLE = "pairs binary, docs binary"
RANGES = "seq int, lo int, hi int, text string"
FRAGMENT = ("key long, doc_id long, seq int, ok boolean, cut boolean, pa array<long>, pb array<long>, sa array<long>, sb array<long>, "
            "closed binary, n array<long>, more array<long>")


def narrow(x: np.ndarray) -> bytes:
    """Numbers in the fewest whole bytes that hold all of them (1, 2 or 4)."""
    top = int(x.max()) if len(x) else 0
    return x.astype("u1" if top < 256 else "<u2" if top < 65536 else "<u4").tobytes()


def widened(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, {1: "u1", 2: "<u2", 4: "<u4"}[len(raw) // n]).astype(np.int64)


def _few(batches: Iterator[pa.RecordBatch], rows: int = 200) -> Iterator[tuple[int | None, str | None]]:
    """The rows of two columns, few of them in Python at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            part = batch.slice(i, rows)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def read_batches(docs: DataFrame, json_path: str, model_path: str, long_chars: int = LONG_CHARS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One pass over the texts: a row per short document, a row per batch (its pair table), and a row per range of a long one.

    ``batch`` numbers the batch, and the document for ranges; the columns of the other kinds of rows are null.
    """
    kinds = arrow_schema(f"{DOCS}, {TABLE}, {RANGES}")

    def rows(n: int, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cols[k.name], k.type) if k.name in cols else pa.nulls(n, k.type) for k in kinds], names=kinds.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = Pair.load(json_path, model_path), TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[str] = []
        empty: list = []
        waiting: list = []
        held = size = 0

        def read():
            """Tokens, counts and group digests of the texts at hand; their distinct pairs wait for the batch to close."""
            t = pair.tokens("".join(texts), np.array([len(x) for x in texts]))
            t.align()
            raw, off = t.strings()
            raw, off = memoryview(raw), off.tolist()
            sha = [hashlib.sha256(raw[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(off[:-1], off[1:])]
            row, link = t.links()
            row <<= ROW_BITS
            row |= link
            both, times = np.unique(row, return_counts=True)
            cut = np.searchsorted(both >> ROW_BITS, np.arange(len(texts) + 1))
            waiting.append((list(ids), t.counts(), sha, both & ((1 << ROW_BITS) - 1), times, cut))

        def close(number):
            table, at = np.unique(np.concatenate([w[3] for w in waiting]), return_inverse=True)
            done = 0
            for doc, counts, sha, link, times, cut in waiting:
                mine = at[done:done + len(link)]
                done += len(link)
                steps = np.diff(mine, prepend=0)
                first = cut[:-1][cut[:-1] < cut[1:]]
                steps[first] = mine[first]  # the first pair of a document counts from 0
                spans = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
                yield rows(len(doc), doc_id=doc, batch=[number] * len(doc), **counts, groups_sha256=sha, n_pairs=np.diff(cut),
                           steps=[narrow(steps[s:e]) for s, e in spans], times=[narrow(times[s:e]) for s, e in spans])
            if len(table):
                yield rows(1, batch=[number], pairs=[table.astype("<i8").tobytes()], docs=[np.bincount(at, minlength=len(table)).astype("<u4").tobytes()])

        def tokenless(ids):
            zero = [0] * len(ids)
            return rows(len(ids), doc_id=ids, n_a=zero, n_b=zero, n_groups=zero, n_links=zero, groups_sha256=[""] * len(ids))

        for doc, text in _few(batches):
            if not text:
                empty.append(doc)
                if len(empty) == 1000:
                    yield tokenless(empty)
                    empty = []
            elif len(text) > long_chars:
                number += 1
                for k, lo, hi, part in ranges(pair, " " + text, range_bytes):
                    yield rows(1, doc_id=[doc], batch=[number], seq=[k], lo=[lo], hi=[hi], text=[part])
            else:
                ids.append(doc)
                texts.append(" " + text)
                held += len(text) + 32
                if held >= PIECE_CHARS:
                    read()
                    size += held
                    ids, texts, held = [], [], 0
                if size >= BATCH_CHARS:
                    number += 1
                    yield from close(number)
                    waiting, size = [], 0
        if empty:
            yield tokenless(empty)
        if texts:
            read()
        if waiting:
            yield from close(number + 1)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stash(d.mapInArrow(run, f"{DOCS}, {TABLE}, {RANGES}"))


def _fragment_row(key, doc, seq, f: Fragment) -> tuple:
    return (key, doc, seq, f.ok, f.cut, list(f.prefix[0]), list(f.prefix[1]), list(f.suffix[0]), list(f.suffix[1]), f.closed, list(f.n), list(f.pairs))


def _fragment_of(r: dict) -> Fragment:
    return Fragment(r["ok"], r["cut"], (tuple(r["pa"]), tuple(r["pb"])), (tuple(r["sa"]), tuple(r["sb"])), r["closed"], tuple(r["n"]), r["more"])


def long_documents(found: DataFrame, json_path: str, model_path: str) -> tuple[DataFrame, DataFrame] | None:
    """((key, doc_id, counts, groups_sha256), (key, pair, times)) of the documents dealt out in ranges; None if there is none.

    Each range is a fragment; fragments meet FAN at a time, level by level,
    until one is left of each document.
    """
    spark = found.sparkSession
    r = found.where("seq is not null").select(F.col("batch").alias("key"), "doc_id", "seq", "lo", "hi", "text")
    last = r.agg(F.max("seq")).first()[0]
    if last is None:
        return None
    made = FRAGMENT + ", pairs array<long>, times array<long>"
    arrow, plain = arrow_schema(made), arrow_schema(FRAGMENT)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair.load(json_path, model_path)
        for batch in batches:
            for x in (x for i in range(0, batch.num_rows, 50) for x in batch.slice(i, 50).to_pylist()):
                f, links = range_fragment(pair, x["text"], x["lo"], x["hi"])
                u, n = np.unique(links, return_counts=True)
                row = (*_fragment_row(x["key"], x["doc_id"], x["seq"], f), u.tolist(), n.tolist())
                yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, row))], arrow)

    ended = "key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, more array<long>"
    kind = arrow_schema(ended)

    def met(group: pa.Table) -> tuple[dict, Fragment]:
        got, whole = sorted(group.to_pylist(), key=lambda x: x["seq"]), Fragment()
        for x in got:
            whole = whole + _fragment_of(x)
        return got[0], whole

    def compose(group: pa.Table) -> pa.Table:
        first, f = met(group)
        return pa.Table.from_pylist([dict(zip(plain.names, _fragment_row(first["key"], first["doc_id"], first["seq"] // FAN, f)))], plain)

    def finish(group: pa.Table) -> pa.Table:
        first, f = met(group)
        w = f.whole()
        sha = hashlib.sha256(w.closed[:-1]).hexdigest() if w.closed else ""
        return pa.Table.from_pylist([dict(zip(kind.names, (first["key"], first["doc_id"], *w.n, sha, list(w.pairs))))], kind)

    f = stash(r.repartition(shuffle_partitions(spark), "key", "seq").mapInArrow(fragments, made))
    tree = f.select(*plain.names)
    while last >= FAN:
        tree = tree.groupBy("key", (F.col("seq") / FAN).cast("int")).applyInArrow(compose, FRAGMENT)
        last //= FAN
    done = stash(tree.groupBy("key").applyInArrow(finish, ended))  # at most FAN fragments of a document are left
    good = done.where("n_links > 0")
    pairs = (f.join(good.select("key"), "key", "left_semi").select("key", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("key", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
             .unionByName(good.select("key", F.explode("more").alias("pair"), F.lit(1).cast("long").alias("times"))))
    return done.drop("more"), stash(pairs.groupBy("key", "pair").agg(F.sum("times").alias("times")))


def requests(found: DataFrame) -> DataFrame:
    """(batch, pair, docs): each distinct pair of a batch, with how many of its documents hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, p, d in zip(*(c.to_pylist() for c in batch.columns)):
                p, d = np.frombuffer(p, "<i8"), np.frombuffer(d, "<u4").astype(np.int64)
                for s in range(0, len(p), 1 << 16):
                    part = p[s:s + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), number)), pa.array(part), pa.array(d[s:s + (1 << 16)])], names=["batch", "pair", "docs"])

    return found.where("pairs is not null").select("batch", "pairs", "docs").mapInArrow(run, "batch long, pair long, docs long")


RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned(docs: DataFrame, json_path: str, model_path: str, long_chars: int = LONG_CHARS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the columns of ``RESULT``.

    Tokenizer a reads a space and the text, b the text (its library adds the
    space); strings of special tokens are plain text.  Texts that are null,
    empty, or not given back byte for byte by both have no tokens: zeros and an
    empty ``groups_sha256``.  n_best and count_sum rest on the number of rows
    of the whole table that hold an id pair linked.  Repeated rows and ids
    count as rows of their own; an empty table gives no rows; other columns are
    not read.  Documents above ``long_chars`` are dealt out in ranges, which
    changes no result.
    """
    found = read_batches(docs, json_path, model_path, long_chars, range_bytes)
    long = long_documents(found, json_path, model_path)
    asked = stash(requests(found))
    held = asked.groupBy("pair").agg(F.sum("docs").alias("n"))
    if long:
        held = held.unionByName(long[1].groupBy("pair").agg(F.count("*").alias("n"))).groupBy("pair").agg(F.sum("n").alias("n"))
    held = stash(held.select("pair", "n", F.shiftright("pair", B_BITS).alias("a")))
    top = held.groupBy("a").agg(F.max("n").alias("top"))
    counts = stash(held.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    answers = asked.select("batch", "pair").join(counts, "pair").select("batch", "pair", "n", "best")
    short = found.where("n_links > 0").select("batch", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs", "steps", "times")
    out = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in RESULT)

    def answer(table: pa.Table, mine: pa.Table) -> pa.Table:  # a batch and its pair table, both of bounded size
        table = table.sort_by("pair")
        n, best = table.column("n").to_numpy(), table.column("best").to_numpy().astype(np.int64)
        good, total = [], []
        for k, s, t in zip(*(mine.column(c).to_pylist() for c in ("n_pairs", "steps", "times"))):
            at, times = np.cumsum(widened(s, k)), widened(t, k)
            good.append(int((best[at] * times).sum()))
            total.append(int((n[at] * times).sum()))
        return mine.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column("n_best", pa.array(good, pa.int64())).append_column(
            "count_sum", pa.array(total, pa.int64())).append_column("groups_sha256", mine.column("groups_sha256"))

    zero = F.lit(0).cast("long")
    parts = answers.groupBy("batch").cogroup(short.groupBy("batch")).applyInArrow(answer, out)
    parts = parts.unionByName(found.where("n_links = 0").select(*RESULT[:5], zero.alias("n_best"), zero.alias("count_sum"), F.lit("").alias("groups_sha256")))
    if long:
        done, pairs = long
        sums = pairs.join(counts, "pair").groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                                             F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        parts = parts.unionByName(done.join(sums, "key", "left").select(*[F.coalesce(c, zero).alias(c) if c in ("n_best", "count_sum") else c for c in RESULT]))
    return parts.select(*RESULT)


def query(docs: DataFrame, json_path: str, model_path: str) -> DataFrame:
    return aligned(docs, json_path, model_path)
