"""Pre-tokens in numpy: matches of the byte-level BPE pattern as spans over code points, and a task-wide store of their ids.

The pattern (``public_tokenizers.PATTERN``) cuts a text into contractions,
letter, number and other runs with one space before them, and white space.
``match_starts`` finds the same cuts for many texts at once from the class of
each code point; ``WordIds`` keeps the ids of the distinct matches a task has
met (bounded; it only saves work), so each is encoded once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from .common import U64, mix64, span_hashes

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Most UTF-8 bytes of text worked on at once, and most distinct matches kept by a worker.
PIECE_BYTES, KEEP_WORDS = 1 << 20, 600_000

_TABLES: dict[str, np.ndarray] = {}


def char_classes() -> np.ndarray:
    """The class of every code point, by the pattern's own character classes."""
    if "class" not in _TABLES:
        import regex
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
        every = points.astype("<u4").tobytes().decode("utf-32-le")  # without an object for each character
        got = np.full(len(points), OTHER, np.uint8)
        for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                got[m.start():m.end()] = kind
        table = np.full(0x110000, OTHER, np.uint8)
        table[points] = got
        _TABLES["class"] = table
        _TABLES["code"] = mix64(np.arange(1, 0x110001, dtype=U64) * U64(0xD1342543DE82EF95))
    return _TABLES["class"]


def char_codes() -> np.ndarray:
    char_classes()
    return _TABLES["code"]


def match_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which code points begin a match; ``first`` has the position of each text's first code point."""
    n = len(cp)
    if not n:
        return np.zeros(0, bool)
    kind = char_classes()[cp]
    begins = np.zeros(n + 3, bool)
    begins[first[first < n]] = True
    begins[n:] = True
    start = begins[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last of some white space before a text goes on: a blank joins what follows, another character stands alone
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:n])
    start[last] = True
    start[last[cp[last] == 0x20] + 1] = False
    # contractions
    quote = np.flatnonzero(start & (cp == 0x27))
    quote = quote[~begins[quote + 1]]
    if len(quote):
        pad = np.concatenate([cp, np.zeros(3, cp.dtype)])
        one, two = pad[quote + 1], np.where(begins[quote + 2], 0, pad[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e"))
                | (one == ord("l")) & (two == ord("l")))
        for hit, size in ((quote[short], 2), (quote[long], 3)):
            start[hit + 1] = False
            after = hit + size
            start[after[after < n]] = True
    return start


class WordIds:
    """Ids of distinct matches by their hash, made by ``encode(list of str) -> list of uint32 bytes`` when first met."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], keep: int = KEEP_WORDS):
        self.encode, self.keep = encode, keep
        self.known: dict[int, bytes] = {}  # met since the last change of generation
        self.older: dict[int, bytes] = {}  # met in the generation before

    def ids(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text) of texts lying one after another in ``text``, ``sizes`` code points each."""
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        off = np.concatenate([[0], np.cumsum(sizes)])
        at = np.flatnonzero(match_starts(cp, off[:-1]))
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        end = np.append(at[1:], len(cp))
        h, where, word = np.unique(span_hashes(char_codes()[cp], at, end), return_index=True, return_inverse=True)
        if len(self.known) > self.keep // 2:  # words that keep coming back stay, the others go
            self.known, self.older = {}, self.known
        known, older, keys, new = self.known, self.older, h.tolist(), []
        for i, k in enumerate(keys):
            if k not in known:
                if k in older:
                    known[k] = older[k]
                else:
                    new.append(i)
        if new:
            a, b = at[where[new]].tolist(), end[where[new]].tolist()
            for i, x in zip(new, self.encode([text[s:e] for s, e in zip(a, b)])):
                known[keys[i]] = x
        parts = [known[k] for k in keys]
        sizes_of = np.array([len(x) // 4 for x in parts], np.int64)
        flat = np.frombuffer(b"".join(parts), np.uint32)
        begin = np.cumsum(sizes_of) - sizes_of
        per = sizes_of[word]
        run = np.concatenate([[0], np.cumsum(per)])
        take = np.repeat(begin[word] - run[:-1], per) + np.arange(run[-1])
        return flat[take], run[np.searchsorted(at, off)]


def texts_in_pieces(col) -> Iterator[tuple[int, int, str, np.ndarray]]:
    """(first row, row after the last, joined text, code points of each) of an Arrow string column, null as empty."""
    texts = [t or "" for t in col.to_pylist()]
    a, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE_BYTES:
            yield a, i, "".join(texts[a:i]), np.array([len(x) for x in texts[a:i]], np.int64)
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts), "".join(texts[a:]), np.array([len(x) for x in texts[a:]], np.int64)
