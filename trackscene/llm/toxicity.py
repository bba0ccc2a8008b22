"""Toxicity by nearest labelled examples (operator 5): exact TF-IDF cosine over a block-max inverted index.

Fit: a bounded sample of the labelled rows gives the examples and the terms
that tell their labels apart (chi-square); terms are words and word beginnings.
The terms' document frequencies are counted over all documents.  Index: the
examples' unit vectors as postings per term, cut into blocks of examples, with
the largest weight of each block.  Score: a text visits blocks in falling
order of their bound and stops when no block can beat its k-th neighbour, so the
neighbours are exact.  Votes weigh by similarity, and a prior from the examples
without any term stands for what no neighbour says.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BYTE_CODE, U64, Spans, column, mix64, pack, pieces, stash, utf8
from .ngram import shingle_sets

#: The bound of the fit: at most so many examples of each label, and so many terms.
EXAMPLES, TERMS = 1000, 1024
#: Least chi-square of a term, and least number of examples that have it.
CHI_SQUARE, LEAST_DF = 20.0, 3
NEIGHBOURS, BLOCK, PRIOR_WEIGHT, THRESHOLD = 15, 128, 0.5, 0.7
#: Blocks that every text looks at first.
FIRST_BLOCKS = 4
BEGINNINGS = (4, 5, 6, 7, 8)
#: Numbers of occurrences that are terms of their own: a word that is common by chance tells little until it comes again.
LEVELS = np.array([1, 2, 3, 5])
KNOWN = np.dtype([("t", "<u8"), ("level", "<i8")])
PIECE_BYTES = 1 << 19

#: Bytes of words: ASCII letters (folded) and digits, and all of other characters.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_CODES = BYTE_CODE[_FOLD]


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term, row) of every word and every word's beginnings, of rows lying one after another."""
    inside = _WORD[data]
    begin = np.zeros(len(data) + 1, bool)
    begin[off] = True
    left = inside & (begin[:-1] | ~np.concatenate([[False], inside[:-1]]))
    right = inside & (begin[1:] | ~np.concatenate([inside[1:], [False]]))
    s, e = np.flatnonzero(left), np.flatnonzero(right) + 1
    if not len(s):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    spans = Spans(_CODES[data])
    row = np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(s, off)))
    got, rows = [spans.hash(s, e)], [row]
    for n in BEGINNINGS:
        k = e - s > n
        got.append(spans.hash(s[k], s[k] + n) + U64(n))
        rows.append(row[k])
    return np.concatenate(got), np.concatenate(rows)


class Lookup:
    """Which of the known (term, level) pairs a text has: the term at least ``level`` times. A bitmap turns most terms away."""

    def __init__(self, known: np.ndarray):
        self.bases, base = np.unique(known["t"], return_inverse=True)
        self.at = np.full((len(self.bases), len(LEVELS)), -1)
        self.at[base, np.searchsorted(LEVELS, known["level"])] = np.arange(len(known))
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(self.bases >> U64(46)).astype(np.int64)] = True

    def __call__(self, t: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, position among the known pairs), by row and position."""
        if not len(self.bases):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = self.maybe[(t >> U64(46)).astype(np.int64)]
        t, row = t[k], row[k]
        base = np.searchsorted(self.bases, t)
        base[base == len(self.bases)] = 0
        k = self.bases[base] == t
        key, n = np.unique(row[k] * len(self.bases) + base[k], return_counts=True)
        row, base = np.divmod(key, len(self.bases))
        rows, ats = [], []
        for i, level in enumerate(LEVELS):
            hit = (n >= level) & (self.at[base, i] >= 0)
            rows.append(row[hit])
            ats.append(self.at[base[hit], i])
        row, at = np.concatenate(rows), np.concatenate(ats)
        o = np.lexsort((at, row))
        return row[o], at[o]


@dataclass
class Model:
    """What scoring needs; its size is bounded by EXAMPLES and TERMS."""
    known: np.ndarray      # (term, level) pairs, sorted
    idf: np.ndarray
    label: np.ndarray      # of the examples, in the order of the index
    weight: np.ndarray     # of an example's vote: how many labelled rows it stands for
    doc_id: np.ndarray     # evidence
    start: np.ndarray      # postings of term j in block b: start[j * blocks + b] up to the next
    example: np.ndarray
    value: np.ndarray
    block_max: np.ndarray  # (terms, blocks)
    prior: float           # rate of label 1 among examples without terms

    def cosines(self, at: np.ndarray, w: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the examples in some blocks that share a term with the vector."""
        list_of = (at[:, None] * self.block_max.shape[1] + blocks).ravel()
        begin = self.start[list_of]
        size = self.start[list_of + 1] - begin
        run = np.cumsum(size)
        take = np.repeat(begin - run + size, size) + np.arange(run[-1])
        total = np.bincount(self.example[take], self.value[take] * np.repeat(np.repeat(w, len(blocks)), size), minlength=1)
        hit = np.flatnonzero(total)
        return hit, np.round(total[hit], 9)

    def neighbours(self, at: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of the k nearest examples of a unit vector; ties by the order of the index.

        The blocks of the highest bounds give a k-th cosine to beat; of the others
        only those whose bound reaches it are looked at.
        """
        bound = w @ self.block_max[at]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        e, s = self.cosines(at, w, order[:FIRST_BLOCKS]) if len(order) else (np.zeros(0, np.int64), np.zeros(0))
        rest = order[FIRST_BLOCKS:]
        if len(s) >= k:
            rest = rest[bound[rest] >= np.partition(s, -k)[-k] - 1e-8]
        if len(rest):
            e2, s2 = self.cosines(at, w, rest)
            e, s = np.concatenate([e, e2]), np.concatenate([s, s2])
        top = np.lexsort((e, -s))[:k]
        return e[top], s[top]

    def score(self, at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(score, neighbours, cosines) of a text with the terms ``at``."""
        if not len(at):
            return self.prior, at, np.zeros(0)
        w = self.idf[at]
        e, s = self.neighbours(at, w / np.sqrt((w * w).sum()))
        v = s * s * self.weight[e]
        scale = PRIOR_WEIGHT * (self.weight[e].mean() if len(e) else 1.0)
        return float(((v * self.label[e]).sum() + scale * self.prior) / (v.sum() + scale)), e, s


def learnable(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 != 1


def sample(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of at most ``examples`` learnable rows of each label, by hash, and how many rows each label has."""
    l = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
         .where(F.col("label").isin(0, 1)).where(learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")))
    counts = {r["label"]: r["n"] for r in l.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    ids = None
    for y in (0, 1):
        part = l.where(F.col("label") == y).orderBy(order, "doc_id").limit(examples)
        ids = part if ids is None else ids.union(part)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stash(d.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])), counts


def without_copies(examples: DataFrame) -> DataFrame:
    """One example of each group of copies: otherwise all words of a text that was copied often look as if they told the label.

    Copies share the least hash of their three-word sequences under one of two orders.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(1))
            with np.errstate(over="ignore"):
                sets = [s for a, b in pieces(off, PIECE_BYTES) for s in shingle_sets(data[off[a]:off[b]], off[a:b + 1] - off[a], 3)]
                least = [(int(s[0]), int(mix64(s).min())) if len(s) else (0, 0) for s in sets]
            m1, m2 = (pa.array(np.array([m[k] for m in least], U64).view(np.int64)) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, m1, m2], names=["doc_id", "text", "label", "m1", "m2"])

    e = examples.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, text string, label int, m1 long, m2 long")
    for m in ("m1", "m2"):
        e = e.withColumn("rank", F.row_number().over(Window.partitionBy(m).orderBy(F.xxhash64("text"), "doc_id"))).where("rank = 1")
    return stash(e.select("doc_id", "text", "label"))


def _rows_of_terms(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, off = utf8(batch.column(k))
    with np.errstate(over="ignore"):
        for a, b in pieces(off, PIECE_BYTES):
            yield a, b, *terms(data[off[a]:off[b]], off[a:b + 1] - off[a])


def choose_terms(examples: DataFrame, n_pos: int, n_neg: int, most: int = TERMS) -> np.ndarray:
    """The terms whose presence depends most on the label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.array(batch.column(1).to_pylist(), np.int64)
            for a, b, t, row in _rows_of_terms(batch, 0):
                key = np.lexsort((row, t))
                t, row = t[key], row[key]
                first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (row[1:] != row[:-1])])) if len(t) else np.zeros(0, np.int64)
                n, t, row = np.diff(np.append(first, len(t))), t[first], row[first]
                for level in LEVELS.tolist():
                    k = n >= level
                    u, i = np.unique(t[k], return_inverse=True)
                    pos = np.bincount(i, weights=y[a:b][row[k]], minlength=len(u))
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.full(len(u), level)), pa.array(pos),
                                                      pa.array(np.bincount(i, minlength=len(u)) - pos)], names=["t", "level", "pos", "neg"])

    t = examples.select("text", "label").mapInArrow(run, "t long, level long, pos double, neg double")
    t = t.groupBy("t", "level").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") + F.col("neg") >= LEAST_DF)
    p, q = F.col("pos"), F.col("neg")
    n = float(n_pos + n_neg)
    rest = F.greatest(n - p - q, F.lit(0.5))
    chi = n * F.pow(p * (n_neg - q) - q * (n_pos - p), F.lit(2.0)) / ((p + q) * rest * float(max(1, n_pos)) * float(max(1, n_neg)))
    best = t.withColumn("chi", chi).where(F.col("chi") >= CHI_SQUARE).orderBy(F.desc("chi"), "t", "level").limit(most).select("t", "level").collect()
    known = np.empty(len(best), KNOWN)
    known["t"], known["level"] = np.array([x["t"] for x in best], np.int64).view(U64), [x["level"] for x in best]
    return np.sort(known, order=["t", "level"])


def document_frequencies(docs: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all documents each term is, and how many documents there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, df, n = Lookup(known), np.zeros(len(known), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, t, row in _rows_of_terms(batch, 0):
                df += np.bincount(find(t, row)[1], minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(known)), -1)), pa.array(np.append(df, n))], names=["j", "n"])

    got = docs.select(F.col("text").cast("string")).mapInArrow(run, "j long, n long").groupBy("j").agg(F.sum("n").alias("n")).collect()
    by = {r["j"]: r["n"] for r in got}
    return np.array([by.get(j, 0) for j in range(len(known))], np.float64), by.get(-1, 0)


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, most_terms: int = TERMS) -> Model:
    """A model from the learnable labelled rows. Without any, every score is 0.5; with one label only, all votes are for it."""
    chosen, counts = sample(docs, labels, examples)
    chosen = without_copies(chosen)
    left = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = left.get(1, 0), left.get(0, 0)
    known = choose_terms(chosen, n_pos, n_neg, most_terms)
    df, n = document_frequencies(docs, known)
    idf = np.log((1 + n) / (1 + df)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(known)
        for batch in batches:
            for a, b, t, row in _rows_of_terms(batch, 2):
                r, at = find(t, row)
                cut = np.searchsorted(r, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(at, pa.int64()))], names=["doc_id", "label", "at"])

    rows = (chosen.withColumn("_h", F.xxhash64("text")).orderBy("_h", "doc_id").select("doc_id", "label", "text")
            .mapInArrow(vectors, "doc_id long, label int, at array<long>").collect())
    per = {y: counts.get(y, 0) / max(1, sum(r["label"] == y for r in rows)) for y in (0, 1)}
    ones = sum(per[1] for r in rows if r["label"] == 1 and not r["at"])
    zeros = sum(per[0] for r in rows if r["label"] == 0 and not r["at"])
    prior = (ones + 0.5) / (ones + zeros + 1) if rows else 0.5
    rows = [r for r in rows if r["at"]]
    rows.sort(key=lambda r: (min(r["at"]), len(r["at"])))  # alike examples share blocks, which makes the bounds tight
    size = np.array([len(r["at"]) for r in rows], np.int64)
    term = np.array([j for r in rows for j in r["at"]], np.int64)
    w = idf[term]
    ex = np.repeat(np.arange(len(rows)), size)
    w = w / np.sqrt(np.bincount(ex, weights=w * w, minlength=max(1, len(rows))))[ex] if len(term) else w
    o = np.lexsort((ex, term))
    term, ex, w = term[o], ex[o], w[o]
    blocks = max(1, -(-len(rows) // BLOCK))
    block_max = np.zeros((len(known), blocks))
    np.maximum.at(block_max, (term, ex // BLOCK), w)
    label = np.array([r["label"] for r in rows], np.float64)
    return Model(known, idf, label, np.array([per[r["label"]] for r in rows]), np.array([r["doc_id"] for r in rows], np.int64),
                 np.searchsorted(term * blocks + ex // BLOCK, np.arange(len(known) * blocks + 1)), ex, w, block_max, float(prior))


def score(docs: DataFrame, model: Model, text: str = "text", evidence: bool = True) -> DataFrame:
    """``docs`` with ``score`` and ``evidence`` array<struct<doc_id, similarity, label>>, the neighbours that voted.

    The whole text alone decides the score; null and empty texts have the prior.
    Equal texts score alike, an empty table gives no rows, and columns with
    these two names are replaced.
    """
    names = [c for c in docs.columns if c not in ("score", "evidence")]
    s = _scored(pack(docs, text=column(text).cast("string")), model, evidence)
    return s.select(*[F.col("row").getField(c).alias(c) for c in names], "score", *(["evidence"] if evidence else []))


def _scored(d: DataFrame, model: Model, evidence: bool) -> DataFrame:
    """(row, score, evidence) of packed rows (row, text)."""
    from pyspark.sql import types as T
    of = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("label", T.IntegerType())])
    extra = [T.StructField("score", T.DoubleType()), *([T.StructField("evidence", T.ArrayType(of))] if evidence else [])]
    shared = d.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, none = shared.value, np.zeros(0, np.int64)
        find = Lookup(m.known)
        for batch in batches:
            for a, b, t, row in _rows_of_terms(batch, 1):
                r, at = find(t, row)
                out, why = np.full(b - a, m.prior), [(none, np.zeros(0))] * (b - a)
                first = np.flatnonzero(np.diff(r, prepend=-1))
                for x, y in zip(first.tolist(), np.append(first, len(r))[1:].tolist()):
                    out[r[x]], *why[r[x]] = m.score(at[x:y])
                cols = [batch.column(0).slice(a, b - a), pa.array(out, pa.float64())]
                if evidence:
                    e, s = (np.concatenate([v[i] for v in why]) for i in (0, 1))
                    e = e.astype(np.int64)
                    cut = np.cumsum([0, *(len(v[0]) for v in why)])
                    rows = pa.StructArray.from_arrays([pa.array(m.doc_id[e]), pa.array(s), pa.array(m.label[e].astype(np.int32))],
                                                      names=["doc_id", "similarity", "label"])
                    cols.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows))
                yield pa.RecordBatch.from_arrays(cols, names=["row", *(f.name for f in extra)])

    return d.mapInArrow(run, T.StructType([d.schema["row"], *extra]))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; the model is fitted on ``docs`` themselves."""
    model = fit(docs, labels)
    return _scored(pack(docs, text=F.col("text").cast("string")), model, False).where(F.col("score") < threshold).select("row.*")


def query(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    s = score(docs.select("doc_id", "text"), fit(docs, labels))
    return s.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"),
                    F.transform("evidence", lambda x: x["doc_id"]).alias("nearest"))
