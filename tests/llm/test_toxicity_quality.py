"""Operators 5 and 7: held-out accuracy, exact neighbours, and plain counts."""
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackscene.llm import quality, toxicity
from trackscene.llm.common import utf8

from ..conftest import SF_CHECK, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ operator 5
@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_rows_are_told_apart(tables):
    docs, labels = tables
    r = toxicity.query(docs, labels)
    assert r.count() == docs.count() and r.where("score < 0 or score > 1").count() == 0
    j = r.join(labels, "doc_id").where("held_out")
    got = {(x["toxic"], x["predicted"]): x["count"] for x in j.groupBy("toxic", "predicted").count().collect()}
    assert got.get((0, 1), 0) <= 1 and got.get((1, 1), 0) >= 0.75 * (got.get((1, 1), 0) + got.get((1, 0), 0))


def test_labels_of_held_out_rows_are_not_used(tables):
    """Turned labels of held-out rows change no score."""
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(toxicity.learnable(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.query(docs, x).select("doc_id", "score").orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_neighbours_equal_brute_force(tables, model, monkeypatch):
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", 1)
    dense, blocks = np.zeros((len(model.label), len(model.known))), model.block_max.shape[1]
    for j in range(len(model.known)):
        a, b = model.start[[j * blocks, (j + 1) * blocks]]
        dense[model.example[a:b], j] = model.value[a:b]
    assert np.allclose(np.linalg.norm(dense, axis=1), 1)
    texts = [r["text"] for r in tables[0].orderBy("doc_id").collect()]
    find, tested = toxicity.Lookup(model.known), 0
    with np.errstate(over="ignore"):
        for t in texts:
            data, off = utf8(pa.array([t]))
            _, at = find(*toxicity.terms(data, off))
            if not len(at):
                continue
            w = model.idf[at]
            w = w / np.sqrt((w * w).sum())
            cos = np.round(dense[:, at] @ w, 9)
            want = [(e, cos[e]) for e in np.lexsort((np.arange(len(cos)), -cos))[:toxicity.NEIGHBOURS] if cos[e] > 0]
            e, s = model.neighbours(at, w)
            assert np.allclose(s, [c for _, c in want], atol=1e-8)
            strict = [i for i, c in want if c > want[-1][1] + 1e-8]
            assert strict == e.tolist()[:len(strict)]
            tested += 1
    assert tested > 50


def test_terms_of_a_row_do_not_depend_on_its_neighbours():
    texts = ["Idiot, you?", "", "idiots and IDIOT", "é", "x" * 1000]
    with np.errstate(over="ignore"):
        t, row = toxicity.terms(*utf8(pa.array(texts)))
        for k, x in enumerate(texts):
            assert sorted(t[row == k].tolist()) == sorted(toxicity.terms(*utf8(pa.array([x])))[0].tolist())


def test_odd_tables(spark, make, clashing, odd_rows, model, tables):
    s = toxicity.score(clashing(make(odd_rows)), model)
    assert s.count() == len(odd_rows) and s.where("text is null").select("score").first()[0] == model.prior
    assert s.where("size != 'own size'").count() == 0
    labels = spark.createDataFrame([(1, None, 1), (2, 1, 0), (None, 1, 1), (6, 1, None), (6, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    docs = clashing(make(odd_rows))
    out = toxicity.reject(docs, labels)
    assert out.columns == docs.columns
    none = labels.where("doc_id > 1000")
    assert [r["score"] for r in toxicity.query(make([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert toxicity.query(make([]), none).count() == 0


# ------------------------------------------------------------------ operator 7
def plain_counts(t):
    w = WORD.findall(t or "")
    three = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(three)
    covered = {k for i, x in enumerate(three) if n[x] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in t or "")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_counts_equal_plain_ones(spark, make, odd_rows):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(10000 + i, r[1]) for i, r in enumerate(odd_rows)]
    rows += [(20000, "a b c a b c a b c " * 40), (20001, "a a a a"), (20002, "x\n\nx\n x\n\x0b\nx"), (20003, "# * | a | b"), (20004, "a b c d a b c"),
             (20005, "a b   c")]
    got = {r["doc_id"]: r for r in quality.query(make(rows)).collect()}
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_counts(t), (i, t[:80] if t else t)
        assert not (r["kept"] and r["base_failed"])


def test_clean_rows_are_kept_and_junk_goes(spark):
    docs, labels = spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    j = quality.query(docs).join(labels, "doc_id").where("not base_failed")
    rate = {r["quality"]: r["k"] for r in j.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.97 and rate[0] < 0.35, rate


def test_rules_table(spark, make, clashing, odd_rows):
    docs = clashing(make(odd_rows))
    out = quality.apply_rules(docs, (("words", 3, 10), ("symbol_word_ratio", None, 0.1)))
    assert [c for c in docs.columns if c not in ("n_words", "kept")] == out.columns[:len(docs.columns) - 2]
    broken = {r["text"]: r["broken"] for r in out.collect()}
    assert broken[None] == ["words"] and broken["another text under the same id"] == [] and broken["one"] == ["words"]
    assert quality.apply_rules(make([])).count() == 0


def test_no_user_function_in_the_plan(spark):
    plan = quality.query(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
