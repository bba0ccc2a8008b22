"""The pipeline: each stage against a plain version on its own input, and the whole against the stages."""
import base64
import hashlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from trackscene.llm import toxicity

from ..conftest import SF_SMALL
from .test_mix_exact import WS, plain_groups, plain_targets
from .test_ngram_substring import WORD, plain_components


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "mix_sources", "byte_bpe"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, held = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL).cache()
        if name != "byte_bpe":
            assert out.columns == columns
        held.append((name, docs, out))
        docs = out
    for name, before, after in held:
        rows = {r["doc_id"]: r["text"] for r in before.collect()}
        ids = sorted(r["doc_id"] for r in after.select("doc_id").collect())
        if name == "toxicity":
            s = toxicity.query(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
            assert ids == sorted(r["doc_id"] for r in s.where("predicted = 0").collect()) and 0 < len(ids) < len(rows)
        if name == "exact_dedup":
            assert ids == sorted(g[0] for g in plain_groups(list(rows.items())) if g[3])
        if name == "ngram_jaccard":
            assert ids == sorted(i for i, n, c in plain_components(list(rows.items())) if i == c)
        if name == "mix_sources":
            sizes, source = {}, {r["doc_id"]: r["source"] for r in before.collect()}
            for i, t in rows.items():
                sizes[source[i]] = sizes.get(source[i], 0) + len(WORD.findall(t))
            target = plain_targets(sizes)
            for i in rows:
                rate = target[source[i]] / sizes[source[i]] if sizes[source[i]] else 0
                draw = int(hashlib.md5(f"mix|{i}".encode()).hexdigest()[:8], 16) / 2**32
                near = abs(draw - (rate - int(rate))) < 1e-9
                assert near or ids.count(i) == int(rate) + (draw < rate - int(rate))
        if name == "byte_bpe":
            import tiktoken
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(corpus_pipeline.RANKS), "rb"))}
            t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
            for r in after.collect():
                want = t.encode_ordinary(rows[r["doc_id"]])
                assert r["ids"] == want and r["n_tokens"] == len(want)
                assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
                assert r["decoded_sha256"] == hashlib.sha256(rows[r["doc_id"]].encode()).hexdigest()
    whole = E.queries()["pipeline"](spark, SF_SMALL)
    cols = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, whole.select(*cols).collect())) == sorted(map(tuple, docs.select(*cols).collect()))
    assert whole.select(F.sum("n_tokens")).first()[0] > 0 and WS.sub("", " a ") == "a"


def test_queries_are_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
