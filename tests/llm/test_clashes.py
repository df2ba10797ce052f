"""Columns whose names the operators use themselves, and operators compared with plain rereadings."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm.bpe import default_pattern, default_rank_file, encode_documents
from tallyframe.llm.decontam import contaminated
from tallyframe.llm.linededup import dedup_lines
from tallyframe.llm.sharding import assign_shards
from tallyframe.llm.toxicity import CATEGORIES, ChainSpec, fit_toxicity, score_toxicity, terms_of


def docs_with(spark, names, rows=((1, "a b"), (2, "a b"), (3, None))):
    df = spark.createDataFrame(list(rows), "doc_id long, text string")
    return df.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id")).alias(n) for n in names])


def untouched(out, names):
    for r in out.collect():
        for n in names:
            assert r[n] == f"{n} of {r.doc_id}"


def test_line_dedup_keeps_columns_named_like_its_own(spark):
    names = ["__line_gone", "__line_all", "__line_own", "rest", "whole", "gone", "lines", "keeper", "h1", "own_id"]
    shared = "a line that is long enough to be counted as shared by all of them"
    df = docs_with(spark, names, [(i, f"own {i}\n{shared}") for i in range(6)])
    out = dedup_lines(df)
    untouched(out, names)
    assert {r.doc_id: r.n_dropped for r in out.collect()} == {i: int(i < 5) for i in range(6)}
    again = dedup_lines(docs_with(spark, ["N_LINES"]))
    assert [c for c in again.columns if c.lower() == "n_lines"] == ["n_lines"]


def test_sharding_keeps_columns_named_like_its_own(spark):
    names = ["__hash", "__slice", "__id", "__salt", "__start", "__rest", "n"]
    out = assign_shards(docs_with(spark, names), 2)
    untouched(out, names)
    assert [c for c in assign_shards(docs_with(spark, ["SLOT"]), 2).columns if c.lower() == "slot"] == ["slot"]


def test_bpe_keeps_columns_named_like_its_own(spark):
    pytest.importorskip("public_tokenizers")
    out = encode_documents(docs_with(spark, ["__source", "N_TOKENS", "IDS"]), default_rank_file(), default_pattern(), digests=True)
    untouched(out, ["__source"])
    assert sorted(c.lower() for c in out.columns) == sorted(["doc_id", "text", "__source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]) or "text" not in out.columns
    assert {r.doc_id: r.decoded_sha256 for r in out.collect()}[3] == hashlib.sha256(b"").hexdigest()


def test_quality_stage_leaves_a_column_named_score(spark, tmp_path):
    df = docs_with(spark, ["__score", "__source", "__SCORE_"], [(i, f"some plain words of text {i} " * 8) for i in range(20)])
    spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.keep_quality(spark, df, str(tmp_path))
    assert out.columns == df.columns
    untouched(out, ["__score", "__source", "__SCORE_"])


def test_texts_of_one_id_are_decontaminated_apart(spark):
    item = " ".join(f"bench{i}" for i in range(20))
    clean = " ".join(f"plain{i}" for i in range(30))
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    for texts in ([clean, item], [item, clean], [f"{clean} {item}", item]):
        for order in (1, 3):
            df = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string").repartition(order)
            assert {(r.doc_id, r.item, r.words) for r in contaminated(df, bench).collect()} == {(7, 9, 20)}


def test_chain_scores_equal_summing_weights_by_hand(spark):
    texts = [("vile hate " if i % 3 == 0 else "kind calm ") + f"word{i % 7} " + ("$$ junk " if i % 2 else "prose ") for i in range(240)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    chain = fit_toxicity(df, labels, spec=ChainSpec(steps=60))
    assert chain.names == list(CATEGORIES) and any(np.abs(m.earlier).sum() > 0 for m in chain.models)
    for r in score_toxicity(df, chain).collect():
        logits = []
        for name, model in zip(chain.names, chain.models):
            z = model.constant + sum(model.words[chain.terms[t]] for t in terms_of(texts[r.doc_id]) if t in chain.terms)
            z += sum(w * x for w, x in zip(model.earlier, logits))
            logits.append(min(max(z, -30), 30))
            assert r[name] == pytest.approx(1 / (1 + np.exp(-logits[-1])), abs=1e-12)
        assert (r.toxic >= 0.5) == (r.doc_id % 3 == 0)
