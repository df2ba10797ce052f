"""The pipeline's stages on a small corpus, and every registered query on the smallest tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import queries  # noqa: F401
from tallyframe.llm.registry import QUERIES, SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=60):
    r = random.Random(seed)
    syllables = "ka lo mi tu re sa no vi de pa".split()
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = [(i, prose(i, 40 + 3 * i)) for i in range(200)]
    docs += [(1000 + i, " ".join(w + "$$$" for w in prose(i, 20 + 9 * i).split())) for i in range(100)]
    shared = "a line of some length that stands in many of the documents"
    docs += [(2000 + i, prose(2000 + i) + "\n" + shared) for i in range(8)]
    docs += [(3000, prose(5, 55)), (3001, prose(6, 58).replace(" ", "  ")), (3002, prose(5, 55) + " one")]
    docs += [(4000, prose(4000) + " " + prose(9000, 20) + " " + prose(4001))]
    docs += [(5000, None), (5001, ""), (None, prose(5002)), (5003, prose(5003, 30_000)), (5004, prose(5004)), (5004, prose(5004))]
    rows = [(i, t, None if i == 7 else "en", "s", None if t is None else len(t)) for i, t in docs]
    labels = [(i, int(i < 1000), 0) for i, _ in docs if i is not None and i < 2000] + [(3, None, None), (None, 1, 0)]
    spark.createDataFrame(rows, SCHEMA).withColumn("features", F.lit("extra")).withColumn("key", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(9000, 20)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_takes_effect_and_spares_the_rest(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    before = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, corpus).cache()
        assert sorted(after.columns) == sorted(docs.columns), name
        seen[name] = {r.doc_id: r.text for r in after.collect()}
        gone = {r.doc_id for r in before.collect()} - set(seen[name])
        if name == "quality":
            assert gone and all(i is not None and 1000 <= i < 2000 for i in gone - {5000, 5001}) and len(gone) >= 98
        elif name == "line_dedup":
            assert not gone
            assert sum("a line of some length" in t for t in seen[name].values()) == 1
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif name == "near_dedup":
            assert gone == {3000, 3001, 3002}
        else:
            assert gone == {4000}
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, corpus).collect()
    assert {r.doc_id for r in last} == set(seen["decontamination"])
    for r in last:
        assert r.decoded_sha256 == hashlib.sha256((seen["decontamination"][r.doc_id] or "").encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert {5004, 2007, None} <= {r.doc_id for r in rows}
    assert not {3000, 4000, 1001} & {r.doc_id for r in rows}


def test_empty_corpus(spark, corpus):
    none = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, corpus).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_given_tables(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    if name not in SQL:
        tables = {"op5_embedding_dedup": "embeddings", "op9_html_extraction": "pages"}
        assert len(got) == spark.read.parquet(f"{sf_dir}/{tables.get(name, 'documents')}.parquet").count()
        return
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(cursor.fetchall())
