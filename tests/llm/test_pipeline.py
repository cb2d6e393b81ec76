"""The stages of the corpus pipeline on a small folder, each held against what it says it does."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from churnkit.llm.common import store
from churnkit.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(store(stage(spark, out[-1], FOLDER), "test_pipeline"))
    return out


def test_columns_and_stages(steps):
    assert len(pipeline.STAGES) == 5
    for kept in steps[:-1]:
        assert kept.columns == steps[0].columns
    sizes = [s.count() for s in steps]
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0


def test_filters_take_out_rejected_documents_only(steps, spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = labels.filter("quality = 1 and toxic = 0").select("doc_id")
    before, after = steps[0].join(good, "doc_id").count(), steps[1].join(good, "doc_id").count()
    assert after >= 0.95 * before
    assert steps[2].exceptAll(steps[1]).count() == 0 and steps[1].exceptAll(steps[0]).count() == 0


def test_one_document_of_each_group_stays(steps):
    def sets(df):
        out = {}
        for r in df.select("doc_id", "text").collect():
            words = r["text"].encode().lower().split()
            out[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
        return out

    before, after = sets(steps[2]), sets(steps[3])
    near = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    up = {i: i for i in before}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(before)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if near(before[a], before[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert set(after) == {root(i) for i in ids}


def test_mix_takes_effect(steps):
    ratio = steps[4].agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] / steps[3].agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    assert 1.2 < ratio < 1.8
    assert steps[4].groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2


def test_ids_of_every_copy(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r["doc_id"], library.encode(r["text"], add_special_tokens=False).ids) for r in steps[4].collect())
    assert sorted((r["doc_id"], r["ids"]) for r in steps[5].collect()) == want


def test_run_gives_the_last_stage(spark, steps):
    assert pipeline.run(spark, FOLDER).count() == steps[5].count()


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_on_odd_rows(spark, docs, texts):
    """Null ids, texts, languages and sources, empty and very long texts, repeated rows and clashing columns go through all stages."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 1000)
    clashing = [c for c in docs.columns if c not in pipeline.COLUMNS]
    both = docs.unionByName(given.select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in clashing]))
    kept = [store(both, "odd")]
    for _, stage in pipeline.STAGES[:-1]:
        kept.append(store(stage(spark, kept[-1], FOLDER), "odd"))
        assert kept[-1].columns == pipeline.COLUMNS
    assert all(b.select("doc_id", "text").distinct().exceptAll(a.select("doc_id", "text").distinct()).count() == 0 for a, b in zip(kept, kept[1:]))
    ids = pipeline.STAGES[-1][1](spark, kept[-1], FOLDER)
    assert ids.count() == kept[-1].count()
    # The join alone, on all rows: one of each repeated row, and no exact copy of a kept text under another id or none.
    single = pipeline.distinct(spark, kept[0], FOLDER).collect()
    worded = [r["text"] for r in single if r["text"] and r["text"].split()]
    assert len(worded) == len(set(worded))
    assert sum(r["doc_id"] is None for r in single) == sum(t[0] is None for t in texts)
    assert {r["doc_id"] for r in single} >= {80, 81, 82}


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_stages_on_an_empty_table(spark, no_docs, stage):
    out = stage(spark, no_docs.select(*pipeline.COLUMNS), FOLDER)
    assert out.count() == 0
