"""The corpus pipeline stage by stage against plain versions, on awkward documents."""

import collections

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import bestfit, pu_quality
from tidemark.llm.common import shared_path

ITEMS = [(1, "the cat sat on the mat and the dog ran after the red ball in the park")]


@pytest.fixture(scope="module")
def tables(spark):
    path = shared_path(spark, "pipeline-tables")
    docs = [r for r in brute.awkward_documents() if len(r[1] or "") < 50_000]
    docs += [(500 + i, " ".join(f"plain{(i * 7 + k * k) % 97}" for k in range(30)) + ".", "en", "h", 0) for i in range(30)]
    docs += [(600 + i, " ".join(f"bad{(i * 5 + k * k) % 89}$$$" for k in range(30)), "en", "h", 0) for i in range(10)]
    docs += [(700 + i, " ".join(f"plain{(i * 11 + k * k) % 97}" for k in range(40)) + " " + ITEMS[0][1] + ".", "en", "h", 0) for i in range(2)]
    labels = [(700, 1, 0), (701, 1, 0)] + [(500 + i, 1, 0) for i in range(30)] + [(600 + i, 0, 0) for i in range(10)]
    spark.createDataFrame(docs, brute.DOCUMENTS).withColumns({c: F.lit(c) for c in ("uid", "row", "fp", "kept")}).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: collections.Counter(r["doc_id"] for r in df.select("doc_id").collect())

    def step(name, df):
        path = shared_path(spark, name)
        stages[name](spark, df, tables).write.parquet(path)
        return spark.read.parquet(path)

    now = [(r["doc_id"], r["text"]) for r in docs.collect()]
    one = step("quality_rules", docs)
    base = [(d, t) for d, t in now if (m := brute.base_metrics(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]]
    assert one.columns == columns and ids(one) == collections.Counter(d for d, _ in base)

    two = step("quality_classifier", one)
    model = pu_quality.train(one, spark.read.parquet(f"{tables}/labels.parquet"))
    good = [(d, t) for d, t in base if model.scores(np.array([pu_quality.features((t or "").encode(), {})], np.float64))[0] >= 0.3]
    assert two.columns == columns and ids(two) == collections.Counter(d for d, _ in good)

    three = step("near_dedup", two)
    groups = collections.defaultdict(list)
    for d, _, c in brute.near_duplicates(good):
        groups[c].append(d)
    assert three.columns == columns and ids(three) == collections.Counter(min(x for x in g) for c, g in groups.items() if c is not None) + (
        collections.Counter([None]) if None in groups else collections.Counter())

    four = step("decontamination", three)
    left = [(r["doc_id"], r["text"]) for r in three.collect()]
    clean = [(w[0], t) for w, (_, t) in zip(brute.contamination(left, ITEMS), left, strict=True) if not w[5]]
    assert four.columns == columns and ids(four) == collections.Counter(d for d, _ in clean) and len(clean) < len(left)

    five = step("packing", four)
    t = Tokenizer.from_file(bestfit.tokenizer_path())
    want = sorted((d, *p) for d, text in clean for p in brute.pieces(text, t, 2048))
    assert sorted(tuple(r[:5]) for r in five.collect()) == want

    whole = corpus_pipeline.run(spark, tables)
    assert sorted(tuple(r[:5]) for r in whole.collect()) == want


def test_empty_documents(spark):
    path = shared_path(spark, "pipeline-empty")
    for name, schema in (("documents", brute.DOCUMENTS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
