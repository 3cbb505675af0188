"""The quality classifier against a plain version, and its indifference to how rows are split."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import llm_brute as brute
from tidemark.llm import pu_quality

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(11)
    vocabulary = ["".join(r.choices("abcdeilnorst", k=r.randint(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        w = r.choices(vocabulary, k=r.randint(10, 60))
        bad = r.random() < 0.35
        text = " ".join(x.upper() + "!!" if bad and r.random() < 0.5 else x for x in w)
        docs.append((i, None if i % 97 == 0 else "" if i % 89 == 0 else text, "en", "s", 0))
        labels.append((i, int(not bad) if r.random() < 0.95 else None, 0))
    docs += [docs[5]] * 200 + [(None, "no id", "en", "s", 0)] * 3          # a fifth of all rows are one row
    return spark.createDataFrame(docs, brute.DOCUMENTS), spark.createDataFrame(labels, LABELS)


def test_equals_a_plain_version(spark, corpus):
    docs, labels = corpus
    made = pu_quality.featured(docs)
    rows = [(r["doc_id"], r["row_hash"], np.frombuffer(r["f"], np.float32)) for r in made.collect()]
    want = {r["doc_id"]: pu_quality.features((r["text"] or "").encode(), {}) for r in docs.collect()}
    assert len(rows) == 1103 and all(np.array_equal(x, want[d]) for d, _, x in rows)
    training = [(d, h, x) for d, h, x in rows if brute.crc_mod(d, 5) != 0]
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    positives = {d: x for d, _, x in training if d in good}
    prior, score = brute.pu_scores([(h, x) for _, h, x in training], list(positives.values()))
    model = pu_quality.train_on(made, labels)
    assert abs(model.prior - prior) < 5e-3
    got = {r["doc_id"]: r["score"] for r in pu_quality.scored(docs, labels).collect()}
    plain = {d: s for (d, _, _), s in zip(rows, score([x for _, _, x in rows]), strict=True)}
    assert max(abs(got[d] - plain[d]) for d in plain) < 0.02


def test_moments_cover_all_rows(spark, corpus):
    made = pu_quality.featured(corpus[0])
    x = np.array([np.frombuffer(r["f"], np.float32) for r in made.collect()], np.float64)
    n, mean, deviation = pu_quality.moments(made.repartition(5))
    assert n == len(x) and np.allclose(mean, x.mean(axis=0), atol=1e-4) and np.allclose(deviation, x.std(axis=0), atol=1e-3)
    assert pu_quality.moments(made.limit(0))[0] == 0


@pytest.mark.parametrize("most", [8000, 150])
def test_same_model_however_the_rows_are_split(spark, corpus, most):
    docs, labels = corpus
    one, two = (pu_quality.train(d, labels, max_unlabelled=most) for d in (docs.coalesce(1), docs.repartition(7)))
    assert one.prior == two.prior and np.allclose(one.weights, two.weights, atol=1e-9)
    assert np.array_equal(one.mean, two.mean) and np.array_equal(one.scale, two.scale)


def test_no_positives_and_no_documents(spark, corpus):
    docs, labels = corpus
    assert pu_quality.train(docs, labels.withColumn("quality", F.lit(0))) is None
    assert pu_quality.train(docs.limit(0), labels) is None
    assert {r["score"] for r in pu_quality.scored(docs, labels.limit(0)).collect()} == {0.5}
