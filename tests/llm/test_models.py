"""Toxicity and quality: held-out accuracy, features by hand, learning by brute force."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import docs_of, odd_documents, texts_of

from limitlens.llm import quality, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def ranked(scores, labels):
    """Area under the curve; ties count half."""
    good, bad = scores[labels == 1], scores[labels == 0]
    return np.mean((good[:, None] > bad) + 0.5 * (good[:, None] == bad))


@pytest.mark.parametrize("name, label, area", [("op1_toxicity", "toxic", 0.85), ("op5_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, area):
    found = queries.QUERIES[name](spark, SF_DIR).collect()
    docs = texts_of(SF_DIR)
    assert sorted(r["doc_id"] for r in found) == sorted(i for i, _ in docs)
    threshold = 0.5 if label == "toxic" else 0.3
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    labels = dict(texts_of(SF_DIR, "labels", f"doc_id, {label}"))
    held = [(r["score"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    scores, truth = map(np.asarray, zip(*held, strict=True))
    assert ranked(scores, truth) >= area


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("model, label", [(toxicity.toxicity, 2), (quality.quality, 1)])
def test_odd_documents_and_labels(spark, model, label):
    df, rows = odd_documents(spark)
    one_class = [(i, 1, 0) for i in range(1, 9)]
    odd = [(None, 1, 1), (99, 0, 1), (3, None, None), (4, 7, 7), (1, 1, 0), (1, 1, 0)]
    mixed = [(i, i % 2, i % 2) for i in range(1, 12)] + odd
    for labels in ([], one_class, mixed):
        found = model(df, labels_of(spark, labels)).collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in rows)
        assert all(0 <= r["score"] <= 1 for r in found)
        assert all(r["held_out"] for r in found if r["doc_id"] is None)
    assert model(df.limit(0), labels_of(spark, mixed)).collect() == []


def test_the_held_out_fold_is_never_learned(spark):
    docs = [(i, f"text {i} of a kind") for i in range(200)]
    labels = [(i, i % 2, i % 2) for i in range(200)]
    sample = toxicity.training_sample(docs_of(spark, docs), labels_of(spark, labels), "toxic", 10_000).collect()
    assert {r["doc_id"] for r in sample} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    few = toxicity.training_sample(docs_of(spark, docs), labels_of(spark, labels), "toxic", 60).count()
    assert 30 < few < 100


def test_several_labels_of_one_document_in_any_order(spark):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(40)])
    labels = [(i, 0, int(k < i % 4)) for i in range(40) for k in range(3)]  # 0 to 3 of three labels are 1
    ties = [(i, 0, k) for i in range(40, 44) for k in (0, 1)]
    docs = docs.union(docs_of(spark, [(i, "tie") for i in range(40, 44)]))
    drawn = []
    for order in (labels + ties, (labels + ties)[::-1]):
        sample = toxicity.training_sample(docs, labels_of(spark, order).repartition(3), "toxic", 10_000)
        drawn.append({r.doc_id: r.label for r in sample.collect()})
    assert drawn[0] == drawn[1] and all(v == int(i < 40 and i % 4 >= 2) for i, v in drawn[0].items())


def test_features_by_hand():
    f = toxicity.Featurizer([("zorb", False), ("blick", True)])
    names = dict(zip(toxicity.FEATURES, f("You idiot! zorbish blickx blick aidiot"), strict=True))
    assert names["log_public"] == np.log1p(1) and names["log_learned"] == np.log1p(2)
    assert names["near_person"] == 1.0 and names["exclaims"] > 0
    hidden = dict(zip(toxicity.FEATURES, f("an 1d10t and an i.d.i.o.t here"), strict=True))
    assert hidden["hidden_rate"] > 0 and hidden["obfuscated"] > 0 and hidden["log_public"] == 0
    assert f("") == [0.0] * len(toxicity.FEATURES)


def test_terms_that_mark_toxic_documents(spark):
    rows = [(f"plain words {i} vexolith{i % 7}", 1) for i in range(30)] + [(f"plain words {i}", 0) for i in range(90)]
    sample = spark.createDataFrame(rows, "text string, label int")
    terms = toxicity.learn_terms(sample)
    assert ("vexo", False) in terms and ("plain", True) not in terms


def test_ftrl_by_the_plain_recurrence():
    rows = [(i, i, text, y) for i, (text, y) in enumerate([("a b c", 1), ("a a %%%", 0), ("b c d", 1), ("%%% x", 0)])]
    group = pa.table(dict(zip(["doc_id", "order", "text", "label"], zip(*rows, strict=True), strict=True)))
    state = quality._pass_over(None, None)(group)
    z, n = np.zeros(1 << quality.BITS), np.zeros(1 << quality.BITS)
    for _, _, text, label in rows:
        slots, values = quality.features(text)
        w = {}
        for s in slots:
            rate = (quality.BETA + np.sqrt(n[s])) / quality.ALPHA + quality.L2
            w[s] = 0.0 if abs(z[s]) <= quality.L1 else -(z[s] - np.sign(z[s]) * quality.L1) / rate
        p = 1 / (1 + np.exp(-sum(w[s] * v for s, v in zip(slots, values, strict=True))))
        old = n.copy()
        for s, v in zip(slots, values, strict=True):
            g = (p - label) * v
            z[s] += g - (np.sqrt(old[s] + g * g) - np.sqrt(old[s])) / quality.ALPHA * w[s]
            n[s] += g * g
    assert np.allclose(np.frombuffer(state["z"][0].as_py()), z)
    assert np.allclose(np.frombuffer(state["n"][0].as_py()), n)
