"""The classifier's parts against plain versions, calibration, unseen scripts and null ids."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from cartwise.llm import language as L
from cartwise.llm.common import ship_package

SF = "/root/testdata/sf0.01"


def test_ftrl_equals_a_plain_version(monkeypatch):
    monkeypatch.setattr(L, "L1", 0.3)
    rng, classes = np.random.default_rng(1), 3
    rows = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4), int(rng.integers(classes))) for _ in range(40)]
    weights, bias = L.ftrl(rows, classes)
    z, s = {}, {}

    def weight(i, k):
        total, l1 = z.get((i, k), 0.0), 0.0 if i == "bias" else L.L1
        if abs(total) <= l1:
            return 0.0
        return -(total - math.copysign(l1, total)) / ((L.BETA + math.sqrt(s.get((i, k), 0.0))) / L.ALPHA + L.L2)

    for _ in range(L.EPOCHS):
        for at, x, label in rows:
            values = {int(i): float(v) for i, v in zip(at, x, strict=True)} | {"bias": 1.0}
            w = {(i, k): weight(i, k) for i in values for k in range(classes)}
            e = [math.exp(sum(v * w[i, k] for i, v in values.items())) for k in range(classes)]
            for k in range(classes):
                for i, v in values.items():
                    g, before = v * (e[k] / sum(e) - (k == label)), s.get((i, k), 0.0)
                    z[i, k] = z.get((i, k), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / L.ALPHA * w[i, k]
                    s[i, k] = before + g * g
    plain = np.array([[weight(i, k) for k in range(classes)] for i in range(12)])
    assert np.allclose(weights[:12], plain, atol=1e-10) and not weights[12:].any()
    assert np.allclose(bias, [weight("bias", k) for k in range(classes)], atol=1e-10)
    assert (plain == 0).any() and (plain != 0).any()


@pytest.mark.parametrize("wrong", [0, 3])
def test_temperature_equals_the_best_of_a_grid(wrong):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 4, 60)
    z = rng.normal(0, 0.05, (60, 4)) + np.eye(4)[y]  # separable, as on easy held-out rows
    y[:wrong] = (y[:wrong] + 1) % 4

    def loss(t):
        total = 0.0
        for row, label in zip(z, y, strict=True):
            p = np.exp(row / t) / np.exp(row / t).sum()
            target = np.full(4, 1 / 62 / 3)
            target[label] = 61 / 62
            total -= float(target @ np.log(p))
        return total

    grid = np.exp(np.linspace(-4, 2, 1201))
    best = grid[int(np.argmin([loss(t) for t in grid]))]
    assert L.calibrate(list(z), list(y)) == pytest.approx(best, rel=0.01)


def test_temperature_without_anything_to_learn_from():
    assert L.calibrate([], []) == 1.0
    assert L.calibrate([np.array([2.0])] * 3, [0, 0, 0]) == 1.0
    assert L.calibrate([np.zeros(2)] * 3, [0, 1, 0]) == 1.0
    with pytest.warns(UserWarning, match="bound"):
        L.calibrate([np.array([1.0, 0.0])] * 9, [1] * 9)


@pytest.fixture(scope="module")
def learned(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, L.train_on_documents(docs)


def test_temperature_lies_inside_its_range(learned):
    assert -L.LOG_TEMPERATURE + 1 < math.log(learned[1].temperature) < L.LOG_TEMPERATURE - 1


def test_document_frequencies_cover_all_labelled_rows(learned):
    docs, model = learned
    rows = [r.text for r in docs.where(~L.held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).collect() if L.has_letter(r.text)]
    df = np.zeros(L.FEATURES)
    for text in rows:
        df[list(set(L._grams(text).tolist()))] += 1
    seen = df > 0
    assert np.allclose(model.idf[seen], np.log((1 + len(rows)) / (1 + df[seen])) + 1) and not model.idf[~seen].any()


def test_scripts_that_were_not_learned_go(spark, learned, monkeypatch):
    docs, model = learned
    monkeypatch.setattr(L, "train_on_documents", lambda docs: model)
    foreign = ["これは日本語の文章です。", "Это предложение на русском языке.", "هذه جملة باللغة العربية"]
    assert [model.predict(t)[1] for t in foreign] == [0.0] * 3
    assert all(model.predict(t)[0] in model.languages for t in foreign)
    added = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(foreign)], "doc_id long, text string")
    kept = P.identify_language(spark, docs.unionByName(added, allowMissingColumns=True), "").select("doc_id").collect()
    assert min(r.doc_id for r in kept) >= 0
    assert len(kept) == docs.where(L.with_letter(F.col("text"))).count()


def test_null_ids_are_drawn_by_their_texts(spark, monkeypatch):
    monkeypatch.setattr(L, "SAMPLE_ROWS", 40)
    rows = [(None, f"the cat number {chr(97 + i % 26)}{chr(97 + i // 26)} sat", "en") for i in range(300)] + [(None, f"die katze {chr(97 + i % 26)}{chr(97 + i // 26)} sitzt", "de") for i in range(300)]
    docs = spark.createDataFrame(rows + [(None, "the same text", "en")] * 300, "doc_id long, text string, lang string")
    held = []
    monkeypatch.setattr(L, "calibrate", lambda logits, labels: held.append(len(labels)) or 1.0)
    L.train(docs)
    assert held[0] <= 40
