"""Held-out accuracy, training steps against their definitions, odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostvane.llm import langid

COLUMNS = "doc_id long, text string, lang string, score string, held_out string"


def plain_counts(text):
    cleaned = "".join(c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in f" {text.lower()} ")
    while "  " in cleaned:
        cleaned = cleaned.replace("  ", " ")
    out = np.zeros(langid.FEATURES, dtype=np.int64)
    for n in (1, 2, 3):
        for k in range(len(cleaned) - n + 1):
            h = 0
            for step, c in enumerate(cleaned[k : k + n]):
                h = (h ^ ord(c)) * int(langid._FACTORS[step]) & 0xFFFFFFFF
                h ^= h >> 15
            out[h % langid.FEATURES] += 1
    return out


@pytest.mark.parametrize("text", ["", "a", "É", "The quick, brown  fox.\n\n12", "...", "ünïcödé 日本語 🙂", " a  b "])
def test_counts_against_the_definition(text):
    assert (langid.counts(text) == plain_counts(text)).all()


def test_long_texts_in_parts(monkeypatch):
    text = "some words, 1 2 3, más " * 50
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "CHARACTERS_AT_ONCE", 64)
    assert abs(langid.counts(text) - whole).sum() <= 0.1 * whole.sum()


def test_temperature_has_the_smallest_loss():
    rng = np.random.default_rng(1)
    logits, truth = rng.normal(size=(400, 3)) * 4, rng.integers(0, 3, 400)
    truth[:300] = logits[:300].argmax(1)

    def loss(t):
        return -np.log(langid._softmax(logits / t)[np.arange(400), truth]).mean()

    fitted = langid.fit_temperature(logits, truth)
    assert all(loss(fitted) <= loss(t) + 1e-9 for t in np.geomspace(0.05, 20, 200))


def test_weights_are_sparse_and_separate():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(300):
        language = int(rng.integers(0, 2))
        at = np.array([10 + language, 50, int(rng.integers(100, 2000))])
        rows.append((at, np.ones(3) / 3**0.5, language))
    weights = langid.fit_weights(rows, 2)
    assert weights[10, 0] > 0 > weights[10, 1] and weights[11, 1] > 0 > weights[11, 0]
    assert (weights != 0).any(1).sum() < 1000


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    got = langid.predict(docs, model).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang is not None]
    assert len(got) == docs.count() and len(held) > 200
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    right, score = np.array([r.lang_pred == r.lang for r in held]), np.array([r.score for r in held])
    assert abs(right.mean() - score.mean()) < 0.1
    kept = langid.in_known_language(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 0.97 * len(got)


def test_labels_of_held_out_documents_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(langid.remainder("doc_id") == 1, F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.train(docs), langid.train(changed)
    assert a.languages == b.languages and (a.weights == b.weights).all() and a.temperature == b.temperature


def test_odd_input(spark):
    rows = [(None, "hello there", "en", None, None), (2, None, "en", None, None), (3, "", None, None, None), (4, "123 ...", "fr", None, None), (5, "bonjour", "fr", None, None)] * 2
    rows += [(None, None, None, None, None), (6, "hello " * 30_000, "en", None, None)]
    docs = spark.createDataFrame(rows, COLUMNS)
    got = langid.predict(docs, langid.train(docs)).collect()
    assert len(got) == len(rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (2, 3, 4))
    assert all(r.lang_pred in ("en", "fr") for r in got if r.doc_id in (5, 6))
    none = docs.limit(0)
    model = langid.train(none)
    assert model.languages == [] and langid.predict(none, model).collect() == []
    assert {r.lang_pred for r in langid.predict(docs, model).collect()} == {"und"}
    assert langid.in_known_language(docs, model).count() == 0
